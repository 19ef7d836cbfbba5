"""tidemart: a layered commerce warehouse built from PySpark DataFrame transformations."""

__version__ = "0.1.0"
