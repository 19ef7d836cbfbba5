"""Pure DataFrame transformations between the layers, and the table writers."""
