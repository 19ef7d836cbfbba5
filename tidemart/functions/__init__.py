"""Column expressions shared by the operators."""

from tidemart.functions.exprs import (  # noqa: F401
    blank_to_null,
    day_column,
    date_key,
    event_identity,
    mean2,
    percent,
    ratio,
    raw_line,
    surrogate_id,
)
