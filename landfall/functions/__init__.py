"""Column expressions.  Every function returns a ``Column`` built from
Spark built-ins, so it stays inside whole-stage code generation."""

from landfall.functions.casts import to_int, to_long, to_text, sas_date, typed_extract_columns
from landfall.functions.labels import (
    strip_quotes, label_code, label_value, clean_value, port_code, state_code, int_code,
)
from landfall.functions.dates import date_parts, year_range
from landfall.functions.periods import in_periods, period_of, period_from_file_name, period_from_path
from landfall.functions.airports import airport_code

__all__ = [
    "to_int", "to_long", "to_text", "sas_date", "typed_extract_columns",
    "strip_quotes", "label_code", "label_value", "clean_value", "port_code", "state_code", "int_code",
    "date_parts", "year_range", "in_periods", "period_of", "period_from_file_name", "period_from_path", "airport_code",
]
