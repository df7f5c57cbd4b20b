from docferry.functions.naming import (
    database_name,
    normalize_columns,
    normalize_text,
    prefix_columns,
    quote,
    snake_case,
)
from docferry.functions.values import as_text, convert_values
from docferry.functions.widths import varchar_type, widen

__all__ = [
    "as_text",
    "convert_values",
    "database_name",
    "normalize_columns",
    "normalize_text",
    "prefix_columns",
    "quote",
    "snake_case",
    "varchar_type",
    "widen",
]
