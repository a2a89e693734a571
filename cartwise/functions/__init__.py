from .coerce import coerce_column, coerce_frame, to_decimal, to_integer, to_timestamp, with_coerced
from .text import export_field, export_line, py_str_timestamp

__all__ = [
    "coerce_column", "coerce_frame", "to_decimal", "to_integer", "to_timestamp", "with_coerced",
    "export_field", "export_line", "py_str_timestamp",
]
