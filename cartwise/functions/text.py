"""Text rendering of values for the pipe-delimited export.

Values print the way Python's ``str`` prints the collected value: NULL is the
empty string, decimals keep their scale (``0.0000``), timestamps print as
``YYYY-MM-DD HH:MM:SS`` plus a six-digit fraction only when it is non-zero.
Fields holding the separator, a quote, CR or LF are quoted with doubled quotes
(minimal quoting).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEP = "|"


def py_str_timestamp(c: Column) -> Column:
    """From the cast to text: ``date_format`` would take a ``timestamp_ntz`` through the session time zone,
    which changes times that a daylight-saving gap skips."""
    text = c.cast("string")  # a fraction is printed without trailing zeros
    fraction = F.rpad(F.substring_index(text, ".", -1), 6, "0")
    return F.when(F.contains(text, F.lit(".")), F.concat(F.substring_index(text, ".", 1), F.lit("."), fraction)).otherwise(text)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return py_str_timestamp(c)
    if isinstance(dtype, T.StringType):
        return c
    return c.cast("string")


def export_field(c: Column, dtype: T.DataType) -> Column:
    text = F.coalesce(_as_text(c, dtype), F.lit(""))
    needs_quote = text.rlike('[|"\\r\\n]')
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(needs_quote, quoted).otherwise(text)


def export_line(fields: list[tuple[Column, T.DataType]]) -> Column:
    # concat_ws would drop NULLs; every field is coalesced to '' first.
    return F.concat_ws(SEP, *[export_field(c, t) for c, t in fields])
