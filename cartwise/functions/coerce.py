r"""Lenient coercion to the declared types (JVM-side expressions only).

Rules
-----
- integers: text is parsed as an exact decimal first (so ``'10.0'``, ``' 7\t'``
  and ``'1e3'`` convert; white space at the ends does not count); a value that is not integral, NaN, infinite, junk or
  beyond the target range becomes NULL. Never 0, never truncated.
- decimals: ``try_cast`` to ``decimal(18,4)``; NaN and junk become NULL.
- timestamps: ``try_cast`` to ``timestamp_ntz``; junk becomes NULL.
- anything else: text.

Expressions are produced as SQL text (one JVM call per projection instead of
one per sub-expression); Catalyst sees the same expression trees either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import BIGINT, INT, STR, TS, TableSpec

_WIDE = "decimal(38,18)"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TEXT = (T.StringType, T.VarcharType, T.CharType)


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _stripped(c: str) -> str:
    """Without white space at either end (``trim`` alone takes off spaces only)."""
    return f"trim(both ' \\t\\n\\u000b\\f\\r' from {c})"


# Text forms of numbers, with white space at the ends. A failing try_cast costs an exception inside Spark, tens of
# microseconds a value, so text is cast only where its form says that the cast succeeds.
_WHOLE = r"^\\s*+([+-]?[0-9]++)(?:[.]0*+)?\\s*+$"  # an integer, perhaps with a fraction of zeros
_START = r"^\\s*+[+-]?[.]?[0-9]"
_FRACTION = r"^\\s*+[+-]?[0-9]*+[.]0*+[1-9][0-9]*+\\s*+$"  # plainly no integer
_POWER = r"^\\s*+[+-]?[0-9]{1,9}[eE][+]?[0-9]\\s*+$"  # an integer times a power of ten, of 18 digits at most
_SCALED_UP = r"^\\s*+[+-]?(?=[.]?[0-9])[0-9]{0,20}(?:[.][0-9]{0,18})?[eE][+]?[0-9]\\s*+$"  # exact as decimal(38,18)
_NUMBER = r"^\\s*+[+-]?(?=[.]?[0-9])([0-9]*+)(?:[.]([0-9]*+))?(?:[eE]([+-]?[0-9]++))?\\s*+$"


def _exactly_integral_text(t: str) -> str:
    """True when the text, which matches ``_NUMBER``, is a number whose value is an integer, decided on the digits.

    The value is D x 10^(e - f) for the digit string D (integer and fraction
    digits), fraction length f and exponent e; it is integral when the last
    f - e digits of D are zeros. This avoids the rounding of a decimal cast,
    which would turn '1E-20' into 0.
    """
    ip = f"regexp_extract({t}, '{_NUMBER}', 1)"
    fp = f"regexp_extract({t}, '{_NUMBER}', 2)"
    ex = f"regexp_extract({t}, '{_NUMBER}', 3)"
    k = f"(length({fp}) - coalesce(try_cast(nullif({ex}, '') as int), 0))"
    return (
        f"(({ex} = '' or try_cast({ex} as int) is not null)"
        f" and ({k} <= 0 or not (right(concat({ip}, {fp}), {k}) rlike '[1-9]')))"
    )


def _integer_text_sql(c: str, target: str) -> str:
    """Whole numbers are one extraction (a common subexpression of the generated code) and a cast; a whole number times a power of
    ten is exact as a double; plain fractions are none. What else may be a number goes to a function over an array
    of one: its variable binds the text once, and the generated code stays small."""
    u = f"regexp_extract({c}, '{_WHOLE}', 1)"
    digits = f"cast({u} as bigint)" if target == BIGINT else f"try_cast(cast({u} as bigint) as {target})"
    power = f"try_cast(cast({c} as double) as {target})"  # below 2^51 times a power of two
    d = f"try_cast(t as {_WIDE})"
    whole = f"if({d} = floor({d}), try_cast({d} as {target}), null)"
    rest = f"case when t rlike '{_SCALED_UP}' then {whole} when t rlike '{_NUMBER}' and {_exactly_integral_text('t')} then {whole} end"
    return (f"case when length({u}) between 1 and 18 then {digits} when {c} rlike '{_POWER}' then {power}"
            f" when {c} rlike '{_START}' and not ({c} rlike '{_FRACTION}') then transform(array({c}), t -> {rest})[0] end")


def integer_sql(c: str, source: T.DataType, target: str = BIGINT) -> str:
    if isinstance(source, _INTEGRAL):
        return f"try_cast({c} as {target})"
    if isinstance(source, _FLOATING):
        # 2^63 itself is a double that a cast would clamp to the largest bigint
        inside = f"{c} >= -9.223372036854775808E18D and {c} < 9.223372036854775808E18D"
        return f"case when not isnan({c}) and {c} = floor({c}) and {inside} then try_cast({c} as {target}) end"
    if isinstance(source, T.DecimalType):
        return f"case when {c} = floor({c}) then try_cast({c} as {target}) end"
    text = c if isinstance(source, T.StringType) else f"cast({c} as string)"
    return _integer_text_sql(text, target)


def decimal_sql(c: str, source: T.DataType, target: str = "decimal(18,4)") -> str:
    if isinstance(source, _FLOATING):
        return f"case when not isnan({c}) then try_cast({c} as {target}) end"
    if isinstance(source, _TEXT):
        return f"if({c} rlike '[0-9]', try_cast({_stripped(c)} as {target}), null)"  # other text would cost an exception
    return f"try_cast({c} as {target})"


def timestamp_sql(c: str, source: T.DataType) -> str:
    if isinstance(source, T.TimestampNTZType):
        return c
    if isinstance(source, _TEXT):
        return f"try_cast({_stripped(c)} as timestamp_ntz)"
    return f"try_cast({c} as timestamp_ntz)"


def coerce_sql(c: str, source: T.DataType, target: str) -> str:
    if target in (BIGINT, INT):
        return integer_sql(c, source, target)
    if target.startswith("decimal"):
        return decimal_sql(c, source, target)
    if target == TS:
        return timestamp_sql(c, source)
    if isinstance(source, T.StringType):
        return c
    return f"cast({c} as {STR})"


# Column-level forms (take a column name).
def to_integer(name: str, source: T.DataType, target: str = BIGINT) -> Column:
    return F.expr(integer_sql(q(name), source, target))


def to_decimal(name: str, source: T.DataType, target: str = "decimal(18,4)") -> Column:
    return F.expr(decimal_sql(q(name), source, target))


def to_timestamp(name: str, source: T.DataType) -> Column:
    return F.expr(timestamp_sql(q(name), source))


def coerce_column(name: str, source: T.DataType, target: str) -> Column:
    return F.expr(coerce_sql(q(name), source, target))


def coerce_frame(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project the spec's normalised columns with their target types."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(
        *[f"{coerce_sql(q(n), types[n], spec.target_type(n))} as {q(n)}" for n in spec.normalized]
    )


COERCED = "_coerced_"


def with_coerced(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The spec's columns as they came, each followed by its coerced value (``_coerced_<name>``)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(*[e for n in spec.normalized for e in (
        q(n), f"{coerce_sql(q(n), types[n], spec.target_type(n))} as {q(COERCED + n)}")])


__all__ = ["to_integer", "to_decimal", "to_timestamp", "coerce_column", "coerce_frame", "with_coerced", "COERCED", "q"]
