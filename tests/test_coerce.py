import datetime
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.coerce import coerce_frame, to_decimal, to_integer, to_timestamp
from cartwise.specs import SPECS, normalize_name


def test_integer_text(spark):
    vals = ["10.0", " 7 ", "1e3", "10.5", "nan", "x", "9223372036854775808", None,
            "1E-20", "3.0000000000000000001", "1500e-2", "15e-1", "-4.000", "+12", "0.0e5", "1e-99999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    out = [r[0] for r in df.select(to_integer("s", T.StringType())).collect()]
    assert out == [10, 7, 1000, None, None, None, None, None, None, None, 15, None, -4, 12, 0, None]


def test_nan_foreign_key_is_null_never_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (8796093054980.0,), (2.5,), (float("inf"),)], "d double")
    out = [r[0] for r in df.select(to_integer("d", T.DoubleType())).collect()]
    assert out == [None, 8796093054980, None, None]


def test_integer_edges(spark):
    df = spark.createDataFrame([(9.223372036854775808e18,), (-9.223372036854775808e18,), (9.2233720368547748e18,)], "d double")
    out = [r[0] for r in df.select(to_integer("d", T.DoubleType())).collect()]
    assert out == [None, -(2**63), 9223372036854774784]
    df = spark.createDataFrame([(" 7\t",), ("\r\n8.0\u000b",), ("7 7",), ("",)], "s string")
    assert [r[0] for r in df.select(to_integer("s", T.StringType())).collect()] == [7, 8, None, None]
    df = spark.createDataFrame([("2147483647",), ("2147483648",)], "s string")
    assert [r[0] for r in df.select(to_integer("s", T.StringType(), "int")).collect()] == [2147483647, None]


def test_decimal_and_timestamp(spark):
    df = spark.createDataFrame([("3.75", "2021-06-30 23:15:09"), ("nan", "soon"), (None, None)], "p string, t string")
    out = df.select(to_decimal("p", T.StringType()), to_timestamp("t", T.StringType())).collect()
    assert tuple(out[0]) == (Decimal("3.7500"), datetime.datetime(2021, 6, 30, 23, 15, 9))
    assert tuple(out[1]) == tuple(out[2]) == (None, None)


def test_coerced_cart_rows(spark):
    """Source spelling is lower-cased, every declared column gets its type, junk becomes NULL."""
    spec = SPECS["tb_carts"]
    assert [normalize_name(c) for c in spec.columns] == list(spec.normalized) and spec.normalized[:2] == ("pk", "createdts")
    blank = dict.fromkeys(spec.normalized)
    given = [blank | {"pk": "41", "createdts": "2023-02-28 07:00:00", "p_totalprice": "9.5", "p_user": "12.0"},
             blank | {"pk": "42", "createdts": "2023-02-30", "p_totalprice": "nan", "p_user": "12.5"}]
    raw = spark.createDataFrame([tuple(r.values()) for r in given], ", ".join(f"{c} string" for c in spec.normalized))
    coerced = coerce_frame(raw, spec)
    good, bad = coerced.orderBy("pk").collect()
    assert (good["pk"], good["p_user"], good["p_totalprice"]) == (41, 12, Decimal("9.5000"))
    assert (bad["pk"], bad["createdts"], bad["p_user"], bad["p_totalprice"]) == (42, None, None, None)
    assert dict(coerced.dtypes)["createdts"] == "timestamp_ntz"


def test_declared_keys():
    assert {n: s.key for n, s in SPECS.items() if s.key != "pk"} == {"tb_cmssitelp": "itempk"}


def test_integer_text_forms_by_exact_arithmetic(spark):
    """Every form of number text against Python's decimals: plain, zero and other fractions, powers, long digits, junk."""
    import itertools

    bodies = ["0", "7", "007", "12345678901234567", "999999999999999999", "1234567890123456789", "9223372036854775807", "9223372036854775808",
              "5.", "5.0", "5.000", ".0", ".5", "5.50", "0.0", "100.00", "1.0000000000000000000", "1.00000000000000000001", "3e3", "3E+3", "30e-1", "3e-1",
              "1.5e1", "1.5e0", "123456789e9", "1234567890e9", "1e18", "1e19", "0e5", ".5e1", "5.e1", "1e", "e3", ".", "", "1..", "1.2.3", "--1", "nan", "x1", "1x", "1 2", "0x10"]
    vals = [sign + body for sign, body in itertools.product(["", "-", "+", " \t", "\n-"], bodies)] + [b + "\r\u000b " for b in bodies]

    def exact(text):
        import re

        if not re.fullmatch(r"[+-]?(?=[.]?[0-9])[0-9]*([.][0-9]*)?([eE][+-]?[0-9]+)?", text.strip(" \t\n\u000b\f\r")):
            return None
        d = Decimal(text.strip())
        return int(d) if d == d.to_integral_value() and -2**63 <= d < 2**63 else None

    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r["s"]: (r["b"], r["i"]) for r in df.select("s", to_integer("s", T.StringType()).alias("b"), to_integer("s", T.StringType(), "int").alias("i")).collect()}
    small = lambda x: x if x is not None and -2**31 <= x < 2**31 else None
    assert {v: got[v] for v in vals} == {v: (exact(v), small(exact(v))) for v in vals}
