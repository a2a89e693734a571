import csv
import datetime as dt
import io
from decimal import Decimal as D

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.text import export_line


def _python_line(values):
    buf = io.StringIO()
    csv.writer(buf, delimiter="|", lineterminator="\n").writerow(["" if v is None else str(v) for v in values])
    return buf.getvalue()[:-1]


def test_export_line_matches_python_minimal_quoting(spark):
    rows = [
        ("plain", D("0.0000"), dt.datetime(2024, 1, 1, 0, 0, 0, 500000), 7),
        ('say "hi"', D("12.5000"), dt.datetime(2024, 1, 1, 10, 0), None),
        ("a|b", None, None, 3),
        ("line\nbreak", D("1.0000"), dt.datetime(1999, 12, 31, 23, 59, 59, 1), 0),
        ("cr\rhere", D("-2.3400"), dt.datetime(2024, 2, 29), 1),
    ]
    schema = T.StructType([
        T.StructField("s", T.StringType()), T.StructField("d", T.DecimalType(18, 4)),
        T.StructField("t", T.TimestampNTZType()), T.StructField("i", T.LongType()),
    ])
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(export_line([(F.col(f.name), f.dataType) for f in schema.fields])).collect()]
    assert got == [_python_line(r) for r in rows]


def test_times_that_a_zone_skips_print_as_they_are(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    schema = T.StructType([T.StructField("t", T.TimestampNTZType())])
    df = spark.createDataFrame([(dt.datetime(2018, 11, 4, 0, 30),), (dt.datetime(2018, 11, 4, 0, 30, 0, 1200),)], schema)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = [r[0] for r in df.select(export_line([(F.col("t"), T.TimestampNTZType())])).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2018-11-04 00:30:00", "2018-11-04 00:30:00.001200"]
