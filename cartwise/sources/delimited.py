"""Delimited text scan (header, ``|`` separator, ``"`` quote, every column text).

Columns are picked by header name (a file may hold more columns than the
declared ones, in any order); without a header they are taken by position.

Ragged rows: short rows are padded with NULLs and long rows are cut to the
header's columns, as both reference paths do — but never silently. The schema
carries one sentinel column ``_extra`` after the header's columns; a row that
fills it has more fields than the header and is reported by
``read_delimited_checked``.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import q

EXTRA = "_extra"
FILES_AT_ONCE = 64


def _reader(spark: SparkSession, columns: Sequence[str], sep: str, quote: str, header: bool, multi_line: bool):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [T.StructField(EXTRA, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", quote)
        .option("mode", "PERMISSIVE")
        .option("nullValue", "")
        .option("multiLine", multi_line)
    )


def _null_tokens(df: DataFrame, columns: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    extra = [t for t in tokens if t != ""]
    if not extra:
        return df
    return df.select(*[F.when(F.col(c).isin(*extra), None).otherwise(F.col(c)).alias(c) for c in df.columns])


def read_delimited_checked(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    sep: str = "|",
    quote: str = '"',
    header: bool = True,
    null_tokens: Sequence[str] = ("",),
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(rows, long_rows)``: declared columns, and the rows that had surplus fields.

    With ``header`` every file's own header line names its columns, so files of one folder may order or extend
    them differently; files are read together by header. ``multi_line`` allows line breaks inside quotes; files are
    then not split.
    """
    parts = []
    for names, paths in _by_header(spark, path, sep, quote) if header else [(list(columns), [path])]:
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"columns {missing} are missing from the header {names} of {paths[0]}")
        raw = _reader(spark, names, sep, quote, header, multi_line).csv(paths)
        raw = _null_tokens(raw, names, null_tokens)
        extra = F.concat_ws(sep, *[F.coalesce(F.col(q(c)), F.lit("")) for c in (*[n for n in names if n not in columns], EXTRA)])
        parts.append((raw.select(*[q(c) for c in columns]), raw.where(F.col(EXTRA).isNotNull()).select(*[q(c) for c in columns], extra.alias(EXTRA))))
    rows, long_rows = parts[0]
    for more_rows, more_long in parts[1:]:
        rows, long_rows = rows.unionByName(more_rows), long_rows.unionByName(more_long)
    return rows, long_rows


@contextmanager
def _whole_files(spark: SparkSession) -> Iterator[None]:
    """Settings under which a scan does not split files."""
    name = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k, None) for k in (name, "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, str(1 << 60))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def header_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, head): the first line of each of a few files. Under ``_whole_files`` each file is one partition under a limit of
    one row, so that its scan ends after the first line."""
    heads = [spark.read.text(f).select(F.lit(f).alias("file"), F.col("value").alias("head")).limit(1) for f in files]
    return reduce(DataFrame.unionByName, heads)


def _by_header(spark: SparkSession, path: str, sep: str, quote: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for each distinct header line below ``path``. Only names of files and header lines reach the
    driver, ``FILES_AT_ONCE`` in a job, and the data is not scanned for them."""
    names = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    files: dict[str, list[str]] = {}
    with _whole_files(spark):
        for at in range(0, len(names), FILES_AT_ONCE):
            for r in sorted(header_lines(spark, names[at:at + FILES_AT_ONCE]).collect()):
                files.setdefault(r["head"].rstrip("\r").removeprefix("\ufeff"), []).append(r["file"])
    if not files:
        raise ValueError(f"no header below {path}")
    return [(next(csv.reader([head], delimiter=sep, quotechar=quote)), paths) for head, paths in files.items()]


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], **kw) -> DataFrame:
    return read_delimited_checked(spark, path, columns, **kw)[0]
