"""Expressions and small helpers that several training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"  # separators of white-space words
PLAIN_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"  # separators of lower-cased alphanumeric words

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1_000


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that by itself for pure ASCII text, and much
    faster than ``translate``, which is kept for text with other characters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def _pieces(text: Column, separators: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; NULL text has none."""
    return _pieces(text, SPACE_RUN)


def plain_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; NULL has none."""
    return _pieces(ascii_lower(text), PLAIN_GAP)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def column(name: str) -> Column:
    """A column by its exact name (which may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns but ``without`` as one struct, ``_row``, so that no name of theirs can clash with a working
    column. ``unpacked`` gives them back."""
    names = [c for c in docs.columns if c not in without]
    return F.struct(*[column(c).alias(c) for c in names]).alias("_row")


def unpacked(df: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    """The fields of ``_row`` as columns."""
    names = [c for c in df.schema["_row"].dataType.names if c not in without]
    return [F.col("_row").getField(c).alias(c) for c in names]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends there, and
    every executor sees the files. The folder belongs to the checkpoint area and goes with it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stable(docs: DataFrame) -> DataFrame:
    """``docs`` itself if it is a plain read of files (with columns and rows selected), else a stored copy.

    Numbers that ``monotonically_increasing_id`` gives along such a read are the same each time it is
    evaluated; after a shuffle, or for rows from memory, they need not be.
    """
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    kinds = {m[1] for m in re.finditer(r"(?m)^[ :+-]*(\w+)", plan)}
    return docs if kinds <= {"Relation", "Project", "Filter"} else stored(docs, "rows")


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per Spark context, so that functions run there
    that are not installed there. Spark's own file server distributes the archive."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent.parent
    if getattr(sc, "_cartwise_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="cartwise-")) / "cartwise.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._cartwise_shipped = True


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send Python workers at most ``TEXT_ROWS`` rows at a time. With whole texts, Spark's 10,000 take
    tens of megabytes in the executor, outside its heap, and again in each worker."""
    before = spark.conf.get(ARROW_ROWS)
    rows = int(before)
    spark.conf.set(ARROW_ROWS, str(min(rows, TEXT_ROWS) if rows > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def fits(df: DataFrame, rows: int) -> bool:
    """Whether the (small or already stored) table has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; otherwise unchanged, so that
    the join shuffles. Counts the (small or already stored) table once."""
    return F.broadcast(df) if fits(df, rows) else df
