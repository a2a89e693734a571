"""Micro-batch ingest of a source table: insert-if-absent across arrivals.

Files arriving in a source folder are read as a stream; every micro-batch is
coerced, reduced to one row per key, stripped of keys that an *earlier* batch
already stored, and appended to the target table under its key slot and batch id
(``_slot=<s>/_batch=<id>``). A slot is a range of ``slot_width`` keys, so a batch reads only the folders
of slots that its own keys lie in: what it reads is bounded by its keys and the slots' width, not by
the table's history. Keys are therefore owned by the first batch that brought
them, as with ``insert ... on conflict do nothing``.

Replays are idempotent: a re-run of batch ``k`` (after a failure) compares only
against batches ``< k`` and overwrites its own ``_batch=k`` partition (dynamic
partition overwrite), so it writes the same rows again. The stream's progress
lives in its checkpoint location on shared storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.coerce import coerce_frame
from ..operators.dedup import dedup_by_key
from ..specs import BIGINT, INT, TableSpec

BATCH, SLOT = "_batch", "_slot"
SLOT_WIDTH = 1 << 20  # keys to a slot
MAX_SLOTS = 10_000  # that a filter names; a batch over more of them reads all keys


def target_schema(spec: TableSpec) -> T.StructType:
    """The declared schema of a target table (with its slot and batch id)."""
    fields = [T.StructField(n, T.DataType.fromDDL(spec.target_type(n))) for n in spec.normalized]
    return T.StructType([*fields, T.StructField(SLOT, T.LongType()), T.StructField(BATCH, T.LongType())])


def slot_of(spec: TableSpec, slot_width: int = SLOT_WIDTH) -> Column:
    """The slot of a key: its range for integers, a hash for other types."""
    if spec.target_type(spec.key) in (BIGINT, INT):
        return F.floor(F.col(spec.key) / F.lit(slot_width).cast("decimal(20,0)")).cast("long")
    return F.pmod(F.xxhash64(spec.key), F.lit(4096)).cast("long")


def known_keys(target: DataFrame, batch_id: int, spec: TableSpec, slots: Sequence[int] | None) -> DataFrame:
    """Keys that batches before ``batch_id`` stored, from the folders of ``slots`` (None: all) only."""
    known = target.where(F.col(BATCH) < batch_id)
    return (known if slots is None else known.where(F.col(SLOT).isin(*slots))).select(spec.key)


def first_batch_wins_sink(spec: TableSpec, target: str, slot_width: int = SLOT_WIDTH):
    """A ``foreachBatch`` function appending a batch's new keys to ``target``. A table keeps the ``slot_width`` it began with."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the folder exists from here on, so that whatever then goes wrong with reading it fails the batch
        spark.createDataFrame([], target_schema(spec)).write.mode("ignore").partitionBy(SLOT, BATCH).parquet(target)
        rows = coerce_frame(batch, spec)
        slot = slot_of(spec, slot_width)
        own = rows.where(F.col(spec.key).isNotNull()).select(slot.alias(SLOT)).distinct().limit(MAX_SLOTS + 1).collect()
        slots = [r[SLOT] for r in own] if len(own) <= MAX_SLOTS else None
        stored = spark.read.schema(target_schema(spec)).parquet(target)
        fresh = dedup_by_key(rows, spec.key).join(known_keys(stored, batch_id, spec, slots), spec.key, "left_anti")
        (
            fresh.withColumn(SLOT, slot)
            .withColumn(BATCH, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(SLOT, BATCH)
            .parquet(target)
        )

    return write


def start_ingest(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    spec: TableSpec,
    target: str,
    checkpoint_location: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    available_now: bool = True,
    slot_width: int = SLOT_WIDTH,
) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        # a stream's schema is declared up front; the header of every file is checked
        # against it (enforceSchema=false), so a file with other columns fails loudly
        reader = (
            reader.option("header", True).option("sep", "|").option("quote", '"').option("escape", '"')
            .option("enforceSchema", False)
        )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source_dir)
    writer = (
        stream.writeStream.foreachBatch(first_batch_wins_sink(spec, target, slot_width))
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stored_table(spark: SparkSession, target: str, spec: TableSpec) -> DataFrame:
    """The rows stored so far (none before the first batch)."""
    try:
        return spark.read.schema(target_schema(spec)).parquet(target).drop(SLOT, BATCH)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], target_schema(spec)).drop(SLOT, BATCH)
