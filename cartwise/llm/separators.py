"""Token counts by a separator scan over flat, unindexed token streams.

A *stream* is a row of token ids (unsigned 16 or 32 bits, little-endian) of many documents, each
ended by an end-of-document id; there is no index. It is held in *blocks* of a fixed number
of tokens: rows (file, block, tokens). Raw ``.bin`` files are cut into the same rows by ``read_files``.

Scan: each block is searched for the separator in one vectorised comparison; no block needs another. What
comes back per block is its size and the separators' places. Stitching: documents that run over block
borders need where the last separator before the block lies, and ordinals need the separators before it.
Both are prefix sums (and a prefix maximum) over the blocks of a file, taken in two levels, runs of ``RUN``
blocks and then the runs, so that no task sees more than ``RUN`` blocks or one row per run.

Result: one row per document in stream order (file, ordinal, start, n_tokens, ended); tokens after the last
separator are a document with ``ended`` false. Empty documents have zero tokens; empty blocks and files
without blocks are harmless; NULL token blocks count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.bpe import Bpe, Encoder, slices, text_bytes
from cartwise.llm.common import ship, stored

BLOCK = 1 << 16
RUN = 1024


def token_type(largest_id: int) -> str:
    """The width of a stream whose ids go up to ``largest_id``."""
    return "<u2" if largest_id < 1 << 16 else "<u4"


def stream_type(model: Bpe, end_id: int) -> str:
    return token_type(max(end_id, model.size - 1))


def write_stream(docs: DataFrame, model: Bpe, end_id: int, *, doc_id: str = "doc_id", text: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """(file, block, tokens, first, ids): a stored stream per task with the whole texts' tokens, special tokens'
    strings taken as ordinary text. Rows with ``tokens`` are the stream; rows with ``ids`` are the list of documents
    written (from ordinal ``first``), which the scan doesn't read.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col(text).cast("binary").alias("t"), F.col(doc_id).alias("id"))
    id_type = T.ArrayType(given.schema["id"].dataType)
    schema = T.StructType([T.StructField("file", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("tokens", T.BinaryType()),
                           T.StructField("first", T.LongType()), T.StructField("ids", id_type)])
    kind = stream_type(model, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, file = Encoder(shared.value, use_special=False), TaskContext.get().partitionId()
        left, number, first = np.zeros(0, np.int64), 0, 0

        def rows(tokens: list[np.ndarray], ids: pa.Array, first: int) -> pa.RecordBatch:
            nonlocal number
            n, listed = len(tokens), min(1, len(ids))
            lists = [pa.nulls(n, pa.list_(ids.type)), pa.ListArray.from_arrays([0, len(ids)], ids).slice(0, listed)]
            out = [pa.array([file] * (n + listed), pa.int32()), pa.array([*range(number, number + n), *[None] * listed], pa.int64()),
                   pa.array([*(t.astype(kind).tobytes() for t in tokens), *[None] * listed], pa.binary()),
                   pa.array([*[None] * n, *[first] * listed], pa.int64()), pa.concat_arrays(lists)]
            number += n
            return pa.RecordBatch.from_arrays(out, schema.names)

        for b in batches:
            raw = text_bytes(b.column(0))
            for lo, hi in slices([len(x) for x in raw]):
                flat, at = coder.encode([x.decode("utf-8", "replace") for x in raw[lo:hi]])
                stream = np.concatenate((left, np.insert(flat, at[1:], end_id)))
                full = len(stream) // block * block
                ids = b.column(1).slice(lo, hi - lo)
                yield rows(list(stream[:full].reshape(-1, block)), ids, first)
                left, first = stream[full:], first + hi - lo
        if len(left):
            yield rows([left], ids.slice(0, 0), first)

    return stored(given.mapInArrow(run, schema), "token-stream")


def read_files(spark: SparkSession, path: str, end_id: int, block: int = BLOCK, kind: str | None = None) -> DataFrame:
    """(file, block, tokens) of raw token files; ``file`` numbers the paths in order. ``kind`` ('<u2' or '<u4') is as for
    ``find_separators``. A file is one row of Spark's binary reader, so at most 2 GB; longer streams are written in several files."""
    ship(spark)
    paths = spark.read.format("binaryFile").load(path).select("path")
    number = {r["path"]: i for i, r in enumerate(paths.orderBy("path").collect())}  # file names
    width = np.dtype(kind or token_type(end_id)).itemsize * block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                view = data.as_buffer()
                for i, at in enumerate(range(0, view.size, width)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([number[name]], pa.int32()), pa.array([i], pa.int64()),
                        pa.array([view.slice(at, min(width, view.size - at)).to_pybytes()], pa.binary())], ["file", "block", "tokens"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file int, block long, tokens binary")


def find_separators(blocks: DataFrame, end_id: int, kind: str | None = None) -> DataFrame:
    """(file, block, size, at): each block's number of tokens and its separators' places. ``kind`` is the type of the stream's
    ids, which whoever wrote the stream knows: the separator need not be the largest id. Without it, it is taken to be."""
    ship(blocks.sparkSession)
    kind = kind or token_type(end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, places = [], []
            for data in b.column(2):
                tokens = np.frombuffer(data.as_buffer() if data.is_valid else b"", dtype=kind)
                sizes.append(len(tokens))
                places.append(np.flatnonzero(tokens == end_id).astype(np.int32))
            ends = np.cumsum([0, *map(len, places)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(places) if places else np.zeros(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), lists], ["file", "block", "size", "at"])

    return blocks.select("file", "block", "tokens").mapInArrow(run, "file int, block long, size long, at array<int>")


def stitch(found: DataFrame) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) from ``find_separators``' rows (stored)."""
    n = F.size("at").cast("long")
    rows = found.select("*", F.floor(F.col("block") / RUN).alias("run"), n.alias("n"))
    ahead = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("offset", F.coalesce(F.sum("size").over(ahead), F.lit(0))).withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    inside = inside.withColumn("end", F.when(F.col("n") > 0, F.col("offset") + F.element_at("at", -1)))
    inside = inside.withColumn("last", F.max("end").over(ahead))
    runs = inside.groupBy("file", "run").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max("end").alias("end"))
    past = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("size").over(past), F.lit(0))).withColumn("ordinals", F.coalesce(F.sum("n").over(past), F.lit(0)))
    runs = runs.withColumn("end", F.col("base") + F.col("end")).withColumn("previous", F.coalesce(F.max("end").over(past), F.lit(-1)))
    heads = runs.select("file", "run", "base", "ordinals", "previous")
    whole = inside.join(heads, ["file", "run"])
    start = F.col("base") + F.col("offset")
    previous = F.coalesce(F.col("base") + F.col("last"), F.col("previous"))
    ends = F.transform("at", lambda p, i: F.struct(
        (F.col("ordinals") + F.col("before") + i).alias("ordinal"),
        (F.when(i > 0, start + F.get(F.col("at"), i - 1)).otherwise(previous) + 1).alias("start"), (start + p).alias("end")))
    docs = whole.select("file", F.explode(ends).alias("d")).select(
        "file", "d.ordinal", "d.start", (F.col("d.end") - F.col("d.start")).alias("n_tokens"), F.lit(True).alias("ended"))
    tail = runs.groupBy("file").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.coalesce(F.max("end"), F.lit(-1)).alias("end"))
    tail = tail.where("end + 1 < size").select("file", F.col("n").alias("ordinal"), (F.col("end") + 1).alias("start"),
                                               (F.col("size") - F.col("end") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    return docs.unionByName(tail)


def count_tokens(blocks: DataFrame, end_id: int, kind: str | None = None) -> DataFrame:
    """One row per document of the streams in ``blocks`` (file, block, tokens); ``kind`` as for ``find_separators``."""
    return stitch(stored(find_separators(blocks, end_id, kind), "separators"))


def document_tokens(docs: DataFrame, model: Bpe, end_id: int, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, file, ordinal, start and n_tokens of every document, counted in the streams written from them."""
    stream = write_stream(docs, model, end_id, doc_id=doc_id, text=text)
    counted = count_tokens(stream.where("tokens is not null").select("file", "block", "tokens"), end_id, stream_type(model, end_id))
    listed = stream.where("ids is not null").select("file", "first", F.posexplode("ids").alias("i", doc_id))
    listed = listed.select("file", (F.col("first") + F.col("i")).alias("ordinal"), doc_id)
    return counted.join(listed, ["file", "ordinal"]).select(doc_id, "file", "ordinal", "start", "n_tokens")
