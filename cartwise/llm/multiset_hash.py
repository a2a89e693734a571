r"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text's paragraphs are its \n-split lines; NULL and empty texts have none. Each paragraph is hashed to a wide vector, and a
text's fingerprint is the sum of its paragraphs' vectors, each lane modulo a power of two:

- ``exact``: the number of paragraphs and 16 lanes of 32 hash bits (XXH64 of the paragraph, another salt each), modulo 2^32. Texts
  have the same exact lanes if they hold the same paragraphs equally often, in any order; otherwise they agree by chance
  only (512 bits; XXH64 is not meant to withstand an adversary).
- ``lanes``: 128 lanes modulo 2^16. Each sentence of the paragraph (cut at ``[\n.!?;|]+``) adds +1 or -1 to every lane, by the bits
  of two hashes. Their differences tell how alike two texts are: the lanes' cosine estimates that of the texts' sentence
  counts, with a standard error of about 1 / sqrt(128).

Sums commute, so the order of paragraphs does not count, and a paragraph is inserted or deleted by adding or
subtracting its vector (``plus``, ``minus``) without the rest of the text. All is column expressions.

``edits`` joins each document with the next one, ascending by id: NULL ids last; rows that repeat an id by XXH64 of their text, then as
they are read; after the last comes the first. There is one shuffle of the texts. Rows go to buckets that follow that order: cells
between quantiles of the ids, cut evenly by value; an id that fills several cells, and NULL ids, are cut by the hash
of the text, so no id is one task's. The next row comes from a window in the bucket, whose last row is followed by a copy of the
next bucket's first; those copies are picked by a broadcast of one small row a bucket (``MAX_BUCKETS`` at most). Quantiles only
steer sizes: any cells give the same result. Ids are whole numbers. Texts are taken whole. Repeated rows each get a
row. Other columns are kept; those named like an output give way. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import column, packed, stable, stored, unpacked

SENTENCE = "[\\n.!?;|]+ *"
WIDE, NARROW = 0xFFFFFFFF, 0xFFFF
EXACT = 16  # lanes modulo 2^32
HASHES = 2  # 64 lanes modulo 2^16 each
BUCKET_BYTES = 8 << 20
TASK_BUCKETS = 8  # buckets to a task, where the session's shuffle partitions would be fewer
MAX_CELLS = 256
MAX_BUCKETS = 1 << 20
OUT = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _narrow(x: Column) -> Column:
    """x modulo 2^16, from -32,768 on."""
    return ((x + 0x8000).bitwiseAND(NARROW) - 0x8000).cast("smallint")


def _salted(k: int):
    return lambda s: F.xxhash64(s, F.lit(k))


def _bit_counts(hashes: str) -> Column:
    """For j from 0 to 31, how many of the hashes have bit j set, and bit j + 32: two counters of 32 bits in one number."""
    pair = (1 << 32) + 1
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.aggregate(
        hashes, F.lit(0).cast("long"), lambda a, h: a + F.call_function("shiftrightunsigned", h, j).bitwiseAND(pair)))


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the vector (struct of ``exact`` and ``lanes``) of its column ``text`` (a string, NULL: empty) in ``out``."""
    t = F.coalesce(column(text), F.lit(""))
    names = [column(c) for c in df.columns if c != out]
    some = F.filter(F.split(t, SENTENCE), lambda s: s != "")
    hashes = [F.transform(some, _salted(k)).alias(f"_h{k}") for k in range(HASHES)]
    parts = df.select(*names, F.when(t != "", F.split(t, "\\n")).otherwise(F.array().cast("array<string>")).alias("_lines"), *hashes)
    sums = F.transform(F.sequence(F.lit(1), F.lit(EXACT)), lambda k: F.aggregate(
        "_lines", F.lit(0).cast("long"), lambda a, p: a + F.xxhash64(p, k).bitwiseAND(WIDE)).bitwiseAND(WIDE))
    exact = F.concat(F.array(F.size("_lines").cast("long")), sums)
    ones = [_bit_counts(f"_h{k}") for k in range(HASHES)]
    counted = parts.select(*names, exact.alias("_exact"), F.size("_h0").alias("_n"), F.concat(*ones).alias("_ones"))
    lanes = F.flatten(F.transform("_ones", lambda x: F.array(_narrow(2 * x.bitwiseAND(WIDE) - F.col("_n")),
                                                             _narrow(2 * F.shiftrightunsigned(x, 32) - F.col("_n")))))
    return counted.select(*names, F.struct(F.col("_exact").alias("exact"), lanes.alias("lanes")).alias(out))


def plus(a: Column, b: Column) -> Column:
    """The vector of both texts' paragraphs together."""
    return F.struct(F.zip_with(a["exact"], b["exact"], lambda x, y: (x + y).bitwiseAND(WIDE)).alias("exact"),
                    F.zip_with(a["lanes"], b["lanes"], lambda x, y: _narrow(x.cast("int") + y)).alias("lanes"))


def minus(a: Column, b: Column) -> Column:
    """The vector of a's paragraphs without b's."""
    return F.struct(F.zip_with(a["exact"], b["exact"], lambda x, y: (x - y).bitwiseAND(WIDE)).alias("exact"),
                    F.zip_with(a["lanes"], b["lanes"], lambda x, y: _narrow(x.cast("int") - y)).alias("lanes"))


def digits(vector: Column) -> Column:
    """The vector as lowercase hex: 8 digits an exact lane, 4 any other."""
    wide = F.transform(vector["exact"], lambda x: F.lpad(F.hex(x), 8, "0"))
    narrow = F.transform(vector["lanes"], lambda x: F.lpad(F.hex(x.cast("int").bitwiseAND(NARROW)), 4, "0"))
    return F.lower(F.concat(F.array_join(wide, ""), F.array_join(narrow, "")))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a["lanes"], b["lanes"], lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal multisets of paragraphs; otherwise the cosine of the lanes, 0 at least (and for texts without sentences)."""
    size = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.least(F.greatest(_dot(a, b) / F.when(size > 0, size), F.lit(0.0)), F.lit(1.0))
    return F.when(a["exact"] == b["exact"], F.lit(1.0)).otherwise(F.coalesce(cosine, F.lit(0.0)))


def _bucket(cuts: list[int], low: int, high: int, per_cell: int) -> Column:
    """The bucket of a row (id, h): never falling along the order of (id, h)."""
    i, share = F.col("id"), F.col("h").cast("double") / 2.0**64 + 0.5
    edges = F.lit([low, *cuts, high]) if cuts else F.array(F.lit(low), F.lit(high))
    at = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    below, upto = F.size(F.filter(at, lambda c: c < i)), F.size(F.filter(at, lambda c: c <= i))

    def part(x: Column, n: Column) -> Column:
        return F.least(F.floor(x * n), n - 1).cast("long")

    start, stop = (F.get(edges, upto + k).cast("double") for k in (0, 1))
    inside = upto * per_cell + part((i.cast("double") - start) / F.greatest(stop - start, F.lit(1.0)), F.lit(per_cell))
    hot = (below + 1) * per_cell + part(share, (upto - below - 1) * per_cell)
    null = (len(cuts) + 1) * per_cell + part(share, F.lit(per_cell))
    return F.when(i.isNull(), null).when(upto - below > 1, hot).otherwise(inside).cast("long")


def with_next(docs: DataFrame, carried: list[str], *, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows of ``docs`` (id, body, and more) with the next row's ``carried`` columns in ``next``. ``docs`` is a plain read."""
    keys = docs.select("id", F.xxhash64("body").alias("h"), F.octet_length("body").alias("bytes"), F.monotonically_increasing_id().alias("rid"))
    size, low, high = keys.agg(F.sum(F.col("bytes").cast("double")), F.min("id"), F.max("id")).first()
    wanted = min(max(1, math.ceil((size or 0) / bucket_bytes)), MAX_BUCKETS)
    cells = min(wanted, MAX_CELLS)
    cuts = keys.agg(F.percentile_approx("id", [k / cells for k in range(1, cells)], 10_000)).first()[0] if cells > 1 and low is not None else []
    low, high = (0, 0) if low is None else (low, high)
    bucket = _bucket(list(cuts), low, high + 1, math.ceil(wanted / cells)).alias("bucket")
    order = ["none", "id", "h", "rid"]
    keys = keys.select(F.col("id").isNull().alias("none"), "id", "h", "rid", bucket)
    heads = keys.groupBy("bucket").agg(F.min(F.struct(*order))["rid"].alias("head"))
    round_ = Window.orderBy("bucket")  # a row per bucket
    before = F.coalesce(F.lag("bucket").over(round_), F.last("bucket").over(round_.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    heads = stored(heads.select("head", before.alias("before")), "hash-heads")
    rows = docs.select("*", F.col("id").isNull().alias("none"), F.xxhash64("body").alias("h"), F.monotonically_increasing_id().alias("rid"))
    guests = rows.join(F.broadcast(heads), F.col("rid") == F.col("head")).select(*rows.columns, F.col("before").alias("bucket"), F.lit(True).alias("guest"))
    both = rows.select("*", bucket, F.lit(False).alias("guest")).unionByName(guests)
    tasks = math.ceil(wanted / TASK_BUCKETS)
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        both = both.repartition(tasks, "bucket")  # the window needs this exchange anyway
    after = F.lead(F.struct(*carried)).over(Window.partitionBy("bucket").orderBy("guest", *order))
    return both.select("*", after.alias("next")).where("not guest").drop("guest", "bucket", *[c for c in order if c != "id"])


def edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` without its text, with ``n_chars``, the fingerprint, and that of the edited text: the last floor(n_chars / 2) code
    points replaced by the first as many (or all) of the next document; and how like the text is to the edited and to the next one."""
    docs = stable(docs)
    out = (text, *OUT)
    rows = docs.select(packed(docs, out), column(doc_id).cast("long").alias("id"), F.coalesce(column(text), F.lit("")).alias("body"))
    rows = with_next(with_vector(rows, "body", "own"), ["body", "own"], bucket_bytes=bucket_bytes)
    n = F.char_length("body")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - half), F.substring(F.col("next.body"), F.lit(1), half))
    rows = rows.select("_row", n.cast("long").alias("n_chars"), "own", F.col("next.own").alias("after"), edited.alias("edited"))
    rows = with_vector(rows, "edited", "other")
    own, other, after = F.col("own"), F.col("other"), F.col("after")
    return rows.select(*unpacked(rows), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digits(own).alias("fingerprint"),
                       digits(other).alias("edited_fingerprint"), likeness(own, other).alias("near_edited"), likeness(own, after).alias("near_next"))
