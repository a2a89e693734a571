"""SimHash near-duplicates by deletion-variant signatures.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, word shingles joined by one
space, each hashed with XXH64 (seed 42); a bit is 1 if it is set in over half the
shingles, repeats included. Fewer words than a shingle: the whole sequence is the one
shingle. No words (NULL, empty, white space): fingerprint zero, linked like any other.

Linking at ``max_distance`` bits: the 64 bits are cut into ``max_distance // 2 + 1``
segments, so that two linked fingerprints differ by at most one bit in some segment.
Each segment is indexed once per bit with that bit wildcarded; two segment values differ
by at most one bit exactly if they share such a variant. An equality join on
(segment, wildcard, value) proposes, ``bit_count(a ^ b) <= max_distance`` verifies.

Large groups: copies share a fingerprint and are one row before the join. A group of
thousands of near copies would meet itself in all of its variants, so links are
found in two steps. First neighbours in the order of each variant bucket (salted by
four further bits, so that no bucket is one task's) are verified and joined to components:
a linear number of candidates, which joins large groups almost wholly. Then the
complete equality join runs between *different* components only. Pairs within
one component cannot change the result and are not made, so the components are exact.

Components: alternating min-label hooking and pointer jumping over links between distinct
fingerprints; all rounds are joins, cut by written tables. Labels are fingerprints; at the end
every row gets the smallest ``doc_id`` of its component. Rows whose ``doc_id`` is NULL count as
members (their id is not the smallest unless all are NULL). Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import column, packed, ship, small, stable, stored, unpacked

SEED = 42
MAX_ROUNDS = 64
CROWD = 1024
MAX_BROADCAST_ROWS = 1_000_000  # 8 MB of row numbers


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """The signed 64-bit SimHash of one text (see the module docstring)."""
    words = (text or b"").lower().split()  # bytes: A-Z only; splits at \x20 \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(raw), 1 << 16):  # bounded memory for very long texts
        ones += np.unpackbits(raw[i:i + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(raw)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", width: int = 4, out: str = "fp") -> DataFrame:
    """``docs`` without its text, with the fingerprint in ``out`` (long, as signed)."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, out)]
    given = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = given.drop("_text").schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), width) for t in b.column(len(keep))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], fps], [*keep, out])

    return given.mapInArrow(run, schema)


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment: few enough that one differs by at most one bit."""
    n = max_distance // 2 + 1
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(fps: DataFrame, max_distance: int, *cols: str) -> DataFrame:
    """One row per fingerprint, segment and wildcard bit: ``cols``, ``slot`` (the wildcarded bit,
    which also names its segment) and ``value`` (the segment without that bit)."""
    both = [F.struct(F.lit(bit).cast("byte").alias("slot"),
                     F.col("fp").bitwiseAND(F.lit(_signed(((1 << n) - 1) << first & ~(1 << bit)))).alias("value"))
            for first, n in segments(max_distance) for bit in range(first, first + n)]
    return fps.select(*cols, F.explode(F.array(*both)).alias("v")).select(*cols, "v.slot", "v.value")


def _near(a: str, b: str, max_distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_distance


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(fp, comp): the smallest ``fp`` that each node reaches over ``links`` (a, b).

    Hook and jump until no link joins two labels: the links are relabelled, each label adopts its
    smallest neighbour, chains of adoptions are shortened, and ``links`` shrink to those between
    labels that remain. Rounds grow with the logarithm of the component's size.
    """
    live = stored(links.where("a <> b").distinct(), "simhash-links")
    label = None  # (fp, comp) for nodes that have a link
    for _ in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        hook = stored(hook, "simhash-hooks")  # every label that has a link -> itself or a smaller one
        while True:  # pointer jumping within this round's forest
            up = hook.select(F.col("a").alias("to"), F.col("to").alias("up"))
            jumped = stored(hook.join(up, "to").select("a", F.col("up").alias("to"),
                                                       (F.col("up") != F.col("to")).alias("moved")), "simhash-jumps")
            hook = jumped.select("a", "to")
            if jumped.where("moved").isEmpty():
                break
        step = hook.select(F.col("a").alias("comp"), "to")
        if label is None:
            label = hook.select(F.col("a").alias("fp"), F.col("to").alias("comp"))
        else:
            label = label.join(step, "comp", "left").select("fp", F.coalesce("to", "comp").alias("comp"))
        label = stored(label, "simhash-labels")
        a, b = step.toDF("a", "la"), step.toDF("b", "lb")
        live = stored(live.join(a, "a").join(b, "b").where("la <> lb")
                      .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(),
                      "simhash-links")
    else:
        raise RuntimeError("component labels did not settle")
    if label is None:
        return nodes.select("fp", F.col("fp").alias("comp"))
    return nodes.join(label, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp"))


def chain_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Verified links between neighbours in the order of each (salted) variant bucket."""
    index = variants(_spread(fps, "fp"), max_distance, "fp")
    rotated = F.call_function("shiftleft", F.col("fp"), F.lit(13))
    salt = F.pmod(F.col("fp").bitwiseXOR(F.shiftrightunsigned("fp", 32)), F.lit(16)).cast("byte")
    w = Window.partitionBy("slot", "value", "salt").orderBy(rotated, "fp")
    pairs = index.withColumn("salt", salt).select("fp", F.lag("fp").over(w).alias("before"))
    return pairs.where(F.col("before").isNotNull() & _near("fp", "before", max_distance)).select(
        F.least("fp", "before").alias("a"), F.greatest("fp", "before").alias("b")).distinct()


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """Small rows that are about to become many: dealt over all shuffle partitions first."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def cross_links(labelled: DataFrame, max_distance: int) -> DataFrame:
    """Verified links (a, b) between the components of ``labelled`` (fp, comp): the complete
    equality join over variant buckets, made only where a bucket holds two components.

    Buckets of over ``CROWD`` rows are cut again: of ``max_distance + 1`` parts of the 64 bits, two
    linked fingerprints have one in common, so the members meet on (bucket, part) and not all at once.
    """
    edges = [round(64 * i / (max_distance + 1)) for i in range(max_distance + 2)]
    parts = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(((1 << b - a) - 1) << a))).alias("bits"))
                      for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    w = Window.partitionBy("slot", "value")
    mixed = (variants(_spread(labelled, "fp"), max_distance, "fp", "comp")
             .select("*", F.min("comp").over(w).alias("lo"), F.max("comp").over(w).alias("hi"), F.count("*").over(w).alias("n"))
             .where("lo <> hi").select("slot", "value", "fp", "comp", "n"))
    mixed = stored(mixed, "simhash-index")
    plain = mixed.where(F.col("n") <= CROWD).select("slot", "value", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("bits"), "fp", "comp")
    crowded = mixed.where(F.col("n") > CROWD).select("slot", "value", "fp", "comp", F.explode(parts).alias("cut"))
    index = plain.unionByName(crowded.select("slot", "value", "cut.part", "cut.bits", "fp", "comp"))
    key = ["slot", "value", "part", "bits"]
    a = index.select(*key, F.col("fp").alias("fa"), F.col("comp").alias("a"))
    b = index.select(*key, F.col("fp").alias("fb"), F.col("comp").alias("b"))
    return a.join(b, key).where((F.col("a") < F.col("b")) & _near("fa", "fb", max_distance)).select("a", "b").distinct()


def _labelled(rows: DataFrame, width: int, max_distance: int) -> tuple[DataFrame, DataFrame]:
    """The stored ``rows`` (id, text and more) with _fp for the text, and (_fp, top, component_id) for
    each distinct fingerprint."""
    rows = stored(fingerprints(rows, text="text", width=width, out="_fp"), "simhash-rows")
    nodes = stored(rows.groupBy(F.col("_fp").alias("fp")).agg(F.min("id").alias("least")), "simhash-nodes")
    first = stored(components(nodes, chain_links(nodes.select("fp"), max_distance)), "simhash-first")
    heads = first.select("comp").distinct().withColumnRenamed("comp", "fp")
    second = components(heads, cross_links(first, max_distance)).toDF("comp", "top")
    whole = first.join(second, "comp").select("fp", "top")
    least = nodes.join(whole, "fp").groupBy("top").agg(F.min("least").alias("component_id"))
    return rows, whole.join(least, "top").select(F.col("fp").alias("_fp"), "top", "component_id")


def cluster(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4,
            max_distance: int = 4) -> DataFrame:
    """``docs`` without its text, with ``fingerprint`` (16 hex digits) and ``component_id``."""
    out = (text, "fingerprint", "component_id")
    rows = docs.select(packed(docs, out), column(doc_id).alias("id"), column(text).alias("text"))
    rows, final = _labelled(rows, width, max_distance)
    hexed = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return rows.join(final, "_fp").select(*unpacked(rows), hexed.alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 4,
                    max_distance: int = 4) -> DataFrame:
    """One row of ``docs`` per component, unchanged: that with the smallest ``doc_id``, and among rows that
    repeat it the first along the scan. A component of NULL ids alone keeps its first row.

    Texts are not shuffled: rows are numbered along the scan, and the numbers of those that go are joined
    (broadcast when few).
    """
    docs = stable(docs)
    numbered = docs.select(packed(docs), F.monotonically_increasing_id().alias("rid"))
    slim = docs.select(F.monotonically_increasing_id().alias("rid"), column(doc_id).alias("id"), column(text).alias("text"))
    rows, final = _labelled(slim, width, max_distance)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    best = (rows.groupBy("_fp").agg(first.alias("first")).join(final, "_fp")
            .groupBy("top").agg(F.min("first")["rid"].alias("rid")))
    goes = stored(rows.select("rid").join(best, "rid", "left_anti"), "simhash-goes")
    return numbered.join(small(goes, MAX_BROADCAST_ROWS), "rid", "left_anti").select(*unpacked(numbered))
