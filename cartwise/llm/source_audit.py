r"""Source divergence audit: how far each source's term use lies from the other sources of its language.

Terms are matches of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` in the whole text (letters and everything beyond ASCII), A-Z
lower-cased. Each language keeps the ``V`` terms found in at least ``min_docs`` of its documents. A group (language,
source), and the language as a whole, gives every kept term p = 1 + floor(10^9 (count + 1) / (N + V)), N being the group's
occurrences of kept terms. All arithmetic is on whole numbers.

- ``pair`` rows: for each group and each other source of its language, floor((p - q)^2 / q) summed over *all* kept terms, q
  being the other source's p.
- ``term`` rows: the group's kept terms with a count and p above the language's q, by floor((p - q)^2 / q), to ``top`` ranks.

Counting (length-bucketed packing). In each task the bytes of a slice of texts are searched for terms in numpy. Terms of
up to 8 bytes become one uint64 word and those of up to 16 two, big-endian and padded with zeros (which no term
holds), so that words sort as bytes do; they are radix-sorted 16 bits at a time, stably, over documents already in group
order, and counted as runs: occurrences and documents per (term, group). Longer terms go to buckets by powers of two of
their length, each sorted by its bytes. Packed terms stay packed through the shuffles and become text again only in
the result. A document lies in one slice, so document counts add up.

Pairs. Kept terms are dealt by hash into blocks of about ``BLOCK`` rows, and sources into tiles of ``TILE``, so a task
compares two tiles over one block as small matrices, whatever the number of terms or sources. A term that neither of two
sources holds adds the same amount for all such terms, so blocks give only the difference from it. The result has a
row per pair of sources of one language: that is its definition. Tasks never hold more than two tiles of a block.

NULL text, language and source are read as ''. A group whose documents hold no terms counts; where a language keeps no term,
its pairs have value 0 and rank by name. Repeated rows are documents of their own. Ties rank by the bytes of the item. Empty
tables give no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.bpe import slices, text_bytes
from cartwise.llm.common import column, ship, small, stored

SLICE = 2 << 20  # bytes of text that are sorted at a time
BLOCK = 40_000  # rows of (term, source) in a block, about
TILE = 64  # sources in a tile
MAX_BROADCAST_GROUPS = 200_000  # rows of (language, source) with their totals
SCALE = 1_000_000_000
TERM = ["a", "b", "t"]  # a term: first and second eight bytes, and all of them where they are more than 16

_LOWER = np.zeros(256, np.uint8)  # 0 for bytes outside terms
for _i in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _LOWER[_i] = _i + 32 if _i < 0x5B else _i


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by uint64 ``words`` (most significant first), 16 bits at a time from the last."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]  # a radix sort for 16-bit integers
    return order


def _runs(order: np.ndarray, keys: list[np.ndarray], doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows at which runs of equal (keys, group) start, with their lengths and their numbers of documents."""
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    group, doc = group[order], doc[order]
    for k in (*(k[order] for k in keys), group):
        fresh[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(fresh)
    new_doc = fresh.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    n = np.diff(np.append(starts, len(order)))
    d = np.add.reduceat(new_doc.astype(np.int64), starts) if len(starts) else n
    return order[starts], n, d


def count_terms(texts: list[bytes], group: np.ndarray) -> Iterator[tuple]:
    """(group, a, b, long terms or None, occurrences, documents), a tuple of arrays per length bucket."""
    by_group = np.argsort(group, kind="stable")
    ends = np.cumsum([len(texts[i]) + 1 for i in by_group])
    raw = np.frombuffer(b"\0".join([texts[i] for i in by_group]) + bytes(17), np.uint8)
    low = _LOWER[raw]
    edge = np.flatnonzero(np.diff(low != 0, prepend=False))
    starts, stops = edge[::2], edge[1::2]
    size = stops - starts
    doc = np.searchsorted(ends, starts, side="right")
    owner = group[by_group][doc]
    eight = np.ndarray((len(low) - 7,), ">u8", low, strides=(1,))  # the eight bytes from each position on

    def word(at: np.ndarray, length: np.ndarray) -> np.ndarray:
        pad = (8 * (8 - np.minimum(length, 8))).astype(np.uint64)
        return eight[at].astype(np.uint64) >> pad << pad

    one, two = np.flatnonzero(size <= 8), np.flatnonzero((size > 8) & (size <= 16))
    for rows in (one, two):
        keys = [word(starts[rows], size[rows])]
        keys += [word(starts[rows] + 8, size[rows] - 8)] if rows is two else []
        at, n, d = _runs(radix_order(keys), keys, doc[rows], owner[rows])
        a = keys[0][at].view(np.int64)
        yield owner[rows][at], a, keys[1][at].view(np.int64) if rows is two else np.zeros(len(a), np.int64), None, n, d
    data, bucket = low.tobytes(), np.ceil(np.log2(np.maximum(size, 1))).astype(int)
    for width in np.unique(bucket[size > 16]).tolist():
        rows = np.flatnonzero((bucket == width) & (size > 16))
        terms = np.array([data[s:e] for s, e in zip(starts[rows].tolist(), stops[rows].tolist())])
        at, n, d = _runs(np.argsort(terms, kind="stable"), [terms], doc[rows], owner[rows])
        none = np.zeros(len(at), np.int64)
        yield owner[rows][at], none, none, terms[at].tolist(), n, d


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, a, b, t, n, d): occurrences and documents of each term in each group of ``docs`` (lang, source, text)."""
    ship(docs.sparkSession)
    names = ["lang", "source", *TERM, "n", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"]).to_pylist()
            groups = {}
            codes = np.array([groups.setdefault((p["lang"], p["source"]), len(groups)) for p in pair], np.int64)
            langs, sources = pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string())
            sizes = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for lo, hi in slices(sizes, SLICE):
                for owner, a, b, t, n, d in count_terms(text_bytes(batch.column(2).slice(lo, hi - lo)), codes[lo:hi]):
                    at = pa.array(owner)
                    terms = pa.nulls(len(n), pa.binary()) if t is None else pa.array(t, pa.binary())
                    yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), pa.array(a), pa.array(b), terms,
                                                      pa.array(n.astype(np.int64)), pa.array(d)], names)

    parts = docs.mapInArrow(run, "lang string, source string, a long, b long, t binary, n long, d long")
    return parts.groupBy("lang", "source", *TERM).agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def kept_counts(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, a, b, t, n, total, first): rows of kept terms, their language's count, and a mark on one row a term.

    A term's rows are at most one per source: counts are already aggregated.
    """
    term = Window.partitionBy("lang", *TERM)
    rows = counts.select("*", F.sum("n").over(term).alias("total"), F.sum("d").over(term).alias("docs"),
                         (F.row_number().over(term.orderBy("source")) == 1).alias("first"))
    return rows.where(F.col("docs") >= min_docs).drop("d", "docs")


def weight(count: Column, size: Column) -> Column:
    """p of a term that occurs ``count`` times; ``size`` is N + V. NULL where no term is kept."""
    share = F.call_function("div", (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)"), size.cast("decimal(20,0)"))
    return F.when(size > 0, share + 1)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, no, p0, v, blocks, tiles, lang_size, size): one row per occurring group; ``p0`` is its p of an absent
    term, ``size`` its N + V and ``lang_size`` its language's."""
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("terms"), F.count("*").alias("rows"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna(0, ["n", "terms", "rows"])
    lang = Window.partitionBy("lang")
    v, rows, sources = F.sum("terms").over(lang), F.sum("rows").over(lang), F.count("*").over(lang)
    groups = groups.select("lang", "source", "n", F.row_number().over(lang.orderBy("source")).alias("no"), v.alias("v"),
                           F.sum("n").over(lang).alias("lang_n"), F.ceil(rows / BLOCK).alias("blocks"), F.ceil(sources / TILE).alias("tiles"))
    size = F.col("n") + F.col("v")
    return groups.select("lang", "source", (F.col("no") - 1).alias("no"), "v", "blocks", "tiles", size.alias("size"),
                         (F.col("lang_n") + F.col("v")).alias("lang_size"), weight(F.lit(0).cast("long"), size).alias("p0"))


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, more): what the kept terms that group g or h holds add to V times the amount of a term that neither holds."""
    tile = F.floor(F.col("no") / TILE).cast("int").alias("tile")
    slim = groups.select("lang", "source", "no", "size", "p0", "blocks", "tiles")
    block = F.pmod(F.xxhash64(*TERM), F.col("blocks")).cast("int").alias("block")
    held = (kept.select("lang", "source", *TERM, "n").join(small(slim, MAX_BROADCAST_GROUPS), ["lang", "source"])
            .select("lang", "no", tile, "tiles", block, *TERM, weight(F.col("n"), F.col("size")).alias("p")))
    none = [F.lit(None).cast(x).alias(c) for c, x in zip(TERM, ("long", "long", "binary"))]
    marks = (slim.where("blocks > 0").select("lang", "no", tile, "tiles", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block"),
                                             *none, "p0").withColumnRenamed("p0", "p").withColumn("mark", F.lit(True)))
    rows = held.withColumn("mark", F.lit(False)).unionByName(marks)
    every = F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))
    meets = F.array_distinct(F.concat(F.transform(every, lambda j: F.struct(F.col("tile").alias("i"), j.alias("j"))),
                                      F.transform(every, lambda i: F.struct(i.alias("i"), F.col("tile").alias("j")))))
    met = rows.select("lang", "block", "no", "tile", *TERM, "p", "mark", F.explode(meets).alias("meet")).select("*", "meet.i", "meet.j").drop("meet")
    width = TILE

    def compare(table: pa.Table) -> pa.Table:
        col = lambda name: table.column(name).combine_chunks()
        mark, no, p = (col(c).to_numpy(zero_copy_only=False) for c in ("mark", "no", "p"))
        first = {c: table.column(c)[0].as_py() for c in ("lang", "i", "j")}
        rows = np.flatnonzero(~mark)
        text = pc.fill_null(pc.dictionary_encode(col("t")).indices, -1).to_numpy(zero_copy_only=False)[rows]
        keys = [col(c).fill_null(0).to_numpy(zero_copy_only=False)[rows] for c in ("a", "b")] + [text]
        order = np.lexsort(keys)
        fresh = np.zeros(len(rows), bool)
        for k in keys:
            fresh[1:] |= k[order][1:] != k[order][:-1]
        term = np.empty(len(rows), np.int64)
        term[order] = np.cumsum(fresh)
        terms = int(term.max()) + 1 if len(rows) else 0

        def matrix(tile: int) -> tuple[np.ndarray, np.ndarray]:
            """Numbers of the tile's sources, and p of each term in each of them."""
            at = np.flatnonzero(mark & (no // width == tile))
            ids, base = no[at][np.argsort(no[at])], p[at][np.argsort(no[at])]
            out = np.repeat(base[None, :], terms, axis=0)
            own = np.flatnonzero(no[rows] // width == tile)
            out[term[own], np.searchsorted(ids, no[rows][own])] = p[rows][own]
            return ids, np.vstack((out, base[None, :]))  # the last row: a term that no source holds

        (g, left), (h, right) = matrix(first["i"]), matrix(first["j"])
        more = np.empty((len(g), len(h)), np.int64)
        for k in range(len(h)):
            q = right[:, k:k + 1]
            f = (left - q) ** 2 // q
            more[:, k] = f[:-1].sum(axis=0) - terms * f[-1]
        return pa.table({"lang": pa.array([first["lang"]] * more.size, pa.string()), "g": np.repeat(g, len(h)), "h": np.tile(h, len(g)), "more": more.ravel()})

    parts = met.groupBy("lang", "block", "i", "j").applyInArrow(compare, "lang string, g int, h int, more long")
    return parts.groupBy("lang", "g", "h").agg(F.sum("more").alias("more"))


def pair_rows(kept: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("no").alias("g"), "source", "v", F.col("p0").alias("p"))
    b = groups.select("lang", F.col("no").alias("h"), F.col("source").alias("item"), F.col("p0").alias("q"))
    pairs = a.join(b, "lang").where("g <> h").join(pair_sums(kept, groups), ["lang", "g", "h"], "left")
    value = F.coalesce(F.col("v") * gap(F.col("p"), F.col("q")), F.lit(0)) + F.coalesce("more", F.lit(0))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))


def term_text() -> Column:
    words = F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("a", "b")])
    short = F.call_function("rtrim", F.lit("\0"), F.unhex(words).cast("string"))
    return F.coalesce(F.col("t").cast("string"), short)


def term_rows(kept: DataFrame, groups: DataFrame) -> DataFrame:
    sizes = small(groups.select("lang", "source", "size", "lang_size"), MAX_BROADCAST_GROUPS)
    rows = kept.join(sizes, ["lang", "source"]).select("lang", "source", *TERM, weight(F.col("n"), F.col("size")).alias("p"),
                                                       weight(F.col("total"), F.col("lang_size")).alias("q"))
    return rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), term_text().alias("item"), gap(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all ``pair`` rows, and the ``top`` ranks of the ``term`` rows of each group."""
    given = docs.select(*[F.coalesce(column(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))],
                        column(text).cast("binary").alias("text"))
    kept = stored(kept_counts(term_counts(given), min_docs), "audit-kept")
    groups = stored(group_table(given, kept), "audit-groups")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    terms = term_rows(kept, groups).select("*", place).where(F.col("rank") <= top)
    return pair_rows(kept, groups).select("*", place).unionByName(terms)
