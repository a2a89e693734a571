"""Quality classifier: interpolated modified Kneser-Ney byte n-grams of trusted text.

Model. Words ``[^\\x20\\x09-\\x0D]+`` are spelled byte by byte, each ended by one symbol; the n-grams are up to
five bytes of context and a byte. They run over the words' ends through the whole text (RUNNING), so the order
of words counts; WORDS is the same with every word by itself. The longest contexts use counts, the
shorter ones continuation counts (of distinct longer n-grams), each order has three
discounts from its counts of counts, and the shortest backs off to a uniform byte.

Sharded count joins. N-grams are 64-bit integers. What the documents *ask for* (their distinct
n-grams, found with a map-side distinct) is joined order by order with the counts and with the
contexts' totals, all hash-sharded on those integers; the last two orders have at most 65,536 rows and
are broadcast. The result, one probability per n-gram asked for, is broadcast in parts by ranges of n-grams, of
MAX_BROADCAST_KEYS rows (32 MB) each. A worker holds one part at a time: it spells ``GROUP`` bytes of text and looks their n-grams
up in one part after another, so a larger model costs reads of local files but no more memory, and no disk
beyond the model's own size. Beyond MAX_PARTS parts, (document, n-gram, count) rows are joined with it instead, which shuffles
an n-gram for nearly every byte. Texts are only shuffled where over MAX_BROADCAST_ROWS trusted rows are trained on (once).

Verdict. A document is rejected if its perplexity per byte is above the threshold of its language and length
band: the ``quantile`` of all trusted documents of that language and band that are not trained on, times
``margin``. The bands are texts under ``short_symbols`` bytes, whose perplexity spreads wider, and the others. Where
under ``min_rows`` such documents exist, and for NULL languages, the quantile is over the band's documents of all
languages, and without any of those over all held-out ones. Texts without words (NULL, empty) are rejected. Without
trusted rows nothing is judged and all texts with words are kept.

Memory. Texts are taken whole, in pieces of ``PIECE`` bytes that overlap by the context, so what a task holds does
not grow with the length of a text beyond the text itself; distinct n-grams are passed on at ``MAX_PENDING``. Workers get
each text once, ``common.TEXT_ROWS`` at a time, and send back numbers.

All trusted rows (quality 1, not toxic) are used, each once: the half with an even hash of their id trains the model, the
other half sets the thresholds. Both halves grow with the labels. One scan of the texts gives what is asked for and, from
the rows trained on, the counts. Repeated rows are judged each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.bpe import slices, text_bytes
from cartwise.llm.common import column, packed, ship, small, stable, stored, text_batches, unpacked

MAX_BROADCAST_KEYS = 2_000_000  # of a part of the model
MAX_PARTS = 50
GROUP = 1 << 22  # bytes of text that are looked up together in a model of several parts
MAX_BROADCAST_ROWS = 1_000_000  # 8 MB of row numbers
MAX_PENDING = 1_000_000  # n-grams that a task holds before it passes them on
PIECE = 1 << 19  # bytes whose n-grams are made at a time
SPACE_TO_LF = bytes.maketrans(b" \t\x0b\x0c\r", b"\n" * 5)
LF_RUN = re.compile(rb"\n\n+")


@dataclass(frozen=True)
class Settings:
    quantile: float = 0.99
    margin: float = 1.5
    min_rows: int = 50
    short_symbols: int = 120


def trusted(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Distinct ids of rows that are labelled good and not toxic, and never otherwise."""
    good = F.min(F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False)))
    return labels.where(column(doc_id).isNotNull()).groupBy(column(doc_id).alias("id")).agg(good.alias("good")).where("good").select("id")


@dataclass(frozen=True)
class Grams:
    """N-grams of ``order`` bytes of context and a byte, as integers; ``order`` is at most 6 (56 bits)."""

    order: int
    across: bool

    def runs(self, text: bytes) -> list[bytes]:
        """The text (with ``across`` false each word) after ``order`` end symbols, its words ended by one each."""
        joined = LF_RUN.sub(b"\n", text.translate(SPACE_TO_LF)).strip(b"\n")
        pad = (b"\n" if self.across else b" ") * self.order
        units = ([joined] if self.across else joined.split(b"\n")) if joined else []
        return [pad + u + b"\n" for u in units]

    def pieces(self, raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The n-grams of all texts in order, and the text that each is from, about ``PIECE`` at a time. Pieces of
        one text overlap by the context, so that no n-gram is lost or made twice."""
        runs, owners, size = [], [], 0
        for i, text in enumerate(raw):
            for run in self.runs(text):
                for at in range(0, len(run) - self.order, PIECE):
                    runs.append(run[at:at + PIECE + self.order])
                    owners.append(i)
                    size += len(runs[-1])
                    if size >= PIECE:
                        yield self._keys(runs, owners)
                        runs, owners, size = [], [], 0
        if runs:
            yield self._keys(runs, owners)

    def _keys(self, runs: list[bytes], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) - self.order for x in runs], dtype=np.int64)
        a = np.frombuffer(b"".join(runs), dtype=np.uint8)
        key = np.zeros(len(a) - self.order, dtype=np.int64)
        for i in range(self.order + 1):
            key <<= 8
            key |= a[i:i + len(key)]
        at = np.arange(size.sum()) + np.repeat(self.order * np.arange(len(size)), size)
        return key[at], np.repeat(np.array(owners), size)


def _text_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """Row ranges of about ``limit`` bytes with their texts; only one range is held as Python objects at a time."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    for lo, hi in slices(sizes, limit):
        yield lo, hi, text_bytes(column.slice(lo, hi - lo))


WORDS, RUNNING = Grams(4, False), Grams(5, True)


def _distinct(docs: DataFrame, text: str, grams: Grams, taught: str | None = None) -> DataFrame:
    """(key, c): n-grams with their counts, summed within slices and tasks but not over tasks. Texts of rows
    whose column ``taught`` is false add 0."""
    ship(docs.sparkSession)

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, c = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(key)
        key, c = key[order], c[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
        return key[first], np.add.reduceat(c, first) if len(first) else c

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        parts, size = [none], 0  # what is summed, and what came since
        for b in batches:
            marks = b.column(1).to_pylist()
            for lo, hi, raw in _text_slices(b.column(0), PIECE):
                for mark in sorted(set(marks[lo:hi])):
                    for grams_of, _ in grams.pieces([x for x, m in zip(raw, marks[lo:hi]) if m == mark]):
                        key, n = np.unique(grams_of, return_counts=True)
                        parts.append((key, n * mark))
                        size += len(key)
                        if size > MAX_PENDING // 2:
                            parts, size = [summed(parts)], 0
                            if len(parts[0][0]) > MAX_PENDING:
                                yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], ["key", "c"])
                                parts = [none]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(parts)], ["key", "c"])

    mark = F.lit(True) if taught is None else F.coalesce(column(taught), F.lit(False))
    return docs.select(F.col(text).cast("binary").alias("t"), mark.alias("m")).mapInArrow(run, "key long, c long")


def ngram_counts(docs: DataFrame, text: str = "text", grams: Grams = WORDS) -> DataFrame:
    """(key, c): the longest n-grams of all texts with their counts."""
    return _distinct(docs, text, grams).groupBy("key").agg(F.sum("c").alias("c"))


def ngrams_asked(docs: DataFrame, text: str = "text", grams: Grams = WORDS) -> DataFrame:
    """(key): the distinct longest n-grams of all texts."""
    return _distinct(docs, text, grams).select("key").distinct()


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Of n-grams counted once, twice, and more often, from the counts of counts (kept in range
    where those are zero or out of order)."""
    n1, n2, n3, n4 = counts.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first()
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    raw = [i - (i + 1) * y * b / a if a else i * y for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(d, 0.1 * i), 0.95 * i) for i, d in enumerate(raw, 1))


def probabilities(asked: DataFrame, counts: DataFrame, grams: Grams = WORDS) -> DataFrame:
    """(key, logp): the interpolated log probability of the byte after its context, for each n-gram asked."""
    orders = [counts]
    for n in range(grams.order, 0, -1):  # continuation counts of the orders below
        shorter = F.col("key").bitwiseAND((1 << 8 * n) - 1).alias("key")
        orders.append(stored(orders[-1].select(shorter).groupBy("key").agg(F.count("*").alias("c")), "kn-order"))
    out = asked.withColumn("p", F.lit(1 / 256))
    for n, table in enumerate(reversed(orders)):  # n bytes of context
        d1, d2, d3 = _discounts(table)
        c = F.col("c")
        cut = F.when(c == 1, d1).when(c == 2, d2).otherwise(d3)
        room = F.shiftright("key", 8)
        totals = table.groupBy(room.alias("room")).agg(F.sum("c").alias("total"), F.sum(cut).alias("left"))
        dishes = table.select(F.col("key").alias("dish"), (c - cut).alias("own"))
        if n < 2:  # at most 65,536 rows
            totals, dishes = F.broadcast(totals), F.broadcast(dishes)
        at = F.col("key").bitwiseAND((1 << 8 * (n + 1)) - 1)
        out = (out.withColumn("_dish", at).withColumn("_room", F.shiftright(at, 8))
               .join(totals, F.col("_room") == F.col("room"), "left").join(dishes, F.col("_dish") == F.col("dish"), "left")
               .select("key", F.when(F.col("total").isNull(), F.col("p")).otherwise(
                   (F.coalesce("own", F.lit(0.0)) + F.col("left") * F.col("p")) / F.col("total")).alias("p")))
    return out.select("key", F.log("p").alias("logp"))


def train(docs: DataFrame, sample: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          grams: Grams = RUNNING) -> DataFrame:
    """(key, logp) for every n-gram of ``docs``, learned from those whose id is in ``sample`` (id, distinct; stored)."""
    taught = small(sample.select("id", F.lit(True).alias("taught")), MAX_BROADCAST_ROWS)
    texts = docs.select(column(doc_id).alias("id"), column(text).alias("body")).join(taught, "id", "left")
    asked = stored(_distinct(texts, "body", grams, "taught").groupBy("key").agg(F.sum("c").alias("c")), "kn-asked")
    counts = stored(asked.where("c > 0"), "kn-counts")
    return stored(probabilities(asked.select("key"), counts, grams), "kn-model")


def _parts(model: DataFrame) -> tuple[list[Broadcast], np.ndarray] | None:
    """The (stored) model in ranges of n-grams, each broadcast as sorted arrays, and the last n-gram of each but the last; None
    if it is too large. The driver holds one part at a time."""
    rows = model.count()
    n = max(1, -(-rows // MAX_BROADCAST_KEYS))
    if n > MAX_PARTS:
        return None
    edges = sorted(set(model.select(F.percentile_approx("key", [i / n for i in range(1, n)], 100_000)).first()[0])) if n > 1 else []
    parts = []
    for after, last in zip([None, *edges], [*edges, None]):
        part = model if after is None else model.where(F.col("key") > after)
        table = (part if last is None else part.where(F.col("key") <= last)).select("key", "logp").toArrow().sort_by("key")
        parts.append(model.sparkSession.sparkContext.broadcast((table.column("key").to_numpy(), table.column("logp").to_numpy())))
    return parts, np.array(edges, np.int64)


def perplexities(docs: DataFrame, model: DataFrame, *, text: str = "text", grams: Grams = WORDS, with_text: bool = True) -> DataFrame:
    """``docs``, its text only ``with_text``, with ``n_words``, ``n_symbols`` and ``perplexity`` (NULL without words) appended."""
    ship(docs.sparkSession)
    names = ("n_words", "n_symbols", "perplexity")
    keep = [c for c in docs.columns if c not in names and (with_text or c != text)]
    given = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    fields = [T.StructField(n, T.LongType() if n != "perplexity" else T.DoubleType()) for n in names]
    schema = T.StructType([*docs.select(*keep).schema.fields, *fields])
    found = _parts(model)
    if found is None:
        return _perplexities_joined(docs.select(*dict.fromkeys((*keep, text))), model, text, grams).select(*schema.names)
    parts, edges = found
    group = GROUP if len(parts) > 1 else PIECE

    def look_up(waiting: list[tuple[np.ndarray, ...]], total: np.ndarray) -> None:
        """Add the log probabilities of pieces (n-grams, place among them and text of each position) to their texts' totals."""
        logp = [np.zeros(len(key)) for key, _, _ in waiting]
        cuts = [[0, *np.searchsorted(key, edges, side="right"), len(key)] for key, _, _ in waiting]
        for i, part in enumerate(parts):
            known, logs = part.value
            for (key, _, _), out, cut in zip(waiting, logp, cuts):
                mine = slice(cut[i], cut[i + 1])
                out[mine] = logs[np.searchsorted(known, key[mine])]
            if len(parts) > 1 and getattr(part, "_path", None):  # else it would be kept in memory, with all others
                del known, logs
                vars(part).pop("_value", None)
        for (_, at, owner), out in zip(waiting, logp):
            total += np.bincount(owner, weights=out[at], minlength=len(total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw in _text_slices(b.column(len(keep)), group):
                total, n, words = np.zeros(hi - lo), np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                waiting, size = [], 0
                for keys, owner in grams.pieces(raw):
                    key, at = np.unique(keys, return_inverse=True)  # sorted, so that the search runs along the table
                    waiting.append((key, at.astype(np.int32), owner.astype(np.int32)))
                    size += len(keys)
                    n += np.bincount(owner, minlength=hi - lo)
                    words += np.bincount(owner[keys & 0xFF == 10], minlength=hi - lo)
                    if size >= group:
                        look_up(waiting, total)
                        waiting, size = [], 0
                if waiting:
                    look_up(waiting, total)
                ppl = pa.array(np.exp(np.minimum(-total / np.maximum(n, 1), 700)), mask=n == 0)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[:len(keep)]), pa.array(words), pa.array(n), ppl], schema.names)

    return given.mapInArrow(run, schema)


def _perplexities_joined(docs: DataFrame, model: DataFrame, text: str, grams: Grams) -> DataFrame:
    """The same where the model is too large to broadcast: a row per document and distinct n-gram
    is joined with it. Row ids follow the scan, so both reads of ``docs`` agree on them."""
    docs = stable(docs)
    rows = docs.withColumn("_rid", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rids = b.column(0).to_pylist()
            for lo, hi, raw in _text_slices(b.column(1), PIECE):
                for rid, one in zip(rids[lo:hi], raw):
                    for keys, _ in grams.pieces([one]):
                        key, n = np.unique(keys, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), rid)), pa.array(key), pa.array(n)], ["rid", "key", "n"])

    parts = rows.select("_rid", F.col(text).cast("binary").alias("t")).mapInArrow(run, "rid long, key long, n long")
    sums = parts.join(model, "key").groupBy("rid").agg(F.sum("n").alias("n_symbols"), F.sum(F.col("n") * F.col("logp")).alias("total"),
                                                       F.sum(F.when(F.col("key").bitwiseAND(0xFF) == 10, F.col("n"))).alias("n_words"))
    none = F.lit(0).cast("long")
    return rows.join(sums, F.col("_rid") == F.col("rid"), "left").select(
        *docs.columns, F.coalesce("n_words", none).alias("n_words"), F.coalesce("n_symbols", none).alias("n_symbols"),
        F.when(F.col("n_symbols") > 0, F.exp(F.least(-F.col("total") / F.col("n_symbols"), F.lit(700.0)))).alias("perplexity"))


def _short(s: Settings) -> Column:
    return F.col("n_symbols") < s.short_symbols


def thresholds(scored: DataFrame, held: DataFrame, s: Settings, *, doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """(lang, short, threshold): one row per language and length band with ``min_rows`` trusted rows whose id is in ``held``; those with
    lang NULL are for all others, that with short NULL too is for bands without any. ``scored`` is a stored table."""
    rows = scored.where("n_symbols > 0").select(column(doc_id).alias("id"), column(lang).alias("lang"), _short(s).alias("short"), "perplexity")
    rows = rows.join(held, "id", "left_semi")
    cut = (F.percentile_approx("perplexity", s.quantile, 10_000) * s.margin).alias("threshold")
    n = F.count("*").alias("n")
    none = F.lit(None).cast("string").alias("lang")
    own = rows.where("lang is not null").groupBy("lang", "short").agg(cut, n).where(F.col("n") >= s.min_rows)
    band = rows.groupBy("short").agg(cut, n)
    every = rows.agg(cut).select(none, F.lit(None).cast("boolean").alias("short"), "threshold")
    return own.select("lang", "short", "threshold").union(band.select(none, "short", "threshold")).union(every)


@dataclass(frozen=True)
class Classifier:
    model: DataFrame
    limits: DataFrame
    settings: Settings

    def judge(self, scored: DataFrame, *, lang: str = "lang") -> DataFrame:
        """``scored`` with threshold and kept."""
        rest = {r["short"]: r["threshold"] for r in self.limits.where("lang is null").collect()}  # three rows at most
        own = small(self.limits.where("lang is not null").select(F.col("lang").alias("_lang"), F.col("short").alias("_short"), F.col("threshold").alias("_limit")), 10_000)
        short = _short(self.settings)
        every = F.lit(rest[None]).cast("double")
        others = F.coalesce(F.when(short, F.lit(rest.get(True))).otherwise(F.lit(rest.get(False))).cast("double"), every)
        keep = [c for c in scored.columns if c not in ("threshold", "kept")]
        judged = scored.join(own, (F.col(lang) == F.col("_lang")) & (short == F.col("_short")), "left")
        limit = F.coalesce("_limit", others)
        fine = F.coalesce(F.col("perplexity") <= limit, F.lit(True))
        return judged.select(*keep, limit.alias("threshold"), ((F.col("n_words") > 0) & fine).alias("kept"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, doc_id: str = "doc_id",
        text: str = "text", lang: str = "lang") -> tuple[Classifier, DataFrame]:
    """The classifier, and (doc_id, lang, n_words, n_symbols, perplexity, and _rid if ``docs`` has it) of all
    ``docs``, stored."""
    with text_batches(docs.sparkSession):
        good = stored(trusted(labels, doc_id), "kn-trusted")
        half = F.pmod(F.xxhash64("id"), F.lit(2))
        sample, held = stored(good.where(half == 0), "kn-sample"), good.where(half == 1)
        model = train(docs, sample, doc_id=doc_id, text=text)
        rid = [c for c in docs.columns if c == "_rid"]
        slim = docs.select(column(doc_id).alias(doc_id), column(lang).alias(lang), *rid, column(text).alias("_body"))
        scored = stored(perplexities(slim, model, text="_body", grams=RUNNING, with_text=False), "kn-scored")
        limits = stored(thresholds(scored, held, settings, doc_id=doc_id, lang=lang), "kn-limits")
    return Classifier(model, limits, settings), scored


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, doc_id: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, lang, n_words, n_symbols, perplexity, threshold and kept for every document."""
    classifier, scored = fit(docs.select(*dict.fromkeys((doc_id, text, lang))), labels, settings, doc_id=doc_id, text=text, lang=lang)
    return classifier.judge(scored, lang=lang)


def kept(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, doc_id: str = "doc_id",
         text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, unchanged. Rows are numbered along the scan, scored once, and
    the numbers of those that go are joined (broadcast when few), so that texts are not shuffled."""
    docs = stable(docs)
    rid = F.monotonically_increasing_id()
    slim = docs.select(column(doc_id).alias(doc_id), column(lang).alias(lang), column(text).alias(text), rid.alias("_rid"))
    classifier, scored = fit(slim, labels, settings, doc_id=doc_id, text=text, lang=lang)
    goes = stored(classifier.judge(scored, lang=lang).where("not kept").select("_rid"), "kn-goes")
    numbered = docs.select(packed(docs), rid.alias("_rid"))
    return numbered.join(small(goes, MAX_BROADCAST_ROWS), "_rid", "left_anti").select(*unpacked(numbered))
