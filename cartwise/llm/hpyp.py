"""Hierarchical Pitman-Yor language model with seatings sampled by Gibbs.

Restaurants. A text is a sequence of words and one end. Each word is drawn in the restaurant of the word before it (the
end for the first); the parent of all these is the word restaurant without context, whose parent is a spelling model: byte
restaurants for contexts of four bytes, whose parents are the contexts of three, two, one and no bytes; contexts with the
same last bytes share their parent. The root's parent is uniform over bytes. A customer who opens a table
sends one customer to the parent, so

    P(w | u) = (c_uw - d t_uw + (strength + d t_u.) P(w | parent of u)) / (strength + c_u.)

with c customers and t tables. In ``score`` all words that training lacks are one unknown word, as in the base
score; its probability is what the spelling of the known ones leaves over, times that of a new table. In ``spelled_score``
each of them is spelled: it has no customers, so its probability is its spelling's, times that of a new table.

Seating. Given the parent's probabilities, the tables of one dish in one restaurant are drawn as a block
from their exact conditional, t ~ rising(strength + d T, d, t) P^t S_d(c, t) with generalised Stirling
numbers S, up to ``EXACT`` customers; beyond, from its limit for many customers, where S(c, t + 1) / S(c, t)
is 1 / (t d): one table and a negative binomial number (strength / d + T + 1, P) of others, c at most. Sweeps go from long contexts to short ones; dishes of one
restaurant are drawn side by side given the totals before the sweep (the usual parallel Gibbs).
Probabilities are averaged over the sweeps after burn-in.

Distribution. Spelling restaurants are grouped by a hash of the last two bytes of their context: a group holds
whole subtrees, its parent probabilities (contexts of at most one byte, 65,536 numbers at most) come from the
driver, and its tables are counted back for the next round. Word pairs are counted by (context, word); contexts are grouped by
their hash, whole, but with a row only for each dish of several customers (one customer is one table). The tables of the contexts are the
customers of the word restaurant, and its tables those of the spelling: in the first of ``passes`` passes the least that can be sent, one
for each dish, then what the pass before sampled. The word restaurant
needs only its total number of tables from sweep to sweep, so each sweep is a map and one sum.

Scoring. A text's score is the sum over its words of what they give if no pair had a dish, log10 of P(w | parent) and of the share of new
tables after w, and over its pairs that have a dish of what that adds. Words among the ``head`` most frequent and pairs among the ``head_pairs``
most frequent (bounded tables) are added map-side; each other word and pair of a text is asked for once, by its 64-bit XXH64 or the pair's
64 bits, or by the places of both words in ``head``. Spark deals what is asked for and the dishes and words that answer by these numbers
into groups of about ``GROUP_TOKENS`` tokens, as lists, so that a row is not one pair; no word or pair that is in every text is asked for.
What a group answers is one row for each text. What answers is packed once, for all shares. The texts are scored in ``SHARES`` shares, by a hash of
the text, and a stored table goes when nothing reads it any more: the seating and the model go before the first share. Every text asks for nearly every one of its rare pairs, so the lists grow with the tokens.
Two words of one hash would share counts (probability 3e-8 among a million words).

All draws are seeded by what they are drawn for, so a lost task that runs again gives the same rows.
NULL and empty texts are the end alone. Repeated rows are scored each; NULL ids count as training rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.bpe import _Index, slices, text_bytes
from cartwise.llm.common import forget, ship, stored

END = b"\n"  # the end of a text as a word; words hold no white space
ORDER = 4
EXACT = 256
MAX_BROADCAST_KEYS = 2_000_000
FLUSH_WORDS = 300_000
FLUSH_PAIRS = 4_000_000
FLUSH_ASKED = 2_000_000
FLUSH_GIVEN = 1_000_000
GROUP_TOKENS = 500_000
SHARES = 3  # of the texts, scored one after the other, so that the lists of only one are on disk
TEXT, HEADS, PAIR, WORD = range(4)  # texts; pairs of two head words, other pairs, words that are not in the head: as asked for, and what answers
# each stored table's shuffle files go with its job, not when the driver collects its garbage; hashes that recur far apart
# (the words of the pairs) are packed, which Snappy's short window does not do
WHILE_SCORING = (("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false"),  # name, value, default
                 ("spark.sql.parquet.compression.codec", "zstd", "snappy"))
LOW = 256
LEAST_GROUPS, GROUP_KEYS = 64, 50_000  # n-grams seated together; a subtree has at most 256^3, in fact thousands


@dataclass(frozen=True)
class Settings:
    strength: float = 1.0
    burn_in: int = 2
    samples: int = 3
    rounds: int = 1
    passes: int = 2
    head: int = 1 << 18
    head_pairs: int = 1 << 20
    seed: int = 42


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased words ``[^\\x20\\x09-\\x0D]+``, then the end."""
    return [*text.lower().split(), END]


def word_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word, 42)
    return h - (1 << 64) if h >> 63 else h


# ---- seating -------------------------------------------------------------------------------------

_STIRLING: dict[float, np.ndarray] = {}


def log_stirling(d: float) -> np.ndarray:
    """log S_d(c, t) for c, t up to EXACT: S(c+1, t) = S(c, t-1) + (c - d t) S(c, t)."""
    if d not in _STIRLING:
        s = np.full((EXACT + 1, EXACT + 1), -np.inf)
        s[0, 0] = 0.0
        t = np.arange(EXACT + 1)
        for c in range(EXACT):
            with np.errstate(divide="ignore", invalid="ignore"):
                stay = np.where(t <= c, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + s[c]
            stay[0] = -np.inf
            s[c + 1] = np.logaddexp(stay, np.concatenate(([-np.inf], s[c, :-1])))
        _STIRLING[d] = s
    return _STIRLING[d]


def seat(c: np.ndarray, total: np.ndarray, parent: np.ndarray, d: float, strength: float,
         rng: np.random.Generator) -> np.ndarray:
    """Draw the tables of each dish: ``c`` customers, ``total`` tables in its restaurant so far,
    ``parent`` its probability there."""
    out = np.minimum(c, 1).astype(np.int64)
    rest, log_s = strength + d * total, log_stirling(d)
    order = np.argsort(c, kind="stable")
    values, firsts = np.unique(c[order], return_index=True)
    for v, lo, hi in zip(values.tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(c)]):
        if not 2 <= v <= EXACT:
            continue
        for at in range(lo, hi, max(1, (1 << 20) // v)):
            rows = order[at:min(hi, at + max(1, (1 << 20) // v))]
            j = np.arange(v)
            w = np.cumsum(np.log(rest[rows, None] + d * j) + np.log(parent[rows, None]), axis=1) + log_s[v, 1:v + 1]
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            out[rows] = 1 + (w < (rng.random(len(rows)) * w[:, -1])[:, None]).sum(axis=1)
    many = np.flatnonzero(c > EXACT)
    p = np.minimum(parent[many], 1 - 1e-9)
    more = rng.poisson(rng.standard_gamma(rest[many] / d + 1) * p / (1 - p))  # negative binomial
    out[many] = np.minimum(c[many], 1 + more)
    return out


class Level:
    """The dishes of the restaurants of one context length: ``key`` is context and dish."""

    def __init__(self, key: np.ndarray, c: np.ndarray):
        self.key, self.c = key, c
        self.room = np.unique(key >> 8, return_inverse=True)[1]
        self.t = np.minimum(c, 1)

    def totals(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.room, weights=x)[self.room]

    def draw(self, parent: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> None:
        self.t = np.minimum(self.t, self.c)
        self.t = seat(self.c, self.totals(self.t), parent, d, strength, rng)

    def probability(self, parent: np.ndarray, d: float, strength: float) -> np.ndarray:
        t = np.minimum(np.maximum(self.t, np.minimum(self.c, 1)), self.c)
        return (np.maximum(self.c - d * t, 0) + (strength + d * self.totals(t)) * parent) / (strength + self.totals(self.c))


def _shorter(level: Level, length: int) -> tuple[Level, np.ndarray]:
    """The level of contexts one byte shorter, and each dish's place there."""
    key, up = np.unique(level.key & ((1 << 8 * length) - 1), return_inverse=True)
    return Level(key, np.bincount(up, weights=level.t, minlength=len(key)).astype(np.int64)), up


def sample_tree(key: np.ndarray, c: np.ndarray, base: np.ndarray, lengths: range, d: float, s: Settings,
                rng: np.random.Generator) -> tuple[np.ndarray, Level]:
    """Averaged probability of each (context, dish) in ``key`` and the last seating of the shortest
    contexts. ``lengths`` counts their bytes from the longest; ``base(key)`` is the parent of the last."""
    levels, ups = [Level(key, c)], []
    for n in list(lengths)[1:]:
        level, up = _shorter(levels[-1], n + 1)
        levels.append(level)
        ups.append(up)
    root = base[levels[-1].key & (base.size - 1)]

    def parents() -> list[np.ndarray]:
        out = [root]
        for level, up in zip(levels[:0:-1], ups[::-1]):
            out.append(level.probability(out[-1], d, s.strength)[up])
        return out[::-1]

    total = np.zeros(len(key))
    for sweep in range(s.burn_in + s.samples):
        for i, level in enumerate(levels):
            if i:
                level.c = np.bincount(ups[i - 1], weights=levels[i - 1].t, minlength=len(level.key)).astype(np.int64)
            level.draw(parents()[i], d, s.strength, rng)
        if sweep >= s.burn_in:
            total += levels[0].probability(parents()[0], d, s.strength)
    return total / s.samples, levels[-1]


# ---- spelling ------------------------------------------------------------------------------------

def spell_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four bytes of context and a byte for each byte and the end of each word, and the word of each."""
    data = np.frombuffer(b"".join(b"    " + w + END for w in words), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) + 5 for w in words])
    if not len(data):
        return data, owner
    key = data[4:] | data[3:-1] << 8 | data[2:-2] << 16 | data[1:-3] << 24 | data[:-4] << 32
    inside = owner[4:] == owner[:-4]
    return key[inside], owner[4:][inside]


def count_words(docs: DataFrame, text: str, train: Column) -> DataFrame:
    """(word, c): every distinct word of the texts with its count in those where ``train`` is true."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for b in batches:
            for raw, own in zip(text_bytes(b.column(0)), b.column(1).to_pylist()):
                words = words_of(raw)
                seen.update(words if own else dict.fromkeys(words, 0))
                if len(seen) > FLUSH_WORDS:
                    yield flush(seen)
        yield flush(seen)

    def flush(seen: Counter[bytes]) -> pa.RecordBatch:
        out = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        seen.clear()
        return pa.RecordBatch.from_arrays(out, ["word", "c"])

    given = docs.select(F.col(text).cast("binary").alias("t"), train.alias("own"))
    return given.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def spelling_counts(vocabulary: DataFrame, customers: str | Column = "1") -> DataFrame:
    """(key, c): context and byte of all spellings, with the ``customers`` that the words (word, c) send; words without a count
    send none, so that their spellings are in the trees as dishes that nobody has yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, sent = b.column(0).to_pylist(), b.column(1).to_numpy()
            for lo, hi in slices([len(w) for w in words], 1 << 20):
                keys, owner = spell_keys(words[lo:hi])
                key, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, weights=sent[lo:hi][owner], minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "c"])

    sent = F.when(F.col("c") > 0, F.expr(customers) if isinstance(customers, str) else customers).otherwise(0).cast("long")
    return vocabulary.select("word", sent.alias("sent")).mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _low_probabilities(key: np.ndarray, c: np.ndarray, d: float, s: Settings, rng: np.random.Generator) -> np.ndarray:
    """P(byte | one byte) for all pairs, from the customers of the one-byte contexts: at most 65,536."""
    every = np.arange(LOW * LOW, dtype=np.int64)
    customers = np.zeros(LOW * LOW, dtype=np.int64)
    customers[key] = c
    return sample_tree(every, customers, np.full(LOW, 1 / LOW), range(1, -1, -1), d, s, rng)[0]


def _seater(base, turn: int, d: float, s: Settings):
    """Seats one group of whole subtrees: tables of its two-byte contexts, or in the last turn probabilities."""
    def run(group, t):
        t = t.sort_by("key")
        rng = np.random.default_rng([s.seed, turn, group[0].as_py()])
        p, low = sample_tree(t.column("key").to_numpy(), t.column("c").to_numpy(), base.value, range(ORDER, 1, -1), d, s, rng)
        if turn < s.rounds:
            return pa.table({"key": low.key & 0xFFFF, "c": low.t.astype(np.int64), "p": np.zeros(len(low.key))})
        return pa.table({"key": t.column("key"), "c": t.column("c"), "p": p})

    return run


def spelling_model(counts: DataFrame, d: float, s: Settings) -> DataFrame:
    """(key, p): the averaged probability of each byte after its context."""
    spark = counts.sparkSession
    # whole subtrees (contexts with the same last two bytes) go together, many to a group
    groups = max(LEAST_GROUPS, counts.count() // GROUP_KEYS)
    grouped = counts.withColumn("part", F.pmod(F.hash(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(groups)))
    pair = F.col("key").bitwiseAND(0xFFFF).alias("key")
    # the least seating: one table per dish and two-byte context
    low = (counts.where("c > 0").select(F.col("key").bitwiseAND(0xFFFFFF).alias("key")).distinct()
           .groupBy(pair).agg(F.count("*").alias("c")))
    for turn in range(s.rounds + 1):
        rows = low.toPandas()  # at most 65,536 rows
        base = spark.sparkContext.broadcast(_low_probabilities(
            rows["key"].to_numpy(), rows["c"].to_numpy(), d, s, np.random.default_rng([s.seed, turn])))

        seated = grouped.groupBy("part").applyInArrow(_seater(base, turn, d, s), "key long, c long, p double")
        if turn < s.rounds:
            low = seated.groupBy("key").agg(F.sum("c").alias("c"))
    return seated.select("key", "p")


def spell(vocabulary: DataFrame, model: DataFrame) -> DataFrame:
    """(h, c, spelled): the natural log probability of each word's spelling.

    A model of up to MAX_BROADCAST_KEYS keys (32 MB) is broadcast; a larger one is joined.
    """
    spark = vocabulary.sparkSession
    schema = "h long, c long, spelled double"
    if model.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS:
        table = model.toArrow().sort_by("key")  # bounded by the check
        shared = spark.sparkContext.broadcast((table.column("key").to_numpy(), np.log(table.column("p").to_numpy())))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, logs = shared.value
            for b in batches:
                words = b.column(0).to_pylist()
                for lo, hi in slices([len(w) for w in words]):
                    keys, owner = spell_keys(words[lo:hi])
                    total = np.bincount(owner, weights=logs[np.searchsorted(known, keys)], minlength=hi - lo)
                    h = pa.array([word_hash(w) for w in words[lo:hi]], pa.int64())
                    yield pa.RecordBatch.from_arrays([h, b.column(1).slice(lo, hi - lo), pa.array(total)], ["h", "c", "spelled"])

        return vocabulary.select("word", "c").mapInArrow(run, schema)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).to_pylist()
            for lo, hi in slices([len(w) for w in words], 1 << 20):
                keys, owner = spell_keys(words[lo:hi])
                h = np.array([word_hash(w) for w in words[lo:hi]], dtype=np.int64)
                c = b.column(1).slice(lo, hi - lo).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(h[owner]), pa.array(c[owner]), pa.array(keys)], ["h", "c", "key"])

    rows = vocabulary.select("word", "c").mapInArrow(parts, "h long, c long, key long")
    return rows.join(model, "key").groupBy("h", "c").agg(F.sum(F.log("p")).alias("spelled"))


# ---- words ---------------------------------------------------------------------------------------

def _sweeps(words: DataFrame, types: int, first: int, last: int, d: float, s: Settings) -> list[float]:
    """The word restaurant's tables before each sweep from ``first`` to ``last`` (the least seating first), and after the last."""
    totals, given = [float(types)], words.select("h", "c", "spelled")
    for sweep in range(first, last):
        def run(batches: Iterator[pa.RecordBatch], total: float = totals[-1], sweep: int = sweep) -> Iterator[pa.RecordBatch]:
            for b in batches:
                t = _word_sweep(b, total, sweep, d, s)
                yield pa.RecordBatch.from_arrays([pa.array([int(t.sum())], pa.int64())], ["t"])

        totals.append(float(given.mapInArrow(run, "t long").agg(F.sum("t")).first()[0] or 0))
    return totals


def word_tables(words: DataFrame, types: int, turn: int, d: float, s: Settings) -> DataFrame:
    """(h, t): each word's tables after the burn-in sweeps of pass ``turn``. ``words`` is a stored table."""
    first = 1000 * (turn + 1)  # other draws than in other passes
    total = _sweeps(words, types, first, first + s.burn_in, d, s)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = _word_sweep(b, total, first + s.burn_in, d, s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(t)], ["h", "t"])

    return words.select("h", "c", "spelled").mapInArrow(run, "h long, t long")


def word_model(words: DataFrame, customers: int, types: int, d: float, s: Settings) -> tuple[DataFrame, float]:
    """(h, c, score): the averaged log10 probability of each known word; and that of the unknown one,
    which has what the parent leaves over. ``words`` is a stored table."""
    totals, given = _sweeps(words, types, 0, s.burn_in + s.samples, d, s), words.select("h", "c", "spelled")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, parent = b.column(1).to_numpy(), np.exp(b.column(2).to_numpy())
            p = np.zeros(len(c))
            for sweep in range(s.burn_in, s.burn_in + s.samples):
                t = _word_sweep(b, totals[sweep], sweep, d, s)
                p += (c - d * t + (s.strength + d * totals[sweep + 1]) * parent) / (s.strength + customers)
            # a spelling too long for a double keeps its logarithm
            low = (b.column(2).to_numpy() + math.log(new)) / math.log(10)
            with np.errstate(divide="ignore"):
                lp = np.where(p > 0, np.log10(p / s.samples), low)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lp)], ["h", "c", "score"])

    new = sum((s.strength + d * t) / (s.strength + customers) for t in totals[s.burn_in + 1:]) / s.samples
    spelled = given.agg(F.coalesce(F.sum(F.exp("spelled")), F.lit(0.0))).first()[0]
    unknown = math.log10(new * max(1e-9, 1 - spelled))
    return given.mapInArrow(score, "h long, c long, score double"), unknown


def head_words(lm: DataFrame, most: int) -> pa.Table:
    """The ``most`` frequent words (h, c, score), by h. Words up to a count that leaves about so many above it do not compete."""
    n = lm.count()
    if n > most:
        least = lm.agg(F.percentile_approx("c", 1 - most / n, 100_000)).first()[0]
        lm = lm.where(F.col("c") > least)
    return lm.orderBy(F.desc("c"), "h").limit(most).toArrow().sort_by("h")


def _word_sweep(b: pa.RecordBatch, total: float, sweep: int, d: float, s: Settings) -> np.ndarray:
    h, c, spelled = (b.column(i).to_numpy() for i in range(3))
    mark = int(np.bitwise_xor.reduce(h, initial=0)) & (2**63 - 1)
    rng = np.random.default_rng([s.seed, sweep, mark, len(c)])
    return seat(c, np.full(len(c), total), np.maximum(np.exp(spelled), 1e-300), d, s.strength, rng)


# ---- word contexts -------------------------------------------------------------------------------

class Numbers:
    """Numbers the words of a task as they come; emptied when it holds ``FLUSH_WORDS``."""

    def __init__(self) -> None:
        self.empty()

    def empty(self) -> None:
        self.index, self.hashes = _Index(), np.zeros(0, np.int64)

    def of(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of the texts in a row, what each follows (the end at first), and the number of words of each text."""
        end, look = self.index[END], self.index.__getitem__
        lists = [np.array(list(map(look, words_of(x))), dtype=np.int64) for x in raw]
        self.hashes = np.concatenate((self.hashes, np.array([word_hash(w) for w in self.index.fresh], dtype=np.int64)))
        self.index.fresh = []
        flat = np.concatenate(lists)
        return flat, np.concatenate(([end], flat[:-1])), np.array([len(x) for x in lists], dtype=np.int64)


def pair_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    x = u.view(np.uint64)
    return ((x << np.uint64(1)) | (x >> np.uint64(63))).view(np.int64) ^ w


def _pair_key() -> Column:
    return F.shiftleft("u", 1).bitwiseOR(F.shiftrightunsigned("u", 63)).bitwiseXOR(F.col("w")).alias("h")


def count_pairs(docs: DataFrame, text: str, groups: int = LEAST_GROUPS) -> DataFrame:
    """(u, w, c): how often word ``w`` follows ``u`` in the texts, by their hashes; the first follows the end of another text.
    A task sends its pairs as lists, one for each of ``groups`` groups of pairs; a group's pairs come sorted."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, size = Numbers(), [], 0
        for b in batches:
            raw = text_bytes(b.column(0))
            for lo, hi in slices([len(x) for x in raw]):
                if size > FLUSH_PAIRS or len(numbers.index) > FLUSH_WORDS:
                    yield flush(numbers, held)
                    held, size = [], 0
                flat, before, _ = numbers.of(raw[lo:hi])
                held.append(before << 32 | flat)
                size += len(flat)
        if held:
            yield flush(numbers, held)

    def flush(numbers: Numbers, held: list[np.ndarray]) -> pa.RecordBatch:
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        u, w = numbers.hashes[pair >> 32], numbers.hashes[pair & 0xFFFFFFFF]
        if len(numbers.index) > FLUSH_WORDS:
            numbers.empty()
        part, lists = dealt(group_of(pair_key(u, w), groups), u, w, n)
        return pa.RecordBatch.from_arrays([pa.array(part), *lists], ["part", "u", "w", "c"])

    def add(t: pa.Table) -> pa.Table:
        u, w, c = (flattened(t, x) for x in "uwc")
        order = np.lexsort((w, u))
        u, w, c = u[order], w[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], (u[1:] != u[:-1]) | (w[1:] != w[:-1]))))
        return pa.table({"u": u[first], "w": w[first], "c": np.add.reduceat(c, first)})

    given = docs.select(F.col(text).cast("binary").alias("t"))
    sent = given.mapInArrow(run, "part int, u array<long>, w array<long>, c array<long>")
    return sent.groupBy("part").applyInArrow(add, "u long, w long, c long")


def group_of(key: np.ndarray, groups: int) -> np.ndarray:
    mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(groups)).astype(np.int32)


def dealt(part: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The groups that occur in ``part``, and of each of ``values`` a list for each of them, in the order given."""
    order = np.argsort(part.astype(np.uint16) if part.max(initial=0) < 1 << 16 else part, kind="stable")  # small numbers are sorted by radix
    part = part[order]
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(first, len(part)).astype(np.int32))
    return part[first], [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in values]


def flattened(t: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in t.column(name).chunks] or [np.zeros(0)])


def seat_pairs(pairs: DataFrame, lm: DataFrame, turn: int, d: float, s: Settings) -> DataFrame:
    """Seats the restaurants of all contexts ``u`` on the words' probabilities ``lm`` (h, score). (u, w, c, t, last): the mean and
    the last number of tables of each dish of several customers; where ``w`` is NULL, the mean of the context's tables.

    Dishes of one customer have one table and come as their number, so a context is at most as long as the words that
    follow it more than once.
    """
    many = pairs.where("c > 1").join(lm.select(F.col("h").alias("w"), "score"), "w").select("u", "w", "c", "score")
    single = pairs.where("c = 1").groupBy("u").agg(F.count("*").alias("c")).select(
        "u", F.lit(None).cast("long").alias("w"), "c", F.lit(None).cast("double").alias("score"))
    groups = max(LEAST_GROUPS, pairs.count() // (4 * GROUP_KEYS))

    def run(group, t):
        t = t.sort_by([("u", "ascending"), ("w", "ascending")])
        u, at = np.unique(t.column("u").to_numpy(), return_inverse=True)
        one = t.column("w").is_null().to_numpy()
        c = t.column("c").to_numpy()
        alone = np.bincount(at[one], weights=c[one], minlength=len(u))
        room, c, parent = at[~one], c[~one], np.maximum(10.0 ** t.column("score").to_numpy()[~one], 1e-300)
        rng = np.random.default_rng([s.seed, 77 + turn, group[0].as_py()])
        tables, mean, all_mean = np.ones(len(c), np.int64), np.zeros(len(c)), np.zeros(len(u))
        for sweep in range(s.burn_in + s.samples):
            total = alone + np.bincount(room, weights=tables, minlength=len(u))
            tables = seat(c, total[room] - tables, parent, d, s.strength, rng)
            if sweep >= s.burn_in:
                mean += tables / s.samples
                all_mean += (alone + np.bincount(room, weights=tables, minlength=len(u))) / s.samples
        none = pa.nulls(len(u), pa.int64())
        return pa.table({"u": np.concatenate((u[room], u)), "w": pa.concat_arrays([t.column("w").combine_chunks().filter(pa.array(~one)), none]),
                         "c": pa.concat_arrays([pa.array(c), none]), "t": np.concatenate((mean, all_mean)),
                         "last": pa.concat_arrays([pa.array(tables), none])})

    rows = many.unionByName(single).withColumn("part", F.pmod(F.hash("u"), F.lit(groups)))
    return rows.groupBy("part").applyInArrow(run, "u long, w long, c long, t double, last long")


def sent_up(pairs: DataFrame, seated: DataFrame | None) -> DataFrame:
    """(h, k): the customers that the context restaurants send to each word, one for each table; the least seating without ``seated``."""
    if seated is None:
        return pairs.groupBy(F.col("w").alias("h")).agg(F.count("*").alias("k"))
    rows = pairs.where("c = 1").select("w", F.lit(1).cast("long").alias("k")).unionByName(
        seated.where("w is not null").select("w", F.col("last").alias("k")))
    return rows.groupBy(F.col("w").alias("h")).agg(F.sum("k").alias("k"))


# ---- scoring -------------------------------------------------------------------------------------

def discount(counts: DataFrame, c: str = "c") -> float:
    """n1 / (n1 + 2 n2) of the counts, kept inside (0, 1)."""
    n1, n2 = counts.agg(F.count_if(F.col(c) == 1), F.count_if(F.col(c) == 2)).first()
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def score(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None,
          settings: Settings = Settings()) -> DataFrame:
    """One row per document; learns from the rows where ``held_out`` is not true.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity (of the
    model, per token), spelled_score. Scores are log10 probabilities.
    """
    conf = docs.sparkSession.conf
    before = {name: conf.get(name, default) for name, _, default in WHILE_SCORING}
    for name, value, _ in WHILE_SCORING:
        conf.set(name, value)
    try:
        return _score(docs, doc_id, text, F.lit(False) if held_out is None else held_out, settings)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def _score(docs: DataFrame, doc_id: str, text: str, held_out: Column, s: Settings) -> DataFrame:
    spark = docs.sparkSession
    held_out = F.coalesce(held_out, F.lit(False))
    counted = stored(count_words(docs, text, ~held_out), "lm-vocabulary")
    train_tokens, types = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    pairs = stored(count_pairs(docs.where(~held_out), text, max(LEAST_GROUPS, train_tokens // GROUP_TOKENS)), "lm-pairs")
    pair_d, seated = discount(pairs), None
    sent = counted.select("word", "c", F.lit(1).alias("t"))
    vocabulary = words = lm = None
    for turn in range(s.passes):
        before, k = (vocabulary, words), sent_up(pairs, seated)
        vocabulary = stored(counted.select("word", F.xxhash64("word").alias("h")).join(k, "h", "left").select(
            "word", F.coalesce("k", F.lit(0)).cast("long").alias("c")), "lm-customers")
        d = discount(vocabulary)
        customers = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
        counts = stored(spelling_counts(sent, "t"), "lm-spelling-counts")
        if turn:
            forget(seated, lm, *before)  # the tables of a pass go when the next has what it needs of them
        model = stored(spelling_model(counts, discount(counts), s), "lm-spelling")
        words = stored(spell(vocabulary, model), "lm-words")
        forget(counts, model)
        known = stored(words.where("c > 0"), "lm-known")
        lm, unknown = word_model(known, customers, types, d, s)
        lm = stored(lm, "lm-known-words")
        seated = stored(seat_pairs(pairs, lm, turn, pair_d, s), "lm-seated")
        if turn + 1 < s.passes:
            tables = word_tables(words, types, turn, d, s)
            sent = vocabulary.withColumn("h", F.xxhash64("word")).join(tables, "h").select("word", "c", "t")
    taken = known.agg(F.coalesce(F.sum(F.exp("spelled")), F.lit(0.0))).first()[0]
    new = unknown - math.log10(max(1e-9, 1 - taken))  # a new table
    lm = lm.select("h", "score").unionByName(words.where("c = 0").select("h", (F.col("spelled") / math.log(10) + new).alias("score")))
    lm = stored(counted.select(F.xxhash64("word").alias("h"), "c").join(lm, "h").join(
        seated.where("w is null").select(F.col("u").alias("h"), F.col("t").alias("tables")), "h", "left").select(
        "h", "c", "score", (s.strength + pair_d * F.coalesce("tables", F.lit(0.0))).alias("new")), "lm-model")
    forget(counted, vocabulary, words)
    dishes = seated.where("w is not null").select("u", "w", _pair_key(), "c", (F.col("c") - pair_d * F.col("t")).alias("own")).unionByName(
        pairs.where("c = 1").select("u", "w", _pair_key(), "c", F.lit(1 - pair_d).alias("own")))

    head, most = head_words(lm, s.head), head_words(dishes, s.head_pairs)  # bounded by the settings
    head_h = head.column("h").to_numpy()
    floor, strength, groups = train_tokens + 0.5 * (types + 1), s.strength, max(LEAST_GROUPS, train_tokens // GROUP_TOKENS)
    shared = spark.sparkContext.broadcast((head_h, *_word_values(head, strength, unknown, floor)))
    (u, there_u), (w, there_w) = (_find(most.column(x).to_numpy(), head_h) for x in "uw")
    both = there_u & there_w
    _, new, lp, *_ = shared.value
    gains = spark.sparkContext.broadcast((most.column("h").to_numpy()[both], _gain(most.column("own").to_numpy()[both], new[u[both]], lp[w[both]])))
    del most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_h, _, _, *sums = shared.value
        most_h, most_gain = gains.value
        numbers, held, size, start = Numbers(), [], 0, 0
        for b in batches:
            raw = text_bytes(b.column(2))
            for lo, hi in slices([len(x) for x in raw]):
                if len(numbers.index) > FLUSH_WORDS:
                    numbers.empty()
                flat, before, sizes = numbers.of(raw[lo:hi])
                h, m = numbers.hashes, hi - lo
                rid = b.column(0).slice(lo, m).to_numpy()
                owner = np.repeat(np.arange(m), sizes)
                at, is_head = _find(h, head_h)
                known, base, score, spelled = (np.bincount(owner, weights=np.where(is_head, x[at] if len(x) else 0.0, 0.0)[flat], minlength=m) for x in sums)
                rare = ~is_head[flat]
                word, n = np.unique(owner[rare] * len(h) + flat[rare], return_counts=True)
                if held and rid[-1] - start > 32_000:  # numbered by short integers from the first
                    yield flush(held)
                    held, size = [], 0
                start = start if held else rid[0]
                held.append((np.full(len(word), WORD, np.int8), h[word % len(h)], rid[word // len(h)], n))

                pair, n = np.unique((owner * len(h) + before) * len(h) + flat, return_counts=True)
                rest, w = np.divmod(pair, len(h))
                own, u = np.divmod(rest, len(h))
                key = pair_key(h[u], h[w])
                place, found = _find(key, most_h)
                gain = np.bincount(own[found], weights=n[found] * most_gain[place[found]], minlength=m)
                left = np.flatnonzero(~found)
                u, w = u[left], w[left]
                coded = is_head[u] & is_head[w]
                held.append((np.where(coded, HEADS, PAIR).astype(np.int8), np.where(coded, at[u] << 32 | at[w], key[left]), rid[own[left]], n[left]))
                size += len(word) + len(left)
                yield _row(asked, m, part=group_of(rid, groups), kind=np.full(m, TEXT, np.int8), base=rid, id=b.column(1).slice(lo, m), held=b.column(3).slice(lo, m),
                           tokens=sizes, known=known, base_score=base, score=score + gain, spelled=spelled + gain)
                if size > FLUSH_ASKED:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def flush(held: list[tuple]) -> pa.RecordBatch:
        kind, key, rid, n = (np.concatenate(x) for x in zip(*held))
        low = rid.min() if len(rid) else 0
        order = np.argsort(key)  # equal upper halves of keys side by side
        return _packed(asked, kind[order], key[order], groups, base=low, rid=(rid[order] - low).astype(np.int16), n=n[order].astype(np.int32))

    def supply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Dishes of two head words, by their places in the head."""
        head_h = shared.value[0]

        def found() -> Iterator[tuple[np.ndarray, ...]]:
            for b in batches:
                (u, there_u), (w, there_w) = (_find(b.column(i).to_numpy(), head_h) for i in range(2))
                both = there_u & there_w
                yield (u << 32 | w)[both], b.column(2).to_numpy()[both]

        for key, own in _joined(found()):
            order = np.argsort(key, kind="stable")
            yield _packed(asked, np.full(len(key), HEADS, np.int8), key[order], groups, value=own[order])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Other dishes, with what the head tells of their words."""
        head_h, new, lp, *_ = shared.value
        for b in batches:
            (u, there_u), (w, there_w) = (_find(b.column(i).to_numpy(), head_h) for i in range(2))
            left = ~(there_u & there_w)
            told = [pa.array(x[at[left]] if len(x) else np.zeros(left.sum()), mask=~there[left]) for x, at, there in ((new, u, there_u), (lp, w, there_w))]
            yield pa.RecordBatch.from_arrays([*(b.column(i).filter(pa.array(left)) for i in range(3)), *told], ["u", "w", "own", "new", "lp"])

    def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, w, *x = (b.column(i).to_numpy() for i in range(5))
            yield pa.RecordBatch.from_arrays([pa.array(pair_key(u, w)), pa.array(_gain(*x))], ["h", "gain"])

    def supply_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, gain in _joined((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches):
            yield _packed(asked, np.full(len(key), PAIR, np.int8), key, groups, value=gain)

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_h = shared.value[0]
        for b in batches:
            t = pa.table(b).filter(pa.array(~_find(b.column(0).to_numpy(), head_h)[1]))
            _, _, known, base, _, spelled = _word_values(t, strength, unknown, floor)
            yield _packed(asked, np.full(len(base), WORD, np.int8), t.column("h").to_numpy(), groups, value=spelled, word_base=base, n=known.astype(np.int32))

    def answer(t: pa.Table) -> pa.Table:
        _, new, lp, *_ = shared.value
        texts = t.filter(pa.array(t.column("kind").to_numpy() == TEXT))
        parts = [[np.zeros(0, np.int64)] + [np.zeros(0)] * 4]
        for kind in (HEADS, PAIR, WORD):
            rows = t.filter(pa.array(t.column("kind").to_numpy() == kind))
            given = rows.filter(rows.column("value").is_valid())
            ask = rows.filter(rows.column("rid").is_valid())
            key, sought = _keys(given), _keys(ask)
            order = np.argsort(key, kind="stable")
            place, found = _find(sought, key[order])
            at = order[place[found]] if len(key) else np.zeros(0, np.int64)
            rid = (np.repeat(ask.column("base").to_numpy(), pc.list_value_length(ask.column("rid")).to_numpy()) + flattened(ask, "rid")).astype(np.int64)[found]
            n, value = flattened(ask, "n")[found], flattened(given, "value")
            if kind == HEADS:
                value = _gain(value, new[key >> 32], lp[key & 0xFFFFFFFF]) if len(key) else value
            if kind == WORD:
                is_known = flattened(given, "n")[at]
                parts.append([rid, n * is_known, n * flattened(given, "word_base")[at], n * np.where(is_known > 0, value[at], unknown), n * value[at]])
            else:
                parts.append([rid, np.zeros(len(n)), np.zeros(len(n)), n * value[at], n * value[at]])
        rid, *sums = (np.concatenate(x) for x in zip(*parts))
        rid, at = np.unique(rid, return_inverse=True)
        sums = [np.bincount(at, weights=x, minlength=len(rid)) for x in sums]
        m = len(rid)
        both = lambda name, x, kind: pa.concat_arrays([texts.column(name).combine_chunks().cast(kind), pa.array(x).cast(kind)])
        return pa.table({
            "rid": both("base", rid, pa.int64()), "id": pa.concat_arrays([texts.column("id").combine_chunks(), pa.nulls(m, texts.column("id").type)]),
            "held": pa.concat_arrays([texts.column("held").combine_chunks(), pa.nulls(m, pa.bool_())]),
            "n": both("tokens", np.zeros(m, np.int64), pa.int64()), "known": both("known", sums[0], pa.int64()),
            "base": both("base_score", sums[1], pa.float64()), "score": both("score", sums[2], pa.float64()), "spelled": both("spelled", sums[3], pa.float64())})

    given = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t"), held_out.alias("held"))
    id_type = given.schema["id"].dataType.simpleString()
    schema = (f"part int, kind byte, base long, hi array<int>, lo array<int>, rid array<short>, n array<int>, value array<double>, word_base array<double>, "
              f"id {id_type}, held boolean, tokens long, known double, base_score double, score double, spelled double")
    asked = spark.createDataFrame([], schema).toArrow().schema
    by_word = lm.select(F.col("h").alias("by"), F.col("new").alias("found_new"), F.col("score").alias("found_lp"))
    told = dishes.select("u", "w", "own").mapInArrow(others, "u long, w long, own double, new double, lp double")
    # the head lacks at least one word of each: the first join tells of that, the second only of those it lacks both of
    told = told.withColumn("by", F.when(F.col("new").isNull(), F.col("u")).otherwise(F.col("w"))).join(by_word, "by", "left").select(
        "u", "w", "own", F.coalesce("new", "found_new").alias("new"),
        F.when(F.col("new").isNull(), F.col("lp")).otherwise(F.coalesce("lp", "found_lp")).alias("lp"))
    rest = told.where("lp is null").drop("lp").join(by_word.select(F.col("by").alias("w"), F.col("found_lp").alias("lp")), "w", "left")
    told = told.where("lp is not null").unionByName(rest)
    told = stored(told.select("u", "w", "own", "new", "lp").mapInArrow(gained, "h long, gain double"), "lm-gains")
    supplies = [dishes.select("u", "w", "own").mapInArrow(supply, schema), told.mapInArrow(supply_others, schema),
                lm.select("h", "c", "score", "new").mapInArrow(rare_words, schema)]
    answers = stored(reduce(DataFrame.unionByName, supplies).select("part", "kind", "hi", "lo", "n", "value", "word_base"), "lm-answers")
    forget(seated, lm, told)
    shares = []
    for i in range(SHARES):
        mine = given.where(F.pmod(F.xxhash64("t"), F.lit(SHARES)) == i)
        whole = mine.mapInArrow(run, schema).unionByName(answers, allowMissingColumns=True).groupBy("part").applyInArrow(
            answer, f"rid long, id {id_type}, held boolean, n long, known long, base double, score double, spelled double")
        shares.append(stored(whole.groupBy("rid").agg(
            F.max("id").alias(doc_id), F.max("held").alias("held_out"), F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"),
            F.sum("base").alias("base_score"), F.sum("score").alias("score"), F.sum("spelled").alias("spelled_score")), "lm-scores"))
    forget(answers)
    out = reduce(DataFrame.unionByName, shares)
    return out.select(doc_id, "held_out", "n_tokens", "n_known",
                      F.lit(int(train_tokens)).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"), "spelled_score")


def _find(sought: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each among the sorted ``known`` (any if it is not there), and whether it is there."""
    if not len(known):
        return np.zeros(len(sought), np.int64), np.zeros(len(sought), bool)
    at = np.minimum(np.searchsorted(known, sought), len(known) - 1)
    return at, known[at] == sought


def _joined(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The arrays of the parts one after the other, about ``FLUSH_GIVEN`` rows at a time."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= FLUSH_GIVEN:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def _word_values(lm: pa.Table, strength: float, unknown: float, floor: float) -> tuple[np.ndarray, ...]:
    """Of each word (h, c, score, new): the customers it takes as a context through new tables, its log10 probability; and what a text
    gets for it: whether it is known, the base score, the score and the spelled score, as if none of its pairs had a dish."""
    c, lp, new = (lm.column(x).to_numpy() for x in ("c", "score", "new"))
    share = np.log10(new) - np.log10(strength + c)  # each word of a text is once a context: the end is that of the first word
    return new, lp, (c > 0).astype(float), np.log10((c + 0.5) / floor), np.where(c > 0, lp, unknown) + share, lp + share


def _gain(own: np.ndarray, new: np.ndarray, lp: np.ndarray) -> np.ndarray:
    """How much the dish's own customers add to the log10 of what its context gives through a new table."""
    return np.log10(own + new * 10.0 ** lp) - (np.log10(new) + lp)


def _row(schema: pa.Schema, m: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(m, f.type) if f.name not in given else given[f.name] if isinstance(given[f.name], pa.Array)
                                       else pa.array(given[f.name], f.type) for f in schema], schema=schema)


def _packed(schema: pa.Schema, kind: np.ndarray, key: np.ndarray, groups: int, base: int | None = None, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each kind and group of keys, with the list of its keys' halves and of each of ``values``."""
    place, lists = dealt(kind.astype(np.int64) * groups + group_of(key, groups), (key >> 32).astype(np.int32), key.astype(np.int32), *values.values())
    lists = {name: x.cast(schema.field(name).type) for name, x in zip(("hi", "lo", *values), lists)}
    more = {} if base is None else {"base": np.full(len(place), base)}
    return _row(schema, len(place), part=(place % groups).astype(np.int32), kind=(place // groups).astype(np.int8), **more, **lists)


def _keys(rows: pa.Table) -> np.ndarray:
    return flattened(rows, "hi").astype(np.int64) << 32 | flattened(rows, "lo").astype(np.int64) & 0xFFFFFFFF
