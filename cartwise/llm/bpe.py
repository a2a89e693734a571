"""Byte-level BPE encoding and decoding: speculate with longest matches, verify pairs.

A text is cut at the special tokens' strings, then into words by the byte-level
pattern. Each new word is encoded in three steps:

1. *Speculate*: greedy longest match over the vocabulary (tokens that do not encode to
   themselves are left out).
2. *Verify*: the proposal equals the merges' result exactly if every adjacent pair of its
   tokens is compatible, that is, if no merge ever crosses their border. The check walks
   back in merge time for all pairs at once in numpy: the later made of the two border
   parts is undone, and a merge of the border parts that would have come before that
   undoing refutes the pair. Among equal ranks the left merge comes first.
3. *Merge*: only words with a refuted pair are merged exactly (heap of ranks).

Words are encoded once per task and looked up afterwards; the table of words is emptied when it
holds ``MAX_WORDS``, so memory is bounded. Texts are taken whole. The model (about 2 MB, from a
tokenizer file that is a parameter) is read on the driver and goes out as a broadcast variable.

NULL and empty texts have no tokens; bytes that are not UTF-8 count as U+FFFD. Rows
are mapped one by one: repeated rows and NULLs in other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm.common import column, ship

MAX_WORDS = 150_000
SLICE_BYTES = 4 << 20
DIGEST_BYTES = 1 << 20  # of text at a time where nothing but digests is kept: a worker then holds some 100 MB beyond its model
# Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# The same for text up to U+024F, with its letters, numbers and white space spelled out: ``re`` is several
# times faster than ``regex`` there.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
LATIN = rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
NEVER = int(np.iinfo(np.int64).max)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes in order for U+0100 and on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of values[starts[i]:starts[i] + lengths[i]]."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]


class Bpe:
    """A byte-level BPE model as plain arrays (pickles small)."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[int, int, int]], special: dict[str, int]):
        """``merges``: (left, right, product) ids in rank order; ``special``: text -> id."""
        self.vocab, self.special = vocab, special
        self.size = 1 + max([*vocab.values(), *special.values()])
        self.ranks = {(a, b): r for r, (a, b, _) in reversed(list(enumerate(merges)))}
        self.products = [c for _, _, c in merges]
        keys = np.array([a * self.size + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.array(list(self.ranks.values()), dtype=np.int64)[order]
        self.left = np.zeros(self.size, dtype=np.int64)
        self.right = np.zeros(self.size, dtype=np.int64)
        self.rank = np.full(self.size, -1, dtype=np.int64)
        self.byte = [vocab[bytes([b])] for b in range(256)]
        self.known = {}  # tokens that encode to themselves, by their bytes
        for token, i in vocab.items():
            parts, last = self._merge(token)
            if parts == [i]:
                self.known[token] = i
                if last:
                    self.rank[i], self.left[i], self.right[i] = last
        self.prefixes = {t[:n]: -1 for t in self.known for n in range(1, len(t))} | self.known
        content = {i: t for t, i in vocab.items()} | {i: s.encode() for s, i in special.items()}
        self.lengths = np.array([len(content.get(i, b"")) for i in range(self.size)], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.content = np.frombuffer(b"".join(content.get(i, b"") for i in range(self.size)), dtype=np.uint8)

    @classmethod
    def from_json(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars, named = byte_alphabet(), spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        return cls({bytes(chars[c] for c in t): i for t, i in named.items()},
                   [(named[a], named[b], named[a + b]) for a, b in merges],
                   {t["content"]: t["id"] for t in spec["added_tokens"]})

    def _merge(self, word: bytes) -> tuple[list[int], tuple[int, int, int] | None]:
        """Exact merging, lowest rank first and leftmost among equals; also the last merge."""
        if len(word) > 48:
            return self._merge_long(word)
        ids, last, look = [self.byte[b] for b in word], None, self.ranks.get
        found = [look(p, NEVER) for p in zip(ids, ids[1:])]
        while found and (rank := min(found)) < NEVER:
            i = found.index(rank)
            last = (rank, ids[i], ids[i + 1])
            ids[i:i + 2] = [one := self.products[rank]]
            del found[i]
            if i:
                found[i - 1] = look((ids[i - 1], one), NEVER)
            if i < len(found):
                found[i] = look((one, ids[i + 1]), NEVER)
        return ids, last

    def _merge_long(self, word: bytes) -> tuple[list[int], tuple[int, int, int] | None]:
        """The same with a heap and links, for words of any length."""
        ids: list[int | None] = [self.byte[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(self.ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        last = None
        while heap:
            rank, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = self.products[rank], None
            last = (rank, a, b)
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                if (p := (ids[i], ids[k])) in self.ranks:
                    heapq.heappush(heap, (self.ranks[p], i, p))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in self.ranks:
                heapq.heappush(heap, (self.ranks[p], h, p))
        return [i for i in ids if i is not None], last

    def speculate(self, word: bytes) -> list[int]:
        """Greedy longest match over tokens that encode to themselves."""
        look, out, at, end = self.prefixes.get, [], 0, len(word)
        while at < end:
            stop, best = at + 1, None
            while stop <= end and (i := look(word[at:stop])) is not None:
                if i >= 0:
                    best, found = i, stop
                stop += 1
            out.append(best)  # single bytes are tokens, so there is one
            at = found
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave each pair of neighbours (a, b) as it is."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        fine, live = np.ones(len(x), dtype=bool), np.arange(len(x))
        limit = np.full(len(x), NEVER)
        while len(live):
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            crossed = (self.keys[at] == key) & (self.key_ranks[at] < limit)
            fine[live[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~crossed & (np.maximum(rx, ry) >= 0)
            undo_x = rx > ry  # equal ranks: the left one was made first
            limit = np.where(undo_x, rx, ry + 1)[on]
            x, y = np.where(undo_x, self.right[x], x)[on], np.where(undo_x, y, self.left[y])[on]
            live = live[on]
        return fine

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        proposed = [self.speculate(w) for w in words]
        lengths = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.array([i for p in proposed for i in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fine = self.compatible(pair // self.size, pair % self.size)
        for i in np.unique(owner[inner[~fine[back]]]).tolist():
            proposed[i] = self._merge(words[i])[0]
        return proposed

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts whose ids lie between ``offsets``; as UTF-8, errors replaced."""
        ids = ids.astype(np.int64)
        sizes = self.lengths[ids]
        data = _ragged(self.content, self.starts[ids], sizes)
        ends = np.concatenate(([0], np.cumsum(sizes)))[offsets]
        raw, inside = data.tobytes(), ends[ends < len(data)]
        try:
            raw.decode("utf-8")
            if not ((data[inside] & 0xC0) == 0x80).any():
                return data, ends
        except UnicodeDecodeError:
            pass
        texts = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends.tolist(), ends[1:].tolist())]
        return np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)])


class _Index(dict):
    """Numbers words as they come; ``fresh`` holds those not yet encoded."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.fresh.append(word)
        return i


class Encoder:
    """Encodes texts with a bounded table of encoded words. One per task."""

    def __init__(self, model: Bpe, use_special: bool = True):
        self.model = model
        self.any_words, self.latin_words = regex.compile(PATTERN).findall, re.compile(LATIN).findall
        self.beyond_latin = re.compile("[^\x00-\u024f]").search
        names = model.special if use_special else {}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self._reset()

    def _reset(self) -> None:
        self.index = _Index()
        self.ids, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def words(self, text: str) -> list[str]:
        return self.any_words(text) if self.beyond_latin(text) else self.latin_words(text)

    def _add_fresh(self) -> None:
        coded = self.model.encode_words([w.encode() for w in self.index.fresh])
        self.ids = np.concatenate((self.ids, np.array([i for c in coded for i in c], dtype=np.int32)))
        self.lengths = np.concatenate((self.lengths, np.array([len(c) for c in coded], dtype=np.int64)))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.index.fresh = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the offsets of the texts in them."""
        if len(self.index) > MAX_WORDS:
            self._reset()
        special, look = self.model.special, self.index.__getitem__
        numbers = []  # the words of each text; special tokens as -1 - id
        for text in texts:
            if self.cut and any(s in text for s in special):
                row = []
                for part in self.cut(text):
                    row += [-1 - special[part]] if part in special else map(look, self.words(part))
            else:
                row = list(map(look, self.words(text)))
            numbers.append(np.array(row, dtype=np.int64))
        self._add_fresh()
        flat = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        word = flat >= 0
        base = len(self.ids)
        table = np.concatenate((self.ids, (-1 - flat[~word]).astype(np.int32)))
        lengths, starts = np.ones(len(flat), np.int64), np.zeros(len(flat), np.int64)
        lengths[word], starts[word] = self.lengths[flat[word]], self.starts[flat[word]]
        starts[~word] = base + np.arange(int((~word).sum()))
        ids = _ragged(table, starts, lengths)
        words_at = np.cumsum([0, *map(len, numbers)])
        return ids, np.concatenate(([0], np.cumsum(lengths)))[words_at]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, at least one row."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.to_pylist()]


def encode(docs: DataFrame, model: Bpe, *, text: str = "text", ids: str = "ids", use_special: bool = True) -> DataFrame:
    """``docs`` without its text, with the token ids (array of int) of the whole text in ``ids``."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, ids)]
    given = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = given.drop("_text").schema.add(ids, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(shared.value, use_special)
        for b in batches:
            raw = text_bytes(b.column(len(keep)))
            for lo, hi in slices([len(x) for x in raw]):
                flat, at = coder.encode([x.decode("utf-8", "replace") for x in raw[lo:hi]])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[:len(keep)]), lists], [*keep, ids])

    return given.mapInArrow(run, schema)


def decode(coded: DataFrame, model: Bpe, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """``coded`` with the text that its ids stand for in ``text`` (special tokens kept)."""
    ship(coded.sparkSession)
    keep = [c for c in coded.columns if c != text]
    shared = coded.sparkSession.sparkContext.broadcast(model)
    given = coded.select(*keep)
    schema = T.StructType([*given.schema.fields, T.StructField(text, T.StringType())])
    at_ids = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(at_ids)
            sizes = [0 if n is None else 4 * n for n in pa.compute.list_value_length(lists).to_pylist()]
            for lo, hi in slices(sizes):
                part = lists.slice(lo, hi - lo)
                lengths = np.array([0 if n is None else n for n in pa.compute.list_value_length(part).to_pylist()], np.int64)
                data, ends = shared.value.decode(part.flatten().to_numpy(zero_copy_only=False),
                                                 np.concatenate(([0], np.cumsum(lengths))))
                texts = pa.LargeStringArray.from_buffers(
                    hi - lo, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns), texts], [*keep, text])

    return given.mapInArrow(run, schema)


def digest(docs: DataFrame, model: Bpe, *, text: str = "text") -> DataFrame:
    """Encode, decode, and return n_tokens with SHA-256 digests of the ids and of the decoded text, in one pass of one
    worker a task: neither the ids nor the decoded texts leave it."""
    ship(docs.sparkSession)
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    keep = [c for c in docs.columns if c not in (text, *names)]
    given = docs.select(*[column(c) for c in keep], F.col(text).cast("binary").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(n, T.LongType() if n == "n_tokens" else T.StringType()) for n in names]
    schema = T.StructType([*given.schema.fields[:-1], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return digests(batches, shared.value, schema.names)

    return given.mapInArrow(run, schema)


def digests(batches: Iterator[pa.RecordBatch], model: Bpe, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches with their last column, the texts, replaced by number and digests of the ids and of the decoded text."""
    sha, coder, decimal = hashlib.sha256, Encoder(model), [b"%d" % i for i in range(model.size)]
    for b in batches:
        texts = b.column(b.num_columns - 1)
        for lo, hi in slices(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist(), DIGEST_BYTES):
            flat, at = coder.encode([x.decode("utf-8", "replace") for x in text_bytes(texts.slice(lo, hi - lo))])
            data, ends = model.decode(flat, at)
            ids = [sha(b",".join(map(decimal.__getitem__, flat[i:j].tolist()))).hexdigest() for i, j in zip(at.tolist(), at[1:].tolist())]
            raw = memoryview(np.ascontiguousarray(data))
            decoded = [sha(raw[i:j]).hexdigest() for i, j in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[:-1]), pa.array(np.diff(at), pa.int64()),
                                              pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names)
