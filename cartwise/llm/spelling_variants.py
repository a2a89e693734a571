r"""Spelling variant grouping by a relational trie frontier.

Words. Maximal runs of ``[A-Za-zÀ-ÿ]+`` in whole texts, A-Z lower-cased. Where ``thin`` divides the CRC-32 h
of ``<doc_id>:<run>`` (0: never), the run loses its code point h mod length. Words are the distinct results of at least
``min_length`` code points with at least ``min_count`` occurrences in all documents.

Near words differ by exactly one inserted, deleted or replaced code point. They are found over two tries of all words,
one read forwards and one backwards, so that every edit lies in the later half of one of them, where tries are sparse:

- *Nodes* are prefixes from just before a word's middle on, as 64-bit rolling hashes. Those where words part or end are
  kept. A word's kept nodes, read off its own path, are its states without an edit.
- The *edge table* is a row per kept node and next kept node below it, with the text between them. It is distributed by node.
- *Fork*: a state without an edit joins the edges of its node that begin with another code point than the word's next one, and
  replaces, inserts or deletes one: (word, position, node, edits = 1). Two near words part at exactly one such node.
- *Frontier*, level by level: states with an edit join the edge table on (node, next code point), and live on if the edge's
  text is what the word goes on with. A state at the end of its word and of another one is a near pair. Rounds are bounded by the
  kept nodes on one path, and end when no state is left.

Each state carries the word that it has become, and pairs are joined with the vocabulary by that text, so that a clash of
hashes can add work but no wrong pair. Nodes that many words share: a state's fan-out is at most the alphabet (90), edges of nodes with over
``CROWD`` words are repeated under that many salts, and the nodes that hold over 1 in ``MAX_HOT`` prefix rows (so at most
``MAX_HOT``) are marked by a broadcast.

Forms: a word's form is its near word with most occurrences (ties: first in code-point order), if those are at least ``ratio``
times its own. Counts grow along forms, so chains end; roots are found by pointer doubling.

NULL and empty texts hold no words. A NULL id counts as the empty string in the hash. Repeated rows count each. Very long
runs are words like others; a document's text is taken whole. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.bpe import slices
from cartwise.llm.common import ascii_lower, column, ship, stored

GAP = "[^a-zÀ-ÿ]+"
CROWD = 4096  # words below a node that one salt of its edges serves
MAX_HOT = 10_000
SLICE = 1 << 19  # code points whose prefixes are made at a time
MAX_PARTS = 64  # results of as many rounds are read as they are; more are written together


def word_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5,
                thin: int = 199) -> DataFrame:
    """(word, n). Each run is one row only inside its task: counts are summed there before the shuffle."""
    rows = docs.select(F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(ascii_lower(F.coalesce(column(text), F.lit(""))), GAP)).alias("run"))
    rows = rows.where(F.char_length("run") >= min_length)
    if thin:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(F.col("h"), F.char_length("run").cast("long")).cast("int")
        less = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.char_length("run")))
        rows = rows.select("run", h.alias("h")).select(F.when(F.col("h") % thin == 0, less).otherwise(F.col("run")).alias("run"))
        rows = rows.where(F.char_length("run") >= min_length)
    return rows.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefixes(vocabulary: DataFrame) -> DataFrame:
    """(wid, back, depth, node, c) for the later half of each word, forwards and backwards: the prefix of ``depth`` code points
    and the code point after it, -1 at the end."""
    ship(vocabulary.sparkSession)
    names = ["wid", "back", "depth", "node", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words = b.column(0).to_numpy(), b.column(1).to_pylist()
            for lo, hi in slices([len(w) for w in words], SLICE):
                m = np.array([len(w) for w in words[lo:hi]])
                point = np.frombuffer("".join(words[lo:hi]).encode("utf-32-le"), "<u4")
                first = np.cumsum(m) - m
                at = np.arange(m.sum()) - np.repeat(first, m)
                power = np.cumprod(np.full(m.max(), 0x9E3779B97F4A7C15, np.uint64))
                low = np.maximum(m // 2 - 1, 0)
                many = m - low + 1
                owner = np.repeat(np.arange(len(m)), many)
                depth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[owner]
                for back in (False, True):
                    c = point[np.repeat(first + m - 1, m) - at] if back else point
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(c.astype(np.uint64)) * power[at])))
                    value = sums[first[owner] + depth] - sums[first[owner]]
                    node = _mix(value ^ _mix((2 * depth + back).astype(np.uint64))).view(np.int64)
                    ended = depth == m[owner]
                    after = np.where(ended, -1, c[np.minimum(first[owner] + depth, len(c) - 1)].astype(np.int64)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi][owner]), pa.array(np.full(len(owner), back)), pa.array(depth.astype(np.int32)),
                                                      pa.array(node), pa.array(after)], names)

    return vocabulary.select("wid", "word").mapInArrow(run, "wid long, back boolean, depth int, node long, c int")


def paths(vocabulary: DataFrame) -> DataFrame:
    """A row per word, direction and kept node on its path: the text in that direction, the node (``depth``, whether a word
    ends there, whether words part there, its number of words) and the next one (NULL after the last)."""
    rows = stored(prefixes(vocabulary), "trie-prefixes")
    kept = rows.groupBy("node").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("words"))
    kept = kept.where("low <> high or low = -1").select("node", (F.col("low") == -1).alias("ends"), (F.col("low") != F.col("high")).alias("parts"), "words")
    kept = stored(kept, "trie-nodes")
    hot = F.broadcast(kept.where(F.col("words") * MAX_HOT > rows.count()))
    rows = rows.drop("c")
    met = rows.join(hot, "node").unionByName(rows.join(hot.select("node"), "node", "left_anti").join(kept, "node"))
    text = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    met = met.join(vocabulary.select("wid", "word"), "wid").select("wid", "back", text.alias("text"), "depth", "node", "ends", "parts", "words")
    after = F.lead(F.struct("depth", "node", "ends")).over(Window.partitionBy("wid", "back").orderBy("depth"))
    return stored(met.withColumn("next", after), "trie-paths")


def _salts():
    return F.ceil(F.col("words") / CROWD).cast("int")


def edge_table(path: DataFrame) -> DataFrame:
    """(node, salts, child, ends, label): the kept nodes below each kept node and the text in between."""
    steps = path.where("next is not null").groupBy("node", F.col("next.node").alias("child")).agg(
        F.max("words").alias("words"), F.bool_or("next.ends").alias("ends"),
        F.min_by(F.expr("substring(text, depth + 1, next.depth - depth)"), "wid").alias("label"))
    return stored(steps.select("node", _salts().alias("salts"), "child", "ends", "label"), "trie-edges")


def _states(near: str, rest: str, when: str) -> str:
    return f"if({when}, named_struct('near', {near}, 'rest', {rest}), null)"


def forks(path: DataFrame, edges: DataFrame) -> DataFrame:
    """(wid, back, near, rest, node, ends): states after the one edit. ``near`` is the word that the state is on the way to,
    ``rest`` what it still has to match."""
    middle = F.floor(F.char_length("text") / 2)
    start = F.when(F.col("back"), F.char_length("text") - middle).otherwise(middle)
    seeds = path.where(F.col("parts") & (F.col("depth") >= start)).select(
        "wid", "back", "text", "depth", "node", "ends", F.pmod(F.col("wid"), _salts().cast("long")).cast("int").alias("salt"),
        F.expr("substring(text, 1, depth)").alias("head"), F.expr("substring(text, depth + 1, 1)").alias("c"),
        F.expr("substring(text, depth + 1)").alias("tail"), F.expr("substring(text, depth + 2)").alias("after"))
    last = seeds.where("ends and after = '' and c <> ''").select("wid", "back", F.col("head").alias("near"), F.lit("").alias("rest"), "node", "ends")
    salted = edges.select(F.col("node").alias("at"), "child", F.col("ends").alias("child_ends"), "label",
                          F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    met = seeds.drop("ends").join(salted, (F.col("node") == F.col("at")) & (seeds["salt"] == salted["salt"])).where("left(label, 1) <> c")
    met = met.select("wid", "back", "head", "tail", "after", "c", "label", "child", "child_ends", F.expr("substring(label, 2)").alias("more"))
    edits = F.expr("filter(array(" + ", ".join((
        _states("concat(head, left(label, 1), after)", "substring(after, length(more) + 1)", "c <> '' and startswith(after, more)"),
        _states("concat(head, left(label, 1), tail)", "substring(tail, length(more) + 1)", "startswith(tail, more)"),
        _states("concat(head, after)", "substring(after, length(label) + 1)", "c <> '' and startswith(after, label)"))) + "), x -> x is not null)")
    made = met.select("wid", "back", F.col("child").alias("node"), F.col("child_ends").alias("ends"), F.explode(edits).alias("s"))
    return made.select("wid", "back", "s.near", "s.rest", "node", "ends").unionByName(last)


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(wid, near): all near words of each word of ``vocabulary`` (wid, word, n), each once."""
    path = paths(vocabulary)
    edges = edge_table(path)
    step = edges.select(F.col("node").alias("at"), F.expr("left(label, 1)").alias("c"), "label", "child", F.col("ends").alias("child_ends"))
    live, found = stored(forks(path, edges), "trie-states"), []
    while True:
        found.append(live.where("rest = '' and ends").select("wid", "back", "near"))
        going = live.where("rest <> ''")
        if going.isEmpty():
            break
        met = going.join(step, (F.col("node") == F.col("at")) & (F.expr("left(rest, 1)") == F.col("c"))).where("startswith(rest, label)")
        live = stored(met.select("wid", "back", "near", F.expr("substring(rest, length(label) + 1)").alias("rest"), F.col("child").alias("node"),
                                 F.col("child_ends").alias("ends")), "trie-states")
        if len(found) >= MAX_PARTS:  # a long chain of words that begin each other: keep the plan short
            found = [stored(_union(found), "trie-found")]
    return _union(found).select("wid", F.when(F.col("back"), F.reverse("near")).otherwise(F.col("near")).alias("near")).distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word on the way from each word of ``forms`` (word, form). Doubles its steps each round."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("up"))
        jumped = stored(now.join(up, "root", "left").select("word", F.coalesce("up", "root").alias("root"), F.col("up").isNotNull().alias("moved")), "spelling-roots")
        now = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return now


def group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5, thin: int = 199,
          ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    counted = word_counts(docs, doc_id=doc_id, text=text, min_length=min_length, min_count=min_count, thin=thin)
    vocabulary = stored(counted.withColumn("wid", F.monotonically_increasing_id()), "spelling-words")
    pairs = near_pairs(vocabulary).join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("wid").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    rows = vocabulary.join(best, "wid", "left").withColumn("form_n", -F.col("best.less"))
    form = F.col("form_n") >= ratio * F.col("n")
    rows = stored(rows.select("word", F.when(form, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(form, F.col("form_n")).alias("form_n")), "spelling-forms")
    top = roots(rows.where("form is not null"))
    return rows.join(top, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
