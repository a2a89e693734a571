"""Benchmark decontamination by a distributed positional inverted index.

Texts and test items are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A test
window is ``size`` consecutive words of an item, or a shorter item as a whole.

1. Count every test term over all texts (partial aggregation; only test terms are kept).
2. Each distinct window names its rarest and its second rarest term with their offsets.
3. Store the postings (document row, position, and the words around) of those terms: an index of what
   the searches ask for first, so the endless lists of common words are never built.
4. The postings of a window's rarest term propose a start; the offset-adjusted list of the second rarest
   must hold (same row, start + its offset): an equality join of lists, never a product.
5. Exact phrases: the survivors' words are compared with the window.
6. Proximity: where the two rarest terms stand together but off their places by up to ``slack`` words, or in place
   without the whole window, the words around are compared with the window in order (longest common subsequence); from
   ``near_share`` of the window's words on, it is a near match (a word inserted, left out or replaced).

Skew: a passage that a third of all documents share gives one posting per document and window, and
all joins but the one on test terms are keyed by (row, position). The test side is
broadcast when it has at most MAX_BROADCAST_WINDOWS rows. Beyond that, each row's distinct words (without the text)
are joined with the test terms, and the terms found come back to their row, whose places are read off locally.

NULL and empty texts have no words; items without words have no windows; items with a NULL id
count as the item ''. Repeated rows are judged each. Only DataFrame functions run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import column, fits, packed, plain_words, small, stable, stored, unpacked

MAX_BROADCAST_WINDOWS = 200_000


@dataclass(frozen=True)
class Tests:
    """``windows``: window, size, first/second term with offsets; ``items``: window, item."""

    windows: DataFrame
    items: DataFrame
    size: int


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_row, rid, _words): rows numbered along the scan; each read of the same files gives the same numbers."""
    docs = stable(docs)
    return docs.select(packed(docs), F.monotonically_increasing_id().alias("rid"), plain_words(column(text)).alias("_words"))


def cut_tests(benchmark: DataFrame, rows: DataFrame, size: int, *, item_id: str = "item_id", text: str = "text") -> Tests:
    """The windows of ``benchmark`` with their two rarest terms over ``rows`` (of ``numbered``)."""
    w = benchmark.select(F.coalesce(column(item_id).cast("string"), F.lit("")).alias("item"), plain_words(column(text)).alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))))
    items = w.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), size).alias("window")).distinct()
    items = stored(items, "decon-items")
    terms = items.select("window").distinct().select("window", F.posexplode("window").alias("at", "term"))
    wanted = stored(terms.select("term").distinct(), "decon-terms")
    seen = (rows.select(F.explode("_words").alias("term")).join(small(wanted, MAX_BROADCAST_WINDOWS), "term")
            .groupBy("term").agg(F.count("*").alias("n")))
    seen = stored(seen, "decon-frequencies")
    ranked = (terms.join(seen, "term", "left").groupBy("window")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term"))).alias("t")))  # at most ``size`` each
    second = F.when(F.size("t") > 1, F.col("t")[1]).otherwise(F.col("t")[0])
    windows = ranked.where(F.col("t")[0]["n"] > 0).select(
        "window", F.col("t")[0]["term"].alias("first"), F.col("t")[0]["at"].alias("first_at"),
        second["term"].alias("second"), second["at"].alias("second_at"))
    return Tests(stored(windows, "decon-windows"), items, size)


def _places(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(rid, _words, pos, term, lead) of every word of ``rows`` that is one of ``terms`` (term, lead)."""
    if fits(terms, MAX_BROADCAST_WINDOWS):  # texts do not leave their task
        return rows.select("rid", "_words", F.posexplode("_words").alias("pos", "term")).join(F.broadcast(terms), "term")
    own = rows.select("rid", F.explode(F.array_distinct("_words")).alias("term")).join(terms, "term")
    own = own.groupBy(F.col("rid").alias("_r")).agg(F.map_from_entries(F.collect_list(F.struct("term", "lead"))).alias("_leads"))  # a text's own words
    met = rows.join(own, F.col("rid") == F.col("_r")).select("rid", "_words", "_leads")
    hits = F.filter(F.transform("_words", lambda w, i: F.struct(i.alias("pos"), w.alias("term"), F.element_at("_leads", w).alias("lead"))),
                    lambda x: x["lead"].isNotNull())
    return met.select("rid", "_words", F.explode(hits).alias("x")).select("rid", "_words", "x.*")


def postings(rows: DataFrame, tests: Tests, slack: int = 0) -> DataFrame:
    """(term, rid, pos, around, here): the stored lists of all first and second terms. ``around`` holds the
    words up to ``size - 1 + slack`` before and after, ``here`` the term's place among them; second terms that
    are nobody's first carry none."""
    first = tests.windows.select(F.col("first").alias("term"), F.lit(True).alias("lead"))
    terms = first.union(tests.windows.select("second", F.lit(False))).groupBy("term").agg(F.max("lead").alias("lead"))
    found = _places(rows, stored(terms, "decon-leads"))
    reach = tests.size - 1 + slack
    begin = F.greatest(F.col("pos") - reach, F.lit(0))
    around = F.slice("_words", begin + 1, F.col("pos") - begin + 1 + reach)
    return stored(found.select("term", "rid", "pos", F.when(F.col("lead"), around).alias("around"), (F.col("pos") - begin).alias("here")), "decon-postings")


def proposals(index: DataFrame, tests: Tests) -> DataFrame:
    """Starts that the rarest term's list proposes for each window."""
    windows = small(tests.windows, MAX_BROADCAST_WINDOWS)
    return (index.where("around is not null").join(windows, F.col("term") == F.col("first"))
            .withColumn("start", F.col("pos") - F.col("first_at")).drop("term"))


def exact(index: DataFrame, tests: Tests) -> DataFrame:
    """(rid, start, window) of every place where a window stands word by word."""
    second = index.select(F.col("term").alias("second"), "rid", F.col("pos").alias("second_pos"))
    both = proposals(index, tests).withColumn("second_pos", F.col("start") + F.col("second_at")).where("start >= 0").join(
        second, ["rid", "second_pos", "second"])
    at = F.col("here") - F.col("first_at") + 1
    return both.where(F.slice("around", at, F.size("window")) == F.col("window")).select("rid", "start", "window")


def proximity(index: DataFrame, tests: Tests, slack: int) -> DataFrame:
    """(rid, start, window, shift) where the second rarest term stands ``shift`` words, 0 < |shift| <= slack,
    from its place beside the rarest: near matches that ``exact`` does not return."""
    return _shifted(index, tests, slack).where("shift <> 0").select("rid", "start", "window", "shift")


def _shifted(index: DataFrame, tests: Tests, slack: int) -> DataFrame:
    second = index.select(F.col("term").alias("second"), "rid", F.col("pos").alias("second_pos"))
    shifts = F.explode(F.sequence(F.lit(-slack), F.lit(slack))).alias("shift")
    lead = proposals(index, tests).select("rid", "start", "window", "second", "second_at", "first_at", "here", "around", shifts)
    lead = lead.withColumn("second_pos", F.col("start") + F.col("second_at") + F.col("shift"))
    return lead.join(second, ["rid", "second_pos", "second"])


def common_in_order(a: Column, b: Column) -> Column:
    """The length of the longest common subsequence of two short arrays of words."""
    n = F.size(b)

    def row(above: Column, x: Column) -> Column:  # one word of ``a`` against all of ``b``
        return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), lambda r, j: F.concat(r, F.array(
            F.when(F.get(b, j - 1) == x, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(r, j - 1))))))

    return F.get(F.aggregate(a, F.array_repeat(F.lit(0), n + 1), row), n)


def near(index: DataFrame, tests: Tests, slack: int, share: float) -> DataFrame:
    """(rid, window) where ``share`` of the window's words stand in order, within ``slack`` words of its place, around a hit of
    its two rarest terms, but not the whole window word by word. Windows of under three words have no near matches."""
    hits = _shifted(index, tests, slack).where(F.size("window") > 2)
    begin = F.greatest(F.col("here") - F.col("first_at") - slack, F.lit(0))
    at = F.col("here") - F.col("first_at") + 1
    length = F.size("window") + F.when(at > slack, 2 * slack).otherwise(at - 1 + slack)
    # the same words around are compared once
    seen = hits.select("rid", "window", F.slice("around", begin + 1, length).alias("part"),
                       (F.when(at > 0, F.slice("around", F.greatest(at, F.lit(1)), F.size("window"))) == F.col("window")).alias("whole"))
    least = F.ceil(F.size("window") * share)
    there = F.size(F.filter("window", lambda w: F.array_contains("part", w)))  # in any order: no fewer than in order, and cheap
    seen = seen.where(~F.coalesce("whole", F.lit(False)) & (there >= least)).select("rid", "window", "part").distinct()
    return seen.where(common_in_order(F.col("part"), F.col("window")) >= least).select("rid", "window").distinct()


@dataclass(frozen=True)
class Matches:
    """The numbered rows, the stored exact and near matches, and the tests."""

    rows: DataFrame
    exact: DataFrame
    near: DataFrame
    tests: Tests


def matches(docs: DataFrame, benchmark: DataFrame, size: int = 10, *, text: str = "text", item_id: str = "item_id", slack: int = 3,
            near_share: float = 0.8) -> Matches:
    rows = numbered(docs, text)
    tests = cut_tests(benchmark, rows, size, item_id=item_id, text=text)
    index = postings(rows, tests, slack)
    return Matches(rows, stored(exact(index, tests), "decon-matches"), stored(near(index, tests, slack, near_share), "decon-near"), tests)


def _items(found: DataFrame, tests: Tests) -> DataFrame:
    """(rid, item): the distinct items of the windows found in each row."""
    return found.select("rid", "window").distinct().join(small(tests.items, MAX_BROADCAST_WINDOWS), "window").select("rid", "item").distinct()


def _digest(items: Column) -> Column:
    return F.sha2(F.concat_ws(",", F.coalesce(items, F.array().cast("array<string>"))).cast("binary"), 256)


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10, *, text: str = "text", item_id: str = "item_id", slack: int = 3,
           near_share: float = 0.8) -> DataFrame:
    """``docs`` without its text, with n_words, n_hit, n_items, items_sha256 and contaminated of the exact phrases, and
    with n_near (items with near matches only) and near_items_sha256 of the near ones."""
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near", "near_items_sha256")
    m = matches(docs, benchmark, size, text=text, item_id=item_id, slack=slack, near_share=near_share)
    covered = F.transform(F.collect_set(F.struct("start", F.size("window").alias("n"))), lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1))
    hits = m.exact.groupBy(F.col("rid").alias("_h")).agg(F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"))
    whole = stored(_items(m.exact, m.tests), "decon-whole")
    both = whole.select("rid", "item", F.lit(True).alias("whole")).unionByName(
        _items(m.near, m.tests).join(whole, ["rid", "item"], "left_anti").withColumn("whole", F.lit(False)))

    def listed(kind: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(kind, F.col("item"))))

    items = both.groupBy(F.col("rid").alias("_i")).agg(listed(F.col("whole")).alias("_items"), listed(~F.col("whole")).alias("_near"))
    out = m.rows.select("_row", "rid", F.size("_words").cast("long").alias("n_words"))
    out = out.join(hits, F.col("rid") == F.col("_h"), "left").join(items, F.col("rid") == F.col("_i"), "left")
    zero = F.lit(0).cast("long")

    def many(items: str) -> Column:
        return F.coalesce(F.size(items), F.lit(0)).cast("long")

    return out.select(*unpacked(m.rows, (text, *names)), "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                      F.when(F.col("_items").isNull(), zero).otherwise(many("_items")).alias("n_items"), _digest(F.col("_items")).alias("items_sha256"),
                      (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
                      F.when(F.col("_near").isNull(), zero).otherwise(many("_near")).alias("n_near"), _digest(F.col("_near")).alias("near_items_sha256"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = 10, *, text: str = "text", item_id: str = "item_id", drop_near: bool = False,
          slack: int = 3, near_share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no test window (with ``drop_near``: no near one either), unchanged."""
    rows = numbered(docs, text)
    tests = cut_tests(benchmark, rows, size, item_id=item_id, text=text)
    index = postings(rows, tests, slack if drop_near else 0)
    found = exact(index, tests).select("rid")
    if drop_near:
        found = found.unionByName(near(index, tests, slack, near_share).select("rid"))
    bad = small(stored(found.distinct(), "decon-bad"), 1_000_000)  # 8 MB, else shuffled
    return rows.drop("_words").join(bad, "rid", "left_anti").select(*unpacked(rows))
