"""Quality rules: distribution divergence from language references.

One pass over the whole texts yields a small row of counts per document (stored). A
language's reference is the mean over its documents with at least ``min_words`` words of
their normalised histograms, so no long or repeated document dominates by its length: one
of character classes (lower case, upper case, digits, symbols, other ASCII marks, other letters,
the rest) and one of the language's most common words with all other words as the last bin. A document is kept
if it passes the base rules and lies within ``max_classes`` and at most ``max_words`` (below) of its
references in Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).

Limits of words. The distance to the common words falls with a text's length, and a text without one of
them lies at a fixed distance (``void``) that ``max_words`` may never reach. So ``max_words`` is lowered, from all documents
that pass the other rules: per language and length (doubling number of words; at least ``min_rows`` documents) to
the median plus ``spread`` times the way from the 10 % quantile to the median, which foreign text among them hardly
moves; and, where a language's median is under half its void, to ``near_void`` of that, at any length.

Documents under ``min_words`` words are too short to compare and answer to the base rules alone.

Base counts: ``n_words`` (``[^\\x20\\x09-\\x0D]+``), ``word_chars`` (code points in them),
``n_symbols`` (``[#*$%&|<>]``), ``n_dup_lines`` (lines with a word that equal an earlier one),
``n_repeat_words`` (words in 8-word windows that occur twice or more). Windows are compared by 64-bit
hashes of their words' hashes, within one text (20,000 windows collide with probability 1e-11).

NULL and empty texts have no words and fail the base rules. NULL languages are a group of their own, with
the common words of all languages; so are languages without a word list. Rows are judged one by
one. Only DataFrame functions run; work within a row is linear in its text but for one sort of the windows
of texts that repeat some.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.common import ascii_lower, column, packed, small, space_words, stored, unpacked

WINDOW = 8
# Frequent function words of each language.
COMMON_WORDS = {
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "ist", "nicht"),
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}
CLASSES = ("lower", "upper", "digit", "symbol", "mark", "letter", "rest")


@dataclass(frozen=True)
class Settings:
    min_words: int = 50
    max_classes: float = 0.25
    max_words: float = 0.3
    spread: float = 3.0
    near_void: float = 0.95
    min_rows: int = 100
    common: dict[str, tuple[str, ...]] = field(default_factory=lambda: COMMON_WORDS)


def _strip(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, f"[{chars}]+", "")


def _covered(pairs: Column) -> Column:
    """The words covered by windows whose hash occurs twice or more; ``pairs``: (hash, start) of all
    windows in order, or NULL if no hash repeats."""
    def twin(pair: Column, i: Column) -> Column:
        same = [F.coalesce(F.get(pairs, i + step)["h"] == pair["h"], F.lit(False)) for step in (-1, 1)]
        return same[0] | same[1]

    def cover(acc: Column, at: Column) -> Column:
        return F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"))

    starts = F.array_sort(F.transform(F.filter(pairs, twin), lambda p: p["i"]))
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.when(pairs.isNull(), F.lit(0).cast("long")).otherwise(F.aggregate(starts, zero, cover, lambda acc: acc["n"]))


def features(docs: DataFrame, s: Settings, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(_row, _language, base counts, _classes, _common): other columns packed, histograms as arrays of counts."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_classes", "_common")
    keep = ["_row", "_language"]
    body = F.coalesce(column(text), F.lit(""))
    lists = {k: list(v) for k, v in s.common.items()}
    every = sorted({w for v in lists.values() for w in v})
    wanted = F.lit(None)
    for k, v in lists.items():
        wanted = F.when(column(lang) == k, F.array(*map(F.lit, v))).otherwise(wanted)
    wanted = F.coalesce(wanted.cast("array<string>"), F.array(*map(F.lit, every)))

    a = docs.select(packed(docs, (text, *names, "base_failed", "js_classes", "js_words", "kept")), column(lang).alias("_language"), body.alias("_text"), space_words(body).alias("_words"), wanted.alias("_wanted"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    # one class after the other is taken out; what is left gets short after the first two steps
    a = a.select("*", lines.alias("_lines"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_wh"),
                 F.filter("_words", lambda w: ascii_lower(w).isin(every)).alias("_hits"), _strip(F.col("_text"), "\\x20\\x09-\\x0D").alias("_t0"))
    steps = ("a-z", "A-Z", "0-9", "#*$%&|<>", "\\x21-\\x7E", "\\p{L}")
    for i, chars in enumerate(steps):
        a = a.withColumn(f"_t{i + 1}", _strip(F.col(f"_t{i}"), chars))
    sizes = [F.char_length(f"_t{i}").cast("long") for i in range(len(steps) + 1)]
    classes = F.array(*[x - y for x, y in zip(sizes, sizes[1:])], sizes[-1])
    n = F.size("_words")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_wh"), i + k) for k in range(WINDOW)]))
    lowered = F.transform("_hits", ascii_lower)
    a = a.select(*keep, "_wanted", n.cast("long").alias("n_words"), sizes[0].alias("word_chars"), (sizes[3] - sizes[4]).alias("n_symbols"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 windows.alias("_windows"), classes.alias("_classes"), lowered.alias("_low"))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    counts = F.transform("_wanted", lambda w: F.size(F.filter("_low", lambda x: x == w)).cast("long"))
    a = a.select("*", F.when(repeated, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_pairs"),
                 counts.alias("_counts"))
    inside = F.aggregate("_counts", F.lit(0).cast("long"), lambda x, y: x + y)
    return a.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", _covered(F.col("_pairs")).alias("n_repeat_words"),
                    "_classes", F.concat("_counts", F.array(F.col("n_words") - inside)).alias("_common"))


def _share(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance in [0, 1] of two distributions (arrays of one length)."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    each = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    total = F.aggregate(each, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def references(rows: DataFrame, s: Settings) -> DataFrame:
    """(lang, classes, words): the mean histograms of each language, as arrays."""
    long = rows.where(F.col("n_words") >= s.min_words).select(
        F.col("_language").alias("_lang"), F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), _share(F.col(c)).alias("p"))
                                                       for kind, c in (("classes", "_classes"), ("words", "_common"))])).alias("h"))
    bins = long.select("_lang", "h.kind", F.posexplode("h.p").alias("bin", "p"))
    means = bins.groupBy("_lang", "kind", "bin").agg(F.avg("p").alias("p"))  # a few dozen rows a language
    arrays = means.groupBy("_lang").pivot("kind", ["classes", "words"]).agg(F.array_sort(F.collect_list(F.struct("bin", "p"))))
    return arrays.select("_lang", *[F.transform(k, lambda x: x["p"]).alias(f"_ref_{k}") for k in ("classes", "words")])


def _length_band() -> Column:
    return F.least(F.floor(F.log2("n_words")), F.lit(9)).cast("int")


def limits(compared: DataFrame, refs: DataFrame, s: Settings) -> DataFrame:
    """(lang, band, limit): the largest distance of words; band -1 is for lengths with too few documents."""
    fine = compared.where(~F.col("base_failed") & (F.col("js_classes") <= s.max_classes) & F.col("js_words").isNotNull())
    fine = fine.select("_language", _length_band().alias("_band"), "js_words")
    low, mid = (F.percentile_approx("js_words", q, 10_000) for q in (0.1, 0.5))
    bands = fine.groupBy("_language", "_band").agg(low.alias("low"), mid.alias("mid"), F.count("*").alias("n")).where(F.col("n") >= s.min_rows)
    bands = bands.select("_language", "_band", (F.col("mid") + s.spread * (F.col("mid") - F.col("low"))).alias("own"))
    whole = fine.groupBy("_language").agg(mid.alias("mid"))
    none = F.transform("_ref_words", lambda x, i: F.when(i == F.size("_ref_words") - 1, 1.0).otherwise(0.0))
    void = refs.select("_lang", js_distance(none, F.col("_ref_words")).alias("void"))
    ceiling = F.least(F.lit(s.max_words), F.when(F.col("void") > 2 * F.col("mid"), s.near_void * F.col("void")))
    tops = whole.join(void, F.col("_language").eqNullSafe(F.col("_lang"))).select("_lang", ceiling.alias("top"))
    every = bands.unionByName(whole.select("_language", F.lit(-1).alias("_band"), F.lit(None).cast("double").alias("own")))
    return every.join(tops, F.col("_language").eqNullSafe(F.col("_lang"))).select(
        F.col("_language").alias("_lang"), F.col("_band").alias("_at"), F.least("own", "top").alias("_limit"))


def judge(docs: DataFrame, settings: Settings = Settings(), *, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without its text, with the base counts, ``base_failed``, ``js_classes``, ``js_words``
    (NULL under ``min_words``) and ``kept``."""
    s = settings
    rows = stored(features(docs, s, text=text, lang=lang), "divergence-features")
    refs = small(stored(references(rows, s), "divergence-references"), 10_000)
    out = rows.join(refs, F.col("_language").eqNullSafe(F.col("_lang")), "left")
    long = F.col("n_words") >= s.min_words
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = out.select("_row", "_language", *counts, failed.alias("base_failed"),
                     F.when(long, js_distance(_share(F.col("_classes")), F.col("_ref_classes"))).alias("js_classes"),
                     F.when(long, js_distance(_share(F.col("_common")), F.col("_ref_words"))).alias("js_words"))
    cuts = stored(limits(out, refs, s), "divergence-limits")  # at most 11 rows a language
    own = small(cuts.where("_at >= 0"), 50_000)
    rest = small(cuts.where("_at < 0").select(F.col("_lang").alias("_of"), F.col("_limit").alias("_rest")), 10_000)
    out = (out.join(own, F.col("_language").eqNullSafe(F.col("_lang")) & (_length_band() == F.col("_at")), "left")
           .join(rest, F.col("_language").eqNullSafe(F.col("_of")), "left"))
    limit = F.coalesce("_limit", "_rest", F.lit(s.max_words))
    near = F.coalesce((F.col("js_classes") <= s.max_classes) & (F.col("js_words") <= limit), F.lit(True))
    return out.select(*unpacked(rows), *counts, "base_failed", "js_classes", "js_words", (~F.col("base_failed") & near).alias("kept"))
