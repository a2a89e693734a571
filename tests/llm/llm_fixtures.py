"""Small documents with every awkward case: NULLs in any column, empty and very long texts, repeated rows,
ties, and extra columns whose names clash with working and output columns."""

import random

from pyspark.sql import functions as F

CLASHING = ("rid", "h", "id", "term", "pos", "value", "slot", "comp", "top", "key", "n", "kept", "n_words", "score", "label", "fingerprint")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "the re in an er on ti es th at en or st nd".split()


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def edge_rows(extra=()):
    rng = random.Random(8)
    a = words(rng, 60)
    rows = [
        (1, a, "en"), (2, a, "en"), (3, a.replace(" ", "  ").upper(), None), (4, None, "en"), (5, "", "fr"), (6, " \n\t ", "en"),
        (7, "one", "en"), (8, "É à ß 漢字 \U0001f642 naïve", "de"), (None, words(rng, 30), "en"), (None, None, None),
        (9, words(rng, 20_000), "en"), (10, words(rng, 40), "xx"), (10, words(rng, 40), "xx"), (1, a, "en"),
        (11, "no spaces " + "x" * 50_000, "es"), (12, words(rng, 12) + "\n" + words(rng, 12), "es"),
    ]
    return [(i, t, lang, "src0", None if t is None else len(t)) for i, t, lang in [*rows, *extra]]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def edge_docs(spark, extra=()):
    return frame(spark, edge_rows(extra)).repartition(3)


def no_docs(spark):
    return frame(spark, [])


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
