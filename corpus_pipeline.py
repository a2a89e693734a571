"""A corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Folders are new ones below ``spark.checkpoint.dir``.

- quality: documents that the Kneser-Ney classifier rejects go.
- near_duplicates: of each SimHash group one document stays: the one with the smallest ``doc_id``. Of rows that
  repeat that id, the smallest by (text, all other columns) stays.
- decontamination: documents that hold a benchmark window go.
- surrogates: personal data in the text is replaced; ``n_chars`` is counted again.
- tokens: what is left is encoded and decoded; one row of counts and digests per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import bpe, decontaminate, kneser_ney, simhash, surrogates
from cartwise.llm.common import stored, table
from cartwise.llm.settings import SURROGATE_KEY, tokenizer_path

ORACLE_SQL = None  # trained models, fingerprints and tokenizers; tested against plain Python instead


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kneser_ney.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs, width=4, max_distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"), size=10)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = surrogates.pseudonymise(docs, SURROGATE_KEY)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest(docs.select("doc_id", "text"), bpe.Bpe.from_json(tokenizer_path()))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", pii),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
