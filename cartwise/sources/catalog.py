"""Source catalogue: the 8 declared tables read from a data folder (any Hadoop URI)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..specs import SPECS, TableSpec, normalize_name
from .delimited import read_delimited


def path_join(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_source(spark: SparkSession, data_dir: str, spec: TableSpec) -> DataFrame:
    """Raw table with normalised (renamed, lower-case) column names, values untyped."""
    path = path_join(data_dir, spec.file)
    if spec.fmt == "csv":
        df = read_delimited(spark, path, list(spec.columns))
    else:
        df = spark.read.parquet(path).select(*spec.columns)
    return df.toDF(*[normalize_name(c) for c in spec.columns])


def load_sources(spark: SparkSession, data_dir: str, register: bool = False) -> dict[str, DataFrame]:
    out = {}
    for name, spec in SPECS.items():
        out[name] = read_source(spark, data_dir, spec)
        if register:
            out[name].createOrReplaceTempView(name)
    return out
