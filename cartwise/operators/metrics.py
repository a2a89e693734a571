"""Row counts per table and load metrics (read / null key / duplicate / rejected)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import COERCED, q, with_coerced
from ..specs import TableSpec


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table_name, row_count) per table; each count is a partial aggregate."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_metrics(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """rows_read, null_keys (after coercion), duplicate rows, rejected values, rows_kept.

    Duplicates are counted per key in a grouped partial aggregate, never by
    collecting keys. As a plain aggregate the counts stay exact when tasks run again.
    """
    both = with_coerced(raw, spec)
    per_key = both.selectExpr(f"{q(COERCED + spec.key)} as _k", f"{rejected_sql(spec)} as _rej").groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.sum("_rej").alias("_rej"))
    return _metrics(per_key, spec)


def rejected_sql(spec: TableSpec) -> str:
    """Over ``with_coerced``: how many of a row's values are given but did not convert."""
    return " + ".join(f"case when {q(n)} is not null and {q(COERCED + n)} is null then 1 else 0 end" for n in spec.normalized)


ROWS, REJECTED = "_rows", "_rejected"


def staged_metrics(counted: DataFrame, spec: TableSpec) -> DataFrame:
    """The same as ``load_metrics``, from a table of one row per key (NULL too) that carries its counts."""
    return _metrics(counted.selectExpr(f"{q(spec.key)} as _k", f"{ROWS} as _n", f"{REJECTED} as _rej"), spec)


def _metrics(per_key: DataFrame, spec: TableSpec) -> DataFrame:
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("_k").isNotNull(), F.col("_n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("_rej"), F.lit(0)).alias("rejected_values"),
        F.count("_k").alias("rows_kept"),
    ).select(F.lit(spec.name).alias("table_name"), "*")
