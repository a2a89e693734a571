"""Sinks: CSV reports and the master/detail text export."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.export import ordered_lines


def write_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV in a directory ``path``. ``single_file`` only for bounded outputs
    (a top-n, a per-state table): it funnels the last stage into one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_lines(lines: DataFrame, path: str, single_file: bool = False) -> None:
    """Write export lines in order. A sorted frame is range-partitioned, so the
    part files read in name order give the global order."""
    out = ordered_lines(lines).select("line")
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)
