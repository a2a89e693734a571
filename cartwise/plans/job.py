"""Report runner and end-to-end job.

Stage 1 cleans the 8 sources once and writes the prepared tables as plain Parquet to a staging
folder on shared storage; stage 2 computes every report from those files, several at once. Reports never repeat the scan, coercion and de-duplication, lineage is
cut at the staging boundary, and a lost executor repeats only tasks of the current stage. The staged
tables are not bucketed: every wide operator then has an exchange whose skewed partitions AQE
can split, and the number of files follows the data.

Only ``spark.read``, DataFrames and ``spark.conf`` are used, so the job also runs from a Spark Connect
session. Folders and the input's size are arguments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import staged_metrics, table_counts
from ..session import SCALE_CONF, shuffle_partitions_for
from ..sinks import write_lines, write_report
from ..sources.catalog import load_sources, path_join
from ..specs import SPECS
from . import reports
from .export import top_cart_lines
from .prepare import prepare_counted, without_counts
from .views import CountedTables, cart_enriched, cart_item_summary, cart_items

# Report names (output folder names), and whether a report is small enough for one file.
REPORTS = {
    "top_produtos_abandonados": True,
    "top_duplas_produtos_abandonados": True,
    "produtos_com_aumento_abandono": True,
    "produtos_novos_primeiro_mes": False,
    "abandonos_por_estado": True,
    "relatorio_produtos_mes": False,
    "relatorio_diario": False,
}
EXPORT_NAME = "top_50_carrinhos.txt"
LOOKUPS = ("tb_regions", "tb_paymentmodes", "tb_cmssitelp", "tb_users", "tb_paymentinfos", "tb_addresses")
AT_ONCE = 4  # reports (or tables) that run side by side
METRICS = ("rows_read", "null_keys", "duplicates", "rejected_values", "rows_kept")


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, work: Mapping[str, Callable[[], object]], at_once: int = AT_ONCE) -> dict[str, object]:
    """Run independent pieces of work from ``at_once`` threads, each in a scheduler pool of its name, so that the last tasks
    of one and the planning of the next leave no cores idle. If any fails, the others end and the first to fail, in
    the order given, is raised under its name."""

    def run(name: str) -> object:
        context = getattr(spark, "_sc", None)  # a Spark Connect session has none
        if context is not None:
            context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return work[name]()
        finally:
            if context is not None:
                context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(work)))) as pool:
        running = {name: pool.submit(run, name) for name in work}
    for name, job in running.items():
        if job.exception() is not None:
            raise RuntimeError(f"{name} failed: {job.exception()}") from job.exception()
    return {name: job.result() for name, job in running.items()}


def stage_prepared(raw: Mapping[str, DataFrame], stage_dir: str) -> dict[str, DataFrame]:
    """Clean and write each source once (with its counts per key). Returns the prepared tables and ``cart_items``, a projection of them."""
    spark = next(iter(raw.values())).sparkSession
    counted = together(spark, {name: lambda n=name: _stage(prepare_counted(raw[n], SPECS[n]), path_join(stage_dir, n)) for name in raw})
    out = {name: without_counts(df, SPECS[name]) for name, df in counted.items()}
    return out | {"cart_items": cart_items(out["tb_cartentries"])}


def register_views(prepared: Mapping[str, DataFrame], items: DataFrame) -> None:
    """Temporary views for SQL users: ``prepared_<table>``, ``cart_items``, ``cart_item_summary``, ``cart_enriched``."""
    for name in SPECS:
        prepared[name].createOrReplaceTempView(f"prepared_{name}")
    items.createOrReplaceTempView("cart_items")
    cart_item_summary(items).createOrReplaceTempView("cart_item_summary")
    cart_enriched(prepared, items).createOrReplaceTempView("cart_enriched")


def build_reports(
    prepared: Mapping[str, DataFrame], items: DataFrame, n: int = 50, stage_dir: str | None = None
) -> dict[str, DataFrame]:
    """The 7 report frames by name. With ``stage_dir`` the shared intermediates (the entries summed by product, cart and month
    of R1/R2, the (product, month) aggregate of R3/R4/R6 made from them, and the per-cart rollup of R5/R7) are
    written once and read by their reports."""
    rollup = cart_enriched(prepared, items, need=reports.ROLLUP_NEED)
    if stage_dir is None:
        stats = reports.product_month_stats(items)
        top, pairs = reports.top_products(items, n), reports.top_pairs(items, n)
    else:
        def entries() -> tuple[DataFrame, DataFrame]:
            months = _stage(reports.basket_months(items), path_join(stage_dir, "basket_months"))
            return months, _stage(reports.product_month_totals(months), path_join(stage_dir, "product_month_stats"))

        written = together(items.sparkSession, {"basket_months": entries, "cart_rollup": lambda: _stage(rollup, path_join(stage_dir, "cart_rollup"))})
        (months, stats), rollup = written.values()
        top = reports.top_product_totals(months, n)
        pairs = reports.top_pairs(months.where("first"), n, materialize=False, distinct=True)
    frames = (
        top,
        pairs,
        reports.rising_products(stats=stats, n=n),
        reports.first_month(stats=stats),
        reports.by_state(rollup),
        reports.product_month(stats=stats),
        reports.daily(rollup),
    )
    return dict(zip(REPORTS, frames))


def run_reports(
    prepared: Mapping[str, DataFrame],
    output_dir: str,
    n: int = 50,
    items: DataFrame | None = None,
    stage_dir: str | None = None,
) -> None:
    """The reports and the export, written side by side."""
    items = items if items is not None else cart_items(prepared["tb_cartentries"])
    frames = build_reports(prepared, items, n, stage_dir)
    work = {name: lambda r=name: write_report(frames[r], path_join(output_dir, f"{r}.csv"), single_file=REPORTS[r]) for name in frames}
    work[EXPORT_NAME] = lambda: write_lines(top_cart_lines(prepared, items, n), path_join(output_dir, EXPORT_NAME))
    together(items.sparkSession, work)


def prepare_to(
    spark: SparkSession,
    data_dir: str | None,
    stage_dir: str,
    raw_tables: Mapping[str, DataFrame] | None = None,
    metrics: bool = True,
) -> dict[str, dict[str, int]]:
    """Load the 8 sources, clean them and write them to ``stage_dir``.

    With ``metrics``, returns per table rows_read, null_keys, duplicates, rejected_values and rows_kept: sums over the
    counts per key that the written tables carry, so each source is read once, and exact also when
    executors are lost and tasks run again.
    """
    raw = raw_tables if raw_tables is not None else load_sources(spark, data_dir)
    stage_prepared(raw, stage_dir)
    if not metrics:
        return {}
    rows = reduce(DataFrame.unionByName, [staged_metrics(_counted(spark, stage_dir, name), SPECS[name]) for name in raw]).collect()  # a row each
    return {r["table_name"]: {m: r[m] for m in METRICS} for r in rows}


def _counted(spark: SparkSession, stage_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_join(stage_dir, name))


def staged_tables(spark: SparkSession, stage_dir: str) -> dict[str, DataFrame]:
    """The staged tables and ``cart_items``; lookup tables are counted, from the files' footers."""
    counted = {name: _counted(spark, stage_dir, name) for name in SPECS}
    rows = reduce(DataFrame.unionByName, [counted[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in LOOKUPS]).collect()  # a row each
    tables = {name: without_counts(df, SPECS[name]) for name, df in counted.items()}
    return CountedTables(tables | {"cart_items": cart_items(tables["tb_cartentries"])}, {r["name"]: r["n"] for r in rows})


def reports_from(spark: SparkSession, stage_dir: str, output_dir: str, top_limit: int = 50, register: bool = False) -> None:
    """The 7 reports and the export from tables written by ``prepare_to``; named views on request."""
    staged = staged_tables(spark, stage_dir)
    items = staged.pop("cart_items")
    if register:
        register_views(staged, items)
    run_reports(staged, output_dir, top_limit, items=items, stage_dir=stage_dir)


def counts_from(spark: SparkSession, stage_dir: str) -> list[tuple[str, int]]:
    """(table, rows) of the staged tables."""
    staged = staged_tables(spark, stage_dir)
    return [(r["table_name"], r["row_count"]) for r in table_counts({k: staged[k] for k in SPECS}).collect()]


@contextmanager
def scale_settings(spark: SparkSession, input_bytes: int | None) -> Iterator[None]:
    """The job's session settings (``SCALE_CONF``, and shuffle partitions for the input's size), taken
    back at the end."""
    wanted = {k: v for k, v in SCALE_CONF.items() if k.startswith("spark.sql.")}  # others are fixed at start
    if input_bytes:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_job(
    spark: SparkSession,
    data_dir: str | None,
    output_dir: str,
    top_limit: int = 50,
    stage_dir: str | None = None,
    raw_tables: Mapping[str, DataFrame] | None = None,
    input_bytes: int | None = None,
    register: bool = False,
) -> dict[str, dict[str, int]]:
    """load -> prepare -> stage -> 7 reports + export. Usable from spark-submit or a notebook.

    ``stage_dir`` defaults to ``_stage`` below ``output_dir``; its files may be deleted after the run (with
    ``register`` the views read them). Returns the load metrics per table.
    """
    stage_dir = stage_dir or path_join(output_dir, "_stage")
    with scale_settings(spark, input_bytes):
        kept = prepare_to(spark, data_dir, stage_dir, raw_tables)
        reports_from(spark, stage_dir, output_dir, top_limit, register)
    return kept


def main(argv: list[str] | None = None) -> None:
    import argparse

    p = argparse.ArgumentParser(description="Abandoned-basket reports on Spark")
    sub = p.add_subparsers(dest="command")
    for name in ("prepare", "reports", "run", "counts"):
        sp = sub.add_parser(name)
        if name in ("prepare", "run"):
            sp.add_argument("--data-dir", required=True)
            sp.add_argument("--input-gb", type=float, default=None, help="size of the sources, for the number of shuffle partitions")
        if name in ("reports", "run"):
            sp.add_argument("--output-dir", required=True)
            sp.add_argument("--top-limit", type=int, default=50)
        sp.add_argument("--stage-dir", required=name != "run", default=None)
    a = p.parse_args(argv)
    if a.command is None:
        p.error("choose a command: prepare, reports, run or counts")
    spark = SparkSession.builder.appName("cartwise").getOrCreate()
    size = int(a.input_gb * 1e9) if getattr(a, "input_gb", None) else None
    if a.command == "counts":
        for table, n in counts_from(spark, a.stage_dir):
            print(f"{table}: {n}")
    elif a.command == "prepare":
        cols = ("rows_kept", "rows_read", "null_keys", "duplicates", "rejected_values")
        print("table\t" + "\t".join(cols))
        with scale_settings(spark, size):
            kept = prepare_to(spark, a.data_dir, a.stage_dir)
        for table, m in kept.items():
            print(table + "\t" + "\t".join(str(m[c]) for c in cols))
    elif a.command == "reports":
        with scale_settings(spark, None):
            reports_from(spark, a.stage_dir, a.output_dir, a.top_limit)
    else:
        run_job(spark, a.data_dir, a.output_dir, a.top_limit, a.stage_dir, input_bytes=size)


if __name__ == "__main__":
    main()
