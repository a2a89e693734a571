"""The registered queries: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Decimal outputs
are widened to ``decimal(38, s)`` so that both engines of the correctness check
report the same type (the values are unchanged).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import coerce_frame, to_decimal, to_integer, to_timestamp
from ..functions.text import export_field
from ..operators import league_points, load_batches, load_metrics, nearest_ancestor, table_counts, top_pairs, topk_sum_at_least
from ..operators.metrics import staged_metrics
from ..session import scratch_path
from ..sources import driver
from ..sources.catalog import load_sources
from ..sources.delimited import read_delimited_checked
from ..specs import SPECS
from . import reports
from .export import top_cart_lines
from .job import EXPORT_NAME, REPORTS, run_job, stage_prepared
from .prepare import prepare, prepare_all, prepare_counted
from .views import cart_enriched, cart_item_summary, cart_items

TOP_N = 50
COMMISSION_THRESHOLD = 290000


def canon(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) and f.dataType.precision != 38:
            cols.append(F.col(f.name).cast(T.DecimalType(38, f.dataType.scale)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _prepared(spark, sf_dir):
    return prepare_all(driver.source_tables(spark, sf_dir))


def _items(spark, sf_dir):
    return cart_items(prepare(driver.cartentries(spark, sf_dir), SPECS["tb_cartentries"]))


def q_dedup_entries(spark, sf_dir):
    return canon(prepare(driver.cartentries(spark, sf_dir), SPECS["tb_cartentries"]))


ENTRY_SQL = (
    "l_orderkey * 8 + l_linenumber as pk", "l_shipdate as createdts", "l_orderkey as p_order",
    "l_linenumber as p_entrynumber", "l_partkey as p_product", "l_quantity as p_quantity", "l_extendedprice as p_totalprice",
)


def _arrivals(spark, sf_dir) -> list[DataFrame]:
    """Two arrivals that together hold the whole table: open lines, then the others (raw columns)."""
    entries = driver.table(spark, sf_dir, "lineitem").selectExpr(*ENTRY_SQL, "coalesce(l_linestatus = 'O', false) as _open")
    return [entries.where("_open").drop("_open"), entries.where("not _open").drop("_open")]


def q_insert_if_absent(spark, sf_dir):
    spec = SPECS["tb_cartentries"]
    return canon(load_batches([coerce_frame(b, spec) for b in _arrivals(spark, sf_dir)], "pk"))


def q_table_counts(spark, sf_dir):
    return table_counts(_prepared(spark, sf_dir))


def q_load_metrics(spark, sf_dir):
    raw = driver.source_tables(spark, sf_dir)
    out = None
    for name, df in raw.items():
        m = load_metrics(df, SPECS[name])
        out = m if out is None else out.unionByName(m)
    return out


def q_lenient_casts(spark, sf_dir):
    li = driver.table(spark, sf_dir, "lineitem")
    s = T.StringType()
    texts = li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pk"),
        F.col("l_quantity").cast("string").alias("qty_text"),
        F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" ")).alias("line_text"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("e3")).alias("exp_text"),
        F.col("l_extendedprice").cast("string").alias("price_text"),
        F.col("l_returnflag").alias("flag_text"),
        F.col("l_shipdate").cast("string").alias("ts_text"),
        F.col("l_discount"),
        F.col("l_tax"),
        F.when(F.col("l_returnflag") == "N", F.lit("nan")).otherwise(F.col("l_quantity").cast("string")).alias("qtynan_text"),
    )
    d = T.DoubleType()
    return canon(texts.select(
        "pk",
        to_integer("qty_text", s).alias("qty_int"),
        to_integer("line_text", s).alias("line_int"),
        to_integer("exp_text", s).alias("exp_int"),
        to_integer("price_text", s).alias("price_int"),
        to_decimal("price_text", s).alias("price_dec"),
        to_integer("flag_text", s).alias("flag_int"),
        to_timestamp("flag_text", s).alias("flag_ts"),
        to_timestamp("ts_text", s).alias("ship_ts"),
        to_integer("l_discount", d).alias("disc_int"),
        to_decimal("l_tax", d).alias("tax_dec"),
        to_integer("qtynan_text", s).alias("qtynan_int"),
        to_decimal("qtynan_text", s).alias("qtynan_dec"),
    ))


def q_cart_items(spark, sf_dir):
    return canon(_items(spark, sf_dir))


def q_cart_item_summary(spark, sf_dir):
    return canon(cart_item_summary(_items(spark, sf_dir)))


def q_cart_enriched(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return canon(cart_enriched(p, cart_items(p["tb_cartentries"])))


def q_top_products(spark, sf_dir):
    return canon(reports.top_products(_items(spark, sf_dir), TOP_N))


def q_top_pairs(spark, sf_dir):
    return reports.top_pairs(_items(spark, sf_dir), TOP_N)


def q_rising_products(spark, sf_dir):
    return canon(reports.rising_products(_items(spark, sf_dir), TOP_N))


def q_first_month(spark, sf_dir):
    return canon(reports.first_month(_items(spark, sf_dir)))


def _rollup(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return cart_enriched(p, cart_items(p["tb_cartentries"]), need=reports.ROLLUP_NEED)


def q_by_state(spark, sf_dir):
    return canon(reports.by_state(_rollup(spark, sf_dir)))


def q_product_month(spark, sf_dir):
    return canon(reports.product_month(_items(spark, sf_dir)))


def q_daily(spark, sf_dir):
    return canon(reports.daily(_rollup(spark, sf_dir)))


def q_top_carts(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return canon(reports.top_carts(p, cart_items(p["tb_cartentries"]), TOP_N))


def q_top_carts_lines(spark, sf_dir):
    p = _prepared(spark, sf_dir)
    return top_cart_lines(p, cart_items(p["tb_cartentries"]), TOP_N).select("cart_id", "line_kind", "entry_id", "line")


def q_league_points(spark, sf_dir):
    return league_points(driver.times(spark, sf_dir), driver.jogos(spark, sf_dir))


def q_topk_sum_at_least(spark, sf_dir):
    return topk_sum_at_least(driver.comissoes(spark, sf_dir), "vendedor", "valor", 3, COMMISSION_THRESHOLD)


def q_nearest_ancestor(spark, sf_dir):
    return nearest_ancestor(driver.colaboradores(spark, sf_dir), "id", "lider_id", "salario", 2)


def q_delimited_roundtrip(spark, sf_dir):
    nation = driver.table(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation-pipe")
    nation.write.mode("overwrite").option("header", True).option("sep", "|").csv(path)
    rows, _long = read_delimited_checked(spark, path, ["n_nationkey", "n_name", "n_regionkey"])
    s = T.StringType()
    return rows.select(
        to_integer("n_nationkey", s).alias("n_nationkey"),
        F.col("n_name"),
        to_integer("n_regionkey", s).alias("n_regionkey"),
    )


def q_ragged_rows(spark, sf_dir):
    """Short, long and quoted rows made from every line item: what is kept, and what is reported."""
    li = driver.table(spark, sf_dir, "lineitem")
    key = "cast(l_orderkey * 8 + l_linenumber as string)"
    lines = li.selectExpr(f"""concat_ws('|', {key}, case l_linenumber % 4 when 0 then l_returnflag
        when 1 then concat('"', l_returnflag, '|""', l_linestatus, '"') else l_linestatus end,
        case when l_linenumber % 4 <> 2 then cast(l_partkey as string) end, case when l_linenumber % 4 = 3 then 'surplus' end) as line""")
    path = scratch_path(spark, "ragged")
    lines.write.text(path)
    rows, long_rows = read_delimited_checked(spark, path, ["k", "flag", "part"], header=False)
    kept = rows.groupBy("k", "flag", "part").agg(F.count("*").alias("n")).withColumn("kind", F.lit("row"))
    surplus = long_rows.groupBy("k", "flag", "part").agg(F.count("*").alias("n")).withColumn("kind", F.lit("long"))
    return kept.unionByName(surplus)


def _entries_with_rejects(spark, sf_dir):
    """Entries with NULL keys, junk numbers and dates."""
    li = driver.table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "case when l_linenumber = 7 then null when l_linenumber = 6 then 'junk' else cast(l_orderkey * 8 + l_linenumber as string) end as pk",
        "case when l_returnflag = 'R' then '2024-13-01' else cast(l_shipdate as string) end as createdts",
        "cast(l_orderkey as string) as p_order", "concat(l_linenumber, '.0') as p_entrynumber",
        "case when l_linenumber = 2 then concat(l_partkey, '.5') else concat(' ', l_partkey, '\t') end as p_product",
        "case when l_linestatus = 'O' then 'nan' else cast(l_quantity as string) end as p_quantity",
        "cast(l_extendedprice as string) as p_totalprice",
    )


def q_load_rejects(spark, sf_dir):
    """Load metrics of entries with NULL keys, junk numbers and dates."""
    return load_metrics(_entries_with_rejects(spark, sf_dir), SPECS["tb_cartentries"])


def _write_sources(spark, sf_dir, base: str) -> None:
    """The mapped tables as files in source spelling: pipe text and Parquet."""
    for name, df in driver.source_tables(spark, sf_dir).items():
        spec = SPECS[name]
        df = df.toDF(*spec.columns)
        if spec.fmt == "csv":
            df.write.option("header", True).option("sep", "|").csv(f"{base}/{spec.file}")
        else:
            df.write.option("compression", "zstd").parquet(f"{base}/{spec.file}")


def q_source_files(spark, sf_dir):
    """The sources from files: loaded by the catalogue, cleaned, one line of text per row."""
    base = scratch_path(spark, "source-files")
    _write_sources(spark, sf_dir, base)
    out = None
    for name, df in prepare_all(load_sources(spark, base)).items():
        fields = [export_field(F.col(f.name), f.dataType) for f in df.schema.fields]
        part = df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *fields).alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


def _numbered(lines: DataFrame, skip: int) -> DataFrame:
    """(position, line): a report's lines with their place in it, over part files in name order, each without its first
    ``skip`` lines. A file's lines in one task are numbered in a row already (``at``), so only their first number and how
    many lines of the file, and of the files before it, come before them are added: a small table."""
    task = F.shiftright("at", 33).alias("task")
    runs = lines.groupBy("file_name", task).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("file_name").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
    sizes = lines.groupBy("file_name").agg((F.count("*") - skip).alias("n"))
    every = sizes.agg(F.collect_list(F.struct("file_name", "n"))).scalar()  # a pair per part file
    before = F.aggregate(F.filter("every", lambda f: f["file_name"] < F.col("file_name")), F.lit(0).cast("bigint"), lambda a, f: a + f["n"])
    starts = runs.select("file_name", "task", (F.col("earlier") - F.col("first") + 1 - skip).alias("shift"), every.alias("every")).select("file_name", "task", "shift", before.alias("before"))
    within = lines.select("file_name", task, "at", F.col("value").alias("line")).join(F.broadcast(starts), ["file_name", "task"])
    no = F.col("at") + F.col("shift")
    return within.where(no > 0).select((F.col("before") + no).alias("position"), "line")


def q_report_files(spark, sf_dir):
    """The whole job on files: every line of the seven reports and of the export with its place in the output."""
    base = scratch_path(spark, "report-files")
    _write_sources(spark, sf_dir, f"{base}/data")
    run_job(spark, f"{base}/data", f"{base}/out", TOP_N, f"{base}/stage")
    out = None
    for name in (*(f"{r}.csv" for r in REPORTS), EXPORT_NAME):
        lines = spark.read.text(f"{base}/out/{name}").select("value", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
        part = _numbered(lines, 0 if name == EXPORT_NAME else 1).select(F.lit(name).alias("report"), "position", "line")  # a header line each
        out = part if out is None else out.unionByName(part)
    return out


def q_stream_ingest(spark, sf_dir):
    """The two arrivals of ``insert_if_absent`` as files of a stream that is stopped and started again."""
    from ..streaming.ingest import start_ingest, stored_table

    spec = SPECS["tb_cartentries"]
    base = scratch_path(spark, "stream-ingest")
    for i, arrival in enumerate(_arrivals(spark, sf_dir)):
        arrival.write.parquet(f"{base}/incoming/{i:04d}")
        start_ingest(spark, f"{base}/incoming/*", arrival.schema, spec, f"{base}/target", f"{base}/_checkpoint").awaitTermination()
    return canon(stored_table(spark, f"{base}/target", spec))


def q_staged_metrics(spark, sf_dir):
    """Load metrics as a by-product of cleaning: sums over the counts per key that the staged tables carry."""
    stage = scratch_path(spark, "staged-metrics")
    raw = driver.source_tables(spark, sf_dir)
    stage_prepared(raw, stage)
    return reduce(DataFrame.unionByName, [staged_metrics(spark.read.parquet(f"{stage}/{name}"), SPECS[name]) for name in raw])


def q_staged_rejects(spark, sf_dir):
    """The metrics of ``load_rejects`` from the counted one-row-per-key table."""
    spec = SPECS["tb_cartentries"]
    return staged_metrics(prepare_counted(_entries_with_rejects(spark, sf_dir), spec), spec)


def q_mixed_headers(spark, sf_dir):
    """Orders in files whose headers order and extend the columns differently, read as one table."""
    orders = driver.table(spark, sf_dir, "orders")
    base = scratch_path(spark, "mixed-headers")
    headers = (("o_orderkey", "o_custkey", "o_totalprice"), ("o_totalprice", "o_orderpriority", "o_custkey", "o_orderkey"), ("o_custkey", "o_totalprice", "o_orderkey", "o_orderpriority"))
    for i, columns in enumerate(headers):
        orders.where(F.pmod("o_orderkey", F.lit(3)) == i).select(*columns).write.option("header", True).option("sep", "|").csv(f"{base}/{i}")
    rows, _ = read_delimited_checked(spark, f"{base}/*", list(headers[0]))
    s = T.StringType()
    return canon(rows.select(to_integer("o_orderkey", s).alias("o_orderkey"), to_integer("o_custkey", s).alias("o_custkey"), to_decimal("o_totalprice", s).alias("o_totalprice")))


def q_sparse_lookups(spark, sf_dir):
    """Lookups of carts of which nine in ten have no user and most no address."""
    p = _prepared(spark, sf_dir)
    carts = p["tb_carts"].withColumns({"p_user": F.expr("if(pk % 10 = 0, p_user, null)"), "p_paymentaddress": F.expr("if(pk % 7 = 0, p_paymentaddress, null)")})
    return cart_enriched(p, need=("user_uid", "postal_code", "state"), carts=carts)


def q_top_pairs_cut(spark, sf_dir):
    """``top_pairs`` with baskets cut into lists of two products: their pairs come from lists that meet as well."""
    return top_pairs(_items(spark, sf_dir), TOP_N, block=2)


def q_stream_slots(spark, sf_dir):
    """Arrivals by return flag into a target of many key slots; the first arrival that holds a key wins."""
    from ..streaming.ingest import start_ingest, stored_table

    spec = SPECS["tb_cartentries"]
    base = scratch_path(spark, "stream-slots")
    entries = driver.table(spark, sf_dir, "lineitem").selectExpr(*ENTRY_SQL, "coalesce(l_returnflag, '') as _flag")
    for i, flag in enumerate("NRA"):
        arrival = entries.where((F.col("_flag") == flag) if flag != "A" else ~F.col("_flag").isin("N", "R")).drop("_flag")
        arrival.write.parquet(f"{base}/incoming/{i:04d}")
        start_ingest(spark, f"{base}/incoming/*", arrival.schema, spec, f"{base}/target", f"{base}/_checkpoint", slot_width=1 << 18).awaitTermination()
    return canon(stored_table(spark, f"{base}/target", spec))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_entries": q_dedup_entries,
    "insert_if_absent": q_insert_if_absent,
    "table_counts": q_table_counts,
    "load_metrics": q_load_metrics,
    "lenient_casts": q_lenient_casts,
    "cart_items": q_cart_items,
    "cart_item_summary": q_cart_item_summary,
    "cart_enriched": q_cart_enriched,
    "top_products": q_top_products,
    "top_pairs": q_top_pairs,
    "rising_products": q_rising_products,
    "first_month": q_first_month,
    "by_state": q_by_state,
    "product_month": q_product_month,
    "daily": q_daily,
    "top_carts": q_top_carts,
    "top_carts_lines": q_top_carts_lines,
    "league_points": q_league_points,
    "topk_sum_at_least": q_topk_sum_at_least,
    "nearest_ancestor": q_nearest_ancestor,
    "delimited_roundtrip": q_delimited_roundtrip,
    "ragged_rows": q_ragged_rows,
    "load_rejects": q_load_rejects,
    "source_files": q_source_files,
    "report_files": q_report_files,
    "stream_ingest": q_stream_ingest,
    "staged_metrics": q_staged_metrics,
    "staged_rejects": q_staged_rejects,
    "mixed_headers": q_mixed_headers,
    "sparse_lookups": q_sparse_lookups,
    "top_pairs_cut": q_top_pairs_cut,
    "stream_slots": q_stream_slots,
}
