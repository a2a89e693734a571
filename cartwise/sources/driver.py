"""The driver's TPC-H-style tables presented as the 8 basket source tables.

This is the fixture mapping used by the correctness harness on both sides (Spark
here, DuckDB in ``cartwise.oracle``). Lineitems become cart entries,
orders become carts, customers become users and addresses, suppliers payment
infos, regions sites, nations states. (order, line) repeats in the data, so the
entry key really needs de-duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import path_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of a driver table; the relation (file listing, footer schema) is
    resolved once per session and path, like a catalog table. The memo lives on
    the session object, so a new session never sees another session's frames."""
    path = path_join(sf_dir, f"{name}.parquet")
    scans = spark.__dict__.setdefault("_cartwise_scans", {})
    if path not in scans:
        scans[path] = spark.read.parquet(path)
    return scans[path]


def cartentries(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber as pk",
        "l_shipdate as createdts",
        "l_orderkey as p_order",
        "l_linenumber as p_entrynumber",
        "l_partkey as p_product",
        "l_quantity as p_quantity",
        "l_extendedprice as p_totalprice",
    )


def carts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as pk",
        "o_orderdate as createdts",
        "o_totalprice as p_totalprice",
        "o_custkey as p_paymentaddress",
        "o_orderkey % 120 as p_paymentinfo",
        "cast(substring(o_orderpriority, 1, 1) as bigint) as p_paymentmode",
        "o_custkey as p_user",
        "o_orderkey % 7 as p_site",
    )


def users(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as pk", "c_name as p_uid")


def paymentmodes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(substring(o_orderpriority, 1, 1) as bigint) as pk", "o_orderpriority as p_code"
    )


def paymentinfos(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey as pk", "s_nationkey as p_installments")


def sites(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("cast(r_regionkey as bigint) as itempk", "r_name as p_name")


def addresses(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as pk",
        # shifted by 5: customers of nations 20-24 point at regions that do not exist
        "cast(c_nationkey + 5 as bigint) as p_region",
        "case when c_mktsegment = 'BUILDING' then 'nan' else c_mktsegment end as p_postalcode",
    )


def regions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as bigint) as pk", "n_name as p_isocode", "n_name as p_isocodeshort"
    )


def source_tables(spark: SparkSession, sf_dir: str):
    """Raw (untyped, duplicated) source tables keyed by their source names, built lazily."""
    from ..plans.prepare import LazyTables

    makers = {
        "tb_regions": regions, "tb_paymentmodes": paymentmodes, "tb_cmssitelp": sites, "tb_users": users,
        "tb_paymentinfos": paymentinfos, "tb_addresses": addresses, "tb_carts": carts, "tb_cartentries": cartentries,
    }
    return LazyTables({k: (lambda f=f: f(spark, sf_dir)) for k, f in makers.items()})


# Stand-alone question tables.
def colaboradores(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") == 0, None).otherwise(F.floor((F.col("c_custkey") - 1) / 3).cast("bigint")).alias("lider_id"),
        F.col("c_acctbal").alias("salario"),
    )


def times(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("time_id"), F.col("n_name").alias("time_nome"))


def jogos(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_orderkey") % 23).alias("mandante_time"),
        (F.col("o_custkey") % 23).alias("visitante_time"),
        (F.col("o_orderkey") % 5).alias("mandante_gols"),
        (F.col("o_custkey") % 4).alias("visitante_gols"),
    )


def comissoes(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("vendedor"), F.col("l_extendedprice").cast("decimal(18,4)").alias("valor"))
