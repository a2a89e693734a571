"""Reports R1-R8. Every function takes and returns DataFrames; limits are arguments.

Orderings are total (down to a key) and put NULLs last in both directions.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.pairs import top_pairs as _top_pairs
from .views import cart_enriched


def _a(c: str):
    return F.col(c).asc_nulls_last()


def _d(c: str):
    return F.col(c).desc_nulls_last()


# R1
def top_products(items: DataFrame, n: int = 50) -> DataFrame:
    """Per product: distinct carts, items and revenue; the n most abandoned.

    ``count(distinct cart_id)`` is planned as a (product, cart) partial
    aggregate followed by a product aggregate, so a very popular product is
    reduced map-side before it is shuffled.
    """
    return (
        items.groupBy("product_id")
        .agg(
            F.count_distinct("cart_id").alias("abandoned_carts"),
            F.sum("quantity").alias("abandoned_items"),
            F.sum("total_price").alias("unrealized_revenue"),
        )
        .orderBy(_d("abandoned_carts"), _d("unrealized_revenue"), _a("product_id"))
        .limit(n)
    )


# The shared input of R1, R2 and R6 where it is worth writing
def basket_months(items: DataFrame) -> DataFrame:
    """The entries summed by product, cart and month; ``first`` marks one row of each product and cart.

    One exchange, by product and cart, serves both the sums and the marks, and what is made from the marks
    needs no distinct count.
    """
    sums = items.repartition("product_id", "cart_id").groupBy("product_id", "cart_id", "month").agg(
        F.sum("quantity").alias("quantity"), F.sum("total_price").alias("total_price"))
    w = Window.partitionBy("product_id", "cart_id").orderBy(_a("month"))
    return sums.withColumn("first", F.row_number().over(w) == 1)


def _totals(carts) -> tuple:
    return (carts.alias("abandoned_carts"), F.sum("quantity").cast("decimal(28,4)").alias("abandoned_items"),
            F.sum("total_price").cast("decimal(28,4)").alias("unrealized_revenue"))


def top_product_totals(months: DataFrame, n: int = 50) -> DataFrame:
    """R1 from ``basket_months``."""
    return months.groupBy("product_id").agg(*_totals(F.count_if("first"))).orderBy(
        _d("abandoned_carts"), _d("unrealized_revenue"), _a("product_id")).limit(n)


def product_month_totals(months: DataFrame) -> DataFrame:
    """``product_month_stats`` from ``basket_months``."""
    return months.groupBy("product_id", "month").agg(*_totals(F.count("cart_id")))


# R2
def top_pairs(items: DataFrame, n: int = 50, materialize: bool = True, distinct: bool = False) -> DataFrame:
    return _top_pairs(items, n, materialize=materialize, distinct=distinct)


# R6 (also the shared input of R3 and R4)
def product_month_stats(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id", "month").agg(
        F.count_distinct("cart_id").alias("abandoned_carts"),
        F.sum("quantity").alias("abandoned_items"),
        F.sum("total_price").alias("unrealized_revenue"),
    )


def product_month(items: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    stats = stats if stats is not None else product_month_stats(items)
    return stats.select(
        "product_id", "month", "abandoned_carts", "abandoned_items", "unrealized_revenue"
    ).orderBy(_a("month"), _a("product_id"))


# R3
def rising_products(items: DataFrame | None = None, n: int = 50, stats: DataFrame | None = None) -> DataFrame:
    """Months in which a product's distinct carts rose against its previous *observed* month.

    The window runs over the monthly aggregate (at most one row per product and
    month), so even the most popular product is a short window partition.
    """
    stats = stats if stats is not None else product_month_stats(items)
    w = Window.partitionBy("product_id").orderBy(_a("month"))
    prev = F.lag("abandoned_carts").over(w)
    ranked = stats.select("product_id", "month", "abandoned_carts", prev.alias("previous_month_carts"))
    inc = F.col("abandoned_carts") - F.col("previous_month_carts")
    pct = F.round(F.try_divide(F.lit(Decimal("100.0")) * inc, F.col("previous_month_carts")), 2)
    return (
        ranked.where(F.col("previous_month_carts").isNotNull() & (F.col("abandoned_carts") > F.col("previous_month_carts")))
        .select(
            "product_id", "month", "previous_month_carts", "abandoned_carts",
            inc.alias("cart_increase"), pct.cast("decimal(38,2)").alias("pct_increase"),
        )
        .orderBy(_d("cart_increase"), _d("pct_increase"), _a("product_id"), _a("month"))
        .limit(n)
    )


# R4
def first_month(items: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Each product's first month with its carts, items and revenue in that month.

    Taken from the (product, month) aggregate with ``min(struct(month, ...))``
    per product — no join back to the entries.
    """
    stats = stats if stats is not None else product_month_stats(items)
    first = (
        stats.where(F.col("product_id").isNotNull() & F.col("month").isNotNull())
        .groupBy("product_id")
        .agg(F.min(F.struct("month", "abandoned_carts", "abandoned_items", "unrealized_revenue")).alias("_f"))
    )
    return first.select(
        "product_id",
        F.col("_f.month").alias("launch_month"),
        F.col("_f.abandoned_carts").alias("first_month_abandoned_carts"),
        F.col("_f.abandoned_items").alias("first_month_abandoned_items"),
        F.col("_f.unrealized_revenue").alias("first_month_unrealized_revenue"),
    ).orderBy(_a("launch_month"), _d("first_month_abandoned_carts"), _a("product_id"))


def _cart_rollup(enriched: DataFrame, by) -> DataFrame:
    # cart_enriched holds exactly one row per cart_id (key de-duplicated), so
    # count(cart_id) equals count(distinct cart_id) and stays a plain partial
    # aggregate instead of shuffling every cart id.
    return enriched.groupBy(by).agg(
        F.count("cart_id").alias("abandoned_carts"),
        F.sum("item_quantity_sum").alias("abandoned_items"),
        F.sum("cart_total_price").alias("unrealized_revenue"),
    )


# R5
def by_state(enriched: DataFrame) -> DataFrame:
    return _cart_rollup(enriched, F.coalesce(F.col("state"), F.lit("SEM_UF")).alias("state")).orderBy(
        _d("abandoned_carts"), _d("unrealized_revenue"), _a("state")
    )


# R7
def daily(enriched: DataFrame) -> DataFrame:
    return _cart_rollup(enriched, F.col("cart_date")).orderBy(_a("cart_date"))


ROLLUP_NEED = ("cart_id", "cart_date", "state", "cart_total_price", "item_quantity_sum")


# R8
TOP_CART_COLUMNS = (
    "cart_id", "created_ts", "cart_total_price", "user_uid", "payment_mode_code", "installments",
    "site_name", "postal_code", "item_quantity_sum", "item_count",
)
TOP_ITEM_COLUMNS = ("product_id", "quantity", "total_price", "entry_number")


def top_cart_set(prepared: Mapping[str, DataFrame], items: DataFrame, n: int = 50) -> tuple[DataFrame, DataFrame]:
    """(heads, entries) of the n most expensive carts: the enriched carts, and all their entries.

    The ranking needs only the cart's own price and key, so it is a distributed top-n of the prepared
    carts, before any lookup. It stays lazy for every n; what is small enough at run time is
    broadcast by the planner's own size checks.
    """
    price = F.coalesce(F.col("p_totalprice"), F.lit(0).cast("decimal(18,4)"))
    top = prepared["tb_carts"].orderBy(price.desc_nulls_last(), F.col("pk").asc()).limit(n)
    entries = items.join(top.select(F.col("pk").alias("cart_id")), "cart_id", "left_semi")
    return cart_enriched(prepared, entries, need=TOP_CART_COLUMNS, carts=top), entries


def top_cart_heads(prepared: Mapping[str, DataFrame], items: DataFrame, n: int = 50) -> DataFrame:
    return top_cart_set(prepared, items, n)[0]


def top_carts(prepared: Mapping[str, DataFrame], items: DataFrame, n: int = 50) -> DataFrame:
    heads, entries = top_cart_set(prepared, items, n)
    its = entries.select("cart_id", "entry_id", *TOP_ITEM_COLUMNS)
    return (
        heads.join(its, "cart_id", "left")
        .orderBy(_d("cart_total_price"), _a("cart_id"), _a("entry_number"), _a("product_id"), _a("entry_id"))
        .select(*TOP_CART_COLUMNS, *TOP_ITEM_COLUMNS)
    )
