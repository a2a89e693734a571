"""Analytic views: cart_items, cart_item_summary, cart_enriched."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


NULL_SPREAD = 1024
MAX_LOOKUP_ROWS = 100_000  # of a table that is broadcast: about 15 MB in the driver and in each executor
ENRICHED_COLUMNS = (
    "cart_id", "created_ts", "cart_date", "month", "cart_total_price", "user_uid", "payment_mode_code",
    "installments", "site_name", "postal_code", "state", "item_quantity_sum", "item_count",
)


def cart_items(entries: DataFrame) -> DataFrame:
    """One row per entry with a cart reference. ``month`` is the entry's month."""
    return entries.where("p_order is not null").selectExpr(
        "p_order as cart_id",
        "pk as entry_id",
        "p_product as product_id",
        "coalesce(p_quantity, cast(0 as decimal(18,4))) as quantity",
        "coalesce(p_totalprice, cast(0 as decimal(18,4))) as total_price",
        "p_entrynumber as entry_number",
        "createdts as entry_created_ts",
        "trunc(to_date(createdts), 'month') as month",
    )


def cart_item_summary(items: DataFrame) -> DataFrame:
    return items.groupBy("cart_id").agg(
        F.sum("quantity").alias("item_quantity_sum"), F.count("entry_id").alias("item_count")
    )


class CountedTables(dict):
    """Prepared tables by name, with the number of rows of those that are looked up in (``rows``)."""

    def __init__(self, tables: Mapping[str, DataFrame], rows: Mapping[str, int]):
        super().__init__(tables)
        self.rows = dict(rows)


def _sized(table: DataFrame, n: int | None) -> DataFrame:
    """A lookup table that is broadcast by its ``n`` rows, or not at all. The planner goes by bytes of compressed files and shuffles, and 10 MB of
    those may take hundreds in the driver, which builds what it broadcasts. Where ``n`` is not known that is left to the planner."""
    return table if n is None else F.broadcast(table) if n <= MAX_LOOKUP_ROWS else table.hint("merge")


def _lookup(rows: DataFrame, table: DataFrame, fk: str, row_key: str, n: int | None = None) -> DataFrame:
    """Left join on a foreign key that may be NULL in many rows. Those match nothing; a second key, 0 where there is a foreign
    key, deals them over ``NULL_SPREAD`` values by their row's own key, so that they do not meet in one partition."""
    own = F.when(F.col(fk).isNull(), F.pmod(F.xxhash64(row_key), F.lit(NULL_SPREAD)) + 1).otherwise(0).cast("int")
    there = F.pmod(F.xxhash64(fk), F.lit(1)).cast("int")  # 0; a constant would be taken out of the join's keys
    return rows.withColumn("_spread", own).join(_sized(table.withColumn("_spread", there), n), [fk, "_spread"], "left").drop("_spread")


def cart_enriched(
    prepared: Mapping[str, DataFrame],
    items: DataFrame | None = None,
    need: Iterable[str] | None = None,
    carts: DataFrame | None = None,
) -> DataFrame:
    """One row per cart with its lookups and item summary.

    ``need`` names the output columns wanted; only the left joins that supply them are planned. (From
    sources that were just de-duplicated Catalyst drops unused left joins itself, since it knows their keys to be
    unique; from staged files it cannot know.) ``carts`` may be a subset of the prepared carts. With ``CountedTables`` lookups are
    broadcast by their number of rows.
    """
    need = set(ENRICHED_COLUMNS if need is None else need) | {"cart_id"}
    counted = getattr(prepared, "rows", {})
    c = carts if carts is not None else prepared["tb_carts"]
    base = c.selectExpr(
        "pk as cart_id",
        "createdts as created_ts",
        "to_date(createdts) as cart_date",
        "trunc(to_date(createdts), 'month') as month",
        "coalesce(p_totalprice, cast(0 as decimal(18,4))) as cart_total_price",
        "p_user", "p_paymentmode", "p_paymentinfo", "p_site", "p_paymentaddress",
    )
    out = base

    if need & {"item_quantity_sum", "item_count"}:
        out = out.join(cart_item_summary(items), "cart_id", "left")
    # Lookups join on the cart's foreign-key name (USING join): no key columns to drop.
    lookups = [
        ("user_uid", "tb_users", "pk", "p_user", "p_uid"),
        ("payment_mode_code", "tb_paymentmodes", "pk", "p_paymentmode", "p_code"),
        ("installments", "tb_paymentinfos", "pk", "p_paymentinfo", "p_installments"),
        ("site_name", "tb_cmssitelp", "itempk", "p_site", "p_name"),
    ]
    for col_name, table, key, fk, val in lookups:
        if col_name in need:
            out = _lookup(out, prepared[table].selectExpr(f"{key} as {fk}", f"{val} as {col_name}"), fk, "cart_id", counted.get(table))
    if need & {"postal_code", "state"}:
        a = prepared["tb_addresses"].selectExpr(
            "pk as p_paymentaddress", "nullif(p_postalcode, 'nan') as postal_code", "p_region"
        )
        if "state" in need:
            r = prepared["tb_regions"].selectExpr("pk as p_region", "p_isocodeshort as state")
            a = _lookup(a, r, "p_region", "p_paymentaddress", counted.get("tb_regions"))
        out = _lookup(out, a, "p_paymentaddress", "cart_id", counted.get("tb_addresses"))
    exprs = {
        "item_quantity_sum": "coalesce(item_quantity_sum, cast(0 as decimal(28,4))) as item_quantity_sum",
        "item_count": "coalesce(item_count, cast(0 as bigint)) as item_count",
    }
    return out.selectExpr(*[exprs.get(c, c) for c in ENRICHED_COLUMNS if c in need])
