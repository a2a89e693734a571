"""Master/detail text lines for the top carts (no driver-side loop).

One line per cart (10 fields) followed by one line per entry with a product
(``product|quantity|price|`` with an empty last field). The lines are built as
two DataFrames and ordered by (cart price, cart, kind, entry_number, product_id,
entry_id); writing the sorted frame keeps that order across part files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import export_line
from .reports import TOP_CART_COLUMNS, top_cart_set


def top_cart_lines(prepared: Mapping[str, DataFrame], items: DataFrame, n: int = 50) -> DataFrame:
    """(cart_total_price, cart_id, line_kind, entry_number, product_id, entry_id, line): the lines with
    what they are ordered by."""
    heads, entries = top_cart_set(prepared, items, n)
    htypes = {f.name: f.dataType for f in heads.schema.fields}
    head_lines = heads.select(
        "cart_total_price",
        "cart_id",
        F.lit(0).alias("line_kind"),
        F.lit(None).cast("int").alias("entry_number"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.lit(None).cast("bigint").alias("entry_id"),
        export_line([(F.col(c), htypes[c]) for c in TOP_CART_COLUMNS]).alias("line"),
    )
    its = entries.where(F.col("product_id").isNotNull()).join(heads.select("cart_id", "cart_total_price"), "cart_id")
    itypes = {f.name: f.dataType for f in its.schema.fields}
    item_lines = its.select(
        "cart_total_price",
        "cart_id",
        F.lit(1).alias("line_kind"),
        "entry_number",
        "product_id",
        "entry_id",
        export_line(
            [(F.col("product_id"), itypes["product_id"]), (F.col("quantity"), itypes["quantity"]),
             (F.col("total_price"), itypes["total_price"]), (F.lit(""), T.StringType())]
        ).alias("line"),
    )
    return head_lines.unionByName(item_lines)


def ordered_lines(lines: DataFrame) -> DataFrame:
    rest = ("cart_id", "line_kind", "entry_number", "product_id", "entry_id")
    return lines.orderBy(F.col("cart_total_price").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest])
