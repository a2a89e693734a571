"""Top co-occurring product pairs (number of baskets holding both products).

One exact plan for all inputs:

- ``bp``: distinct (basket, product) with a non-null product (partial aggregate, so repeated
  lines of a hot basket collapse map-side).
- Support bound: ``T`` is a lower bound for the n-th best pair count, taken from the exact pair counts
  of the ``m`` best-supported products: any ``n`` exact counts bound the n-th best from below. A pair's
  count never exceeds either product's support, so a pair with a product below ``T`` is out of the
  top n, and every pair of two kept products is counted over all baskets. ``T`` reaches the plan as a
  scalar subquery.
- Lists: the kept products of a basket are collected to one sorted list, with one shuffle by basket, and its
  pairs are read off the list; pair rows are never joined. A basket of over ``BLOCK`` products (there are at most
  rows / ``BLOCK`` such baskets, which are counted first) is cut into k = ceil(size / block) lists by a hash of the product.
  Each list's own pairs are read off as before, and lists of one basket meet two by two on (basket, i, j): each list goes
  to the k - 1 keys that it takes part in, so a basket of 100,000 products is 200 lists and 19,900 keys of at most
  about block² pairs each, spread over tasks.

``bp`` is read by several branches, so it is written once to the checkpoint folder;
``materialize=False`` skips that where ``items`` is cheap to read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

BLOCK = 500
MAX_BROADCAST = 1_000_000  # large baskets, 12 bytes each


def basket_products(items: DataFrame, basket: str = "cart_id", product: str = "product_id") -> DataFrame:
    return items.where(F.col(product).isNotNull()).select(basket, product).distinct()


def _counted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("abandoned_carts"))


def _own_pairs(lists: DataFrame) -> DataFrame:
    """The pairs within each sorted list ``_ps``."""
    first = lists.select("_ps", F.posexplode("_ps").alias("_at", "product_a"))
    return first.select("product_a", F.explode(F.slice("_ps", F.col("_at") + 2, F.size("_ps"))).alias("product_b"))


def _cross_pairs(lists: DataFrame) -> DataFrame:
    """The pairs between different lists (``_i`` of ``_k``) of one basket."""
    every = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda j: F.struct(F.least("_i", j).alias("i"), F.greatest("_i", j).alias("j")))
    keyed = lists.select("_basket", F.col("_i").alias("_own"), "_ps", F.explode(every).alias("_key")).where("_key.i <> _key.j")
    keyed = keyed.select("_basket", F.col("_key.i").alias("_i"), F.col("_key.j").alias("_j"), "_own", "_ps")
    a = keyed.where("_own = _i").select("_basket", "_i", "_j", F.col("_ps").alias("_pa"))
    b = keyed.where("_own = _j").select("_basket", "_i", "_j", F.col("_ps").alias("_pb"))
    both = a.join(b, ["_basket", "_i", "_j"]).select("_pb", F.explode("_pa").alias("_a")).select("_a", F.explode("_pb").alias("_b"))
    return both.select(F.least("_a", "_b").alias("product_a"), F.greatest("_a", "_b").alias("product_b"))


def _pair_counts(bp: DataFrame, basket: str, product: str, large: DataFrame | None) -> DataFrame:
    """Pair counts where ``large`` (_basket, _k) are the baskets of several lists, if any."""
    rows = bp.select(F.col(basket).alias("_basket"), F.col(product).alias("_p"))
    collected = F.array_sort(F.collect_list("_p")).alias("_ps")
    if large is None:
        return _counted(_own_pairs(rows.groupBy("_basket").agg(collected)))
    cut = rows.join(large, "_basket", "left").select("_basket", "_p", F.coalesce("_k", F.lit(1)).alias("_k"))
    lists = cut.groupBy("_basket", "_k", F.pmod(F.hash("_p"), F.col("_k")).alias("_i")).agg(collected)
    return _counted(_own_pairs(lists).unionByName(_cross_pairs(lists.where("_k > 1"))))


def large_baskets(bp: DataFrame, basket: str = "cart_id", block: int = BLOCK) -> DataFrame | None:
    """(_basket, _k) of the baskets of over ``block`` products, with their numbers of lists; None if there are none."""
    sizes = bp.groupBy(F.col(basket).alias("_basket")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_k")).where("_k > 1")
    checkpoint_dir(bp.sparkSession)
    sizes = sizes.checkpoint(eager=True)
    n = sizes.limit(MAX_BROADCAST + 1).count()
    return None if n == 0 else F.broadcast(sizes) if n <= MAX_BROADCAST else sizes


def pair_counts(bp: DataFrame, basket: str = "cart_id", product: str = "product_id", block: int = BLOCK) -> DataFrame:
    """(product_a, product_b, abandoned_carts) with product_a < product_b, for distinct (basket, product) rows."""
    return _pair_counts(bp, basket, product, large_baskets(bp, basket, block))


def _rank() -> list:
    return [F.col("abandoned_carts").desc(), F.col("product_a").asc_nulls_last(), F.col("product_b").asc_nulls_last()]


def top_pairs(
    items: DataFrame,
    n: int = 50,
    basket: str = "cart_id",
    product: str = "product_id",
    probe_products: int | None = None,
    materialize: bool = True,
    block: int = BLOCK,
    distinct: bool = False,
) -> DataFrame:
    """``distinct``: ``items`` has one row for each basket and product already."""
    bp = items.where(F.col(product).isNotNull()).select(basket, product) if distinct else basket_products(items, basket, product)
    if materialize:
        checkpoint_dir(bp.sparkSession)
        bp = bp.checkpoint(eager=True)
    support = bp.groupBy(product).agg(F.count(F.lit(1)).alias("_s"))
    m = probe_products or max(4 * n, 200)
    head = support.orderBy(F.col("_s").desc(), F.col(product).asc_nulls_last()).limit(m).select(product)
    probe = _pair_counts(bp.join(F.broadcast(head), product, "left_semi"), basket, product, None)  # lists of m products at most
    best = probe.orderBy(*_rank()).limit(n)
    bound = best.agg(
        F.when(F.count(F.lit(1)) == n, F.min("abandoned_carts")).otherwise(F.lit(1)).alias("t")
    ).scalar()
    kept = support.where(F.col("_s") >= bound).select(product)
    counts = _pair_counts(bp.join(kept, product, "left_semi"), basket, product, large_baskets(bp, basket, block))
    return counts.orderBy(*_rank()).limit(n)
