"""Nearest qualifying ancestor in a parent-pointer tree (binary lifting).

For every node ``e`` find the closest ancestor ``a`` (parent, grand-parent,
...) with ``value(a) >= factor * value(e)``; NULL when there is none.

Instead of materialising the whole ancestor closure (one row per node and
ancestor, as a recursive CTE does) the operator builds jump tables:

    level k:  node -> (ancestor at distance 2^k, max value over distances 1..2^k)

Each level is one self-join of the previous level, so a tree of depth D needs
``ceil(log2 D)`` levels. Each node then climbs greedily from the highest level
down, jumping 2^k whenever none of the next 2^k ancestors qualifies; after the
last level the parent of the current position is the answer if it qualifies.
Work is O(N log D) rows in O(log D) joins, every one a distributed equi-join
(a popular ancestor is a skewed key on the streamed side; AQE splits it).

Every level is written to the reliable checkpoint directory
(``spark.checkpoint.dir``): each is read by the next level, by the emptiness
check and by the climb, and a lost executor then only costs the current level.
The climb itself is one plan of ``ceil(log2 D)`` joins against those files.
A cycle, or a chain longer than ``max_depth``, raises instead of looping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import checkpoint_dir


class HierarchyTooDeep(RuntimeError):
    pass


def _level(df: DataFrame, reliable: bool) -> tuple[DataFrame, bool]:
    """Materialise a jump level; also report whether any node still has an ancestor.

    With checkpointing the count is observed during the checkpoint write itself
    (no second pass over the level).
    """
    if reliable:
        obs = Observation("jump_level")
        lvl = df.observe(obs, F.count("up").alias("n")).checkpoint(eager=True)
        return lvl, obs.get["n"] > 0
    return df, df.where(F.col("up").isNotNull()).limit(1).count() > 0


def nearest_ancestor(
    df: DataFrame,
    node: str = "id",
    parent: str = "lider_id",
    value: str = "salario",
    factor=2,
    max_depth: int = 1 << 20,
    out: str = "lider_id",
    reliable: bool = True,
) -> DataFrame:
    spark = df.sparkSession
    if reliable:
        checkpoint_dir(spark)
    nodes = df.select(F.col(node).alias("_id"), F.col(parent).alias("_par"), F.col(value).alias("_v"))
    ref = nodes.select(F.col("_id").alias("_pid"), F.col("_v").alias("_pv"))
    lvl, more = _level(
        nodes.join(ref, F.col("_par") == F.col("_pid"), "left").select(
            F.col("_id").alias("node"), F.col("_pid").alias("up"), F.col("_pv").alias("mx")
        ),
        reliable,
    )
    levels = [lvl]
    span = 1
    while more:
        if span >= max_depth:
            raise HierarchyTooDeep(f"ancestor chain longer than max_depth={max_depth} (cycle?)")
        nxt = lvl.alias("a").join(lvl.alias("b"), F.col("a.up") == F.col("b.node"), "left").select(
            F.col("a.node").alias("node"),
            F.col("b.up").alias("up"),
            F.greatest(F.col("a.mx"), F.col("b.mx")).alias("mx"),
        )
        lvl, more = _level(nxt, reliable)
        levels.append(lvl)
        span *= 2
    # levels[-1] has no ancestors at all; chains are shorter than 2^(len(levels)-1).
    state = nodes.select(
        F.col("_id").alias("e"), (F.lit(factor) * F.col("_v")).alias("t"), F.col("_id").alias("cur")
    )
    for lv in reversed(levels[:-1]):
        joined = state.join(lv, state["cur"] == lv["node"], "left")
        fails = ~F.coalesce(F.col("mx") >= F.col("t"), F.lit(False))
        state = joined.select(
            "e", "t", F.when(F.col("up").isNotNull() & fails, F.col("up")).otherwise(F.col("cur")).alias("cur")
        )
    first = levels[0]
    res = state.join(first, state["cur"] == first["node"], "left").select(
        F.col("e").alias(node), F.when(F.col("mx") >= F.col("t"), F.col("up")).alias(out)
    )
    return res.orderBy(F.col(node).asc_nulls_last())

