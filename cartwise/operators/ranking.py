"""League points (union of home and away results) and the top-k-sum threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _points(own: str, other: str):
    return F.when(F.col(own) > F.col(other), 3).when(F.col(own) == F.col(other), 1).otherwise(0)


def league_points(
    teams: DataFrame,
    matches: DataFrame,
    team_id: str = "time_id",
    team_name: str = "time_nome",
    home: str = "mandante_time",
    away: str = "visitante_time",
    home_goals: str = "mandante_gols",
    away_goals: str = "visitante_gols",
) -> DataFrame:
    """3 points a win, 1 a draw, 0 a loss; NULL goals score 0 for both sides.

    Each match is read once and exploded into its home and away rows (no second
    scan for the ``union all``); points are pre-aggregated per team before the
    join with the teams table, so the join input is one row per team.
    """
    sides = F.explode(
        F.array(
            F.struct(F.col(home).alias("_t"), _points(home_goals, away_goals).alias("_p")),
            F.struct(F.col(away).alias("_t"), _points(away_goals, home_goals).alias("_p")),
        )
    )
    per_team = (
        matches.select(sides.alias("_s"))
        .select(F.col("_s._t").alias(team_id), F.col("_s._p").alias("_p"))
        .groupBy(team_id)
        .agg(F.sum("_p").alias("_pts"))
    )
    return (
        teams.select(team_id, team_name)
        .join(per_team, team_id, "left")
        .groupBy(team_id, team_name)
        .agg(F.coalesce(F.sum("_pts"), F.lit(0)).cast("bigint").alias("num_pontos"))
        .orderBy(F.col("num_pontos").desc(), F.col(team_id).asc_nulls_last())
    )


def topk_sum_at_least(
    df: DataFrame, group: str = "vendedor", value: str = "valor", k: int = 3, threshold=1024
) -> DataFrame:
    """Groups whose ``k`` largest values (NULLs last) sum to at least ``threshold``.

    The ``row_number() <= k`` filter is planned as a WindowGroupLimit, which
    keeps at most ``k`` rows per group on the map side before the shuffle, so a
    group holding most of the rows does not reach one task whole.
    """
    w = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
    return (
        df.select(group, value)
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= k)
        .groupBy(group)
        .agg(F.sum(value).alias("_sum"))
        .where(F.col("_sum") >= F.lit(threshold))
        .select(group)
        .orderBy(F.col(group).asc_nulls_last())
    )
