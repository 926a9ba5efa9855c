"""The flagship read: repair and score the game logs, average each player's last five DraftKings
scores, report the ten best.

Plan shape: row-wise repair + scoring (no shuffle), ``row_number() <= 5`` per player, which Spark
turns into a WindowGroupLimit that also runs map-side before the exchange (each task keeps at most
five rows per player, so a player with a huge history does not reach one task whole), a grouped
average, then TakeOrderedAndProject for the top ten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.operators.etl import fix_invalid, score_platform


def last_n_average(logs: DataFrame, n: int = 5, value: str = "dfs_points_dk") -> DataFrame:
    """WN-LN in set form: per player, mean of ``value`` (NULL as 0) over the newest ``n`` games;
    only players with at least ``n`` games."""
    w = Window.partitionBy("player_id").orderBy(F.col("game_date").desc(), F.col("game_id").desc())
    newest = logs.select("player_id", value, F.row_number().over(w).alias("_rn")).where(F.col("_rn") <= n)
    return (newest.groupBy("player_id")
            .agg(F.avg(F.coalesce(F.col(value), F.lit(0.0))).alias("avg"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= n).drop("n"))


def top_recent_scorers(logs: DataFrame, n: int = 5, k: int = 10) -> DataFrame:
    scored = score_platform(fix_invalid(logs), "DraftKings")
    avg = last_n_average(scored, n).select("player_id", F.round("avg", 6).alias(f"avg_dfs_points_l{n}"))
    return avg.orderBy(F.col(f"avg_dfs_points_l{n}").desc(), "player_id").limit(k)
