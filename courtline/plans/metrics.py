"""Advanced box-score metrics over a group of logs (FT-METRIC) and decayed moving averages with an
adaptive window (FT-EMA), in set form: one row per group / player.

Both are written against the real log columns (offensive / defensive rebounds, minutes, DraftKings
points as the fantasy score). Group totals are mergeable aggregates (partial aggregation before the
shuffle). FT-EMA needs order: positions come from ``positions_from_end`` (no whole-player window);
only the newest 15 or 25 logs of a player are gathered into one array, so that array is bounded.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.session import cut_lineage

from courtline.functions.exprs import array_slope
from courtline.operators.frames import positions_from_end, season_chunk

METRIC_SUMS = (("fga", "field_goals_attempted"), ("fgm", "field_goals_made"), ("fta", "free_throws_attempted"),
               ("ftm", "free_throws_made"), ("fg3a", "three_pointers_attempted"), ("fg3m", "three_pointers_made"),
               ("orb", "rebounds_offensive"), ("drb", "rebounds_defensive"), ("ast", "assists"), ("stl", "steals"),
               ("blk", "blocks"), ("tov", "turnovers"), ("pf", "personal_fouls"), ("mins", "minutes"))
METRIC_NAMES = ("true_shooting_pct", "usage_rate", "per", "efg_pct", "ast_tov_ratio", "steal_pct", "block_pct")


def metrics_from_totals(t: dict, team_pace: Column | None = None, team_poss: Column | None = None) -> dict:
    """The seven metrics from group totals (``t`` maps names to Columns: pts mean, sums, games)."""
    total_pts = t["pts"] * t["games"]
    tsa = 2 * (t["fga"] + 0.44 * t["fta"])
    mins = t["mins"]
    out = {"true_shooting_pct": F.when(tsa > 0, total_pts / tsa).otherwise(F.lit(0.0))}
    simple = F.when(mins > 0, 100 * (t["fga"] + 0.44 * t["fta"] + t["tov"]) / mins).otherwise(F.lit(0.0))
    if team_pace is not None:
        poss = t["fga"] + 0.44 * t["fta"] + t["tov"]
        ctx = (F.when((mins > 0) & (team_poss > 0), 100 * (poss * team_pace * 5) / (mins * team_poss))
               .otherwise(F.lit(0.0)))
        out["usage_rate"] = F.when(team_pace.isNotNull() & team_poss.isNotNull(), ctx).otherwise(simple)
    else:
        out["usage_rate"] = simple
    raw = (total_pts / mins + (t["orb"] + t["drb"]) / mins + t["ast"] / mins + t["stl"] / mins + t["blk"] / mins
           - t["tov"] / mins - t["pf"] / mins - (t["fga"] / mins - t["fgm"] / mins) - (t["fta"] / mins - t["ftm"] / mins))
    out["per"] = F.when(mins > 0, F.greatest(F.lit(0.0), raw * 15)).otherwise(F.lit(0.0))
    out["efg_pct"] = F.when(t["fga"] > 0, (t["fgm"] + 0.5 * t["fg3m"]) / t["fga"]).otherwise(F.lit(0.0))
    out["ast_tov_ratio"] = (F.when(t["tov"] > 0, t["ast"] / t["tov"])
                            .otherwise(F.when(t["ast"] > 0, t["ast"].cast("double")).otherwise(F.lit(0.0))))
    out["steal_pct"] = F.when(mins > 0, t["stl"] / mins * 48).otherwise(F.lit(0.0))
    out["block_pct"] = F.when(mins > 0, t["blk"] / mins * 48).otherwise(F.lit(0.0))
    return out


def advanced_metrics(logs: DataFrame, keys: Sequence[str] = ("player_id",),
                     team_stats: DataFrame | None = None) -> DataFrame:
    """FT-METRIC: per group, sums skip NULLs, total points = mean of non-NULL points x number of logs;
    usage with team context when ``team_stats`` (keys + team_pace, team_possessions) is given."""
    aggs = [F.avg("points").alias("pts"), F.count(F.lit(1)).alias("games")]
    aggs += [F.coalesce(F.sum(src), F.lit(0)).cast("double").alias(k) for k, src in METRIC_SUMS]
    g = logs.groupBy(*keys).agg(*aggs)
    pace = poss = None
    if team_stats is not None:
        g = g.join(team_stats.select(*keys, "team_pace", "team_possessions"), list(keys), "left")
        pace, poss = F.col("team_pace"), F.col("team_possessions")
    t = {k: F.col(k) for k in ["pts", "games"] + [k for k, _ in METRIC_SUMS]}
    m = metrics_from_totals(t, pace, poss)
    return g.select(*keys, *[m[n].alias(n) for n in METRIC_NAMES])


# ---------------------------------------------------------------------------------------------
# decayed moving averages

# stat name in the output -> log column
EMA_STATS = (("fantasy_points", "dfs_points_dk"), ("points", "points"), ("rebounds", "rebounds_total"),
             ("assists", "assists"), ("steals", "steals"), ("blocks", "blocks"), ("turnovers", "turnovers"),
             ("field_goals_made", "field_goals_made"), ("field_goals_attempted", "field_goals_attempted"),
             ("three_pointers_made", "three_pointers_made"), ("three_pointers_attempted", "three_pointers_attempted"),
             ("free_throws_made", "free_throws_made"), ("free_throws_attempted", "free_throws_attempted"),
             ("minutes_played", "minutes"))
EMA_COLUMNS = ([f"{s}_{k}" for s, _ in EMA_STATS for k in ("ema", "sma", "trend")]
               + [f"{m}_recent" for m in METRIC_NAMES]
               + ["fantasy_points_volatility", "fantasy_points_cv", "consistency_rating", "momentum_ratio"])


def _arr_sum(arr: Column, f) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.coalesce(f(x).cast("double"), F.lit(0.0)))


def moving_averages_with_decay(logs: DataFrame, alpha: float = 0.2, key: str = "player_id") -> DataFrame:
    """FT-EMA per player over the given logs (newest first, ties by game id): needs 5 non-NULL fantasy
    scores; cv = population std / mean of all of them (1.0 if the mean <= 0); the newest 15 (cv <
    0.25) or 25 logs form the window; per stat over its non-NULL values there: EMA with weights
    alpha (1 - alpha)^i (i counts every log, NULL ones too), simple mean, slope over compacted
    newest-first positions (0 with fewer than 3 values; positive = falling); the seven metrics over
    the window (with at least 3 logs); volatility, cv, consistency = 1 / (1 + cv); momentum = mean of
    the newest 3 scores / mean of the next 3 (1.0 if that is <= 0; needs 6)."""
    cols = sorted({src for _, src in EMA_STATS} | {src for _, src in METRIC_SUMS} | {"points"})
    # four branches read the same projected logs: materialise them once (shared checkpoint folder)
    base = cut_lineage(logs.select(key, "game_date", "game_id", *cols))
    fp = F.col("dfs_points_dk")
    stats = base.groupBy(key).agg(F.count(fp).alias("n_fp"), F.avg(fp).alias("m_fp"),
                                  F.stddev_pop(fp).alias("sd_fp"), F.count(F.lit(1)).alias("n_logs"))
    cv = F.when(F.col("m_fp") > 0, F.col("sd_fp") / F.col("m_fp")).otherwise(F.lit(1.0))
    stats = (stats.where(F.col("n_fp") >= 5).withColumn("cv", cv)
             .withColumn("ws", F.when(F.col("cv") < 0.25, F.least(F.lit(15), F.col("n_logs")))
                         .otherwise(F.least(F.lit(25), F.col("n_logs")))))
    # one pass gives both positions, among all logs and among those with a score; what any window can need is staged
    pos = positions_from_end(base, [key], ["game_date", "game_id"], season_chunk("game_date"), alias="pos", also=("cpos", fp.isNotNull()))
    pos = cut_lineage(pos.where((F.col("pos") < 25) | (fp.isNotNull() & (F.col("cpos") < 6))))
    recent = pos.join(stats.select(key, "ws"), key).where(F.col("pos") < F.col("ws"))
    arr = (recent.groupBy(key)
           .agg(F.sort_array(F.collect_list(F.struct("pos", *cols))).alias("w")))
    out = {}
    a1 = F.lit(float(alpha))
    decay = 1 - alpha
    for name, src in EMA_STATS:
        vals = F.filter("w", lambda x: x[src].isNotNull())
        n = F.size(vals)
        sw = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + a1 * F.pow(F.lit(decay), x["pos"]))
        svw = F.aggregate(vals, F.lit(0.0),
                          lambda acc, x: acc + x[src].cast("double") * (a1 * F.pow(F.lit(decay), x["pos"])))
        plain = F.transform(vals, lambda x: x[src].cast("double"))
        out[f"{name}_ema"] = F.when(n > 0, F.when(sw > 0, svw / sw).otherwise(F.lit(0.0)))
        out[f"{name}_sma"] = F.when(n > 0, _arr_sum(plain, lambda x: x) / n)
        out[f"{name}_trend"] = F.when(n >= 3, array_slope(plain)).when(n > 0, F.lit(0.0))
    # metrics over the window (sums skip NULLs; mean points over non-NULL points)
    w_n = F.size("w")
    pts_vals = F.filter("w", lambda x: x["points"].isNotNull())
    t = {"pts": _arr_sum(pts_vals, lambda x: x["points"]) / F.size(pts_vals), "games": w_n.cast("double")}
    for k, src in METRIC_SUMS:
        t[k] = _arr_sum(F.col("w"), lambda x, s=src: x[s])
    for mname, expr in metrics_from_totals(t).items():
        out[f"{mname}_recent"] = F.when(w_n >= 3, expr)
    g = arr.select(key, *[v.alias(k) for k, v in out.items()])
    # momentum: newest six non-NULL scores over all logs
    mom = (pos.where(fp.isNotNull() & (F.col("cpos") < 6)).groupBy(key)
           .agg(F.avg(F.when(F.col("cpos") < 3, fp)).alias("r3"), F.avg(F.when(F.col("cpos") >= 3, fp)).alias("p3"),
                F.count(F.lit(1)).alias("n6")))
    res = (stats.join(g, key).join(mom, key, "left")
           .withColumns({"fantasy_points_volatility": F.col("sd_fp"), "fantasy_points_cv": F.col("cv"),
                         "consistency_rating": 1 / (1 + F.col("cv")),
                         "momentum_ratio": F.when(F.col("n6") >= 6, F.when(F.col("p3") > 0, F.col("r3") / F.col("p3"))
                                                  .otherwise(F.lit(1.0)))}))
    return res.select(key, *EMA_COLUMNS)
