"""Point-in-time player features for every (active player, target date) in a date range - one plan,
no loop over dates or players, no cross join.

How it is planned
-----------------
1. *States.* Every game log row gets the features of "the history ending with this game": bounded
   frames (last 5/10/15/20/30/50 games) over ``Window.partitionBy(player, season-chunk)``. Each
   season chunk carries the 49 rows before it as a halo (``chunk_with_halo``), so the frames are
   exact while one player's history is spread over one task per season.
2. *Spine by explosion.* A state is the history for every target date t with
   ``game_date < t <= next game_date`` (strictly-before semantics; tied dates give empty
   intervals, so the last game of a day wins). Exploding each state over its interval clipped to
   [start, end] yields exactly the (player, t) rows that have history - linear in the output, where
   a players x dates cross join followed by a history join would be quadratic.
3. *Side features* - injuries in [t-30, t) as parts of the states' intervals, opponent and salary
   histories (as-of joins) of the few days that have them - are found on narrow rows, placed on the
   state that holds on their day, and collected into one row a player and season.
4. *Wide states don't move.* They are partitioned by player and season since their windows; that row meets them
   there, without an exchange or sort of wide rows, and days are written out last. Of the spine's states only
   the dates are computed and staged, from a few columns of the logs; a reader of a few features has only those computed.

Semantics are those of the reference (history = newest 50 games strictly before t, at least 5;
NULL stats count as 0 in means; a feature is NULL where the reference leaves the key out).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import cut_lineage

from courtline.functions.exprs import (array_mean, array_slope, coalesce0, safe_div,
                                       season_start, truthy)
from courtline.operators.frames import (active_counts, asof_join, chunk_with_halo, explode_intervals, season_chunk,
                                        split_intervals)

ROLL_WINDOWS = (5, 10, 15, 30)
HISTORY = 50
MIN_GAMES = 5
ORDER = ("game_date", "game_id")

# feature names per rolling window (the 17 per window)
ROLL_AVG = (("points", "points"), ("rebounds", "rebounds_total"), ("assists", "assists"), ("steals", "steals"),
            ("blocks", "blocks"), ("turnovers", "turnovers"), ("minutes", "minutes"),
            ("dfs_points", "dfs_points_dk"), ("usage_rate", "usage_rate"),
            ("true_shooting", "true_shooting_percentage"))
ROLL_PCT = (("fg", "field_goals_made", "field_goals_attempted"),
            ("3p", "three_pointers_made", "three_pointers_attempted"),
            ("ft", "free_throws_made", "free_throws_attempted"))
ROLL_STD = (("points", "points"), ("dfs_points", "dfs_points_dk"), ("minutes", "minutes"))


def rolling_names(n: int) -> list[str]:
    return ([f"avg_{a}_L{n}" for a, _ in ROLL_AVG] + [f"avg_{p}_pct_L{n}" for p, _, _ in ROLL_PCT]
            + [f"std_{a}_L{n}" for a, _ in ROLL_STD] + [f"games_played_L{n}"])


KEY_COLS = ["player_id", "target_date"]
INFO_COLS = ["position", "team_id", "is_active"]
RECENT_COLS = ["last_game_points", "last_game_dfs_points", "last_game_minutes", "points_trend_recent",
               "dfs_trend_recent", "recent_consistency"]
ADV_COLS = ["per_estimate", "avg_usage_rate", "usage_rate_trend", "avg_true_shooting", "shooting_trend"]
OPP_COLS = ["opponent_team_id", "is_home_game", "avg_points_vs_opponent", "avg_dfs_vs_opponent",
            "games_vs_opponent"]
INJ_COLS = ["recent_injury_count", "has_recent_injury", "days_since_injury"]
REST_COLS = ["rest_days", "is_back_to_back", "avg_rest_days", "std_rest_days"]
HA_COLS = ["avg_points_home", "avg_dfs_home", "home_games_count", "avg_points_away", "avg_dfs_away",
           "away_games_count", "home_away_dfs_diff"]
SAL_COLS = ["current_salary_dk", "avg_value_dk", "std_value_dk"]
SEASON_COLS = ["season_avg_points", "season_avg_dfs", "season_games_played", "seasonal_trend"]


def feature_cols(windows=ROLL_WINDOWS) -> list[str]:
    """Columns of the feature table for the given rolling windows."""
    return (KEY_COLS + INFO_COLS + [c for n in windows for c in rolling_names(n)] + RECENT_COLS + ADV_COLS + OPP_COLS
            + INJ_COLS + REST_COLS + HA_COLS + SAL_COLS + SEASON_COLS)


FEATURE_COLS = feature_cols()
assert len(FEATURE_COLS) == 110, len(FEATURE_COLS)


def _prep(logs: DataFrame) -> DataFrame:
    """Per-row inputs: stats with NULL as 0 (the ``x or 0`` rule) plus the raw values the truthiness
    and NULL-skipping rules need."""
    c = F.col
    cols = {f"{src}0": coalesce0(src).cast("double") for _, src in ROLL_AVG}
    for _, m, a in ROLL_PCT:
        cols[f"{m}0"] = coalesce0(m).cast("double")
        cols[f"{a}0"] = coalesce0(a).cast("double")
    cols["per_pos"] = (coalesce0("points") + coalesce0("rebounds_total") + coalesce0("assists")
                       + coalesce0("steals") + coalesce0("blocks")).cast("double")
    cols["per_neg"] = (coalesce0("field_goals_attempted") - coalesce0("field_goals_made")
                       + coalesce0("free_throws_attempted") - coalesce0("free_throws_made")
                       + coalesce0("turnovers")).cast("double")
    cols["usage_t"] = F.when(truthy(c("usage_rate")), c("usage_rate"))
    cols["ts_t"] = F.when(truthy(c("true_shooting_percentage")), c("true_shooting_percentage"))
    cols["home"] = F.coalesce(c("is_home"), F.lit(False))
    return logs.select("player_id", "game_id", "game_date", "rest_days", *[v.alias(k) for k, v in cols.items()])


def log_states(logs: DataFrame, windows=ROLL_WINDOWS) -> DataFrame:
    """One row per game log: the state of the player's history ending with that game (inclusive),
    plus ``next_date`` (date of the player's next game, NULL for the last one) and ``_chunk``, the season by which, with the
    player, the rows are partitioned.

    Sums, means and standard deviations over the last n games are running sums minus the running sum n
    rows back (``lag``): running frames are evaluated incrementally, where each sliding frame would rescan its
    n rows for every row. Deviations come from sums and squares of the distance to the chunk's first value, so
    little cancels; a window of equal values is known by the length of their run and has deviation 0. Only the
    slopes need the values of a window themselves.
    """
    base = _prep(logs)
    c = F.col
    framed = chunk_with_halo(base, ["player_id"], list(ORDER), season_chunk("game_date"),
                             lookback=HISTORY - 1, next_of="game_date")
    # extra per-row inputs of the running sums
    framed = framed.withColumns({
        "one": F.lit(1.0),
        "rest0": F.coalesce(c("rest_days").cast("double"), F.lit(0.0)),
        "rest_n": F.when(c("rest_days").isNotNull(), 1.0).otherwise(0.0),
        "h_n": F.when(c("home"), 1.0).otherwise(0.0), "a_n": F.when(~c("home"), 1.0).otherwise(0.0),
        "h_p": F.when(c("home"), c("points0")).otherwise(0.0), "a_p": F.when(~c("home"), c("points0")).otherwise(0.0),
        "h_d": F.when(c("home"), c("dfs_points_dk0")).otherwise(0.0),
        "a_d": F.when(~c("home"), c("dfs_points_dk0")).otherwise(0.0),
        "o_n": F.when(c("_own"), 1.0).otherwise(0.0), "o_p": F.when(c("_own"), c("points0")).otherwise(0.0),
        "o_d": F.when(c("_own"), c("dfs_points_dk0")).otherwise(0.0),
    })
    w = Window.partitionBy("player_id", "_chunk").orderBy(*ORDER)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    spread = [f"{src}0" for _, src in ROLL_STD]
    framed = framed.withColumns({f"_d_{x}": F.col(x) - F.first(x).over(running) for x in spread}) \
        .withColumns({f"_same_{x}": F.col(x) == F.lag(x).over(w) for x in spread} | {"_rn": F.row_number().over(w)})
    framed = framed.withColumns({f"_q_{x}": F.col(f"_d_{x}") * F.col(f"_d_{x}") for x in spread}
                                | {"rest_q": F.col("rest0") * F.col("rest0")}
                                # the row at which the present run of equal values began
                                | {f"_run_{x}": F.max(F.when(~F.coalesce(F.col(f"_same_{x}"), F.lit(False)), F.col("_rn"))).over(running) for x in spread})
    summed = (["points0", "rebounds_total0", "assists0", "steals0", "blocks0", "turnovers0", "minutes0",
               "dfs_points_dk0", "per_pos", "per_neg", "rest0", "rest_n", "h_n", "a_n", "h_p", "a_p", "h_d", "a_d",
               "o_n", "o_p", "o_d", "rest_q", "usage_rate0", "true_shooting_percentage0"]
              + [f"_{k}_{x}" for x in spread for k in "dq"]
              + [f"{m}0" for _, m, _ in ROLL_PCT] + [f"{a}0" for _, _, a in ROLL_PCT])
    step1 = framed.select("*", *[F.sum(x).over(running).alias(f"_c_{x}") for x in summed])

    def wsum(x, n, skip=0):
        """Sum of x over the n rows ending ``skip`` rows before the current one."""
        hi = F.col(f"_c_{x}") if skip == 0 else F.lag(f"_c_{x}", skip).over(w)
        return hi - F.coalesce(F.lag(f"_c_{x}", n + skip).over(w), F.lit(0.0))

    def fr(n):
        return w.rowsBetween(-(n - 1), 0)

    def deviation(x, n, sample):
        """Standard deviation of x over the last n rows, where there are as many."""
        if n < 2:
            return F.lit(None).cast("double") if sample else F.lit(0.0)
        s, q = wsum(f"_d_{x}", n), wsum(f"_q_{x}", n)
        variance = F.greatest(q - s * s / n, F.lit(0.0)) / (n - 1 if sample else n)
        return F.when(F.col("_rn") - F.col(f"_run_{x}") + 1 >= n, F.lit(0.0)).otherwise(F.sqrt(variance))

    rn = F.col("_rn")
    out = {"n_hist": F.least(rn, F.lit(HISTORY))}
    for n in windows:
        ok = rn >= n
        for name, src in ROLL_AVG:
            out[f"avg_{name}_L{n}"] = F.when(ok, wsum(f"{src}0", n) / n)
        for name, m, a in ROLL_PCT:
            out[f"avg_{name}_pct_L{n}"] = F.when(ok, safe_div(wsum(f"{m}0", n), wsum(f"{a}0", n)))
        for name, src in ROLL_STD:
            out[f"std_{name}_L{n}"] = F.when(ok, deviation(f"{src}0", n, True))
        out[f"games_played_L{n}"] = F.when(ok, F.lit(n))
    # recent
    out["last_game_points"] = F.col("points0")
    out["last_game_dfs_points"] = F.col("dfs_points_dk0")
    out["last_game_minutes"] = F.col("minutes0")
    for name, src in (("points_trend_recent", "points0"), ("dfs_trend_recent", "dfs_points_dk0")):
        out[name] = F.when(rn >= 6, wsum(src, 3) / 3 - wsum(src, 3, skip=3) / 3)
    out["recent_consistency"] = F.when(rn >= 10, 1.0 / (1.0 + deviation("dfs_points_dk0", 10, False)))
    # advanced (last 15 totals; last 10 truthy usage / true shooting, newest first)
    tm = wsum("minutes0", 15)
    out["per_estimate"] = F.when(tm > 0, (wsum("per_pos", 15) - wsum("per_neg", 15)) / (tm / 48))
    out["_usage_arr"] = F.reverse(F.collect_list("usage_t").over(fr(10)))
    out["_ts_arr"] = F.reverse(F.collect_list("ts_t").over(fr(10)))
    # rest pattern over the last 10 (NULLs skipped)
    rn10 = wsum("rest_n", 10)
    out["avg_rest_days"] = F.when(rn10 > 0, wsum("rest0", 10) / rn10)
    # whole days: the sums are exact
    rest_var = F.greatest(wsum("rest_q", 10) - wsum("rest0", 10) * wsum("rest0", 10) / rn10, F.lit(0.0)) / rn10
    out["std_rest_days"] = F.when(rn10 > 0, F.sqrt(rest_var))
    # home / away over the last 20 (NULL is_home counts as away)
    hc, ac = wsum("h_n", 20), wsum("a_n", 20)
    out["avg_points_home"] = F.when(hc > 0, wsum("h_p", 20) / hc)
    out["avg_dfs_home"] = F.when(hc > 0, wsum("h_d", 20) / hc)
    out["home_games_count"] = F.when(hc > 0, hc.cast("long"))
    out["avg_points_away"] = F.when(ac > 0, wsum("a_p", 20) / ac)
    out["avg_dfs_away"] = F.when(ac > 0, wsum("a_d", 20) / ac)
    out["away_games_count"] = F.when(ac > 0, ac.cast("long"))
    # season-to-date inside the last 50: the chunk is the season, so own rows are the season's rows
    sc = wsum("o_n", HISTORY)
    out["season_games_played"] = sc.cast("long")
    out["season_avg_points"] = F.when(sc > 0, wsum("o_p", HISTORY) / sc)
    out["season_avg_dfs"] = F.when(sc > 0, wsum("o_d", HISTORY) / sc)
    out["_season_dfs"] = F.collect_list(F.when(F.col("_own"), F.col("dfs_points_dk0"))).over(fr(HISTORY))
    out["next_date"] = F.coalesce(F.lead("game_date").over(w), F.col("_next_chunk_first"))

    st = step1.select("player_id", "game_id", "game_date", "_chunk", "_own", *[v.alias(k) for k, v in out.items()])
    st = st.where("_own").drop("_own")
    # array features are finished per state (arrays hold at most 10 / 50 values)
    m = F.size("_season_dfs")
    mid = F.floor(m / 2).cast("int")
    recent = F.slice("_season_dfs", F.greatest(m - mid + 1, F.lit(1)), F.greatest(mid, F.lit(1)))
    early = F.slice("_season_dfs", 1, F.greatest(m - mid, F.lit(1)))
    st = st.withColumns({
        "avg_usage_rate": array_mean(F.col("_usage_arr")),
        "usage_rate_trend": array_slope(F.col("_usage_arr")),
        "avg_true_shooting": array_mean(F.col("_ts_arr")),
        "shooting_trend": array_slope(F.col("_ts_arr")),
        "seasonal_trend": F.when(m >= 20, array_mean(recent) - array_mean(early)),
        "home_away_dfs_diff": F.col("avg_dfs_home") - F.col("avg_dfs_away"),
    }).drop("_usage_arr", "_ts_arr", "_season_dfs")
    return st


INJURY_DAYS = 30


def injury_steps(injuries: DataFrame) -> DataFrame:
    """FT-INJ as a step function: (player_id, day, _inj_n, _inj_last), where from ``day`` on so many injuries lie in the
    30 days before, the last of them on ``_inj_last``; both NULL where none does. A row for each change."""
    inj = injuries.select("player_id", "injury_date").where(F.col("injury_date").isNotNull())
    steps = active_counts(inj, ["player_id"], F.date_add("injury_date", 1), F.date_add("injury_date", INJURY_DAYS + 1))
    some = F.col("n") > 0
    return steps.select("player_id", "day", F.when(some, F.col("n")).alias("_inj_n"), F.when(some, F.date_sub("latest", 1)).alias("_inj_last"))


def first_log_per_day(logs: DataFrame, cols) -> DataFrame:
    """One log per (player, date): the one with the smallest game_id (a deterministic ``first``)."""
    return (logs.groupBy("player_id", "game_date")
            .agg(F.min_by(F.struct(*[F.col(c) for c in ["game_id", *cols]]), F.col("game_id")).alias("_r"))
            .select("player_id", "game_date", "_r.*"))


def opponent_features(logs: DataFrame, games: DataFrame, players: DataFrame, start, end, source: str = "log") -> DataFrame:
    """(player_id, target_date) + the five opponent features. The target-day game is found through the
    player's log on that day (``source="log"``, as the reference does) or through the schedule of the player's
    current team (``"schedule"``: also for games that are not played yet; of several on a day the smallest id);
    the opponent follows from the player's current team; the history is the newest 5 logs against that
    opponent strictly before t."""
    if source not in ("log", "schedule"):
        raise ValueError(f"opponent source {source!r}: log or schedule")
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    g = games.select("game_id", "home_team_id", "away_team_id")
    p = players.select("player_id", "team_id")
    if source == "log":
        found = first_log_per_day(logs.where(F.col("game_date").between(s, e)), []).join(g, "game_id").join(p, "player_id")
    else:
        sides = games.where(F.col("game_date").between(s, e)).select(
            "game_id", "game_date", "home_team_id", "away_team_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
        row = F.struct("game_id", "home_team_id", "away_team_id")
        first = sides.groupBy("team_id", "game_date").agg(F.min_by(row, F.col("game_id")).alias("_g")).select("team_id", "game_date", "_g.*")
        found = p.join(first, "team_id")
    tgt = (found.select("player_id", F.col("game_date").alias("target_date"),
                   F.when(F.col("team_id") == F.col("home_team_id"), F.col("away_team_id"))
                   .otherwise(F.col("home_team_id")).alias("opponent_team_id"),
                   F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False)).alias("is_home_game")))
    base = (logs.where(F.col("opponent_team_id").isNotNull())
            .select("player_id", "opponent_team_id", "game_id", "game_date",
                    coalesce0("points").cast("double").alias("p0"),
                    coalesce0("dfs_points_dk").cast("double").alias("d0")))
    keys = ["player_id", "opponent_team_id"]
    framed = chunk_with_halo(base, keys, list(ORDER), season_chunk("game_date"), lookback=4)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*ORDER).rowsBetween(-4, 0)
    states = (framed.select(*keys, "game_id", "game_date", "_own",
                            F.avg("p0").over(w).alias("avg_points_vs_opponent"),
                            F.avg("d0").over(w).alias("avg_dfs_vs_opponent"),
                            F.count(F.lit(1)).over(w).alias("games_vs_opponent"))
              .where("_own"))
    return asof_join(tgt, states, keys, "target_date", "game_date",
                     ["avg_points_vs_opponent", "avg_dfs_vs_opponent", "games_vs_opponent"],
                     right_order=["game_id"], strict=True, granularity="season")


def salary_features(salaries: DataFrame, logs: DataFrame, start, end) -> DataFrame:
    """(player_id, target_date, current_salary_dk, avg_value_dk, std_value_dk) for days with a
    DraftKings salary. Value = 1000 * dfs / salary over the newest 10 salary days before t that have a
    log (truthy dfs, salary > 0 only)."""
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    dk = salaries.where(F.col("platform") == "DraftKings").select("player_id", "game_date", "salary")
    cur = (dk.where(F.col("game_date").between(s, e)).groupBy("player_id", "game_date")
           .agg(F.min("salary").alias("current_salary_dk"))
           .withColumnRenamed("game_date", "target_date"))
    day = first_log_per_day(logs, ["dfs_points_dk"])
    hist = (dk.join(day.select("player_id", "game_date", "dfs_points_dk"), ["player_id", "game_date"])
            .withColumn("_v", F.when(truthy(F.col("dfs_points_dk")) & (F.col("salary") > 0),
                                     F.col("dfs_points_dk") / F.col("salary") * 1000)))
    framed = chunk_with_halo(hist, ["player_id"], ["game_date"], season_chunk("game_date"), lookback=9)
    w = Window.partitionBy("player_id", "_chunk").orderBy("game_date").rowsBetween(-9, 0)
    states = (framed.select("player_id", "game_date", "_own", F.avg("_v").over(w).alias("avg_value_dk"),
                            F.stddev_pop("_v").over(w).alias("std_value_dk"))
              .where("_own"))
    return asof_join(cur, states, ["player_id"], "target_date", "game_date", ["avg_value_dk", "std_value_dk"],
                     strict=True, granularity="season")


def _by_season(parts: DataFrame, days: DataFrame | None, held: DataFrame, materialize: bool) -> DataFrame:
    """(player_id, _chunk, _games): for each player and season of the states ``held`` a map from a game to the parts of its
    state's interval and to the ``days`` in it, each with all its rows. A season has its games and few days beside them. With
    ``materialize`` the narrow rows are staged, so that what made them is neither planned nor kept with the wide states."""
    keys = ["player_id", "_chunk", "game_id"]
    part = F.struct(*[c for c in parts.columns if c not in ("player_id", "game_id", "game_date")]).alias("_part")
    rows = parts.select("player_id", season_chunk("game_date").alias("_chunk"), "game_id", part)
    if days is not None:
        placed = asof_join(days, held, ["player_id"], "target_date", "game_date", ["game_id", "game_date"], right_order=["game_id"], strict=True,
                           granularity="season", prefix="_of_")
        day = F.struct(*[c for c in days.columns if c != "player_id"]).alias("_day")
        rows = rows.unionByName(placed.select("player_id", season_chunk("_of_game_date").alias("_chunk"), F.col("_of_game_id").alias("game_id"), day),
                                allowMissingColumns=True)
    else:
        rows = rows.withColumn("_day", F.lit(None).cast("struct<target_date: date>"))
    if materialize:
        rows = cut_lineage(rows)
    of_game = F.struct(F.collect_list("_part").alias("parts"), F.collect_list("_day").alias("days"))
    games = rows.where(F.col("game_id").isNotNull()).repartition("player_id", "_chunk").groupBy(*keys).agg(of_game.alias("_game"))
    return games.groupBy("player_id", "_chunk").agg(F.map_from_entries(F.collect_list(F.struct("game_id", "_game"))).alias("_games"))


def generate_features(logs: DataFrame, players: DataFrame, games: DataFrame, injuries: DataFrame,
                      salaries: DataFrame, start, end, *, opponent: bool = True, injury: bool = True,
                      rest: bool = True, home_away: bool = True, salary: bool = True,
                      windows=ROLL_WINDOWS, min_games: int = MIN_GAMES, opponent_source: str = "log",
                      materialize: bool = True, only: Sequence[str] | None = None) -> DataFrame:
    """FT-BATCH: the feature columns (``feature_cols(windows)``; 110 by default) for every active player and
    every day in [start, end] that has at least ``min_games`` games before it. Rolling windows hold at most
    ``HISTORY`` games. Config switches drop a group to NULLs.

    With ``materialize`` the cleaned logs and salaries, the states' dates and the rows of their days are staged once as parquet in the
    shared ``spark.checkpoint.dir``: the branches read only the columns they need of the same files instead of
    recomputing the ETL each, and a lost executor recomputes nothing upstream.

    ``only`` names the feature columns that the caller reads (with the keys): the same rows, nothing else is computed or staged."""
    if any(not 0 < n <= HISTORY for n in windows):
        raise ValueError(f"rolling windows {tuple(windows)}: 1 to {HISTORY} games")
    if materialize:
        logs = cut_lineage(logs)
        salaries = cut_lineage(salaries)
    st = log_states(logs, windows).where(F.col("n_hist") >= min_games)
    active = players.where(F.col("is_active")).select("player_id", *INFO_COLS)
    # What holds on a state's days is found on narrow rows; the wide states stay where their windows left them, by player
    # and season, and all that is known of a season's games comes to them there, in one row. Of the spine's states only
    # the dates are computed, from a few columns of the logs. Injuries change a few times a year: the states' intervals are
    # cut where they do, before days are written out.
    held = st.select("player_id", "game_id", "game_date", "next_date").join(active.select("player_id").distinct(), "player_id", "left_semi")
    if materialize:  # the branches of the injuries' intervals and of the days' games and salaries read it
        held = cut_lineage(held)
    parts = held.withColumn("_lo", F.col("game_date"))
    if injury:
        parts = split_intervals(parts, ["player_id"], ["game_id", "game_date"], "_lo", "next_date", injury_steps(injuries), "day", ["_inj_n", "_inj_last"])
    parts = parts.join(active, "player_id")
    days = None
    if opponent:
        days = opponent_features(logs, games, players, start, end, opponent_source)
    if salary:
        paid = salary_features(salaries, logs, start, end)
        days = paid if days is None else days.join(paid, KEY_COLS, "full")
    if only is not None:
        days = days.select(*[c for c in days.columns if c in KEY_COLS or c in only]) if days is not None else None
        hurt = any(c in only for c in INJ_COLS)
        parts = parts.select(*[c for c in parts.columns if (c not in INFO_COLS or c in only) and (hurt or not c.startswith("_inj"))])
    st = st.drop("next_date")
    spine = st.join(_by_season(parts, days, held, materialize), ["player_id", "_chunk"])
    game = F.try_element_at("_games", F.col("game_id"))
    spine = spine.select(*[c for c in st.columns if c != "_chunk"], game["days"].alias("_days"), F.explode(game["parts"]).alias("_part"))
    spine = explode_intervals(spine, F.col("_part._lo"), F.col("_part.next_date"), start, end)
    if days is not None:
        of_day = F.filter("_days", lambda d: d["target_date"] == F.col("target_date"))
        spine = spine.withColumn("_day", F.explode_outer(of_day))
        spine = spine.withColumns({c: F.col("_day")[c] for c in days.columns if c not in KEY_COLS})
    spine = spine.withColumns({c: F.col("_part")[c] for c in parts.columns if c not in st.columns}).drop("_days", "_day", "_part")
    t = F.col("target_date")
    same_season = season_start(t) == season_start(F.col("game_date"))
    rd = F.datediff(t, F.col("game_date")) - 1
    spine = spine.withColumns({
        "rest_days": rd,
        "is_back_to_back": rd == 0,
        "season_ok": (F.col("n_hist") >= 10) & same_season,
    })

    def col_or_null(c, dtype="double"):
        return F.col(c) if c in spine.columns else F.lit(None).cast(dtype)

    rolling = [c for n in windows for c in rolling_names(n)]
    sel = {c: col_or_null(c) for c in KEY_COLS + INFO_COLS + rolling + RECENT_COLS + ADV_COLS}
    sel.update({
        "opponent_team_id": col_or_null("opponent_team_id", "long"),
        "is_home_game": col_or_null("is_home_game", "boolean"),
        "avg_points_vs_opponent": col_or_null("avg_points_vs_opponent"),
        "avg_dfs_vs_opponent": col_or_null("avg_dfs_vs_opponent"),
        "games_vs_opponent": col_or_null("games_vs_opponent", "long"),
    })
    if injury and "_inj_n" in spine.columns:
        sel.update({"recent_injury_count": F.coalesce(F.col("_inj_n"), F.lit(0)).cast("long"),
                    "has_recent_injury": F.coalesce(F.col("_inj_n"), F.lit(0)) > 0,
                    "days_since_injury": F.coalesce(F.datediff(t, F.col("_inj_last")), F.lit(999))})
    else:
        sel.update({"recent_injury_count": F.lit(None).cast("long"), "has_recent_injury": F.lit(None).cast("boolean"),
                    "days_since_injury": F.lit(None).cast("int")})
    if rest:
        sel.update({c: F.col(c) for c in REST_COLS})
    else:
        sel.update({"rest_days": F.lit(None).cast("int"), "is_back_to_back": F.lit(None).cast("boolean"),
                    "avg_rest_days": F.lit(None).cast("double"), "std_rest_days": F.lit(None).cast("double")})
    for c in HA_COLS:
        sel[c] = F.col(c) if home_away else F.lit(None).cast(spine.schema[c].dataType)
    sel["current_salary_dk"] = col_or_null("current_salary_dk", "int")
    sel["avg_value_dk"] = col_or_null("avg_value_dk")
    sel["std_value_dk"] = col_or_null("std_value_dk")
    ok = F.col("season_ok")
    sel.update({"season_avg_points": F.when(ok, F.col("season_avg_points")),
                "season_avg_dfs": F.when(ok, F.col("season_avg_dfs")),
                "season_games_played": F.when(ok, F.col("season_games_played")),
                "seasonal_trend": F.when(ok, F.col("seasonal_trend"))})
    return spine.select(*[sel[c].alias(c) for c in feature_cols(windows) if only is None or c in KEY_COLS or c in only])


def feature_summary(features: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """FT-SUMM: records, feature columns, date range and unique players of a feature table; ``columns`` are the table's if
    ``features`` has its keys only."""
    n_cols = len([c for c in columns or features.columns if c not in KEY_COLS])
    return features.agg(F.count(F.lit(1)).alias("records"), F.lit(n_cols).cast("long").alias("feature_columns"),
                        F.min("target_date").alias("first_date"), F.max("target_date").alias("last_date"),
                        F.count_distinct("player_id").alias("players"))
