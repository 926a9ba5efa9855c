"""Cleaning, validation, derived stats, fantasy scoring and rest days as column expressions.

Each step is a DataFrame -> DataFrame function; ``run_full_etl`` composes them into one lazy
plan (the reference runs them as separate passes over a database). Row-wise steps add no shuffle;
only player de-duplication (an aggregate) and rest days (a per-player lag) move data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.functions.exprs import (any_of, coalesce0, count_at_least, dfs_score, truthy,
                                       weights_for, BOX_SCORE_DEFAULTS)
from courtline.operators.frames import lag_across_chunks, season_chunk

# ---------------------------------------------------------------------------------------------
# players


def duplicate_names(players: DataFrame) -> DataFrame:
    """Names held by more than one player row, with their count (AG-HAVING)."""
    return (players.where(F.col("name").isNotNull()).groupBy("name").agg(F.count("*").alias("count"))
            .where(F.col("count") > 1))


def dedup_players(players: DataFrame, id_col: str = "id") -> DataFrame:
    """Among rows with the same name keep the one with the largest ``id`` (ETL-DEDUP).

    Written as ``max_by`` in an aggregate rather than ``row_number`` over a window so a very
    common name is combined map-side before the shuffle (no single task sees the whole group).
    Rows with a NULL name are never duplicates and pass through.
    """
    cols = players.columns
    named = (players.where(F.col("name").isNotNull()).groupBy("name")
             .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(id_col)).alias("r"))
             .select(*[F.col("r")[c].alias(c) for c in cols]))
    return named.unionByName(players.where(F.col("name").isNull()))


# ---------------------------------------------------------------------------------------------
# teams

# Abbreviation -> (conference, division) for the 30 teams.
TEAM_DIVISIONS = {
    "ATL": ("Eastern", "Southeast"), "BOS": ("Eastern", "Atlantic"), "BKN": ("Eastern", "Atlantic"),
    "CHA": ("Eastern", "Southeast"), "CHI": ("Eastern", "Central"), "CLE": ("Eastern", "Central"),
    "DAL": ("Western", "Southwest"), "DEN": ("Western", "Northwest"), "DET": ("Eastern", "Central"),
    "GSW": ("Western", "Pacific"), "HOU": ("Western", "Southwest"), "IND": ("Eastern", "Central"),
    "LAC": ("Western", "Pacific"), "LAL": ("Western", "Pacific"), "MEM": ("Western", "Southwest"),
    "MIA": ("Eastern", "Southeast"), "MIL": ("Eastern", "Central"), "MIN": ("Western", "Northwest"),
    "NOP": ("Western", "Southwest"), "NYK": ("Eastern", "Atlantic"), "OKC": ("Western", "Northwest"),
    "ORL": ("Eastern", "Southeast"), "PHI": ("Eastern", "Atlantic"), "PHX": ("Western", "Pacific"),
    "POR": ("Western", "Northwest"), "SAC": ("Western", "Pacific"), "SAS": ("Western", "Southwest"),
    "TOR": ("Eastern", "Atlantic"), "UTA": ("Western", "Northwest"), "WAS": ("Eastern", "Southeast"),
}


def _division_map() -> Column:
    """The 30-entry table as a literal map: a lookup inside the projection, no join at all."""
    kv = []
    for abbr, (conf, div) in TEAM_DIVISIONS.items():
        kv += [F.lit(abbr), F.struct(F.lit(conf).alias("conference"), F.lit(div).alias("division"))]
    return F.create_map(*kv)


def normalize_teams(teams: DataFrame) -> DataFrame:
    """Upper-case abbreviations; a missing or empty conference sets conference and division from the
    30-team table, 'Unknown' for any other abbreviation (ETL-TEAM)."""
    abbr = F.upper(F.col("abbreviation"))
    hit = _division_map()[abbr]
    missing = F.col("conference").isNull() | (F.col("conference") == "")
    return teams.withColumns({
        "abbreviation": abbr,
        "conference": F.when(missing, F.coalesce(hit["conference"], F.lit("Unknown"))).otherwise(F.col("conference")),
        "division": F.when(missing, F.coalesce(hit["division"], F.lit("Unknown"))).otherwise(F.col("division")),
    })


# ---------------------------------------------------------------------------------------------
# game logs: validation and repair


def invalid_condition() -> Column:
    """The six impossible-value conditions (three-valued: a NULL comparison does not flag)."""
    c = F.col
    return F.coalesce(any_of([
        c("minutes") < 0, c("minutes") > 48, c("points") < 0,
        c("field_goals_made") > c("field_goals_attempted"),
        c("three_pointers_made") > c("three_pointers_attempted"),
        c("free_throws_made") > c("free_throws_attempted"),
    ]), F.lit(False))


def flag_invalid(logs: DataFrame) -> DataFrame:
    """Add ``is_invalid`` (ETL-VALID)."""
    return logs.withColumn("is_invalid", invalid_condition())


def fix_invalid(logs: DataFrame) -> DataFrame:
    """Repair flagged rows only (ETL-FIX): minutes above 48 become 48; made := attempted when made
    exceeds attempted and both are non-zero; negative points/rebounds/assists/steals/blocks become 0.
    Minutes below 0, made > 0 with 0 attempted and negative turnovers are left as they are."""
    bad, c = F.col("_bad"), F.col
    out = {"minutes": F.when(bad & truthy(c("minutes")) & (c("minutes") > 48), F.lit(48.0)).otherwise(c("minutes"))}
    for made, att in (("field_goals_made", "field_goals_attempted"),
                      ("three_pointers_made", "three_pointers_attempted"),
                      ("free_throws_made", "free_throws_attempted")):
        out[made] = (F.when(bad & truthy(c(made)) & truthy(c(att)) & (c(made) > c(att)), c(att))
                     .otherwise(c(made)))
    for stat in ("points", "rebounds_total", "assists", "steals", "blocks"):
        out[stat] = F.when(bad & truthy(c(stat)) & (c(stat) < 0), F.lit(0).cast(logs.schema[stat].dataType)).otherwise(c(stat))
    # all replacements read the pre-fix values; the flag is a column, so its six conditions are in the plan once, not
    # once a replacement (a generated method that long is never compiled)
    return logs.withColumn("_bad", invalid_condition()).withColumns(out).drop("_bad")


# ---------------------------------------------------------------------------------------------
# derived stats


def advanced_stat_columns() -> dict:
    """True shooting, effective FG% and usage exactly as the reference updates a log object."""
    c = F.col
    fga, fta = c("field_goals_attempted"), c("free_throws_attempted")
    tsa = 2 * (fga + 0.44 * fta)
    ts = (F.when(truthy(fga) & truthy(fta), F.when(tsa > 0, c("points") / tsa).otherwise(F.lit(0.0)))
          .otherwise(c("true_shooting_percentage")))
    efg = (F.when(truthy(fga) & (fga > 0), (c("field_goals_made") + 0.5 * c("three_pointers_made")) / fga)
           .otherwise(F.lit(0.0)))
    mins = c("minutes")
    poss = fga + 0.44 * coalesce0(fta) + coalesce0(c("turnovers"))
    usage = F.when(truthy(mins) & (mins > 0), poss / (mins / 48)).otherwise(c("usage_rate"))
    return {"true_shooting_percentage": ts, "effective_field_goal_percentage": efg, "usage_rate": usage}


def advanced_stats(logs: DataFrame, start=None, end=None) -> DataFrame:
    """ETL-ADV: derive TS, eFG and usage for logs whose date is in [start, end] (inclusive)."""
    in_range = F.lit(True)
    if start is not None:
        in_range = in_range & (F.col("game_date") >= F.to_date(F.lit(str(start))))
    if end is not None:
        in_range = in_range & (F.col("game_date") <= F.to_date(F.lit(str(end))))
    return logs.withColumns({k: F.when(in_range, v).otherwise(F.col(k)) for k, v in advanced_stat_columns().items()})


def score_platform(logs: DataFrame, platform: str = "DraftKings") -> DataFrame:
    """ETL-DK / ETL-FD: fill the platform's score where it is still NULL."""
    col = {"DraftKings": "dfs_points_dk", "FanDuel": "dfs_points_fd"}.get(platform)
    w = weights_for(platform)  # raises for an unknown platform
    return logs.withColumn(col, F.coalesce(F.col(col), dfs_score(w)))


def box_score_points(logs: DataFrame, alias: str = "fantasy_points", **weights) -> DataFrame:
    """ETL-SCOREP: parametric scoring with per-stat weights (pts, reb, ast, stl, blk, tov, mins) and
    double / triple / quad-double bonuses."""
    names = {"pts": "points", "reb": "rebounds_total", "ast": "assists", "stl": "steals", "blk": "blocks",
             "tov": "turnovers", "mins": "minutes", "doubleDouble": "double_double",
             "tripleDouble": "triple_double", "quadDouble": "quad_double"}
    w = dict(BOX_SCORE_DEFAULTS)
    for k, v in weights.items():
        w[names.get(k, k)] = float(v)
    return logs.withColumns({alias: dfs_score(w),
                             "categories_ge_10": count_at_least()})


# ---------------------------------------------------------------------------------------------
# rest days


def rest_days(logs: DataFrame, players: DataFrame, chunked: bool = True) -> DataFrame:
    """ETL-REST: days off before each game for active players: 0 for a player's first game, else
    max(0, days since the previous game - 1). Logs of inactive or unknown players keep their value.

    The previous game comes from a per-player lag. With ``chunked`` the window is split per
    (player, season) and a season's first game takes the previous season's last date from a small
    per-season table, so a player with a huge history never lands in a single task.
    """
    active = players.where(F.col("is_active")).select("player_id").distinct()
    flagged = logs.join(active.withColumn("_act", F.lit(True)), "player_id", "left")
    order = ["game_date", "game_id"]
    if chunked:
        framed = lag_across_chunks(flagged, ["player_id"], order, season_chunk("game_date"), "game_date", "_prev")
    else:
        w = Window.partitionBy("player_id").orderBy(*order)
        framed = flagged.withColumn("_prev", F.lag("game_date", 1).over(w))
    prev = F.col("_prev")
    rd = F.when(prev.isNull(), F.lit(0)).otherwise(F.greatest(F.datediff("game_date", prev) - 1, F.lit(0)))
    out = framed.withColumn("rest_days", F.when(F.col("_act"), rd.cast("int")).otherwise(F.col("rest_days")))
    return out.select(*logs.columns)


# ---------------------------------------------------------------------------------------------
# the whole pipeline


def run_full_etl(players: DataFrame, teams: DataFrame, logs: DataFrame, start=None, end=None, *,
                 dedup: bool = True, teams_step: bool = True, validate: bool = True, advanced: bool = True,
                 dk: bool = True, fd: bool = True, rest: bool = True, chunked: bool = True):
    """ETL-RUN: dedup players, normalise teams, repair logs, derive stats in [start, end], DraftKings
    and FanDuel scores, rest days - each switchable; the result is that of this order. Returns (players, teams, logs)
    as lazy plans."""
    if dedup:
        players = dedup_players(players)
    if teams_step:
        teams = normalize_teams(teams)
    if validate:
        logs = fix_invalid(logs)
    # Needs ids and dates only, which no step changes: rows are exchanged before they get wider, and the row-wise steps
    # fall into two stages. In one, their generated method passes the 8,000 bytes up to which the JVM compiles it.
    if rest:
        logs = rest_days(logs, players, chunked=chunked)
    if advanced:
        logs = advanced_stats(logs, start, end)
    if dk:
        logs = score_platform(logs, "DraftKings")
    if fd:
        logs = score_platform(logs, "FanDuel")
    return players, teams, logs
