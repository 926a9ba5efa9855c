"""SQL text for the DuckDB oracle: the ETL written as plain CTEs over the adapter views.

Independent of the DataFrame code paths (no chunking, no as-of tricks): windows over whole keys and
straightforward joins, the way one would write the rules by hand in SQL.
"""

from __future__ import annotations

from courtline.functions.exprs import DK_WEIGHTS, FD_WEIGHTS
from courtline.sources.adapter import ORACLE_CTES


def _score_sql(w: dict) -> str:
    parts = ["0.0::DOUBLE"]
    for stat in ("points", "rebounds_total", "assists", "steals", "blocks", "turnovers", "minutes"):
        if stat in w:
            parts.append(f"CAST(coalesce({stat}, 0) AS DOUBLE) * {float(w[stat])!r}::DOUBLE")
    n10 = ("((CASE WHEN coalesce(points,0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(rebounds_total,0) >= 10 THEN 1 ELSE 0 END)"
           " + (CASE WHEN coalesce(assists,0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(steals,0) >= 10 THEN 1 ELSE 0 END)"
           " + (CASE WHEN coalesce(blocks,0) >= 10 THEN 1 ELSE 0 END))")
    for name, k in (("double_double", 2), ("triple_double", 3), ("quad_double", 4)):
        if name in w:
            parts.append(f"(CASE WHEN {n10} >= {k} THEN {float(w[name])!r}::DOUBLE ELSE 0.0::DOUBLE END)")
    return "round(" + " + ".join(parts) + ", 2)"


DK_SCORE_SQL = _score_sql(DK_WEIGHTS)
FD_SCORE_SQL = _score_sql(FD_WEIGHTS)

_FIX_MADE = ("CASE WHEN bad AND coalesce({m},0) <> 0 AND coalesce({a},0) <> 0 AND {m} > {a} THEN {a} ELSE {m} END AS {m}")
_FIX_NEG = "CASE WHEN bad AND coalesce({c},0) <> 0 AND {c} < 0 THEN 0 ELSE {c} END AS {c}"

LOG_COLS = ("player_id, game_id, game_date, minutes, points, field_goals_made, field_goals_attempted, "
            "three_pointers_made, three_pointers_attempted, free_throws_made, free_throws_attempted, "
            "rebounds_offensive, rebounds_defensive, rebounds_total, assists, steals, blocks, turnovers, "
            "personal_fouls, is_home, opponent_team_id, true_shooting_percentage, "
            "effective_field_goal_percentage, usage_rate, dfs_points_dk, dfs_points_fd, rest_days")


def etl_ctes(start: str | None = None, end: str | None = None) -> str:
    """CTEs players_etl, teams_etl, logs_fixed, logs_adv, logs_scored, logs_etl (after the adapter CTEs)."""
    rng = "TRUE"
    if start:
        rng += f" AND game_date >= DATE '{start}'"
    if end:
        rng += f" AND game_date <= DATE '{end}'"
    fixed_cols = ",\n    ".join([
        "player_id", "game_id", "game_date",
        "CASE WHEN bad AND coalesce(minutes,0) <> 0 AND minutes > 48 THEN 48.0::DOUBLE ELSE minutes END AS minutes",
        _FIX_NEG.format(c="points"),
        _FIX_MADE.format(m="field_goals_made", a="field_goals_attempted"), "field_goals_attempted",
        _FIX_MADE.format(m="three_pointers_made", a="three_pointers_attempted"), "three_pointers_attempted",
        _FIX_MADE.format(m="free_throws_made", a="free_throws_attempted"), "free_throws_attempted",
        "rebounds_offensive", "rebounds_defensive", _FIX_NEG.format(c="rebounds_total"),
        _FIX_NEG.format(c="assists"), _FIX_NEG.format(c="steals"), _FIX_NEG.format(c="blocks"),
        "turnovers", "personal_fouls", "is_home", "opponent_team_id", "true_shooting_percentage",
        "effective_field_goal_percentage", "usage_rate", "dfs_points_dk", "dfs_points_fd", "rest_days"])
    adv_cols = LOG_COLS.replace(
        "true_shooting_percentage, effective_field_goal_percentage, usage_rate",
        f"""CASE WHEN ({rng}) AND coalesce(field_goals_attempted,0) <> 0 AND coalesce(free_throws_attempted,0) <> 0
          THEN (CASE WHEN 2 * (field_goals_attempted + 0.44::DOUBLE * free_throws_attempted) > 0
                     THEN points / (2 * (field_goals_attempted + 0.44::DOUBLE * free_throws_attempted)) ELSE 0.0::DOUBLE END)
          ELSE true_shooting_percentage END AS true_shooting_percentage,
      CASE WHEN NOT ({rng}) THEN effective_field_goal_percentage
           WHEN coalesce(field_goals_attempted,0) <> 0 AND field_goals_attempted > 0
           THEN (field_goals_made + 0.5::DOUBLE * three_pointers_made) / field_goals_attempted ELSE 0.0::DOUBLE END
        AS effective_field_goal_percentage,
      CASE WHEN ({rng}) AND coalesce(minutes,0) <> 0 AND minutes > 0
           THEN (field_goals_attempted + 0.44::DOUBLE * coalesce(free_throws_attempted,0) + coalesce(turnovers,0)) / (minutes / 48)
           ELSE usage_rate END AS usage_rate""")
    scored_cols = LOG_COLS.replace(
        "dfs_points_dk, dfs_points_fd",
        f"coalesce(dfs_points_dk, {DK_SCORE_SQL}) AS dfs_points_dk, coalesce(dfs_points_fd, {FD_SCORE_SQL}) AS dfs_points_fd")
    rest_cols = LOG_COLS.replace(
        "rest_days",
        """CASE WHEN a.player_id IS NULL THEN rest_days
           WHEN lag(game_date) OVER (PARTITION BY l.player_id ORDER BY game_date, game_id) IS NULL THEN 0
           ELSE CAST(greatest(date_diff('day', lag(game_date) OVER (PARTITION BY l.player_id ORDER BY game_date, game_id), game_date) - 1, 0) AS INTEGER)
           END AS rest_days""").replace("player_id, game_id", "l.player_id, game_id", 1)
    return f"""
players_etl AS (
  SELECT id, player_id, name, team_id, position, is_active FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY id DESC) AS rn FROM players) WHERE rn = 1 OR name IS NULL),
teams_etl AS (
  SELECT team_id, upper(abbreviation) AS abbreviation, name,
         CASE WHEN conference IS NULL OR conference = '' THEN 'Unknown' ELSE conference END AS conference,
         CASE WHEN conference IS NULL OR conference = '' THEN 'Unknown' ELSE division END AS division
  FROM teams),
logs_flagged AS (
  SELECT *, coalesce(minutes < 0 OR minutes > 48 OR points < 0 OR field_goals_made > field_goals_attempted
                     OR three_pointers_made > three_pointers_attempted OR free_throws_made > free_throws_attempted,
                     FALSE) AS bad
  FROM player_game_logs),
logs_fixed AS (SELECT {fixed_cols} FROM logs_flagged),
logs_adv AS (SELECT {adv_cols} FROM logs_fixed),
logs_scored AS (SELECT {scored_cols} FROM logs_adv),
active_ids AS (SELECT DISTINCT player_id FROM players_etl WHERE is_active),
logs_etl AS (SELECT {rest_cols} FROM logs_scored l LEFT JOIN active_ids a ON l.player_id = a.player_id)
"""


def with_ctes(body: str, etl: bool = True, start=None, end=None, extra: str = "") -> str:
    """Full oracle statement: adapter CTEs (+ ETL CTEs) (+ extra CTEs) then ``body``."""
    ctes = ORACLE_CTES.strip()
    if etl:
        ctes += ",\n" + etl_ctes(start, end).strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return f"WITH {ctes}\n{body}"
