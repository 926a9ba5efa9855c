"""The registered queries: name -> (spark, sf_dir) -> DataFrame, and the DuckDB oracle for each.

Every query reads the driver tables of ``sf_dir`` through the adapter (``Domain``) and runs over
the whole tables. Floating outputs are rounded to 6 digits on both sides; integer outputs are BIGINT.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.plans.oracle_sql import with_ctes
from courtline.sources.adapter import Domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# What bench.py times when it differs from the registered query: the operator's own output, without
# the rounding / casting that only serves the comparison with the oracle.
BENCH: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c):
    """Round to 6 digits; adding 0.0 turns a negative zero into 0.0 (both sides do the same)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


# ---------------------------------------------------------------------------------------------
# flagship: repair, DraftKings score, newest five per player, top ten

@register("flagship_top_l5", with_ctes("""
SELECT player_id, round(avg(coalesce(dfs_points_dk, 0)), 6) AS avg_dfs_points_l5
FROM ranked WHERE rn <= 5 GROUP BY player_id HAVING count(*) >= 5
ORDER BY avg_dfs_points_l5 DESC, player_id LIMIT 10""", extra="""
ranked AS (SELECT player_id, dfs_points_dk,
                  row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) AS rn
           FROM logs_scored)"""))
def q_flagship(spark, sf_dir):
    from courtline.plans.flagship import top_recent_scorers
    return top_recent_scorers(Domain(spark, sf_dir).player_game_logs)


# ---------------------------------------------------------------------------------------------
# ETL steps

from courtline.operators import etl as E  # noqa: E402
from courtline.operators import quality as Q  # noqa: E402
from courtline.operators import storage as ST  # noqa: E402
from courtline.plans.cleaned import etl_domain  # noqa: E402
from courtline.plans.oracle_sql import LOG_COLS  # noqa: E402

_SHOT_COLS = ("minutes, points, field_goals_made, field_goals_attempted, three_pointers_made, "
              "three_pointers_attempted, free_throws_made, free_throws_attempted, rebounds_total, assists, "
              "steals, blocks, turnovers")


@register("etl_validate", with_ctes(f"""
SELECT player_id, game_id, game_date, {_SHOT_COLS} FROM logs_flagged WHERE bad"""))
def q_etl_validate(spark, sf_dir):
    logs = E.flag_invalid(Domain(spark, sf_dir).player_game_logs)
    return logs.where("is_invalid").select("player_id", "game_id", "game_date", *_SHOT_COLS.split(", "))


@register("etl_fix", with_ctes(f"""
SELECT f.player_id, f.game_id, f.game_date, {', '.join('f.' + c for c in _SHOT_COLS.split(', '))}
FROM logs_fixed f JOIN logs_flagged b ON f.player_id = b.player_id AND f.game_id = b.game_id WHERE b.bad"""))
def q_etl_fix(spark, sf_dir):
    logs = Domain(spark, sf_dir).player_game_logs
    fixed = E.fix_invalid(E.flag_invalid(logs)).where("is_invalid")
    return fixed.select("player_id", "game_id", "game_date", *_SHOT_COLS.split(", "))


@register("etl_advanced", with_ctes("""
SELECT player_id, game_id, round(true_shooting_percentage, 6) AS true_shooting_percentage,
       round(effective_field_goal_percentage, 6) AS effective_field_goal_percentage,
       round(usage_rate, 6) AS usage_rate
FROM logs_adv""", start="1996-01-01", end="2000-12-31"))
def q_etl_advanced(spark, sf_dir):
    logs = E.advanced_stats(E.fix_invalid(Domain(spark, sf_dir).player_game_logs), "1996-01-01", "2000-12-31")
    return logs.select("player_id", "game_id", r6("true_shooting_percentage").alias("true_shooting_percentage"),
                       r6("effective_field_goal_percentage").alias("effective_field_goal_percentage"),
                       r6("usage_rate").alias("usage_rate"))


@register("etl_scores", with_ctes("""
SELECT player_id, game_id, dfs_points_dk, dfs_points_fd FROM logs_scored"""))
def q_etl_scores(spark, sf_dir):
    logs = E.score_platform(E.score_platform(E.fix_invalid(Domain(spark, sf_dir).player_game_logs), "DraftKings"),
                            "FanDuel")
    return logs.select("player_id", "game_id", "dfs_points_dk", "dfs_points_fd")


_N10 = ("((CASE WHEN coalesce(points,0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(rebounds_total,0) >= 10 THEN 1 ELSE 0 END)"
        " + (CASE WHEN coalesce(assists,0) >= 10 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(steals,0) >= 10 THEN 1 ELSE 0 END)"
        " + (CASE WHEN coalesce(blocks,0) >= 10 THEN 1 ELSE 0 END))")


@register("etl_double_triple", with_ctes(f"""
SELECT player_id, game_id, {_N10} >= 2 AS is_double_double, {_N10} >= 3 AS is_triple_double
FROM logs_fixed"""))
def q_etl_double_triple(spark, sf_dir):
    from courtline.functions.exprs import double_double, triple_double
    logs = E.fix_invalid(Domain(spark, sf_dir).player_game_logs)
    return logs.select("player_id", "game_id", double_double().alias("is_double_double"),
                       triple_double().alias("is_triple_double"))


def _box_sql():
    from courtline.plans.oracle_sql import _score_sql
    w = {"points": 1.0, "rebounds_total": 1.2, "assists": 1.5, "steals": 2.0, "blocks": 2.0, "turnovers": -0.5,
         "minutes": 0.1, "double_double": 1.5, "triple_double": 3.0, "quad_double": 5.0}
    return _score_sql(w)


@register("etl_box_score_weights", with_ctes(f"""
SELECT player_id, game_id, {_box_sql()} AS fantasy_points, {_N10} AS categories_ge_10 FROM logs_fixed"""))
def q_etl_box_score(spark, sf_dir):
    logs = E.fix_invalid(Domain(spark, sf_dir).player_game_logs)
    out = E.box_score_points(logs, pts=1.0, reb=1.2, ast=1.5, stl=2.0, blk=2.0, tov=-0.5, mins=0.1,
                             doubleDouble=1.5, tripleDouble=3.0, quadDouble=5.0)
    return out.select("player_id", "game_id", "fantasy_points", "categories_ge_10")


@register("etl_rest_days", with_ctes("SELECT player_id, game_id, game_date, rest_days FROM logs_etl"))
def q_etl_rest(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    return logs.select("player_id", "game_id", "game_date", "rest_days")


def _team_lookup_sql():
    vals = ", ".join(f"('{a}', '{c}', '{d}')" for a, (c, d) in E.TEAM_DIVISIONS.items())
    return f"team_lookup AS (SELECT * FROM (VALUES {vals}) t(abbr, conf, div))"


@register("etl_teams", with_ctes("""
SELECT t.team_id, upper(t.abbreviation) AS abbreviation, t.name,
       CASE WHEN t.conference IS NULL OR t.conference = '' THEN coalesce(k.conf, 'Unknown') ELSE t.conference END AS conference,
       CASE WHEN t.conference IS NULL OR t.conference = '' THEN coalesce(k.div, 'Unknown') ELSE t.division END AS division
FROM dirty_teams t LEFT JOIN team_lookup k ON upper(t.abbreviation) = k.abbr""", etl=False, extra=_team_lookup_sql() + """,
codes AS (SELECT abbr, row_number() OVER (ORDER BY abbr) - 1 AS i FROM team_lookup),
dirty_teams AS (
  SELECT t.team_id, CASE WHEN t.team_id % 3 = 0 THEN t.abbreviation ELSE lower(c.abbr) END AS abbreviation, t.name,
         CASE t.team_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE t.conference END AS conference, t.division
  FROM teams t JOIN codes c ON c.i = t.team_id % 30)"""))
def q_etl_teams(spark, sf_dir):
    """Teams with NULL and empty conferences, known codes in lower case and unknown ones."""
    t = Domain(spark, sf_dir).teams
    codes = F.array(*[F.lit(c.lower()) for c in sorted(E.TEAM_DIVISIONS)])
    k = F.col("team_id")
    return E.normalize_teams(t.withColumns({
        "abbreviation": F.when(k % 3 == 0, F.col("abbreviation")).otherwise(F.get(codes, (k % 30).cast("int"))),
        "conference": F.when(k % 4 == 1, F.lit("")).when(k % 4 != 0, F.col("conference"))}))


_DIRTY_PLAYERS_SQL = """dirty_players AS (
  SELECT id, player_id, CASE WHEN id % 7 = 3 THEN NULL ELSE name END AS name, team_id, position, is_active FROM players
  UNION ALL SELECT id + 1000000, player_id, name, team_id, position, NOT is_active FROM players WHERE id % 3 = 0
  UNION ALL SELECT id + 2000000, player_id, name, team_id, position, is_active FROM players WHERE id % 6 = 0)"""


def _dirty_players(players):
    """Players with copies under larger ids (one or two of each third) and names that are missing."""
    base = players.withColumn("name", F.when(F.col("id") % 7 != 3, F.col("name")))
    again = players.where("id % 3 = 0").withColumns({"id": F.col("id") + 1_000_000, "is_active": ~F.col("is_active")})
    third = players.where("id % 6 = 0").withColumn("id", F.col("id") + 2_000_000)
    return base.unionByName(again).unionByName(third)


@register("etl_dedup_players", with_ctes("""
SELECT id, player_id, name, team_id, position, is_active FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY id DESC) AS rn FROM dirty_players) WHERE name IS NULL OR rn = 1""",
                                         etl=False, extra=_DIRTY_PLAYERS_SQL))
def q_etl_dedup(spark, sf_dir):
    return E.dedup_players(_dirty_players(Domain(spark, sf_dir).players))


@register("etl_duplicate_names", with_ctes("""
SELECT name, count(*) AS count FROM dirty_players WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1""", etl=False,
                                           extra=_DIRTY_PLAYERS_SQL))
def q_etl_dups(spark, sf_dir):
    return E.duplicate_names(_dirty_players(Domain(spark, sf_dir).players))


_ETL_OUT = LOG_COLS.split(", ")
_ETL_DOUBLES = ("true_shooting_percentage", "effective_field_goal_percentage", "usage_rate")


@register("etl_full_run", with_ctes("SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in _ETL_DOUBLES else c for c in _ETL_OUT) + " FROM logs_etl"))
def q_etl_full(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    return logs.select(*[r6(c).alias(c) if c in _ETL_DOUBLES else F.col(c) for c in _ETL_OUT])


# ---------------------------------------------------------------------------------------------
# quality reports

@register("qual_key_injuries", with_ctes("""
SELECT player_id, injury_date, count(*) AS n_rows FROM injuries GROUP BY player_id, injury_date HAVING count(*) > 1""",
                                         etl=False))
def q_qual_key(spark, sf_dir):
    return Q.key_report(Domain(spark, sf_dir).injuries, ["player_id", "injury_date"])


@register("qual_fk_logs_players", with_ctes("""
SELECT l.player_id, l.game_id FROM player_game_logs l WHERE NOT EXISTS (
  SELECT 1 FROM players p WHERE p.player_id = l.player_id AND p.is_active)""", etl=False))
def q_qual_fk(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return Q.fk_report(d.player_game_logs.select("player_id", "game_id"), d.players.where("is_active"), "player_id")


_RANGES = Q.compact_log_ranges(_ETL_OUT)


@register("qual_range_logs", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE NOT ({c} BETWEEN {lo} AND {hi})) AS BIGINT) AS n_out_of_range, "
    f"CAST({lo} AS BIGINT) AS lo, CAST({hi} AS BIGINT) AS hi FROM logs_etl" for c, (lo, hi) in _RANGES.items())))
def q_qual_range(spark, sf_dir):
    """The cleaned logs, ids included, against the compact types of the export's storage plan."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    return Q.range_report(logs.select(*_RANGES), _RANGES)


@register("qual_null_counts", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM logs_etl"
    for c in _ETL_OUT)))
def q_qual_nulls(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    return Q.null_counts(logs, _ETL_OUT)


def _validation_sql(source: str, wrong_type: int) -> str:
    rows = [f"SELECT 'non_empty' AS \"check\", 'error' AS severity, CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_bad FROM {source}"]
    rows += [f"SELECT 'required_column:{c}', 'error', CAST({int(c == 'dfs_points_dk')} AS BIGINT)" for c in Q.REQUIRED_LOG_COLUMNS]
    rows += [f"SELECT 'type:{c}', 'warning', CAST({wrong_type if c == 'points' else 0} AS BIGINT)" for c in Q.EXPORTED_LOG_TYPES]
    rows += [f"SELECT 'nulls:{c}', 'warning', CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM {source}" for c in Q.LOG_KEY_COLUMNS]
    return "\nUNION ALL ".join(rows)


@register("qual_validate_export", with_ctes(_validation_sql("dirty", 1), extra="""
dirty AS (SELECT CASE WHEN game_id % 11 <> 0 THEN player_id END AS player_id, game_id,
                 CASE WHEN game_id % 7 <> 0 THEN game_date END AS game_date, points FROM logs_etl)"""))
def q_qual_validate(spark, sf_dir):
    """Logs with missing ids and dates, without scores and with points that are not in their storage type."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    k = F.col("game_id")
    dirty = logs.select(F.when(k % 11 != 0, F.col("player_id")).alias("player_id"), "game_id",
                        F.when(k % 7 != 0, F.col("game_date")).alias("game_date"), "points")
    return Q.validate_logs(dirty)


# ---------------------------------------------------------------------------------------------
# point-in-time features

from courtline.plans import features as FT  # noqa: E402
from courtline.plans.oracle_features import (INT_FEATURES, NON_DOUBLE, OUTCOME_DAYS, features_oracle_ctes,  # noqa: E402
                                             features_select_sql)


def normalized_features(df: DataFrame, keep=()) -> DataFrame:
    """Integers as BIGINT and doubles rounded to 6 digits, the form the oracle returns; ``keep`` as they are."""
    out = []
    for c in df.columns:
        if c in keep:
            out.append(F.col(c))
        elif c in INT_FEATURES:
            out.append(F.col(c).cast("long").alias(c))
        elif c not in NON_DOUBLE:
            out.append((F.round(F.col(c).cast("double"), 6) + F.lit(0.0)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def data_date_range(dom: Domain):
    """First and last game day of the data (two scalars; the batch covers the whole span)."""
    r = dom.games.agg(F.min("game_date").alias("a"), F.max("game_date").alias("b")).first()
    return r["a"], r["b"]


def features_for(spark, sf_dir, **switches):
    dom = Domain(spark, sf_dir)
    players, _, logs = etl_domain(dom)
    a, b = data_date_range(dom)
    return FT.generate_features(logs, players, dom.games, dom.injuries, dom.dfs_salaries, a, b, **switches)


@register("ft_batch_all_days", with_ctes(features_select_sql(), extra=features_oracle_ctes()))
def q_ft_batch(spark, sf_dir):
    return normalized_features(features_for(spark, sf_dir))


BENCH["ft_batch_all_days"] = lambda spark, sf_dir: features_for(spark, sf_dir)


_WINDOWS, _MIN_GAMES = (3, 7), 3


@register("ft_custom_windows", with_ctes(features_select_sql(FT.feature_cols(_WINDOWS)), extra=features_oracle_ctes(
    windows=_WINDOWS, min_games=_MIN_GAMES)))
def q_ft_windows(spark, sf_dir):
    """FT-ROLL with the caller's windows and least number of games."""
    return normalized_features(features_for(spark, sf_dir, windows=_WINDOWS, min_games=_MIN_GAMES))


@register("ft_opponent_schedule", with_ctes("""
SELECT t.player_id, t.target_date, t.opp AS opponent_team_id, t.is_home_game,
       round(st.p, 6) AS avg_points_vs_opponent, round(st.d, 6) AS avg_dfs_vs_opponent, st.n AS games_vs_opponent
FROM sched t ASOF LEFT JOIN st ON t.player_id = st.player_id AND t.opp = st.opponent_team_id AND t.target_date > st.game_date""", extra="""
side AS (SELECT game_id, game_date, home_team_id, away_team_id, home_team_id AS team_id FROM games
         UNION ALL SELECT game_id, game_date, home_team_id, away_team_id, away_team_id FROM games),
sched AS (SELECT p.player_id, f.game_date AS target_date,
                 CASE WHEN p.team_id = f.home_team_id THEN f.away_team_id ELSE f.home_team_id END AS opp,
                 coalesce(p.team_id = f.home_team_id, FALSE) AS is_home_game
          FROM players_etl p JOIN (SELECT *, row_number() OVER (PARTITION BY team_id, game_date ORDER BY game_id) AS rn FROM side) f
            ON p.team_id = f.team_id AND f.rn = 1),
st AS (SELECT * FROM (
         SELECT player_id, opponent_team_id, game_date, game_id, avg(coalesce(points, 0)) OVER w AS p,
                avg(CAST(coalesce(dfs_points_dk, 0) AS DOUBLE)) OVER w AS d, count(*) OVER w AS n,
                row_number() OVER (PARTITION BY player_id, opponent_team_id, game_date ORDER BY game_id DESC) AS late
         FROM logs_etl WHERE opponent_team_id IS NOT NULL
         WINDOW w AS (PARTITION BY player_id, opponent_team_id ORDER BY game_date, game_id ROWS 4 PRECEDING)) WHERE late = 1)"""))
def q_ft_schedule(spark, sf_dir):
    """FT-OPP from the schedule: every team-mate gets the opponent of the day, with or without a log."""
    dom = Domain(spark, sf_dir)
    players, _, logs = etl_domain(dom)
    a, b = data_date_range(dom)
    logs = cut_lineage(logs.select("player_id", "opponent_team_id", "game_id", "game_date", "points", "dfs_points_dk"))     # read four times
    o = FT.opponent_features(logs, dom.games, players, a, b, source="schedule")
    return o.withColumns({c: r6(c) for c in ("avg_points_vs_opponent", "avg_dfs_vs_opponent")})


@register("ft_summary", with_ctes("""
SELECT count(*) AS records, CAST(108 AS BIGINT) AS feature_columns, min(target_date) AS first_date,
       max(target_date) AS last_date, count(DISTINCT player_id) AS players FROM feat""", extra=features_oracle_ctes()))
def q_ft_summary(spark, sf_dir):
    return FT.feature_summary(features_for(spark, sf_dir, only=()), FT.FEATURE_COLS)


# ---------------------------------------------------------------------------------------------
# analytical reads

from courtline.plans import reads as RD  # noqa: E402

_LOGVIEW_SQL = ", ".join(
    (f"round({src}, 6) AS {dst}" if src in ("true_shooting_percentage", "usage_rate") else
     ("CAST(NULL AS BOOLEAN) AS is_starter" if dst == "is_starter" else f"{src} AS {dst}"))
    for dst, src in RD.LOG_VIEW)


@register("an_logs_newest10", with_ctes(f"""
SELECT {_LOGVIEW_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) AS rn FROM logs_etl)
WHERE rn <= 10"""))
def q_an_logs(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    v = RD.player_game_logs(logs, limit=10)
    return v.withColumns({"true_shooting_percentage": r6("true_shooting_percentage"), "usage_rate": r6("usage_rate")})


@register("an_games_all_days", with_ctes("""
SELECT g.game_id, g.game_date, g.home_team_id, g.away_team_id, h.abbreviation AS home_team_abbr,
       a.abbreviation AS away_team_abbr, CAST(90 + g.game_id % 40 AS INTEGER) AS home_score, CAST(90 + g.game_id % 37 AS INTEGER) AS away_score,
       CASE WHEN g.game_id % 5 > 0 THEN 'Final' END AS game_status, g.total_line, g.home_spread, g.away_spread
FROM games g LEFT JOIN teams_etl h ON g.home_team_id = h.team_id LEFT JOIN teams_etl a ON g.away_team_id = a.team_id"""))
def q_an_games(spark, sf_dir):
    d = Domain(spark, sf_dir)
    _, teams, _ = etl_domain(d)
    k = F.col("game_id")
    games = d.games.withColumns({"home_score": (90 + k % 40).cast("int"), "away_score": (90 + k % 37).cast("int"),
                                 "game_status": F.when(k % 5 > 0, "Final")})
    return RD.games_for_date(games, teams)


_SLATE_SQL = """slate AS (
  SELECT s.game_date, s.player_id, p.name AS player_name, p.team_id, t.abbreviation AS team_abbr, s.position,
         s.salary, g.game_id, g.total_line,
         CASE WHEN p.team_id = g.home_team_id THEN g.home_spread ELSE g.away_spread END AS spread,
         p.team_id = g.home_team_id AS is_home
  FROM dfs_salaries s JOIN players_etl p ON s.player_id = p.player_id JOIN teams_etl t ON p.team_id = t.team_id
  JOIN games g ON (g.home_team_id = p.team_id OR g.away_team_id = p.team_id) AND g.game_date = s.game_date
  WHERE s.platform = 'DraftKings' AND s.is_available)"""


def _slate(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, teams, _ = etl_domain(d)
    return RD.dfs_slate(d.dfs_salaries, players, teams, d.games)


@register("an_slate_all_days", with_ctes("SELECT * FROM slate", extra=_SLATE_SQL))
def q_an_slate(spark, sf_dir):
    return _slate(spark, sf_dir)


@register("an_ownership_all_days", with_ctes("""
SELECT sl.game_date, sl.player_id, sl.player_name, sl.salary,
       round(CASE WHEN mm.hi > mm.lo THEN 5 + (sl.salary - mm.lo) / (mm.hi - mm.lo) * 20
                  WHEN mm.hi IS NOT NULL THEN 15.0 END, 6) AS ownership_projection
FROM slate sl LEFT JOIN mm ON sl.game_date = mm.game_date AND sl.position = mm.position""",
                                             extra=_SLATE_SQL + """,
mm AS (SELECT game_date, position, min(salary) AS lo, max(salary) AS hi FROM slate
       WHERE position IS NOT NULL GROUP BY game_date, position)"""))
def q_an_ownership(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, teams, _ = etl_domain(d)
    o = RD.slate_ownership(d.dfs_salaries, players, teams, d.games)
    return RD.per_game(o.withColumn("ownership_projection", r6("ownership_projection")))


@register("an_player_info", with_ctes("""
SELECT p.player_id, p.name, p.position, p.team_id, t.abbreviation AS team_abbr, p.is_active
FROM players_etl p LEFT JOIN teams_etl t ON p.team_id = t.team_id"""))
def q_an_player(spark, sf_dir):
    players, teams, _ = etl_domain(Domain(spark, sf_dir))
    return RD.player_info(players, teams)


@register("an_team_vs_position", with_ctes("""
SELECT l.opponent_team_id AS team_id, p.position,
       round(coalesce(avg(l.points), 0.0), 6) AS avg_points_allowed,
       round(coalesce(avg(l.rebounds_total), 0.0), 6) AS avg_rebounds_allowed,
       round(coalesce(avg(l.assists), 0.0), 6) AS avg_assists_allowed,
       round(coalesce(avg(l.dfs_points_dk), 0.0), 6) AS avg_dfs_allowed, count(*) AS games_sample_size
FROM logs_etl l JOIN players_etl p ON l.player_id = p.player_id GROUP BY l.opponent_team_id, p.position"""))
def q_an_vspos(spark, sf_dir):
    players, _, logs = etl_domain(Domain(spark, sf_dir))
    o = RD.team_vs_position(logs, players)
    return o.select("team_id", "position", *[r6(c).alias(c) for c in
                                             ("avg_points_allowed", "avg_rebounds_allowed", "avg_assists_allowed",
                                              "avg_dfs_allowed")], "games_sample_size")


def _trends_sql(as_of: str, since: str) -> str:
    return with_ctes("""
SELECT player_id, count(*) AS games_played, round(avg(y_dfs), 6) AS avg_dfs_points, round(avg(y_min), 6) AS avg_minutes,
       round(avg(y_pts), 6) AS avg_points,
       round(CASE WHEN count(*) >= 3 THEN regr_slope(y_dfs, x) ELSE 0.0 END, 6) AS dfs_trend,
       round(CASE WHEN count(*) >= 3 THEN regr_slope(y_min, x) ELSE 0.0 END, 6) AS minutes_trend,
       round(CASE WHEN count(*) >= 3 THEN regr_slope(y_pts, x) ELSE 0.0 END, 6) AS points_trend,
       round(CASE WHEN count(*) > 1 THEN 1.0 / (1.0 + stddev_pop(y_dfs)) ELSE 1.0 END, 6) AS consistency
FROM tl GROUP BY player_id""", extra=f"""
tl AS (SELECT player_id, CAST(coalesce(dfs_points_dk, 0) AS DOUBLE) AS y_dfs, CAST(coalesce(minutes, 0) AS DOUBLE) AS y_min,
              CAST(coalesce(points, 0) AS DOUBLE) AS y_pts,
              CAST(row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) - 1 AS DOUBLE) AS x
       FROM logs_etl WHERE game_date BETWEEN {since} AND {as_of})""")
_FIRST_DAY, _LAST_DAY = "(SELECT min(game_date) FROM games)", "(SELECT max(game_date) FROM games)"
_MID_DAY = f"({_FIRST_DAY} + CAST(date_diff('day', {_FIRST_DAY}, {_LAST_DAY}) // 2 AS INTEGER))"


def _trends(spark, sf_dir, as_of, days):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    o = RD.recent_trends(logs, as_of, days)
    return o.select("player_id", "games_played", *[r6(c).alias(c) for c in o.columns[2:]])


@register("an_trends_all_history", _trends_sql(_LAST_DAY, _FIRST_DAY))
def q_an_trends(spark, sf_dir):
    a, b = data_date_range(Domain(spark, sf_dir))
    return _trends(spark, sf_dir, b, (b - a).days)


@register("an_trends_mid_history", _trends_sql(_MID_DAY, f"{_MID_DAY} - 365"))
def q_an_trends_mid(spark, sf_dir):
    """The year before a day in the middle of the data: later games must not count."""
    a, b = data_date_range(Domain(spark, sf_dir))
    return _trends(spark, sf_dir, a + (b - a) // 2, 365)


@register("an_injury_report_all_days", with_ctes("""
SELECT i.injury_date + CAST(t.k AS INTEGER) AS report_date, i.player_id, p.name AS player_name, i.injury_date, i.status,
       i.description, i.body_part, i.games_missed
FROM injuries i CROSS JOIN range(0, 8) t(k) LEFT JOIN players_etl p ON i.player_id = p.player_id"""))
def q_an_injury(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, _, _ = etl_domain(d)
    return RD.injury_report(d.injuries, players)


_LAST_DAY = "(SELECT max(game_date) FROM games)"


@register("an_reads_of_one_day", with_ctes(f"""
SELECT 'slate' AS what, player_id, game_id, CAST(salary AS BIGINT) AS n FROM slate WHERE game_date = {_LAST_DAY}
UNION ALL SELECT 'games', NULL, game_id, home_team_id FROM games WHERE game_date = {_LAST_DAY}
UNION ALL SELECT 'injuries', player_id, NULL, CAST({_LAST_DAY} - injury_date AS BIGINT) FROM injuries
  WHERE injury_date BETWEEN {_LAST_DAY} - 7 AND {_LAST_DAY}""", extra=_SLATE_SQL))
def q_an_one_day(spark, sf_dir):
    """FLT-DAY: slate, games and injury report of the last day alone."""
    d = Domain(spark, sf_dir)
    players, teams, _ = etl_domain(d)
    day = data_date_range(d)[1]
    none = F.lit(None).cast("long")
    slate = RD.dfs_slate(d.dfs_salaries, players, teams, d.games, day).select(F.lit("slate").alias("what"), "player_id", "game_id", F.col("salary").cast("long").alias("n"))
    games = RD.games_for_date(d.games, teams, day).select(F.lit("games").alias("what"), none.alias("player_id"), "game_id", F.col("home_team_id").alias("n"))
    hurt = RD.injury_report(d.injuries, players, day).select(F.lit("injuries").alias("what"), "player_id", none.alias("game_id"),
                                                              F.datediff("report_date", "injury_date").cast("long").alias("n"))
    return slate.unionByName(games).unionByName(hurt)


@register("an_logs_listed_players", with_ctes("""
SELECT player_id, game_id, game_date, minutes, points FROM logs_etl
WHERE player_id IN (SELECT player_id FROM logs_etl GROUP BY player_id ORDER BY sum(coalesce(dfs_points_dk, 0)) DESC, player_id LIMIT 5)"""))
def q_an_listed(spark, sf_dir):
    """FLT-IN: the log view of a list of players, the five best."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    best = [r.player_id for r in RD.top_players_by(logs, 5).collect()]
    return RD.player_game_logs(logs, player_id=best).select("player_id", "game_id", "game_date", "minutes", "points")


def _series_logs(spark, sf_dir):
    """The cleaned logs' scores, staged: the list of players and the series both read them."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    return cut_lineage(logs.select("player_id", "game_id", "game_date", "dfs_points_dk"))


@register("an_correlation_top10", with_ctes("""
SELECT player_a, player_b, round(CASE WHEN count(*) >= 2 AND min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END, 6)
       AS correlation
FROM pr GROUP BY player_a, player_b
UNION ALL
SELECT player_id, player_id, CASE WHEN count(*) >= 2 AND min(v) < max(v) THEN 1.0 END FROM cl GROUP BY player_id""",
                                            extra="""
tp AS (SELECT player_id FROM logs_etl GROUP BY player_id
       ORDER BY sum(coalesce(dfs_points_dk, 0)) DESC, player_id LIMIT 10),
cl AS (SELECT player_id, game_date, CAST(dfs_points_dk AS DOUBLE) AS v FROM logs_etl
       WHERE dfs_points_dk IS NOT NULL AND player_id IN (SELECT player_id FROM tp)),
pr AS (SELECT a.player_id AS player_a, b.player_id AS player_b, a.v AS x, b.v AS y
       FROM cl a JOIN cl b ON a.game_date = b.game_date AND a.player_id <> b.player_id)"""))
def q_an_corr(spark, sf_dir):
    logs = _series_logs(spark, sf_dir)
    o = RD.correlation_matrix(logs, RD.top_players_by(logs, 10))
    return o.withColumn("correlation", r6("correlation"))


@register("an_correlation_all_players", with_ctes("""
SELECT player_a, player_b, round(CASE WHEN count(*) >= 2 AND min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END, 6)
       AS correlation
FROM pr GROUP BY player_a, player_b
UNION ALL
SELECT player_id, player_id, CASE WHEN count(*) >= 2 AND min(v) < max(v) THEN 1.0 END FROM cl GROUP BY player_id""",
                                                  extra="""
cl AS (SELECT player_id, game_date, CAST(dfs_points_dk AS DOUBLE) AS v FROM logs_etl WHERE dfs_points_dk IS NOT NULL),
pr AS (SELECT a.player_id AS player_a, b.player_id AS player_b, a.v AS x, b.v AS y
       FROM cl a JOIN cl b ON a.game_date = b.game_date AND a.player_id <> b.player_id)"""))
def q_an_corr_all(spark, sf_dir):
    """Every player with a log is listed."""
    logs = _series_logs(spark, sf_dir)
    return RD.correlation_matrix(logs, logs.select("player_id")).withColumn("correlation", r6("correlation"))


CHUNK_SIZE = 30
_INJ_FIRST, _INJ_LAST = "(SELECT min(injury_date) FROM injuries)", "(SELECT max(injury_date) FROM injuries)"


# what is done to the series of a player by the remainder of the id: constant, on a large offset, nearly constant
_SERIES_OFFSET = 1e9


@register("an_correlation_constant_series", with_ctes("""
SELECT player_a, player_b, round(CASE WHEN count(*) >= 2 AND min(x) < max(x) AND min(y) < max(y) THEN corr(x, y) END, 6) AS correlation
FROM pr GROUP BY player_a, player_b
UNION ALL
SELECT player_id, player_id, CASE WHEN count(*) >= 2 AND min(v) < max(v) THEN 1.0 END FROM cl GROUP BY player_id""", extra="""
cl AS (SELECT player_id, game_date, CASE player_id % 4 WHEN 0 THEN 0.0 WHEN 2 THEN CASE WHEN game_id % 50 = 0 THEN 1.0 ELSE 0.0 END
              ELSE CAST(dfs_points_dk AS DOUBLE) END AS v FROM logs_etl WHERE dfs_points_dk IS NOT NULL),
pr AS (SELECT a.player_id AS player_a, b.player_id AS player_b, a.v AS x, b.v AS y
       FROM cl a JOIN cl b ON a.game_date = b.game_date AND a.player_id <> b.player_id)"""))
def q_an_corr_constant(spark, sf_dir):
    """A quarter of the series is constant (0.1 throughout), a quarter lies on an offset of 10^9, a quarter differs from
    a constant by 10^-7 on a few dates. Correlation doesn't change with offset and scale, so the oracle leaves both out."""
    logs = _series_logs(spark, sf_dir)
    kind, v = F.col("player_id") % 4, F.col("dfs_points_dk").cast("double")
    changed = F.when(kind == 0, F.lit(0.1)).when(kind == 1, v + F.lit(_SERIES_OFFSET)) \
        .when(kind == 2, F.when(F.col("game_id") % 50 == 0, F.lit(5.0000001)).otherwise(F.lit(5.0))).otherwise(v)
    logs = logs.withColumn("dfs_points_dk", F.when(F.col("dfs_points_dk").isNotNull(), changed))
    return RD.correlation_matrix(logs, logs.select("player_id")).withColumn("correlation", r6("correlation"))


@register("an_series_wide", with_ctes("SELECT game_date, CAST(nth AS BIGINT) AS game_of_day, " + ", ".join(
    f"max(v) FILTER (WHERE place = {k}) AS top_{k}" for k in range(1, 11)) + " FROM cl GROUP BY game_date, nth", extra="""
tp AS (SELECT player_id, row_number() OVER (ORDER BY sum(coalesce(dfs_points_dk, 0)) DESC, player_id) AS place FROM logs_etl
       GROUP BY player_id QUALIFY place <= 10),
cl AS (SELECT l.game_date, tp.place, round(CAST(l.dfs_points_dk AS DOUBLE), 6) AS v,
              row_number() OVER (PARTITION BY l.player_id, l.game_date ORDER BY l.game_id) AS nth
       FROM logs_etl l JOIN tp USING (player_id))"""))
def q_an_series_wide(spark, sf_dir):
    """The series of the ten best players side by side over all dates."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    best = [r.player_id for r in RD.top_players_by(logs, 10).collect()]
    names = [f"top_{k}" for k in range(1, len(best) + 1)]
    wide = RD.wide_series(logs, best, names=names)
    return wide.select("game_date", "game_of_day", *[r6(F.col(c).cast("double")).alias(c) for c in names])


@register("an_injury_period_chunks", with_ctes(f"""
SELECT chunk_id, {_INJ_FIRST} + CAST(chunk_id * {CHUNK_SIZE + 1} AS INTEGER) AS chunk_start,
       least({_INJ_FIRST} + CAST(chunk_id * {CHUNK_SIZE + 1} AS INTEGER) + {CHUNK_SIZE}, {_INJ_LAST}) AS chunk_end,
       count(*) AS n_injuries
FROM (SELECT CAST(floor(date_diff('day', {_INJ_FIRST}, injury_date) / {CHUNK_SIZE + 1}) AS BIGINT) AS chunk_id
      FROM injuries WHERE injury_date BETWEEN {_INJ_FIRST} AND {_INJ_LAST})
GROUP BY chunk_id""", etl=False))
def q_an_chunks(spark, sf_dir):
    inj = Domain(spark, sf_dir).injuries
    r = inj.agg(F.min("injury_date").alias("a"), F.max("injury_date").alias("b")).first()
    c = RD.period_chunks(inj, "injury_date", r.a, r.b, CHUNK_SIZE)
    return c.groupBy("chunk_id", "chunk_start", "chunk_end").agg(F.count(F.lit(1)).alias("n_injuries"))


@register("an_dataset_facts", with_ctes("""
SELECT 'teams' AS dataset, count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM teams
UNION ALL SELECT 'players', count(*), 6 FROM players
UNION ALL SELECT 'games', count(*), 7 FROM games
UNION ALL SELECT 'player_game_logs', count(*), 27 FROM player_game_logs
UNION ALL SELECT 'dfs_salaries', count(*), 6 FROM dfs_salaries
UNION ALL SELECT 'injuries', count(*), 7 FROM injuries""", etl=False))
def q_an_facts(spark, sf_dir):
    d = Domain(spark, sf_dir)
    frames = {"teams": d.teams, "players": d.players, "games": d.games, "player_game_logs": d.player_game_logs,
              "dfs_salaries": d.dfs_salaries, "injuries": d.injuries}
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows",
                                                               F.lit(len(df.columns)).cast("long").alias("n_columns"))
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _training(spark, sf_dir, min_salary=3000):
    """The features go through the store, as a training run reads them."""
    dom = Domain(spark, sf_dir)
    players, _, logs = etl_domain(dom)
    a, b = data_date_range(dom)
    feats = FT.generate_features(logs, players, dom.games, dom.injuries, dom.dfs_salaries, a, b)
    path = _scratch(spark, "training-store")
    EX.store_features(feats, path, version="v1")
    return RD.training_from_store(spark, path, logs, dom.dfs_salaries, "v1", a, b, min_salary), dom


_TRAIN_EXTRA = ["actual_dfs_points", "actual_minutes", "actual_points", "actual_rebounds", "actual_assists",
                "salary", "value"]
_OUTCOME_SQL = """oc AS MATERIALIZED (
  SELECT l.player_id, l.game_date, l.dfs_points_dk AS actual_dfs_points, l.minutes AS actual_minutes, l.points AS actual_points,
         l.rebounds_total AS actual_rebounds, l.assists AS actual_assists, s.salary, s.position,
         CASE WHEN s.salary > 0 THEN l.dfs_points_dk / (s.salary / 1000) ELSE 0.0 END AS value
  FROM logs_etl l JOIN dfs_salaries s ON s.player_id = l.player_id AND s.game_date = l.game_date
  WHERE s.platform = 'DraftKings' AND s.salary >= 3000),
"""
_TRAIN_SQL = """train AS (
  SELECT f.* EXCLUDE (position), oc.* EXCLUDE (player_id, game_date)
  FROM feat f JOIN oc ON f.player_id = oc.player_id AND f.target_date = oc.game_date)"""
_TRAIN_CTES = _OUTCOME_SQL + features_oracle_ctes(OUTCOME_DAYS) + ",\n" + _TRAIN_SQL


def _train_sql_select():
    from courtline.plans.oracle_features import features_select_sql
    base = features_select_sql(source="train").split("\nFROM train")[0]
    extra = ", ".join(["round(actual_dfs_points, 6) AS actual_dfs_points", "actual_minutes", "actual_points",
                       "actual_rebounds", "actual_assists", "salary", "round(value, 6) AS value"])
    return base + ",\n  " + extra + "\nFROM train"


@register("an_training_set", with_ctes(_train_sql_select(), extra=_TRAIN_CTES))
def q_an_training(spark, sf_dir):
    t, _ = _training(spark, sf_dir)
    t = normalized_features(t.select(*FT.FEATURE_COLS, *_TRAIN_EXTRA), _TRAIN_EXTRA)
    return t.withColumns({"actual_dfs_points": r6("actual_dfs_points"), "value": r6("value")})


@register("an_training_bucketed", with_ctes("""
SELECT player_id, target_date, position, round(avg_points_L5, 6) AS avg_points_l5, round(actual_dfs_points, 6) AS actual_dfs_points,
       salary, round(value, 6) AS value FROM train""", extra=_TRAIN_CTES))
def q_an_training_bucketed(spark, sf_dir):
    """JN-TRAIN on co-partitioned tables: features and salaries are bucketed by (player, date), so the three-way join
    exchanges the logs once and neither of the others."""
    dom = Domain(spark, sf_dir)
    players, _, logs = etl_domain(dom)
    a, b = data_date_range(dom)
    feats = FT.generate_features(logs, players, dom.games, dom.injuries, dom.dfs_salaries, a, b, opponent=False, injury=False, salary=False,
                                 only=("position", "avg_points_L5"))
    return RD.training_from_buckets(spark, feats.select("player_id", "target_date", "position", "avg_points_L5"), logs, dom.dfs_salaries,
                                    _scratch(spark, "buckets"), buckets=8).select(
        "player_id", "target_date", "position", r6("avg_points_L5").alias("avg_points_l5"), r6("actual_dfs_points").alias("actual_dfs_points"),
        "salary", r6("value").alias("value"))


@register("an_export_summary", with_ctes("""
SELECT count(*) FILTER (WHERE k) AS records, count(*) FILTER (WHERE NOT k) AS filtered_out,
       min(target_date) FILTER (WHERE k) AS first_date, max(target_date) FILTER (WHERE k) AS last_date,
       count(DISTINCT player_id) FILTER (WHERE k) AS unique_players,
       round(avg(actual_dfs_points) FILTER (WHERE k), 6) AS target_mean,
       round(stddev_samp(actual_dfs_points) FILTER (WHERE k), 6) AS target_std
FROM (SELECT *, coalesce(salary >= 5000 AND actual_minutes >= 20, FALSE) AS k FROM train)""",
                                         extra=_TRAIN_CTES))
def q_an_export(spark, sf_dir):
    s = RD.export_summary(_training(spark, sf_dir)[0], min_salary=5000, min_minutes=20)
    return s.withColumns({"target_mean": r6("target_mean"), "target_std": r6("target_std")})


@register("io_training_export", with_ctes("""
SELECT t.player_id, t.target_date, t.position, round(t.actual_dfs_points, 6) AS actual_dfs_points, t.actual_minutes,
       round(t.value, 6) AS value, t.salary AS salary_dk, f.salary_fd
FROM train t LEFT JOIN (SELECT player_id, game_date, max(salary) AS salary_fd FROM dfs_salaries
                        WHERE platform = 'FanDuel' GROUP BY player_id, game_date) f
  ON t.player_id = f.player_id AND t.target_date = f.game_date
WHERE (t.salary >= 5000 OR f.salary_fd >= 5000) AND t.actual_minutes >= 20""", extra=_TRAIN_CTES))
def q_io_training_export(spark, sf_dir):
    """Both platforms' salaries, the export thresholds, rows written and read back."""
    t, dom = _training(spark, sf_dir)
    path = _scratch(spark, "training-export")
    RD.export_training(RD.with_fanduel(t, dom.dfs_salaries), path, min_salary=5000, min_minutes=20)
    back = FS.read_parquet(spark, path)
    return back.select("player_id", "target_date", "position", r6("actual_dfs_points").alias("actual_dfs_points"), "actual_minutes",
                       r6("value").alias("value"), "salary_dk", "salary_fd")


# ---------------------------------------------------------------------------------------------
# sources, sinks, upserts, exports

import uuid  # noqa: E402

from courtline.operators import sinks as SK  # noqa: E402
from courtline.plans import exports as EX  # noqa: E402
from courtline.session import cut_lineage, scratch_path, write_text  # noqa: E402
from courtline.sources import files as FS  # noqa: E402


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_DUCK = {"smallint": "SMALLINT", "tinyint": "TINYINT", "int": "INTEGER", "float": "FLOAT"}


def _as_stored(expr: str, name: str, types: dict) -> str:
    """SQL of a typed column; floats come back as rounded doubles on both sides."""
    t = types.get(name)
    if t == "float":
        return f"round(CAST(CAST({expr} AS FLOAT) AS DOUBLE), 4) AS {name}"
    return f"TRY_CAST({expr} AS {_DUCK[t]}) AS {name}" if t else f"{expr} AS {name}"


def _floats_back(df, types):
    return df.withColumns({c: F.round(F.col(c).cast("double"), 4) for c, t in types.items() if t == "float" and c in df.columns})


_SEASON_SQL_OF = ("CAST(CASE WHEN month({0}) >= 10 THEN year({0}) ELSE year({0}) - 1 END AS VARCHAR) || '-' || "
                  "lpad(CAST((CASE WHEN month({0}) >= 10 THEN year({0}) ELSE year({0}) - 1 END + 1) % 100 AS VARCHAR), 2, '0')")


def _export_sql_cols():
    out = []
    for c in EX.LOG_EXPORT_COLS:
        if c == "team_id":
            out.append("p.team_id")
        elif c == "month":
            out.append("CAST(month(l.game_date) AS INTEGER) AS month")
        elif c == "season":
            out.append(_SEASON_SQL_OF.format("l.game_date") + " AS season")
        elif c in EX.LOG_EXPORT_DEFAULTS:
            v = EX.LOG_EXPORT_DEFAULTS[c]
            lit = "FALSE" if v is False else (f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v))
            out.append(_as_stored(f"coalesce({'l.' + c if c in _ETL_OUT else 'NULL'}, {lit})", c, EX.LOG_TYPES))
        else:
            out.append(f"l.{c}")
    return ", ".join(out)


_EXPORT_SQL = f"""logs_export AS (
  SELECT {_export_sql_cols()}
  FROM logs_etl l LEFT JOIN players_etl p ON l.player_id = p.player_id)"""


def _exported_logs(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, _, logs = etl_domain(d)
    path = _scratch(spark, "export-logs")
    EX.export_logs(logs, players, path)
    return spark, path


@register("io_export_logs_roundtrip", with_ctes("SELECT * FROM logs_export", extra=_EXPORT_SQL))
def q_io_export(spark, sf_dir):
    _, path = _exported_logs(spark, sf_dir)
    return _floats_back(FS.read_parquet(spark, path).select(*EX.LOG_EXPORT_COLS), EX.LOG_TYPES)


@register("io_dataset_summary_by_season", with_ctes(
    "SELECT season, count(*) AS records FROM logs_export GROUP BY season", extra=_EXPORT_SQL))
def q_io_summary(spark, sf_dir):
    _, path = _exported_logs(spark, sf_dir)
    return FS.records_by(spark, path, ["season"])


@register("io_feature_store_json_read", with_ctes(features_select_sql(), extra=features_oracle_ctes()))
def q_io_feature_store(spark, sf_dir):
    feats = features_for(spark, sf_dir)
    path = _scratch(spark, "feature-store")
    EX.store_features(feats, path, version="v1", as_json=True)
    stored = EX.read_features(spark, path, version="v1")
    schema = feats.drop("player_id", "target_date").schema
    return normalized_features(EX.expand_features(stored, schema).select(*FT.FEATURE_COLS))


@register("io_feature_store_by_day", with_ctes(features_select_sql(), extra=features_oracle_ctes()))
def q_io_store_by_day(spark, sf_dir):
    """Saved in three writes that cut through each season, one of them twice, beside another version: the stored
    version equals the batch."""
    feats = cut_lineage(features_for(spark, sf_dir))     # saved in five parts
    path = _scratch(spark, "feature-days")
    day = F.dayofmonth("target_date") % 3
    EX.store_features(feats.where(day == 0).withColumn("last_game_points", F.lit(-1.0)), path, version="v1")
    EX.store_features(feats.where(day == 1), path, version="v2")
    for k in (0, 1, 2):
        EX.store_features(feats.where(day == k), path, version="v1")
    return normalized_features(EX.read_features(spark, path, version="v1").select(*FT.FEATURE_COLS))


_MORE_WINDOWS = (3, 5, 7, 10, 15, 30)


@register("io_feature_store_two_versions", with_ctes(f"""
SELECT 'v1' AS version, * FROM ({features_select_sql()}) UNION ALL BY NAME
SELECT 'v2' AS version, * FROM ({features_select_sql(FT.feature_cols(_MORE_WINDOWS))})""", extra=features_oracle_ctes(windows=_MORE_WINDOWS)))
def q_io_store_two_versions(spark, sf_dir):
    """A version with two more rolling windows is stored beside the first, in two saves: each reads back whole and
    with its own columns (NULL here where the first has none)."""
    feats = cut_lineage(features_for(spark, sf_dir, windows=_MORE_WINDOWS))
    path = _scratch(spark, "feature-versions")
    even = F.dayofmonth("target_date") % 2 == 0
    EX.store_features(feats.select(*FT.FEATURE_COLS), path, version="v1")
    EX.store_features(feats.where(even), path, version="v2")
    EX.store_features(feats.where(~even), path, version="v2")
    EX.store_features(feats.where(even).select(*FT.FEATURE_COLS), path, version="v1")
    stored = ["feature_set_version", "season", "created_at"]
    first, second = (EX.read_features(spark, path, v).drop(*stored) for v in ("v1", "v2"))
    both = first.withColumn("version", F.lit("v1")).unionByName(second.withColumn("version", F.lit("v2")), allowMissingColumns=True)
    return normalized_features(both, ["version"])


UPSERT_SPLIT, UPSERT_OVERLAP = "1999-01-01", "1998-12-01"


@register("io_upsert_replay", with_ctes(f"""
SELECT player_id, game_id, game_date,
       CASE WHEN game_date >= DATE '{UPSERT_OVERLAP}' THEN points + 1 ELSE points END AS points, dfs_points_dk
FROM logs_etl"""))
def q_io_upsert(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    base = cut_lineage(logs.select("player_id", "game_id", "game_date", "points", "dfs_points_dk",     # read three times
                                   F.year("game_date").alias("year")))
    path = _scratch(spark, "upsert")
    SK.write_partitioned(base.where(F.col("game_date") < F.lit(UPSERT_SPLIT).cast("date")), path, ["year"])
    upd = base.where(F.col("game_date") >= F.lit(UPSERT_OVERLAP).cast("date")).withColumn("points", F.col("points") + 1)
    for _ in range(2):  # the replay of the same batch must not change the table
        SK.upsert_partitioned(spark, path, upd.withColumn("_seq", F.lit(1)), ["player_id", "game_id"], ["year"], "_seq")
    return spark.read.parquet(path).select("player_id", "game_id", "game_date", "points", "dfs_points_dk")


@register("io_upsert_moved_key", with_ctes("""
SELECT player_id, game_id, CASE WHEN game_id % 4 = 0 THEN game_date + 366 ELSE game_date END AS game_date, points,
       CAST(year(CASE WHEN game_id % 4 = 0 THEN game_date + 366 ELSE game_date END) AS INTEGER) AS year FROM logs_etl"""))
def q_io_upsert_moved(spark, sf_dir):
    """Every fourth game is moved by a year, into another partition: the old row must go."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    base = cut_lineage(logs.select("player_id", "game_id", "game_date", "points", F.year("game_date").alias("year")))
    path = _scratch(spark, "upsert-moved")
    SK.write_partitioned(base, path, ["year"])
    moved = base.where("game_id % 4 = 0").withColumn("game_date", F.date_add("game_date", 366)).withColumn("year", F.year("game_date"))
    SK.upsert_partitioned(spark, path, moved.withColumn("_seq", F.lit(1)), ["player_id", "game_id"], ["year"], "_seq")
    return spark.read.parquet(path).select("player_id", "game_id", "game_date", "points", "year")


@register("io_upsert_two_versions", with_ctes("SELECT player_id, game_id, points + 2 AS points FROM logs_etl"))
def q_io_upsert_versions(spark, sf_dir):
    """Two versions of each row in one batch: the later one wins."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    base = cut_lineage(logs.select("player_id", "game_id", "points", F.year("game_date").alias("year")))
    path = _scratch(spark, "upsert-versions")
    SK.write_partitioned(base, path, ["year"])
    both = [base.withColumns({"points": F.col("points") + v, "_seq": F.lit(v)}) for v in (2, 1)]
    SK.upsert_partitioned(spark, path, both[0].unionByName(both[1]), ["player_id", "game_id"], ["year"], "_seq")
    return spark.read.parquet(path).select("player_id", "game_id", "points")


@register("io_upsert_after_crash", with_ctes("""
SELECT player_id, game_id, CASE WHEN game_id % 4 = 0 THEN game_date + 366 ELSE game_date END AS game_date, points,
       CAST(year(CASE WHEN game_id % 4 = 0 THEN game_date + 366 ELSE game_date END) AS INTEGER) AS year
FROM logs_etl WHERE game_id % 4 = 0 OR year(game_date) > 1996"""))
def q_io_upsert_crash(spark, sf_dir):
    """The whole first years move to others, so their partitions are emptied. The writer stops after the new
    partitions are in place and before the old files are gone; the same batch comes again. One row a key is left,
    as after one clean write."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    base = cut_lineage(logs.select("player_id", "game_id", "game_date", "points", F.year("game_date").alias("year"))
                       .where("game_id % 4 = 0 or year > 1996"))
    path = _scratch(spark, "upsert-crash")
    SK.write_partitioned(base, path, ["year"])
    moved = base.where("game_id % 4 = 0").withColumn("game_date", F.date_add("game_date", 366)).withColumn("year", F.year("game_date"))
    batch = (moved.withColumn("_seq", F.lit(1)), ["player_id", "game_id"], ["year"], "_seq")
    record = SK.decide_upsert(spark, path, *batch)
    SK.replace_partitions(spark, path, record)
    SK.upsert_partitioned(spark, path, *batch)
    return SK.read_table(spark, path).select("player_id", "game_id", "game_date", "points", "year")


@register("io_upsert_null_key", with_ctes("""
SELECT k AS player_id, g AS game_id, max(points) + 1 AS points FROM (
  SELECT CASE WHEN player_id % 7 = 0 THEN NULL ELSE player_id END AS k, CASE WHEN game_id % 5 = 0 THEN NULL ELSE game_id END AS g, points
  FROM logs_etl) GROUP BY k, g"""))
def q_io_upsert_null_key(spark, sf_dir):
    """Keys with NULL parts, written three times: a NULL key is a key like any other, one row each."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    rows = logs.select(F.when(F.col("player_id") % 7 != 0, F.col("player_id")).alias("player_id"),
                       F.when(F.col("game_id") % 5 != 0, F.col("game_id")).alias("game_id"), "points",
                       F.col("points").alias("_order"))
    rows = cut_lineage(rows.withColumn("half", F.coalesce(F.col("player_id"), F.lit(0)) % 2))    # follows from the key
    path = _scratch(spark, "upsert-null")
    for more in (0, 1, 1):
        SK.upsert_partitioned(spark, path, rows.withColumn("points", F.col("points") + more), ["player_id", "game_id"], ["half"], "_order")
    return SK.read_table(spark, path).select("player_id", "game_id", "points")


@register("io_upsert_stored_duplicates", with_ctes("""
SELECT player_id, game_id, points + 1 AS points, version + 1 AS version, CASE WHEN game_id % 2 = 0 THEN 'late' END AS note
FROM (SELECT *, 2 AS version FROM logs_etl)"""))
def q_io_upsert_duplicates(spark, sf_dir):
    """A table that holds each key twice, in two versions, is merged with newer rows, half of which bring a column
    of their own: one row a key is left, the column NULL in the others."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    base = cut_lineage(logs.select("player_id", "game_id", "points", F.year("game_date").alias("year")))
    path = _scratch(spark, "upsert-duplicates")
    both = [base.withColumns({"points": F.col("points") + v - 2, "version": F.lit(v)}) for v in (1, 2)]
    SK.write_partitioned(both[0].unionByName(both[1]), path, ["year"])
    new = base.withColumns({"points": F.col("points") + 1, "version": F.lit(3)})
    even = F.col("game_id") % 2 == 0
    SK.upsert_partitioned(spark, path, new.where(even).withColumn("note", F.lit("late")), ["player_id", "game_id"], ["year"], "version")
    SK.upsert_partitioned(spark, path, new.where(~even), ["player_id", "game_id"], ["year"], "version")
    return SK.read_table(spark, path).select("player_id", "game_id", "points", "version", "note")


@register("io_players_ingest", with_ctes("""
SELECT p.id, p.player_id, CASE WHEN p.id % 2 = 0 THEN 'New ' || p.name ELSE p.name END AS name, p.team_id, p.position,
       DATE '1990-01-01' + CAST(p.id % 1000 AS INTEGER) AS birth_date, CASE WHEN p.id % 2 = 0 THEN TRUE ELSE p.is_active END AS is_active
FROM players p WHERE p.id % 5 <> 0
UNION ALL
SELECT p.id + 28268405000, p.id + 28268405000, 'New ' || p.name, p.team_id, p.position, DATE '2000-02-29', TRUE FROM players p WHERE p.id % 5 = 0""",
                                         etl=False))
def q_io_players(spark, sf_dir):
    """Raw player rows (strings): every second known player is renamed (birth date and id stay), ids of eleven
    digits are new, an id that doesn't parse is skipped."""
    p = Domain(spark, sf_dir).players
    table = p.where("id % 5 <> 0").withColumn("birth_date", F.expr("date_add(DATE'1990-01-01', cast(id % 1000 as int))"))
    new = F.col("id") % 5 == 0
    raw = p.where(new | (F.col("id") % 2 == 0)).select(
        F.when(new, F.col("id") + 28268405000).otherwise(F.col("id")).cast("string").alias("playerID"),
        F.concat(F.lit("New "), "name").alias("longName"), F.lit(None).cast("string").alias("playerName"),
        F.col("team_id").cast("string").alias("teamID"), F.col("position").alias("pos"), F.lit("20000229").alias("bDay"),
        F.lit("Active").alias("status"), F.lit(2).alias("_seq"))
    bad = raw.limit(1).withColumn("playerID", F.lit("n/a"))
    old = raw.withColumns({"longName": F.lit("stale"), "_seq": F.lit(1)})
    return SK.upsert_players(table, raw.unionByName(old).unionByName(bad), "_seq")


@register("io_teams_ingest", with_ctes("""
SELECT team_id, upper(abbreviation) AS abbreviation, 'City ' || name AS name, coalesce(conference, '') AS conference, '' AS division
FROM teams""", etl=False))
def q_io_teams(spark, sf_dir):
    t = Domain(spark, sf_dir).teams
    raw = t.select(F.col("team_id").cast("string").alias("teamID"), F.lower("abbreviation").alias("teamAbv"), F.lit("City").alias("teamCity"),
                   F.col("name").alias("teamName"), "conference", "division")
    return SK.raw_teams(raw.unionByName(raw.withColumn("teamID", F.lit(""))))


_BOX_MAP = dict(SK._BOX_INT)
_BOX_SRC = {"pts": "points", "fgm": "field_goals_made", "fga": "field_goals_attempted", "tpm": "three_pointers_made",
            "tpa": "three_pointers_attempted", "ftm": "free_throws_made", "fta": "free_throws_attempted",
            "oreb": "rebounds_offensive", "dreb": "rebounds_defensive", "reb": "rebounds_total", "ast": "assists",
            "stl": "steals", "blk": "blocks", "tov": "turnovers", "pf": "personal_fouls", "min": "minutes"}


def _box_rows(logs, players):
    """Box-score rows as the API sends them (all strings), built from the adapter logs."""
    p = players.select("player_id", F.col("name").alias("longName"), "team_id", F.col("position").alias("pos"))
    j = logs.join(p, "player_id", "left")
    cols = [F.col("player_id").cast("string").alias("playerID"), "longName", F.lit(None).cast("string").alias("playerName"),
            F.col("team_id").cast("string").alias("teamID"), "pos", F.col("game_id").cast("string").alias("gameID")]
    cols += [F.col(src).cast("string").alias(api) for api, src in _BOX_SRC.items()]
    cols += [F.lit(None).cast("string").alias(c) for c in ("fg_pct", "tp_pct", "ft_pct", "plusMinus", "fantasyPoints")]
    cols += [F.when(F.col("game_id") % 3 == 0, "True").otherwise("false").alias("starter")]
    return j.select(*cols)


_BOX_SQL = """box AS (
  SELECT CAST(l.player_id AS BIGINT) AS player_id, l.game_id, l.game_date, l.minutes,
         """ + ", ".join(f"l.{c}" for c in ("points", "field_goals_made", "field_goals_attempted", "three_pointers_made",
                                            "three_pointers_attempted", "free_throws_made", "free_throws_attempted",
                                            "rebounds_offensive", "rebounds_defensive", "rebounds_total", "assists",
                                            "steals", "blocks", "turnovers", "personal_fouls")) + """,
         coalesce(coalesce(p.team_id, 0) = g.home_team_id, FALSE) AS is_home,
         CASE WHEN coalesce(coalesce(p.team_id, 0) = g.home_team_id, FALSE) THEN g.away_team_id ELSE g.home_team_id END AS opponent_team_id,
         l.game_id % 3 = 0 AS is_starter, p.name, p.team_id, p.position
  FROM player_game_logs l LEFT JOIN players p ON l.player_id = p.player_id JOIN games g ON l.game_id = g.game_id)"""


@register("io_box_score_ingest", with_ctes("SELECT * FROM box WHERE player_id > 0", etl=False, extra=_BOX_SQL))
def q_io_box(spark, sf_dir):
    d = Domain(spark, sf_dir)
    rows = _box_rows(d.player_game_logs, d.players)
    path = _scratch(spark, "box-landing")
    rows.write.mode("overwrite").option("compression", "lz4").json(path)    # its names repeat in every row
    raw = spark.read.schema(", ".join(f"`{c}` string" for c in rows.columns)).json(path)
    good, _bad = SK.box_scores_to_logs(raw, d.games)
    return good.select("player_id", "game_id", "game_date", "minutes", *[c for c, _ in SK._BOX_INT
                                                                        if c != "plus_minus"],
                       "is_home", "opponent_team_id", "is_starter", "name", "team_id", "position")


_LONG_ID = 28268405000


@register("io_box_score_long_ids", with_ctes(f"SELECT player_id + {_LONG_ID} AS player_id, game_id, points, team_id + {_LONG_ID} AS team_id FROM box",
                                             etl=False, extra=_BOX_SQL))
def q_io_box_long(spark, sf_dir):
    """Ids of eleven digits keep every digit; ids that don't parse or are not positive are set apart."""
    d = Domain(spark, sf_dir)
    rows = _box_rows(d.player_game_logs, d.players)
    long = rows.withColumns({c: (F.col(c).cast("long") + _LONG_ID).cast("string") for c in ("playerID", "teamID")})
    bad = rows.withColumn("playerID", F.when(F.col("gameID").cast("long") % 2 == 0, "-5").otherwise("abc"))
    good, apart = SK.box_scores_to_logs(long.unionByName(bad), d.games)
    return good.join(apart.select(F.col("player_id").alias("_p"), "game_id"), (F.col("player_id") == F.col("_p")) & (good.game_id == apart.game_id),
                     "left_anti").select("player_id", "game_id", "points", "team_id")


@register("io_stub_players", with_ctes("""
SELECT DISTINCT l.player_id AS id, l.player_id, p.name, p.team_id, p.position, TRUE AS is_active
FROM player_game_logs l JOIN players p ON l.player_id = p.player_id WHERE NOT p.is_active""", etl=False))
def q_io_stub(spark, sf_dir):
    """Players seen in box scores but missing from the player table (here: the table without the
    inactive players) get minimal rows."""
    d = Domain(spark, sf_dir)
    good, _ = SK.box_scores_to_logs(_box_rows(d.player_game_logs, d.players), d.games)
    return SK.stub_players(good, d.players.where("is_active"))


def _odds_docs(games):
    """Odds documents built from the games: game_id % 3 sportsbooks per game (0 books -> no rows)."""
    books = F.filter(F.array(*[F.struct(F.lit(name).alias("sportsBook"), F.lit(k).alias("k")) for k, name in
                               enumerate(("fanduel", "draftkings"))]), lambda b: b["k"] < F.col("game_id") % 3)
    g = games.select("*", books.alias("_books"))
    odds = F.transform("_books", lambda b: F.struct(
        b["sportsBook"].alias("sportsBook"),
        F.struct(F.col("total_line").cast("string").alias("totalOver"), F.col("total_line").cast("string").alias("totalUnder"),
                 (F.lit(-110) - b["k"] * 5).cast("string").alias("totalOverOdds"),
                 (F.lit(-110) + b["k"] * 5).cast("string").alias("totalUnderOdds"),
                 F.col("home_spread").cast("string").alias("homeTeamSpread"),
                 F.col("away_spread").cast("string").alias("awayTeamSpread"),
                 F.lit("-110").alias("homeTeamSpreadOdds"), F.lit("-110").alias("awayTeamSpreadOdds"),
                 (F.col("home_spread") * 10).cast("int").cast("string").alias("homeTeamMLOdds"),
                 (F.col("away_spread") * 10).cast("int").cast("string").alias("awayTeamMLOdds")).alias("odds")))
    game = F.struct(F.col("game_id").cast("string").alias("gameID"), F.date_format("game_date", "yyyyMMdd").alias("gameDate"),
                    F.col("home_team_id").cast("string").alias("homeTeam"), F.col("away_team_id").cast("string").alias("awayTeam"),
                    F.col("home_team_id").cast("string").alias("teamIDHome"),
                    F.col("away_team_id").cast("string").alias("teamIDAway"),
                    F.lit(None).cast("string").alias("last_updated_e_time"), odds.alias("sportsBooks"))
    # one document per day and block of 16 consecutive game ids: a document never holds more than 16
    # games, however many games a day has
    return (g.groupBy("game_date", F.floor(F.col("game_id") / 16).alias("_b"))
            .agg(F.collect_list(game).alias("body")).select("body"))


@register("io_odds_flatten", with_ctes("""
SELECT CAST(g.game_id AS VARCHAR) AS game_id, CASE k WHEN 0 THEN 'fanduel' ELSE 'draftkings' END AS sportsbook,
       g.home_spread, g.away_spread, -110 AS home_spread_odds, -110 AS away_spread_odds,
       CAST(g.home_spread * 10 AS INTEGER) AS home_moneyline, CAST(g.away_spread * 10 AS INTEGER) AS away_moneyline,
       g.total_line AS total_points, CAST(-110 - k * 5 AS INTEGER) AS over_odds,
       CAST(-110 + k * 5 AS INTEGER) AS under_odds
FROM games g JOIN range(0, 2) t(k) ON t.k < g.game_id % 3""", etl=False))
def q_io_odds(spark, sf_dir):
    d = Domain(spark, sf_dir)
    path = _scratch(spark, "odds-docs")
    _odds_docs(d.games).write.mode("overwrite").json(path)
    flat = FS.flatten_odds(FS.read_documents(spark, path, FS.ODDS_DOC))
    return SK.raw_odds(flat, "2024-01-01 00:00:00").drop("timestamp")


def _salary_docs(sal):
    row = F.struct(F.col("player_id").cast("string").alias("playerID"), F.lit(None).cast("string").alias("longName"),
                   F.col("position").alias("pos"), F.lit(None).cast("string").alias("team"),
                   F.lit(None).cast("string").alias("teamID"), F.col("salary").cast("string").alias("salary"))
    arrays = {k: F.collect_list(F.when(F.col("platform") == name, row)) for k, name in FS.PLATFORM_ARRAYS}
    # one document per day and block of 16 consecutive player ids (at most 16 players x 3 platforms)
    return (sal.groupBy(F.date_format("game_date", "yyyyMMdd").alias("date_str"),
                        F.floor(F.col("player_id") / 16).alias("_b"))
            .agg(*[v.alias(k) for k, v in arrays.items()])
            .select("date_str", F.struct(*[F.col(k) for k, _ in FS.PLATFORM_ARRAYS]).alias("body")))


@register("io_salary_flatten", with_ctes("""
SELECT player_id, game_date, platform, salary, coalesce(position, '') AS position, TRUE AS is_available FROM dfs_salaries""", etl=False))
def q_io_salary(spark, sf_dir):
    d = Domain(spark, sf_dir)
    path = _scratch(spark, "salary-docs")
    _salary_docs(d.dfs_salaries).write.mode("overwrite").json(path)
    docs = FS.read_documents(spark, path, T.StructType([*FS.SALARY_DOC.fields, T.StructField("date_str", T.StringType())]))
    flat = FS.flatten_salaries(docs, carry=["date_str"])
    return SK.raw_salaries(flat).select("player_id", "game_date", "platform", "salary", "position", "is_available")


@register("io_gap_dates", with_ctes("""
SELECT CAST(d AS DATE) AS missing_date
FROM generate_series(CAST((SELECT min(game_date) FROM games) AS TIMESTAMP),
                     CAST((SELECT max(game_date) FROM games) AS TIMESTAMP), INTERVAL 1 DAY) s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT game_date FROM games)""", etl=False))
def q_io_gaps(spark, sf_dir):
    g = Domain(spark, sf_dir).games
    spine = FS.date_spine_between(g, "game_date", "game_date", "game_date")
    return SK.missing(spine, g, ["game_date"]).select(F.col("game_date").alias("missing_date"))


@register("io_csv_folder_union", with_ctes("""
SELECT player_id, injury_date, status, CASE WHEN status = 'Out' THEN body_part END AS body_part FROM injuries""",
                                           etl=False))
def q_io_csv(spark, sf_dir):
    inj = Domain(spark, sf_dir).injuries
    root = _scratch(spark, "csv-landing")
    SK.write_csv(inj.where("status = 'Out'").select("player_id", "injury_date", "status", "body_part"), f"{root}/out")
    SK.write_csv(inj.where("status <> 'Out'").select("player_id", "status", "injury_date"), f"{root}/questionable")
    df = FS.read_csv_dir(spark, [f"{root}/out", f"{root}/questionable"])
    return df.select(F.col("player_id").cast("long").alias("player_id"),
                     F.to_date("injury_date").alias("injury_date"), "status", "body_part")


_CSV_SCHEMA = T.StructType([T.StructField("player_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("team_id", T.LongType())])


def _csv_landing(spark, sf_dir):
    """Players as landing files: two good ones with their columns in another order, one whose last line is cut, one
    with a value of another type, a broken archive, one that isn't text, an empty one."""
    players = Domain(spark, sf_dir).players.select("player_id", F.regexp_replace("name", "[,\"]", " ").alias("name"), "team_id")
    root = _scratch(spark, "csv-bad")
    part = F.col("player_id") % 4
    SK.write_csv(players.where(part == 0), f"{root}/good")
    SK.write_csv(players.where(part == 1).select("team_id", "name", "player_id"), f"{root}/reordered")
    few = players.where(part == 2).orderBy("player_id").limit(20).collect()
    lines = [f"{r.player_id},{r.name},{'' if r.team_id is None else r.team_id}" for r in few]
    head = "player_id,name,team_id\n"
    write_text(spark, f"{root}/odd/cut.csv", head + "\n".join([*lines[:10], "77,cut of"]))
    write_text(spark, f"{root}/odd/typed.csv", head + "\n".join([*lines[10:], "n/a,no number,1", ""]))
    write_text(spark, f"{root}/odd/junk.csv", "\x00\x01\ufffdPNG\n\x02")
    write_text(spark, f"{root}/odd/broken.csv.gz", head)
    write_text(spark, f"{root}/odd/empty.csv", "")
    return FS.scan_csv_dir(spark, [f"{root}/{d}" for d in ("good", "reordered", "odd")], schema=_CSV_SCHEMA)


@register("io_csv_bad_files", with_ctes("""
SELECT player_id, regexp_replace(name, '[,"]', ' ', 'g') AS name, team_id FROM players
WHERE player_id % 4 IN (0, 1) OR player_id IN (SELECT player_id FROM players WHERE player_id % 4 = 2 ORDER BY player_id LIMIT 20)""", etl=False))
def q_io_csv_bad(spark, sf_dir):
    """The good rows of a folder with bad files and bad lines, files with their columns in another order among them."""
    return _csv_landing(spark, sf_dir).rows


@register("io_csv_file_report", with_ctes("""
SELECT kind, status, CAST(sum(records) AS BIGINT) AS records, CAST(sum(bad_records) AS BIGINT) AS bad_records, reason FROM (
  SELECT 'part' AS kind, 'ok' AS status, count(*) AS records, 0 AS bad_records, NULL AS reason FROM players WHERE player_id % 4 IN (0, 1)
  UNION ALL SELECT 'cut.csv', 'partial', least(n, 10), 1, NULL FROM few
  UNION ALL SELECT 'typed.csv', 'partial', greatest(n - 10, 0), 1, NULL FROM few
  UNION ALL VALUES ('junk.csv', 'skipped', 0, 0, 'header is not text'), ('broken.csv.gz', 'skipped', 0, 0, 'not a compressed file'),
                   ('empty.csv', 'empty', 0, 0, NULL))
GROUP BY kind, status, reason""", extra="few AS (SELECT least(count(*), 20) AS n FROM players WHERE player_id % 4 = 2)", etl=False))
def q_io_csv_report(spark, sf_dir):
    """The report of the same folder, Spark's part files taken together."""
    name = F.regexp_extract("file", "([^/]+)$", 1)
    kind = F.when(name.startswith("part-"), "part").otherwise(name)
    return _csv_landing(spark, sf_dir).files.where("status <> 'ok' or records > 0").groupBy(kind.alias("kind"), "status", "reason") \
        .agg(F.sum("records").alias("records"), F.sum("bad_records").alias("bad_records"))


@register("io_dataset_status", with_ctes("""
SELECT 'logs' AS dataset, 'ok' AS status, count(*) AS records, CAST(29 AS BIGINT) AS n_columns, TRUE AS has_files FROM player_game_logs
UNION ALL SELECT 'salaries', 'ok', count(*), 4, TRUE FROM dfs_salaries
UNION ALL SELECT 'broken', 'error', NULL, NULL, TRUE
UNION ALL SELECT 'odds', 'not_collected', NULL, NULL, FALSE
UNION ALL SELECT 'total', 'incomplete', (SELECT count(*) FROM player_game_logs) + (SELECT count(*) FROM dfs_salaries), NULL, TRUE""", etl=False))
def q_io_status(spark, sf_dir):
    """Status of stored datasets: a partitioned one, a plain one, one that can't be read and one that isn't there."""
    d = Domain(spark, sf_dir)
    root = _scratch(spark, "status")
    logs = d.player_game_logs
    SK.write_partitioned(logs.withColumns({"year": F.year("game_date"), "month": F.month("game_date")}).select(*logs.columns[:27], "year", "month"),
                         f"{root}/logs", ["year"])
    SK.write_dataset(d.dfs_salaries.select("player_id", "game_date", "platform", "salary"), f"{root}/salaries")
    write_text(spark, f"{root}/broken/part-0.parquet", "no parquet")
    status = FS.dataset_status(spark, {k: f"{root}/{k}" for k in ("logs", "salaries", "broken", "odds")})
    return status.select("dataset", "status", "records", "n_columns", (F.col("files") > 0).alias("has_files"))


_FORMATS_SQL = "SELECT '{0}' AS format, count(*) AS n_rows, CAST(sum(player_id) AS BIGINT) AS ids, count(DISTINCT name) AS names, TRUE AS written FROM players"


@register("io_formats_roundtrip", with_ctes(" UNION ALL ".join(_FORMATS_SQL.format(f) for f in SK.FORMATS) + """
UNION ALL SELECT 'parquet again', count(*), CAST(sum(player_id) AS BIGINT), count(DISTINCT name), TRUE FROM players WHERE player_id % 2 = 0
UNION ALL SELECT 'nothing', count(*), CAST(sum(player_id) AS BIGINT), count(DISTINCT name), FALSE FROM players WHERE player_id % 2 = 0
UNION ALL SELECT 'empty', 0, NULL, 0, TRUE""", etl=False))
def q_io_formats(spark, sf_dir):
    """SNK-FMT and SNK-EMPTY: each format written and read back; an overwrite replaces, an empty frame leaves what is
    there; an empty dataset with a declared schema can be read."""
    players = Domain(spark, sf_dir).players.select("player_id", "name")
    root, schema = _scratch(spark, "formats"), "player_id long, name string"

    def told(name, fmt, written, path):
        back = spark.read.schema(schema).option("header", True).format(fmt).load(path)
        return back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("player_id").alias("ids"), F.count_distinct("name").alias("names")) \
            .select(F.lit(name).alias("format"), "n_rows", "ids", "names", F.lit(written).alias("written"))

    out = [told(f, f, SK.write_dataset(players, f"{root}/{f}", f), f"{root}/{f}") for f in SK.FORMATS]
    again = f"{root}/again"
    SK.write_dataset(players, again)
    done = SK.write_dataset(players.where("player_id % 2 = 0"), again)
    out.append(told("parquet again", "parquet", done, again))
    out.append(told("nothing", "parquet", SK.write_dataset(players.where("player_id < 0"), again), again))
    SK.empty(spark, players.schema).write.parquet(f"{root}/empty")
    out.append(told("empty", "parquet", True, f"{root}/empty"))
    return SK.union_all(out)


@register("qual_export_overflow", with_ctes("""
SELECT 'logs' AS dataset, 'points' AS column_name, count(*) FILTER (WHERE points * 1000 > 32767) AS n FROM logs_etl HAVING n > 0
UNION ALL SELECT 'logs', 'plus_minus', count(*) FILTER (WHERE rebounds_total * 10 > 127) AS n FROM logs_etl HAVING n > 0
UNION ALL SELECT 'salaries', 'salary', count(*) FILTER (WHERE CAST(salary AS BIGINT) * 1000000 > 2147483647) AS n FROM dfs_salaries HAVING n > 0
UNION ALL SELECT 'odds', 'home_moneyline', count(*) FILTER (WHERE game_id % 3 = 0) AS n FROM games HAVING n > 0"""))
def q_qual_overflow(spark, sf_dir):
    """Values that don't fit their storage type, counted by the exports themselves."""
    d = Domain(spark, sf_dir)
    players, _, logs = etl_domain(d)
    root = _scratch(spark, "overflow")
    wide = logs.select("player_id", "game_id", "game_date", "opponent_team_id", "is_home", (F.col("points").cast("long") * 1000).alias("points"),
                       (F.col("rebounds_total").cast("long") * 10).alias("plus_minus"))
    k = F.col("game_id")
    odds = d.games.select("game_id", F.lit("book").alias("sportsbook"), F.lit(None).cast("timestamp").alias("timestamp"),
                          F.when(k % 3 == 0, F.lit(40000)).otherwise(F.lit(-110)).alias("home_moneyline"))
    found = {"logs": EX.export_logs(wide, players, f"{root}/logs"),
             "salaries": EX.export_salaries(d.dfs_salaries.withColumn("salary", F.col("salary").cast("long") * 1000000), f"{root}/salaries"),
             "odds": EX.export_odds(odds, d.games, f"{root}/odds")}
    return spark.createDataFrame([(t, c, n) for t, of in found.items() for c, n in of.items()], "dataset string, column_name string, n long")


@register("io_clustered_layout", with_ctes("SELECT player_id, game_id, game_date, points FROM logs_etl"))
def q_io_clustered(spark, sf_dir):
    """Logs written along a curve of player and date: the same rows."""
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    path = _scratch(spark, "clustered")
    ST.write_clustered(cut_lineage(logs.select("player_id", "game_id", "game_date", "points")), path, ["player_id", "game_date"])
    return spark.read.parquet(path)


@register("io_logical_names", with_ctes("""
SELECT game_id, kind, CASE kind
    WHEN 0 THEN 'player_logs_' || ymd || '_' || 'T' || home_team_id || '@T' || away_team_id || '.parquet'
    WHEN 1 THEN 'player_logs_' || ymd || '_' || 'T' || home_team_id || '.parquet'
    WHEN 2 THEN 'games_' || ymd || '.parquet' WHEN 3 THEN 'injuries_' || ymd || '_to_' || ymd || '.parquet'
    WHEN 4 THEN 'players_current.parquet' ELSE 'dfs_salaries_' || ymd || '.parquet' END AS logical
FROM (SELECT game_id, home_team_id, away_team_id, strftime(game_date, '%Y%m%d') AS ymd, CAST(game_id % 6 AS BIGINT) AS kind FROM games)""", etl=False))
def q_io_names(spark, sf_dir):
    """SC-REGEX: landing-file names as the collectors write them, to their logical names."""
    g = Domain(spark, sf_dir).games
    ymd, home, away = F.date_format("game_date", "yyyyMMdd"), F.concat(F.lit("T"), "home_team_id"), F.concat(F.lit("T"), "away_team_id")
    stamp = F.concat(F.lit("_"), F.date_format(F.date_add("game_date", 9000), "yyyyMMdd"), F.lit("_010203.parquet"))
    kind = F.col("game_id") % 6
    name = F.when(kind == 0, F.concat(F.lit("player_logs_"), ymd, F.lit("_game_"), ymd, F.lit("_"), home, F.lit("@"), away)) \
        .when(kind == 1, F.concat(F.lit("player_logs_"), ymd, F.lit("_game_"), home)) \
        .when(kind == 2, F.concat(F.lit("games_"), ymd)).when(kind == 3, F.concat(F.lit("injuries_"), ymd, F.lit("_to_"), ymd)) \
        .when(kind == 4, F.concat(F.lit("players_list_current_"), "game_id")).otherwise(F.concat(F.lit("dfs_salaries_"), ymd))
    return g.select("game_id", kind.cast("long").alias("kind"), FS.logical_name(F.concat(name, stamp)).alias("logical"))


@register("io_newest_snapshot_multi_file", with_ctes("SELECT * FROM players", etl=False))
def q_io_newest(spark, sf_dir):
    players = Domain(spark, sf_dir).players
    root = _scratch(spark, "snapshots")
    players.withColumn("is_active", F.lit(True)).write.parquet(f"{root}/players_current_20240101_000000")
    players.repartition(4).write.parquet(f"{root}/players_current_20240102_000000")
    snap = spark.read.parquet(f"{root}/players_current_20240101_000000", f"{root}/players_current_20240102_000000")
    return FS.newest_per_key(snap).drop("_file_key").select(*players.columns)


# ---------------------------------------------------------------------------------------------
# streaming

from courtline.streaming import ingest as SS  # noqa: E402

_STREAM_COLS = ["player_id", "game_id", "game_date", "points", "dfs_points_dk", "dfs_points_fd",
                "true_shooting_percentage", "effective_field_goal_percentage", "usage_rate"]


def _landing(spark, logs, name, batches):
    """Write landing files in arrival order (one folder write per batch)."""
    root = _scratch(spark, name)
    for i, b in enumerate(batches):
        b.write.mode("append").parquet(f"{root}/landing")
    return root


@register("ss_landing_score_upsert", with_ctes("SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in _ETL_DOUBLES else c for c in _STREAM_COLS) + " FROM logs_scored"))
def q_ss_landing(spark, sf_dir):
    logs = Domain(spark, sf_dir).player_game_logs
    batch = cut_lineage(logs.withColumn("year", F.year("game_date")))
    root = _landing(spark, logs, "stream-logs", [batch.where("year < 1998"), batch.where("year >= 1997")])
    src = SS.stream_landing(spark, f"{root}/landing", batch.schema, max_files_per_trigger=4)
    scored = SS.stream_score(SS.stream_dedup(src, ["player_id", "game_id"])).withColumn("_seq", F.lit(1))
    SS.run_available_now(scored, SS.upsert_sink(f"{root}/table", ["player_id", "game_id"], ["year"], "_seq"),
                         f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/table")
    return out.select(*[r6(c).alias(c) if c in _ETL_DOUBLES else F.col(c) for c in _STREAM_COLS])


@register("ss_late_and_corrected_rows", with_ctes("""
SELECT player_id, game_id, CASE WHEN game_id % 3 = 0 THEN points + 7 ELSE points END AS points FROM logs_fixed"""))
def q_ss_late(spark, sf_dir):
    """The newest year lands first, then all older ones, then corrections of every third game and replays: late
    rows are kept and corrections applied."""
    logs = E.fix_invalid(Domain(spark, sf_dir).player_game_logs).select("player_id", "game_id", "game_date", "points")
    rows = logs.withColumns({"year": F.year("game_date"), "version": F.lit(1)})
    last = F.lit(rows.agg(F.max("year")).first()[0])
    fixed = rows.where("game_id % 3 = 0").withColumns({"points": F.col("points") + 7, "version": F.lit(2)})
    root = _landing(spark, rows, "stream-late", [rows.where(F.col("year") == last), rows.where(F.col("year") < last),
                                                 fixed.unionByName(rows.where("game_id % 5 = 0"))])
    src = SS.stream_landing(spark, f"{root}/landing", rows.schema, max_files_per_trigger=1000)
    keys = ["player_id", "game_id"]
    SS.run_available_now(SS.stream_dedup(src, keys), SS.upsert_sink(f"{root}/table", keys, ["year"], "version", fixed_partitions=True),
                         f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").select("player_id", "game_id", "points")


@register("ss_versions_out_of_order", with_ctes("""
SELECT player_id, game_id, points + CASE WHEN game_id % 3 = 2 THEN 1 ELSE 3 END AS points,
       CAST(CASE WHEN game_id % 3 = 2 THEN 1 ELSE 3 END AS INTEGER) AS version FROM logs_fixed"""))
def q_ss_versions(spark, sf_dir):
    """Three versions of most rows arrive over three batches, the newest first for some and in the middle for others:
    an older version that comes later changes nothing."""
    logs = E.fix_invalid(Domain(spark, sf_dir).player_game_logs).select("player_id", "game_id", "game_date", "points")
    rows = cut_lineage(logs.withColumn("year", F.year("game_date")))
    third = F.col("game_id") % 3

    def version(k, *games):
        return rows.where(third.isin(*games)).withColumns({"points": F.col("points") + k, "version": F.lit(k)})

    arrivals = [version(3, 0).unionByName(version(1, 1, 2)), version(1, 0).unionByName(version(3, 1)), version(2, 0, 1)]
    root = _scratch(spark, "stream-versions")
    sink = SS.upsert_sink(f"{root}/table", ["player_id", "game_id"], ["year"], "version", fixed_partitions=True)
    for batch in arrivals:      # a run for each arrival: a batch each
        batch.write.mode("append").parquet(f"{root}/landing")
        src = SS.stream_landing(spark, f"{root}/landing", arrivals[0].schema, max_files_per_trigger=1000)
        SS.run_available_now(src, sink, f"{root}/checkpoint")
    return SK.read_table(spark, f"{root}/table").select("player_id", "game_id", "points", "version")


@register("ss_rest_days_late_logs", with_ctes("SELECT player_id, game_id, game_date, rest_days FROM logs_etl"))
def q_ss_rest(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, _, _ = etl_domain(d)
    logs = d.player_game_logs.withColumn("year", F.year("game_date"))
    late = F.col("game_id") % 5 == 0
    root = _landing(spark, logs, "stream-rest", [logs.where(~late), logs.where(late)])
    src = SS.stream_landing(spark, f"{root}/landing", logs.schema, max_files_per_trigger=64).withColumn("_seq", F.lit(1))
    sink = SS.rest_days_sink(f"{root}/table", players, ["player_id", "game_id"], ["year"], "_seq", fixed_partitions=True)
    SS.run_available_now(src, sink, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/table").select("player_id", "game_id", "game_date", "rest_days")


# ---------------------------------------------------------------------------------------------
# as-of join on a second time series (JN-ASOF on events)

from courtline.operators.frames import asof_join  # noqa: E402


@register("jn_asof_events_previous", """
SELECT e.event_id, e.user_id, e.ts, p.event_type AS prev_event_type, round(p.value, 6) AS prev_value
FROM events e ASOF LEFT JOIN events p ON e.user_id = p.user_id AND e.ts > p.ts""")
def q_jn_asof(spark, sf_dir):
    from courtline.sources.adapter import read_table
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    right = ev.select("user_id", F.col("ts").alias("pts"), F.col("event_type").alias("prev_event_type"),
                      F.col("value").alias("prev_value"))
    out = asof_join(ev.select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "pts",
                    ["prev_event_type", "prev_value"], strict=True,
                    granularity="week")
    return out.withColumn("prev_value", r6("prev_value"))


# ---------------------------------------------------------------------------------------------
# FT-METRIC and FT-EMA

from courtline.plans import metrics as MT  # noqa: E402


def _metric_sql(t: dict) -> dict:
    """The seven metrics as SQL over totals named in ``t`` (text expressions)."""
    tp = f"({t['pts']} * {t['games']})"
    mins = t["mins"]
    tsa = f"(2 * ({t['fga']} + 0.44 * {t['fta']}))"
    raw = (f"({tp} / {mins} + ({t['orb']} + {t['drb']}) / {mins} + {t['ast']} / {mins} + {t['stl']} / {mins}"
           f" + {t['blk']} / {mins} - {t['tov']} / {mins} - {t['pf']} / {mins} - ({t['fga']} / {mins} - {t['fgm']} / {mins})"
           f" - ({t['fta']} / {mins} - {t['ftm']} / {mins}))")
    return {
        "true_shooting_pct": f"CASE WHEN {tsa} > 0 THEN {tp} / {tsa} ELSE 0.0 END",
        "usage_rate": f"CASE WHEN {mins} > 0 THEN 100 * ({t['fga']} + 0.44 * {t['fta']} + {t['tov']}) / {mins} ELSE 0.0 END",
        "per": f"CASE WHEN {mins} > 0 THEN greatest(0.0, {raw} * 15) ELSE 0.0 END",
        "efg_pct": f"CASE WHEN {t['fga']} > 0 THEN ({t['fgm']} + 0.5 * {t['fg3m']}) / {t['fga']} ELSE 0.0 END",
        "ast_tov_ratio": f"CASE WHEN {t['tov']} > 0 THEN {t['ast']} / {t['tov']} WHEN {t['ast']} > 0 THEN {t['ast']} ELSE 0.0 END",
        "steal_pct": f"CASE WHEN {mins} > 0 THEN {t['stl']} / {mins} * 48 ELSE 0.0 END",
        "block_pct": f"CASE WHEN {mins} > 0 THEN {t['blk']} / {mins} * 48 ELSE 0.0 END",
    }


_SEASON_SQL = ("CAST(CASE WHEN month(game_date) >= 10 THEN year(game_date) ELSE year(game_date) - 1 END AS VARCHAR) || '-' || "
               "lpad(CAST((CASE WHEN month(game_date) >= 10 THEN year(game_date) ELSE year(game_date) - 1 END + 1) % 100 AS VARCHAR), 2, '0')")
_MT_TOT = {k: k for k in ["pts", "games"] + [k for k, _ in MT.METRIC_SUMS]}


@register("ft_metrics_player_season", with_ctes(
    "SELECT player_id, season, " + ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" for n, e in _metric_sql(_MT_TOT).items())
    + " FROM mt", extra="mt AS (SELECT player_id, " + _SEASON_SQL + " AS season, avg(points) AS pts, CAST(count(*) AS DOUBLE) AS games, "
    + ", ".join(f"CAST(coalesce(sum({src}), 0) AS DOUBLE) AS {k}" for k, src in MT.METRIC_SUMS)
    + " FROM logs_etl GROUP BY ALL)"))
def q_ft_metrics(spark, sf_dir):
    from courtline.functions.exprs import season_label
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    m = MT.advanced_metrics(logs.withColumn("season", season_label("game_date")), keys=("player_id", "season"))
    return m.select("player_id", "season", *[r6(c).alias(c) for c in MT.METRIC_NAMES])


@register("ft_metrics_team_context", with_ctes(
    "SELECT player_id, season, " + ", ".join(f"round(CAST({e} AS DOUBLE), 6) AS {n}" for n, e in (_metric_sql(_MT_TOT) | {
        "usage_rate": f"CASE WHEN pace IS NULL OR poss IS NULL THEN ({_metric_sql(_MT_TOT)['usage_rate']}) WHEN mins > 0 AND poss > 0 "
                      "THEN 100 * ((fga + 0.44 * fta + tov) * pace * 5) / (mins * poss) ELSE 0.0 END"}).items())
    + " FROM mt LEFT JOIN tm USING (player_id, season)", extra="mt AS (SELECT player_id, " + _SEASON_SQL + " AS season, avg(points) AS pts, CAST(count(*) AS DOUBLE) AS games, "
    + ", ".join(f"CAST(coalesce(sum({src}), 0) AS DOUBLE) AS {k}" for k, src in MT.METRIC_SUMS)
    + " FROM logs_etl GROUP BY ALL), tm AS (SELECT player_id, season, 95.0 + player_id % 10 AS pace, "
    "CASE WHEN player_id % 7 = 0 THEN 0.0 WHEN player_id % 7 > 1 THEN shots END AS poss FROM (SELECT player_id, " + _SEASON_SQL + " AS season, "
    "CAST(sum(coalesce(field_goals_attempted, 0)) * 5 AS DOUBLE) AS shots FROM logs_etl WHERE player_id % 3 > 0 GROUP BY ALL))"))
def q_ft_metrics_team(spark, sf_dir):
    """FT-METRIC with team context: usage from pace and possessions where both are known, else as without."""
    from courtline.functions.exprs import season_label
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    logs = cut_lineage(logs.withColumn("season", season_label("game_date")))
    k = F.col("player_id")
    team = logs.where(k % 3 > 0).groupBy("player_id", "season").agg(
        F.sum(F.coalesce("field_goals_attempted", F.lit(0)) * 5).cast("double").alias("_fga"))
    team = team.select("player_id", "season", (95.0 + k % 10).alias("team_pace"),
                       F.when(k % 7 == 0, F.lit(0.0)).when(k % 7 > 1, F.col("_fga")).alias("team_possessions"))
    m = MT.advanced_metrics(logs, keys=("player_id", "season"), team_stats=team)
    return m.select("player_id", "season", *[r6(c).alias(c) for c in MT.METRIC_NAMES])


def _ema_oracle():
    stat_ctes, stat_cols = [], []
    for name, src in MT.EMA_STATS:
        stat_ctes.append(f"""e_{name} AS (
  SELECT player_id, sum(v * w) / sum(w) AS {name}_ema, avg(v) AS {name}_sma,
         CASE WHEN count(*) >= 3 THEN regr_slope(v, cpos) ELSE 0.0 END AS {name}_trend
  FROM (SELECT player_id, CAST({src} AS DOUBLE) AS v, 0.2 * pow(0.8, pos) AS w,
               row_number() OVER (PARTITION BY player_id ORDER BY pos) - 1 AS cpos
        FROM rw WHERE {src} IS NOT NULL) GROUP BY player_id)""")
        stat_cols += [f"{name}_ema", f"{name}_sma", f"{name}_trend"]
    tot = {"pts": "pts", "games": "games", **{k: k for k, _ in MT.METRIC_SUMS}}
    rec = _metric_sql(tot)
    ctes = f"""
eb AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) - 1 AS pos FROM logs_etl),
es AS (SELECT player_id, count(dfs_points_dk) AS n_fp, avg(dfs_points_dk) AS m_fp, stddev_pop(dfs_points_dk) AS sd_fp,
              count(*) AS n_logs FROM eb GROUP BY player_id),
ew AS (SELECT *, CASE WHEN m_fp > 0 THEN sd_fp / m_fp ELSE 1.0 END AS cv FROM es WHERE n_fp >= 5),
ew2 AS (SELECT *, CASE WHEN cv < 0.25 THEN least(15, n_logs) ELSE least(25, n_logs) END AS ws FROM ew),
rw AS (SELECT eb.* FROM eb JOIN ew2 ON eb.player_id = ew2.player_id WHERE eb.pos < ew2.ws),
{",".join(stat_ctes)},
rm AS (SELECT player_id, avg(points) AS pts, CAST(count(*) AS DOUBLE) AS games,
              {", ".join(f"CAST(coalesce(sum({src}), 0) AS DOUBLE) AS {k}" for k, src in MT.METRIC_SUMS)}
       FROM rw GROUP BY player_id),
rmm AS (SELECT player_id, {", ".join(f"CASE WHEN games >= 3 THEN {e} END AS {n}_recent" for n, e in rec.items())} FROM rm),
mo AS (SELECT player_id, avg(dfs_points_dk) FILTER (WHERE cpos < 3) AS r3, avg(dfs_points_dk) FILTER (WHERE cpos >= 3) AS p3,
              count(*) AS n6
       FROM (SELECT player_id, dfs_points_dk,
                    row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) - 1 AS cpos
             FROM logs_etl WHERE dfs_points_dk IS NOT NULL) WHERE cpos < 6 GROUP BY player_id)"""
    joins = " ".join(f"LEFT JOIN e_{n} USING (player_id)" for n, _ in MT.EMA_STATS)
    sel = ", ".join(f"round(CAST({c} AS DOUBLE), 6) + 0.0 AS {c}" for c in
                    stat_cols + [f"{m}_recent" for m in MT.METRIC_NAMES])
    body = f"""SELECT player_id, {sel}, round(sd_fp, 6) AS fantasy_points_volatility, round(cv, 6) AS fantasy_points_cv,
       round(1 / (1 + cv), 6) AS consistency_rating,
       round(CASE WHEN n6 >= 6 THEN (CASE WHEN p3 > 0 THEN r3 / p3 ELSE 1.0 END) END, 6) AS momentum_ratio
FROM ew2 JOIN rmm USING (player_id) {joins} LEFT JOIN mo USING (player_id)"""
    return with_ctes(body, extra=ctes)


@register("ft_ema_decay_players", _ema_oracle())
def q_ft_ema(spark, sf_dir):
    _, _, logs = etl_domain(Domain(spark, sf_dir))
    m = MT.moving_averages_with_decay(logs)
    return m.select("player_id", *[r6(c).alias(c) for c in MT.EMA_COLUMNS])


# ---------------------------------------------------------------------------------------------
# more ingestion and exports: raw game / injury rows, injury / salary / team exports, odds gaps

@register("io_raw_games_ingest", with_ctes("""
SELECT CAST(game_id AS VARCHAR) AS game_id, game_date,
       CAST(CASE WHEN month(game_date) >= 10 THEN year(game_date) ELSE year(game_date) - 1 END AS VARCHAR) || '-' ||
       lpad(CAST((CASE WHEN month(game_date) >= 10 THEN year(game_date) ELSE year(game_date) - 1 END + 1) % 100 AS VARCHAR), 2, '0') AS season,
       'Regular Season' AS season_type, home_team_id, away_team_id,
       CAST(NULL AS INTEGER) AS home_score, CAST(NULL AS INTEGER) AS away_score,
       CASE WHEN game_id % 2 = 0 THEN 'Final' ELSE 'Scheduled' END AS game_status, '' AS game_time
FROM games""", etl=False))
def q_io_raw_games(spark, sf_dir):
    g = Domain(spark, sf_dir).games
    rows = g.select(F.col("game_id").cast("string").alias("gameID"), F.date_format("game_date", "yyyyMMdd").alias("date_str"),
                    F.lit(None).cast("string").alias("seasonType"), F.col("home_team_id").cast("string").alias("homeTeamID"),
                    F.col("away_team_id").cast("string").alias("awayTeamID"), F.lit(None).cast("string").alias("homeScore"),
                    F.lit(None).cast("string").alias("awayScore"),
                    F.when(F.col("game_id") % 2 == 0, "Final").alias("gameStatus"),
                    F.lit(None).cast("string").alias("gameTime"))
    return SK.raw_games(rows)


@register("io_raw_injuries_ingest", with_ctes("""
SELECT player_id, injury_date, status, '' AS description, body_part FROM injuries""", etl=False))
def q_io_raw_injuries(spark, sf_dir):
    inj = Domain(spark, sf_dir).injuries
    raw = inj.select(F.col("player_id").cast("string").alias("playerID"),
                     F.date_format("injury_date", "yyyyMMdd").alias("injDate"), "status",
                     F.lit(None).cast("string").alias("description"), F.col("body_part").alias("bodyPart"))
    # blank dates are skipped: append a copy of the rows with an empty date, which must vanish
    raw = raw.unionByName(raw.withColumn("injDate", F.lit("")))
    return SK.raw_injuries(raw)


@register("io_raw_injuries_long_ids", with_ctes(f"""
SELECT player_id + {_LONG_ID} AS player_id, injury_date, status, body_part FROM injuries""", etl=False))
def q_io_raw_injuries_long(spark, sf_dir):
    """Eleven-digit ids stay apart; rows whose id doesn't parse are skipped, none becomes player 0."""
    inj = Domain(spark, sf_dir).injuries
    raw = inj.select((F.col("player_id") + _LONG_ID).cast("string").alias("playerID"),
                     F.date_format("injury_date", "yyyyMMdd").alias("injDate"), "status",
                     F.lit("").alias("description"), F.col("body_part").alias("bodyPart"))
    raw = raw.unionByName(raw.withColumn("playerID", F.lit("unknown")))
    return SK.raw_injuries(raw).select("player_id", "injury_date", "status", "body_part")


@register("io_export_injuries", with_ctes(f"""
SELECT player_id, injury_date, coalesce(status, 'Unknown') AS status, coalesce(description, '') AS description,
       coalesce(body_part, '') AS body_part, return_date, {_as_stored('coalesce(games_missed, 0)', 'games_missed', EX.INJURY_TYPES)},
       {_SEASON_SQL_OF.format('injury_date')} AS season FROM injuries""", etl=False))
def q_io_export_injuries(spark, sf_dir):
    path = _scratch(spark, "export-injuries")
    EX.export_injuries(Domain(spark, sf_dir).injuries, path)
    return FS.read_parquet(spark, path)


@register("io_export_salaries", with_ctes(f"""
SELECT player_id, game_date, salary, coalesce(position, '') AS position, coalesce(is_available, TRUE) AS is_available,
       {_SEASON_SQL_OF.format('game_date')} AS season, platform FROM dfs_salaries""", etl=False))
def q_io_export_salaries(spark, sf_dir):
    path = _scratch(spark, "export-salaries")
    EX.export_salaries(Domain(spark, sf_dir).dfs_salaries, path)
    return FS.read_parquet(spark, path)


_ODDS_EXPR = {"home_spread": "g.home_spread", "away_spread": "g.away_spread", "home_spread_odds": "-110", "away_spread_odds": "-110",
              "home_moneyline": "CAST(g.home_spread * 10 AS INTEGER)", "away_moneyline": "CAST(g.away_spread * 10 AS INTEGER)",
              "total_points": "g.total_line", "over_odds": "-110 - k * 5", "under_odds": "-110 + k * 5"}


@register("io_export_odds", with_ctes(f"""
SELECT CAST(g.game_id AS VARCHAR) AS game_id, g.game_date, CASE k WHEN 0 THEN 'fanduel' ELSE 'draftkings' END AS sportsbook,
       {', '.join(_as_stored(f'coalesce({e}, 0)', c, EX.ODDS_TYPES) for c, e in _ODDS_EXPR.items())},
       {_SEASON_SQL_OF.format('g.game_date')} AS season
FROM games g JOIN range(0, 2) t(k) ON t.k < g.game_id % 3""", etl=False))
def q_io_export_odds(spark, sf_dir):
    d = Domain(spark, sf_dir)
    docs, path = _scratch(spark, "odds-docs"), _scratch(spark, "export-odds")
    _odds_docs(d.games).write.mode("overwrite").json(docs)
    odds = SK.raw_odds(FS.flatten_odds(FS.read_documents(spark, docs, FS.ODDS_DOC)), "2024-01-01 00:00:00")
    EX.export_odds(odds, d.games, path)
    return _floats_back(FS.read_parquet(spark, path).drop("timestamp"), EX.ODDS_TYPES)


@register("io_json_bodies", with_ctes("""
SELECT CAST(game_id AS VARCHAR) AS gameID, strftime(game_date, '%Y%m%d') AS gameDate, CAST(home_team_id AS VARCHAR) AS teamIDHome FROM games""",
                                      etl=False))
def q_io_bodies(spark, sf_dir):
    """SRC-JSON: one row per element of each document's body."""
    docs = _scratch(spark, "json-bodies")
    _odds_docs(Domain(spark, sf_dir).games).write.mode("overwrite").json(docs)
    element = T.StructType([T.StructField(c, T.StringType()) for c in ("gameID", "gameDate", "teamIDHome")])
    return FS.read_body(spark, docs, element)


@register("io_logs_with_parent", with_ctes("""
SELECT l.player_id, l.game_id FROM player_game_logs l WHERE l.player_id IN (SELECT player_id FROM players WHERE is_active)""", etl=False))
def q_io_with_parent(spark, sf_dir):
    """JN-SEMI: the complement of the foreign-key report."""
    d = Domain(spark, sf_dir)
    return SK.with_parent(d.player_game_logs, d.players.where("is_active"), ["player_id"]).select("player_id", "game_id")


@register("an_logs_last_season", with_ctes("""
SELECT player_id, game_id, game_date FROM logs_etl, (SELECT max(year(game_date) + CASE WHEN month(game_date) >= 10 THEN 1 ELSE 0 END) AS y FROM games) s
WHERE game_date BETWEEN make_date(CAST(s.y - 1 AS INTEGER), 10, 1) AND make_date(CAST(s.y AS INTEGER), 4, 30)"""))
def q_an_last_season(spark, sf_dir):
    """SRC-SEASON, FLT-DYN: the logs of the last season of the data."""
    dom = Domain(spark, sf_dir)
    _, _, logs = etl_domain(dom)
    _, b = data_date_range(dom)
    lo, hi = FS.season_range(b.year + (b.month >= 10))
    return RD.filter_optional(logs, start=lo, end=hi).select("player_id", "game_id", "game_date")


@register("an_logs_recent_days", with_ctes("""
SELECT player_id, game_id, game_date FROM logs_etl WHERE game_date BETWEEN (SELECT max(game_date) FROM games) - 90 AND (SELECT max(game_date) FROM games)"""))
def q_an_recent(spark, sf_dir):
    """SRC-RECENT: the last 90 days of the data."""
    dom = Domain(spark, sf_dir)
    _, _, logs = etl_domain(dom)
    _, b = data_date_range(dom)
    lo, hi = FS.recent_range(90, b)
    return RD.filter_optional(logs, start=lo, end=hi).select("player_id", "game_id", "game_date")


@register("io_team_game_logs", with_ctes("""
SELECT CASE WHEN coalesce(l.is_home, FALSE) THEN g.home_team_id ELSE g.away_team_id END AS team_id, l.game_id, l.game_date,
       """ + ", ".join(f"CAST(sum(coalesce(l.{c}, 0)) AS BIGINT) AS {c}" for c in EX.TEAM_LOG_SUMS) + """,
       round(CASE WHEN sum(coalesce(l.field_goals_attempted,0)) = 0 THEN 0.0 ELSE sum(coalesce(l.field_goals_made,0)) / sum(coalesce(l.field_goals_attempted,0)) END, 6) AS field_goal_percentage,
       round(CASE WHEN sum(coalesce(l.three_pointers_attempted,0)) = 0 THEN 0.0 ELSE sum(coalesce(l.three_pointers_made,0)) / sum(coalesce(l.three_pointers_attempted,0)) END, 6) AS three_point_percentage,
       round(CASE WHEN sum(coalesce(l.free_throws_attempted,0)) = 0 THEN 0.0 ELSE sum(coalesce(l.free_throws_made,0)) / sum(coalesce(l.free_throws_attempted,0)) END, 6) AS free_throw_percentage,
       coalesce(l.is_home, FALSE) AS is_home,
       CASE WHEN coalesce(l.is_home, FALSE) THEN g.away_team_id ELSE g.home_team_id END AS opponent_team_id
FROM logs_etl l JOIN games g ON l.game_id = g.game_id
GROUP BY 1, l.game_id, l.game_date, coalesce(l.is_home, FALSE), g.home_team_id, g.away_team_id"""))
def q_io_team_logs(spark, sf_dir):
    d = Domain(spark, sf_dir)
    _, _, logs = etl_domain(d)
    t = EX.team_game_logs(logs, d.games)
    return t.withColumns({c: r6(c) for c in ("field_goal_percentage", "three_point_percentage", "free_throw_percentage")})


@register("io_export_team_logs", with_ctes("""
SELECT team_id, game_id, game_date, """ + ", ".join(_as_stored(c, c, EX.TEAM_TYPES) for c in EX.TEAM_LOG_SUMS) + """, is_home, opponent_team_id,
       """ + ", ".join(_as_stored(f"coalesce(CASE WHEN {a} > 0 THEN {m} / {a} END, 0.0)", c, EX.TEAM_TYPES) for c, m, a in (
    ("field_goal_percentage", "field_goals_made", "field_goals_attempted"), ("three_point_percentage", "three_pointers_made", "three_pointers_attempted"),
    ("free_throw_percentage", "free_throws_made", "free_throws_attempted"),
    ("true_shooting_percentage", "points", "(2 * (field_goals_attempted + 0.44 * free_throws_attempted))"),
    ("effective_field_goal_percentage", "(field_goals_made + 0.5 * three_pointers_made)", "field_goals_attempted"))) + """,
       """ + ", ".join(_as_stored("0", c, EX.TEAM_TYPES) for c in EX.TEAM_EXPORT_DEFAULTS) + """,
       CAST(month(game_date) AS INTEGER) AS month, """ + _SEASON_SQL_OF.format("game_date") + """ AS season
FROM side""", extra="""side AS (
  SELECT CASE WHEN coalesce(l.is_home, FALSE) THEN g.home_team_id ELSE g.away_team_id END AS team_id, l.game_id, l.game_date,
         """ + ", ".join(f"CAST(sum(coalesce(l.{c}, 0)) AS BIGINT) AS {c}" for c in EX.TEAM_LOG_SUMS) + """,
         coalesce(l.is_home, FALSE) AS is_home, CASE WHEN coalesce(l.is_home, FALSE) THEN g.away_team_id ELSE g.home_team_id END AS opponent_team_id
  FROM logs_etl l JOIN games g ON l.game_id = g.game_id
  GROUP BY 1, l.game_id, l.game_date, coalesce(l.is_home, FALSE), g.home_team_id, g.away_team_id)"""))
def q_io_export_team(spark, sf_dir):
    d = Domain(spark, sf_dir)
    _, _, logs = etl_domain(d)
    path = _scratch(spark, "export-team")
    EX.export_team_logs(logs, d.games, path)
    return _floats_back(FS.read_parquet(spark, path), EX.TEAM_TYPES)


@register("io_days_without_odds", with_ctes("""
SELECT DISTINCT game_date FROM games WHERE game_date NOT IN (
  SELECT g.game_date FROM games g WHERE g.game_id % 3 <> 0)""", etl=False))
def q_io_odds_gaps(spark, sf_dir):
    d = Domain(spark, sf_dir)
    path = _scratch(spark, "odds-gap-docs")
    _odds_docs(d.games).write.mode("overwrite").json(path)
    odds = SK.raw_odds(FS.flatten_odds(FS.read_documents(spark, path, FS.ODDS_DOC)), "2024-01-01 00:00:00")
    wanted = d.games.select("game_date").distinct()
    return SK.missing(wanted, SK.days_with_odds(odds, d.games), ["game_date"])
