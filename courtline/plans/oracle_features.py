"""DuckDB oracle for the 110 point-in-time features, written the brute-force way: every anchor log
joined to its newest 50 rows (``k`` = 0 is the anchor), FILTER aggregates per window, compacted
positions by ``row_number``, and an ASOF JOIN from the players x days spine to the anchors."""

from __future__ import annotations

from courtline.plans.features import FEATURE_COLS, ROLL_AVG, ROLL_PCT, ROLL_STD, ROLL_WINDOWS

_SRC0 = {"points": "p0", "rebounds_total": "reb0", "assists": "ast0", "steals": "stl0", "blocks": "blk0",
         "turnovers": "tov0", "minutes": "min0", "dfs_points_dk": "dfs0", "usage_rate": "usg0",
         "true_shooting_percentage": "ts0", "field_goals_made": "fgm0", "field_goals_attempted": "fga0",
         "three_pointers_made": "tpm0", "three_pointers_attempted": "tpa0", "free_throws_made": "ftm0",
         "free_throws_attempted": "fta0"}

DOUBLE_FEATURES = None  # filled below


def _state_aggs(windows=ROLL_WINDOWS) -> str:
    out = ["count(*) AS n_hist"]
    for n in windows:
        ok = f"count(*) >= {n}"
        f = f"FILTER (WHERE k < {n})"
        for name, src in ROLL_AVG:
            out.append(f"CASE WHEN {ok} THEN avg({_SRC0[src]}) {f} END AS avg_{name}_L{n}")
        for name, m, a in ROLL_PCT:
            sm, sa = f"sum({_SRC0[m]}) {f}", f"sum({_SRC0[a]}) {f}"
            out.append(f"CASE WHEN {ok} THEN (CASE WHEN {sa} = 0 THEN 0.0 ELSE {sm} / {sa} END) END AS avg_{name}_pct_L{n}")
        for name, src in ROLL_STD:
            out.append(f"CASE WHEN {ok} THEN stddev_samp({_SRC0[src]}) {f} END AS std_{name}_L{n}")
        out.append(f"CASE WHEN {ok} THEN {n} END AS games_played_L{n}")
    out += [
        "max(p0) FILTER (WHERE k = 0) AS last_game_points",
        "max(dfs0) FILTER (WHERE k = 0) AS last_game_dfs_points",
        "max(min0) FILTER (WHERE k = 0) AS last_game_minutes",
        "CASE WHEN count(*) >= 6 THEN avg(p0) FILTER (WHERE k < 3) - avg(p0) FILTER (WHERE k BETWEEN 3 AND 5) END AS points_trend_recent",
        "CASE WHEN count(*) >= 6 THEN avg(dfs0) FILTER (WHERE k < 3) - avg(dfs0) FILTER (WHERE k BETWEEN 3 AND 5) END AS dfs_trend_recent",
        "CASE WHEN count(*) >= 10 THEN 1.0 / (1.0 + stddev_pop(dfs0) FILTER (WHERE k < 10)) END AS recent_consistency",
        "CASE WHEN sum(min0) FILTER (WHERE k < 15) > 0 THEN (sum(per_pos) FILTER (WHERE k < 15) - sum(per_neg) FILTER (WHERE k < 15)) / (sum(min0) FILTER (WHERE k < 15) / 48) END AS per_estimate",
        "avg(rest_days) FILTER (WHERE k < 10) AS avg_rest_days",
        "stddev_pop(rest_days) FILTER (WHERE k < 10) AS std_rest_days",
        "avg(p0) FILTER (WHERE k < 20 AND home) AS avg_points_home",
        "avg(dfs0) FILTER (WHERE k < 20 AND home) AS avg_dfs_home",
        "CASE WHEN count(*) FILTER (WHERE k < 20 AND home) > 0 THEN count(*) FILTER (WHERE k < 20 AND home) END AS home_games_count",
        "avg(p0) FILTER (WHERE k < 20 AND NOT home) AS avg_points_away",
        "avg(dfs0) FILTER (WHERE k < 20 AND NOT home) AS avg_dfs_away",
        "CASE WHEN count(*) FILTER (WHERE k < 20 AND NOT home) > 0 THEN count(*) FILTER (WHERE k < 20 AND NOT home) END AS away_games_count",
        "count(*) FILTER (WHERE rseason = aseason) AS season_games_played",
        "avg(p0) FILTER (WHERE rseason = aseason) AS season_avg_points",
        "avg(dfs0) FILTER (WHERE rseason = aseason) AS season_avg_dfs",
    ]
    return ",\n    ".join(out)


_ALL_DAYS = "SELECT p.player_id, p.position, p.team_id, p.is_active, d.target_date\n          FROM players_etl p CROSS JOIN days d WHERE p.is_active"
# the (player, day) pairs that a training row needs: a log and a DraftKings salary on the day
OUTCOME_DAYS = """SELECT DISTINCT p.player_id, p.position, p.team_id, p.is_active, oc.game_date AS target_date
          FROM players_etl p JOIN oc ON oc.player_id = p.player_id WHERE p.is_active"""


def features_oracle_ctes(spine: str = _ALL_DAYS, windows=ROLL_WINDOWS, min_games: int = 5) -> str:
    src = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {v}" for c, v in _SRC0.items())
    return f"""
lg AS (
  SELECT player_id, game_id, game_date, rest_days, {src},
    CAST(coalesce(points,0) + coalesce(rebounds_total,0) + coalesce(assists,0) + coalesce(steals,0) + coalesce(blocks,0) AS DOUBLE) AS per_pos,
    CAST(coalesce(field_goals_attempted,0) - coalesce(field_goals_made,0) + coalesce(free_throws_attempted,0) - coalesce(free_throws_made,0) + coalesce(turnovers,0) AS DOUBLE) AS per_neg,
    CASE WHEN coalesce(usage_rate, 0) <> 0 THEN usage_rate END AS usage_t,
    CASE WHEN coalesce(true_shooting_percentage, 0) <> 0 THEN true_shooting_percentage END AS ts_t,
    coalesce(is_home, FALSE) AS home,
    CASE WHEN month(game_date) >= 10 THEN year(game_date) ELSE year(game_date) - 1 END AS season,
    row_number() OVER (PARTITION BY player_id ORDER BY game_date, game_id) AS idx,
    row_number() OVER (PARTITION BY player_id, game_date ORDER BY game_id DESC) AS last_of_day
  FROM logs_etl),
pairs AS MATERIALIZED (
  SELECT a.player_id, a.idx AS aidx, a.game_date AS adate, a.season AS aseason, a.idx - r.idx AS k,
         r.season AS rseason, r.p0, r.reb0, r.ast0, r.stl0, r.blk0, r.tov0, r.min0, r.dfs0, r.usg0, r.ts0,
         r.fgm0, r.fga0, r.tpm0, r.tpa0, r.ftm0, r.fta0, r.per_pos, r.per_neg, r.usage_t, r.ts_t, r.home, r.rest_days
  FROM lg a JOIN lg r ON a.player_id = r.player_id AND r.idx BETWEEN a.idx - 49 AND a.idx
  WHERE a.last_of_day = 1),
st_main AS (SELECT player_id, aidx, adate, {_state_aggs(windows)} FROM pairs GROUP BY player_id, aidx, adate),
usage_c AS (SELECT player_id, aidx, usage_t AS y, row_number() OVER (PARTITION BY player_id, aidx ORDER BY k) - 1 AS x
            FROM pairs WHERE k < 10 AND usage_t IS NOT NULL),
usage_s AS (SELECT player_id, aidx, avg(y) AS avg_usage_rate,
                   CASE WHEN count(*) > 1 THEN regr_slope(y, x) END AS usage_rate_trend FROM usage_c GROUP BY player_id, aidx),
ts_c AS (SELECT player_id, aidx, ts_t AS y, row_number() OVER (PARTITION BY player_id, aidx ORDER BY k) - 1 AS x
         FROM pairs WHERE k < 10 AND ts_t IS NOT NULL),
ts_s AS (SELECT player_id, aidx, avg(y) AS avg_true_shooting,
                CASE WHEN count(*) > 1 THEN regr_slope(y, x) END AS shooting_trend FROM ts_c GROUP BY player_id, aidx),
seas AS (SELECT player_id, aidx, dfs0, row_number() OVER (PARTITION BY player_id, aidx ORDER BY k) - 1 AS sk,
                count(*) OVER (PARTITION BY player_id, aidx) AS m
         FROM pairs WHERE rseason = aseason),
seas_t AS (SELECT player_id, aidx, CASE WHEN max(m) >= 20 THEN avg(dfs0) FILTER (WHERE sk < m // 2)
                                        - avg(dfs0) FILTER (WHERE sk >= m // 2) END AS seasonal_trend
           FROM seas GROUP BY player_id, aidx),
states AS MATERIALIZED (
  SELECT m.*, u.avg_usage_rate, u.usage_rate_trend, t.avg_true_shooting, t.shooting_trend, s.seasonal_trend
  FROM st_main m LEFT JOIN usage_s u USING (player_id, aidx) LEFT JOIN ts_s t USING (player_id, aidx)
  LEFT JOIN seas_t s USING (player_id, aidx)),
days AS (
  SELECT CAST(d AS DATE) AS target_date
  FROM generate_series(CAST((SELECT min(game_date) FROM games) AS TIMESTAMP),
                       CAST((SELECT max(game_date) FROM games) AS TIMESTAMP), INTERVAL 1 DAY) g(d)),
spine AS ({spine}),
anchored AS (
  SELECT * FROM (SELECT s.*, st.* EXCLUDE (player_id)
                 FROM spine s ASOF JOIN states st ON s.player_id = st.player_id AND s.target_date > st.adate)
  WHERE n_hist >= {min_games}),
inj AS (
  SELECT s.player_id, s.target_date, count(*) AS n, max(i.injury_date) AS last
  FROM anchored s JOIN injuries i ON i.player_id = s.player_id
   AND i.injury_date >= s.target_date - 30 AND i.injury_date < s.target_date
  GROUP BY s.player_id, s.target_date),
tg AS (SELECT player_id, game_date AS target_date, min(game_id) AS game_id FROM logs_etl GROUP BY player_id, game_date),
tgo AS (
  SELECT tg.player_id, tg.target_date,
         CASE WHEN p.team_id = g.home_team_id THEN g.away_team_id ELSE g.home_team_id END AS opp,
         coalesce(p.team_id = g.home_team_id, FALSE) AS is_home_game
  FROM tg JOIN games g ON tg.game_id = g.game_id JOIN players_etl p ON tg.player_id = p.player_id),
vs AS (
  SELECT t.player_id, t.target_date, l.points, l.dfs_points_dk,
         row_number() OVER (PARTITION BY t.player_id, t.target_date ORDER BY l.game_date DESC, l.game_id DESC) AS rn
  FROM tgo t JOIN logs_etl l ON l.player_id = t.player_id AND l.opponent_team_id = t.opp AND l.game_date < t.target_date),
vsa AS (
  SELECT player_id, target_date, avg(coalesce(points, 0)) AS avg_points_vs_opponent,
         avg(coalesce(dfs_points_dk, 0)) AS avg_dfs_vs_opponent, count(*) AS games_vs_opponent
  FROM vs WHERE rn <= 5 GROUP BY player_id, target_date),
dk AS (SELECT player_id, game_date, salary FROM dfs_salaries WHERE platform = 'DraftKings'),
cur AS (SELECT player_id, game_date AS target_date, min(salary) AS current_salary_dk FROM dk GROUP BY player_id, game_date),
day1 AS (SELECT player_id, game_date, dfs_points_dk AS dfs FROM (
           SELECT *, row_number() OVER (PARTITION BY player_id, game_date ORDER BY game_id) AS rn FROM logs_etl) WHERE rn = 1),
shist AS (SELECT dk.player_id, dk.game_date,
                 CASE WHEN coalesce(d.dfs, 0) <> 0 AND dk.salary > 0 THEN d.dfs / dk.salary * 1000 END AS v
          FROM dk JOIN day1 d ON dk.player_id = d.player_id AND dk.game_date = d.game_date),
sv AS (SELECT c.player_id, c.target_date, h.v,
              row_number() OVER (PARTITION BY c.player_id, c.target_date ORDER BY h.game_date DESC) AS rn
       FROM cur c JOIN shist h ON h.player_id = c.player_id AND h.game_date < c.target_date),
sva AS (SELECT player_id, target_date, avg(v) AS avg_value_dk, stddev_pop(v) AS std_value_dk
        FROM sv WHERE rn <= 10 GROUP BY player_id, target_date),
feat AS (
  SELECT a.*, o.opp AS opponent_team_id, o.is_home_game, v.avg_points_vs_opponent, v.avg_dfs_vs_opponent,
         v.games_vs_opponent, coalesce(i.n, 0) AS recent_injury_count, coalesce(i.n, 0) > 0 AS has_recent_injury,
         coalesce(date_diff('day', i.last, a.target_date), 999) AS days_since_injury,
         date_diff('day', a.adate, a.target_date) - 1 AS rest_days_t,
         c.current_salary_dk, CASE WHEN c.current_salary_dk IS NOT NULL THEN sv.avg_value_dk END AS avg_value_dk,
         CASE WHEN c.current_salary_dk IS NOT NULL THEN sv.std_value_dk END AS std_value_dk,
         a.n_hist >= 10 AND (CASE WHEN month(a.target_date) >= 10 THEN year(a.target_date) ELSE year(a.target_date) - 1 END)
                          = (CASE WHEN month(a.adate) >= 10 THEN year(a.adate) ELSE year(a.adate) - 1 END) AS season_ok
  FROM anchored a
  LEFT JOIN inj i ON a.player_id = i.player_id AND a.target_date = i.target_date
  LEFT JOIN tgo o ON a.player_id = o.player_id AND a.target_date = o.target_date
  LEFT JOIN vsa v ON a.player_id = v.player_id AND a.target_date = v.target_date
  LEFT JOIN cur c ON a.player_id = c.player_id AND a.target_date = c.target_date
  LEFT JOIN sva sv ON a.player_id = sv.player_id AND a.target_date = sv.target_date)
"""


_SPECIAL = {
    "rest_days": "rest_days_t",
    "is_back_to_back": "rest_days_t = 0",
    "home_away_dfs_diff": "avg_dfs_home - avg_dfs_away",
    "season_avg_points": "CASE WHEN season_ok THEN season_avg_points END",
    "season_avg_dfs": "CASE WHEN season_ok THEN season_avg_dfs END",
    "season_games_played": "CASE WHEN season_ok THEN season_games_played END",
    "seasonal_trend": "CASE WHEN season_ok THEN seasonal_trend END",
}

INT_FEATURES = {"player_id", "team_id", "opponent_team_id", "games_vs_opponent", "recent_injury_count",
                "days_since_injury", "rest_days", "home_games_count", "away_games_count", "current_salary_dk",
                "season_games_played"} | {f"games_played_L{n}" for n in ROLL_WINDOWS}
INT_FEATURES |= {f"games_played_L{n}" for n in range(1, 51)}
NON_DOUBLE = INT_FEATURES | {"target_date", "position", "is_active", "is_home_game", "has_recent_injury",
                             "is_back_to_back"}
DOUBLE_FEATURES = [c for c in FEATURE_COLS if c not in NON_DOUBLE]


def features_select_sql(cols=FEATURE_COLS, source: str = "feat") -> str:
    parts = []
    for c in cols:
        e = _SPECIAL.get(c, c)
        if c in INT_FEATURES:
            parts.append(f"CAST({e} AS BIGINT) AS {c}")
        elif c not in NON_DOUBLE:
            parts.append(f"round(CAST({e} AS DOUBLE), 6) + 0.0 AS {c}")
        else:
            parts.append(f"{e} AS {c}")
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {source}"
