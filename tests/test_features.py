import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from courtline.plans import features as FT
from tests.feature_oracle import close, features as py_features

LOG_COLS = ["player_id", "game_id", "game_date", "minutes", "points", "field_goals_made", "field_goals_attempted",
            "three_pointers_made", "three_pointers_attempted", "free_throws_made", "free_throws_attempted",
            "rebounds_total", "assists", "steals", "blocks", "turnovers", "usage_rate", "true_shooting_percentage",
            "dfs_points_dk", "rest_days", "is_home", "opponent_team_id"]
LOG_SCHEMA = ("player_id long, game_id long, game_date date, minutes double, points int, field_goals_made int, "
              "field_goals_attempted int, three_pointers_made int, three_pointers_attempted int, free_throws_made int, "
              "free_throws_attempted int, rebounds_total int, assists int, steals int, blocks int, turnovers int, "
              "usage_rate double, true_shooting_percentage double, dfs_points_dk double, rest_days int, "
              "is_home boolean, opponent_team_id long")


def make_fixture(seed=11):
    """Three players (one inactive), ~70 games each over a season border, with same-day ties, NULLs and
    zeros in every stat, injuries at the window edges and DraftKings salaries with gaps."""
    rnd = random.Random(seed)
    start = dt.date(2020, 7, 1)
    players = [{"player_id": 1, "position": "PG", "team_id": 10, "is_active": True},
               {"player_id": 2, "position": None, "team_id": 11, "is_active": True},
               {"player_id": 3, "position": "C", "team_id": 12, "is_active": False}]
    logs, games, gid = [], [], 1000
    for p in players:
        day = start
        for i in range(70):
            day += dt.timedelta(days=rnd.choice([0, 1, 2, 2, 3, 9]))
            gid += 1
            home = rnd.choice([p["team_id"], 20, 21])
            away = rnd.choice([t for t in (20, 21, 22, p["team_id"]) if t != home])
            games.append({"game_id": gid, "game_date": day, "home_team_id": home, "away_team_id": away})

            def v(hi, p_null=0.1):
                r = rnd.random()
                return None if r < p_null else (0 if r < 0.2 else rnd.randint(1, hi))
            usage = None if rnd.random() < 0.2 else (0.0 if rnd.random() < 0.2 else round(rnd.uniform(5, 40), 3))
            ts = None if rnd.random() < 0.2 else (0.0 if rnd.random() < 0.2 else round(rnd.uniform(0.2, 0.8), 4))
            logs.append({"player_id": p["player_id"], "game_id": gid, "game_date": day,
                         "minutes": None if rnd.random() < 0.1 else float(rnd.randint(0, 48)),
                         "points": v(40), "field_goals_made": v(12), "field_goals_attempted": v(20),
                         "three_pointers_made": v(5), "three_pointers_attempted": v(9), "free_throws_made": v(8),
                         "free_throws_attempted": v(10), "rebounds_total": v(15), "assists": v(12), "steals": v(4),
                         "blocks": v(4), "turnovers": v(6), "usage_rate": usage, "true_shooting_percentage": ts,
                         "dfs_points_dk": None if rnd.random() < 0.1 else round(rnd.uniform(0, 60), 2),
                         "rest_days": None if rnd.random() < 0.1 else rnd.randint(0, 5),
                         "is_home": None if rnd.random() < 0.1 else rnd.random() < 0.5,
                         "opponent_team_id": rnd.choice([20, 21, 22, None])})
    injuries = []
    for p in players:
        for k in range(6):
            injuries.append({"player_id": p["player_id"], "injury_date": start + dt.timedelta(days=60 + 17 * k)})
    salaries = []
    for l in logs:
        if rnd.random() < 0.8:
            salaries.append({"player_id": l["player_id"], "game_date": l["game_date"], "platform": "DraftKings",
                             "salary": rnd.choice([0, 3000, 4500, 7200, 9900])})
    # dedupe salary keys (player, day, platform)
    seen, sal = set(), []
    for s in salaries:
        k = (s["player_id"], s["game_date"])
        if k not in seen:
            seen.add(k)
            sal.append(s)
    return players, logs, games, injuries, sal


@pytest.fixture(scope="module")
def fixture(spark):
    players, logs, games, injuries, sal = make_fixture()
    P = spark.createDataFrame([(p["player_id"], p["position"], p["team_id"], p["is_active"]) for p in players],
                              "player_id long, position string, team_id long, is_active boolean")
    L = spark.createDataFrame([tuple(l[c] for c in LOG_COLS) for l in logs], LOG_SCHEMA)
    G = spark.createDataFrame([(g["game_id"], g["game_date"], g["home_team_id"], g["away_team_id"]) for g in games],
                              "game_id long, game_date date, home_team_id long, away_team_id long")
    I = spark.createDataFrame([(i["player_id"], i["injury_date"]) for i in injuries], "player_id long, injury_date date")
    S = spark.createDataFrame([(s["player_id"], s["game_date"], s["platform"], s["salary"]) for s in sal],
                              "player_id long, game_date date, platform string, salary int")
    return (players, logs, games, injuries, sal), (P, L, G, I, S)


START, END = dt.date(2020, 8, 1), dt.date(2021, 2, 15)


def test_features_match_row_oracle(fixture):
    (players, logs, games, injuries, sal), (P, L, G, I, S) = fixture
    got = FT.generate_features(L, P, G, I, S, START, END).collect()
    want = py_features(logs, players, games, injuries, sal, START, END)
    assert len(got) == len(want) and len(got) > 100
    bad = []
    for r in got:
        exp = want[(r.player_id, r.target_date)]
        for c in FT.FEATURE_COLS[2:]:
            if not close(r[c], exp.get(c)):
                bad.append((r.player_id, r.target_date, c, r[c], exp.get(c)))
    assert not bad, bad[:10]


def test_no_look_ahead(fixture):
    """Adding logs, injuries and salaries dated at or after t changes nothing at t, except the declared
    exceptions (the day's own game for opponent features, the day's salary)."""
    (_, _, _, _, _), (P, L, G, I, S) = fixture
    t = dt.date(2020, 11, 20)
    base = FT.generate_features(L, P, G, I, S, t, t)
    future_logs = L.where(F.col("game_date") >= t).withColumn("game_id", F.col("game_id") + 100000) \
        .withColumn("game_date", F.date_add("game_date", 1))
    more = FT.generate_features(L.unionByName(future_logs), P, G, I.unionByName(I.withColumn("injury_date", F.lit(t))),
                                S, t, t)
    cols = [c for c in FT.FEATURE_COLS if c not in ("opponent_team_id", "is_home_game", "avg_points_vs_opponent",
                                                    "avg_dfs_vs_opponent", "games_vs_opponent", "current_salary_dk",
                                                    "avg_value_dk", "std_value_dk")]
    assert sorted(base.select(*cols).collect()) == sorted(more.select(*cols).collect())


def test_batch_is_union_of_days(fixture):
    (_, _, _, _, _), (P, L, G, I, S) = fixture
    a, b = dt.date(2020, 12, 1), dt.date(2020, 12, 6)
    batch = FT.generate_features(L, P, G, I, S, a, b)
    days = None
    d = a
    while d <= b:
        one = FT.generate_features(L, P, G, I, S, d, d)
        days = one if days is None else days.unionByName(one)
        d += dt.timedelta(days=1)
    assert sorted(batch.collect()) == sorted(days.collect())


def test_feature_width():
    assert len(FT.FEATURE_COLS) == 110
