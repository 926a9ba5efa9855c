import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtline.operators import etl as E

LOG_SCHEMA = ("player_id long, game_id long, game_date date, minutes double, points int, field_goals_made int, "
              "field_goals_attempted int, three_pointers_made int, three_pointers_attempted int, free_throws_made int, "
              "free_throws_attempted int, rebounds_total int, assists int, steals int, blocks int, turnovers int, "
              "true_shooting_percentage double, effective_field_goal_percentage double, usage_rate double, "
              "dfs_points_dk double, dfs_points_fd double, rest_days int")

D = dt.date(2024, 1, 1)


def log(pid=1, gid=1, d=D, minutes=30.0, pts=10, fgm=4, fga=8, tpm=1, tpa=3, ftm=1, fta=2, reb=5, ast=3, stl=1, blk=1,
        tov=2, ts=None, efg=None, usg=None, dk=None, fd=None, rest=None):
    return (pid, gid, d, minutes, pts, fgm, fga, tpm, tpa, ftm, fta, reb, ast, stl, blk, tov, ts, efg, usg, dk, fd, rest)


def test_fix_only_flagged_rows(spark):
    rows = [log(gid=1, minutes=50.0, fgm=9, fga=8),          # flagged: cap minutes, made := attempted
            log(gid=2, fgm=3, fga=0),                           # flagged (made > attempted) but attempted 0: unchanged
            log(gid=3, minutes=-5.0),                           # flagged; minutes < 0 is left as is
            log(gid=4, reb=-2),                                 # not flagged: negative rebounds alone stay
            log(gid=5, pts=-4, reb=-1, tov=-3)]                 # flagged by points: negatives to 0, turnovers stay
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    out = {r.game_id: r for r in E.fix_invalid(df).collect()}
    assert out[1].minutes == 48.0 and out[1].field_goals_made == 8
    assert out[2].field_goals_made == 3
    assert out[3].minutes == -5.0
    assert out[4].rebounds_total == -2
    assert out[5].points == 0 and out[5].rebounds_total == 0 and out[5].turnovers == -3
    flags = {r.game_id: r.is_invalid for r in E.flag_invalid(df).collect()}
    assert flags == {1: True, 2: True, 3: True, 4: False, 5: True}


def test_advanced_branches(spark):
    rows = [log(gid=1, pts=20, fga=10, fta=5, minutes=24.0, tov=2),
            log(gid=2, fga=10, fta=0, ts=0.5),                  # FTA 0: TS keeps the old value
            log(gid=3, fga=0, fta=4, fgm=0),                    # FGA 0: eFG 0.0
            log(gid=4, minutes=0.0, usg=7.0),                   # minutes 0: usage unchanged
            log(gid=5, minutes=None, usg=None, d=dt.date(2023, 1, 1))]  # outside the range: untouched
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    out = {r.game_id: r for r in E.advanced_stats(df, "2024-01-01", "2024-01-31").collect()}
    assert out[1].true_shooting_percentage == pytest.approx(20 / (2 * (10 + 0.44 * 5)))
    assert out[1].effective_field_goal_percentage == pytest.approx((4 + 0.5) / 10)
    assert out[1].usage_rate == pytest.approx((10 + 0.44 * 5 + 2) / (24 / 48))
    assert out[2].true_shooting_percentage == 0.5
    assert out[3].effective_field_goal_percentage == 0.0
    assert out[4].usage_rate == 7.0
    assert out[5].effective_field_goal_percentage is None


def test_scoring_fills_only_missing(spark):
    df = spark.createDataFrame([log(gid=1, dk=99.0), log(gid=2)], LOG_SCHEMA)
    out = {r.game_id: r for r in E.score_platform(df, "DraftKings").collect()}
    assert out[1].dfs_points_dk == 99.0
    assert out[2].dfs_points_dk == 10 + 6.25 + 4.5 + 3 + 3 - 2
    with pytest.raises(ValueError):
        E.score_platform(df, "Yahoo")


@pytest.mark.parametrize("chunked", [True, False])
def test_rest_days(spark, chunked):
    d = dt.date
    rows = [log(pid=1, gid=1, d=d(2021, 9, 28)), log(pid=1, gid=2, d=d(2021, 10, 2)),   # across a season border
            log(pid=1, gid=3, d=d(2021, 10, 3)), log(pid=1, gid=4, d=d(2021, 10, 3)),   # same day: 0
            log(pid=2, gid=5, d=d(2021, 10, 1), rest=7), log(pid=2, gid=6, d=d(2021, 10, 9), rest=8)]
    logs = spark.createDataFrame(rows, LOG_SCHEMA)
    players = spark.createDataFrame([(1, True), (2, False)], "player_id long, is_active boolean")
    out = {r.game_id: r.rest_days for r in E.rest_days(logs, players, chunked=chunked).collect()}
    assert out == {1: 0, 2: 3, 3: 0, 4: 0, 5: 7, 6: 8}


def test_dedup_and_teams(spark):
    players = spark.createDataFrame([(1, 10, "A"), (5, 11, "A"), (3, 12, "B"), (4, 13, None), (6, 14, None)],
                                    "id long, player_id long, name string")
    kept = sorted(r.id for r in E.dedup_players(players).collect())
    assert kept == [3, 4, 5, 6]
    assert [(r.name, r["count"]) for r in E.duplicate_names(players).collect()] == [("A", 2)]
    teams = spark.createDataFrame([(1, "bos", "", None), (2, "xyz", None, None), (3, "lal", "West", "Pac")],
                                  "team_id long, abbreviation string, conference string, division string")
    out = {r.team_id: (r.abbreviation, r.conference, r.division) for r in E.normalize_teams(teams).collect()}
    assert out == {1: ("BOS", "Eastern", "Atlantic"), 2: ("XYZ", "Unknown", "Unknown"), 3: ("LAL", "West", "Pac")}


def test_box_score_weights(spark):
    df = spark.createDataFrame([log(pts=10, reb=10, ast=10, stl=10, minutes=30.0)], LOG_SCHEMA)
    r = E.box_score_points(df, quadDouble=5.0, mins=0.5).first()
    assert r.categories_ge_10 == 4
    assert r.fantasy_points == pytest.approx(10 + 12.5 + 15 + 30 + 3 - 2 + 15 + 5)
