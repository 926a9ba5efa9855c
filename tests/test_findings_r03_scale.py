"""What the third round's findings on time and moved bytes asked for, each on rows of its own."""

import datetime as dt
import glob
import re
from collections import Counter

import pytest

from courtline.operators import etl as E
from courtline.operators import frames as FR
from courtline.operators import storage as ST
from courtline.plans import reads as RD
from courtline.plans.catalog import QUERIES

DAY = dt.date(2024, 1, 1)
LOG = ("player_id long, game_id long, game_date date, minutes double, points int, field_goals_made int, field_goals_attempted int, "
       "three_pointers_made int, three_pointers_attempted int, free_throws_made int, free_throws_attempted int, rebounds_total int, assists int, "
       "steals int, blocks int, turnovers int, true_shooting_percentage double, effective_field_goal_percentage double, usage_rate double, "
       "dfs_points_dk double, dfs_points_fd double, rest_days int")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logs_of(spark, rows):
    return spark.createDataFrame([(p, g, d, 30.0, 10, 4, 8, 1, 2, 1, 1, 5, 3, 1, 1, 2, None, None, None, None, None, None) for p, g, d in rows], LOG)


def test_ownership_is_that_of_the_slate_and_games_come_last(spark):
    salaries = spark.createDataFrame([(1, DAY, "DraftKings", 5000, "PG", True), (2, DAY, "DraftKings", 9000, "PG", True), (3, DAY, "DraftKings", 7000, None, True),
                                      (4, DAY, "DraftKings", 3000, "PG", True), (5, DAY, "DraftKings", 4000, "PG", False), (2, DAY, "FanDuel", 100, "PG", True),
                                      (1, DAY, "DraftKings", 6000, "PG", True), (6, DAY, "DraftKings", 1, "PG", True)],
                                     "player_id long, game_date date, platform string, salary int, position string, is_available boolean")
    players = spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", 20), (4, "D", 30), (5, "E", 10), (6, "F", None)], "player_id long, name string, team_id long")
    teams = spark.createDataFrame([(10, "X"), (20, "Y"), (30, "Z")], "team_id long, abbreviation string")
    games = spark.createDataFrame([(100, DAY, 10, 20), (101, DAY, 20, 40), (102, DAY, 20, 10), (103, DAY + dt.timedelta(1), 30, 10)],
                                  "game_id long, game_date date, home_team_id long, away_team_id long")
    games = games.selectExpr("*", "200d as total_line", "1d as home_spread", "-1d as away_spread")
    want = RD.ownership_projections(RD.dfs_slate(salaries, players, teams, games))
    got = RD.per_game(RD.slate_ownership(salaries, players, teams, games))
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.count() == 10
    plan = plan_text(got)
    assert "Exchange" not in plan[:plan.index("array_repeat")]


def test_rest_days_are_planned_for_readers_that_use_them_only(spark):
    logs = logs_of(spark, [(1, 1, DAY), (1, 2, DAY + dt.timedelta(3)), (1, 3, DAY + dt.timedelta(300)), (None, 4, DAY), (1, 5, None)])
    players = spark.createDataFrame([(1, 1, "A", 10, True)], "id long, player_id long, name string, team_id long, is_active boolean")
    teams = spark.createDataFrame([(10, "X", None, None)], "team_id long, abbreviation string, conference string, division string")
    _, _, out = E.run_full_etl(players, teams, logs)
    scores = out.select("player_id", "game_id", "dfs_points_dk")
    assert not re.search("Window|Join", plan_text(scores))
    assert {r.game_id: r.rest_days for r in out.collect()} == {1: 0, 2: 2, 3: 296}      # NULL keys have no place in an order
    assert {r.game_id for r in scores.collect()} == {1, 2, 3}


def test_a_chunks_rows_are_sorted_once(spark):
    rows = spark.createDataFrame([(1, 1, DAY)], "player_id long, game_id long, game_date date")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = FR.lag_across_chunks(rows, ["player_id"], ["game_date", "game_id"], FR.season_chunk("game_date"), "game_date", "_prev")
        plan = plan_text(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert plan.index("SortMergeJoin") < plan.index("Window")


def test_values_that_do_not_fit_are_found_by_comparison(spark):
    rows = spark.createDataFrame([(2**40, 128, 1.5), (32767, -129, 4e4), (-32768, 127, None), (None, None, -2.0)], "points long, plus_minus int, steals double")
    stored, watch = ST.overflowing(rows, "logs")
    assert [tuple(r) for r in stored.collect()] == [(None, None, 1), (32767, None, None), (-32768, 127, None), (None, None, -2)]
    assert ST.overflow_counts(watch) == {"points": 1, "plus_minus": 2, "steals": 1}
    plan = ST.typed(rows.drop("steals"), ST.STORAGE_TYPES["logs"])._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" not in plan.lower()


def test_row_wise_steps_are_methods_that_the_jvm_compiles(spark, sf_dir, capsys):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES["etl_full_run"](spark, sf_dir).explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_box_scores_land_compressed(spark, sf_dir, tmp_path, monkeypatch):
    from courtline.plans import catalog as C
    monkeypatch.setattr(C, "_scratch", lambda _, name: f"{tmp_path}/{name}")
    n = QUERIES["io_box_score_ingest"](spark, sf_dir).count()
    files = glob.glob(f"{tmp_path}/box-landing/part-*")
    assert n > 0 and files and all(f.endswith(".json.lz4") for f in files)


def test_schedule_reads_the_cleaned_logs_once(spark, sf_dir):
    assert "lineitem" not in plan_text(QUERIES["ft_opponent_schedule"](spark, sf_dir))
