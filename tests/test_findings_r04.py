"""Findings of round 4, each on rows of its own."""

import datetime as dt
import random
import re
import statistics

import pytest

from courtline.operators import sinks as SK
from courtline.plans import features as FT
from courtline.plans import reads as RD
from tests.test_features import LOG_COLS, LOG_SCHEMA, make_fixture


def frames(spark):
    players, logs, games, injuries, salaries = make_fixture(5)
    return (spark.createDataFrame([(p["player_id"], p["position"], p["team_id"], p["is_active"]) for p in players],
                                  "player_id long, position string, team_id long, is_active boolean"),
            spark.createDataFrame([tuple(l[c] for c in LOG_COLS) for l in logs], LOG_SCHEMA),
            spark.createDataFrame([(g["game_id"], g["game_date"], g["home_team_id"], g["away_team_id"]) for g in games],
                                  "game_id long, game_date date, home_team_id long, away_team_id long"),
            spark.createDataFrame([(i["player_id"], i["injury_date"]) for i in injuries], "player_id long, injury_date date"),
            spark.createDataFrame([(s["player_id"], s["game_date"], s["platform"], s["salary"]) for s in salaries],
                                  "player_id long, game_date date, platform string, salary int"))


def widths(df):
    """Columns of the rows that each exchange of the plan moves."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [int(n) for n in re.findall(r"\) Exchange\s*\nInput \[(\d+)\]", text)]


def test_wide_states_are_not_exchanged(spark):
    p, l, g, i, s = frames(spark)
    batch = FT.generate_features(l, p, g, i, s, dt.date(2020, 12, 1), dt.date(2020, 12, 20))
    assert 0 < max(widths(batch)) < 40
    keys = FT.generate_features(l, p, g, i, s, dt.date(2020, 12, 1), dt.date(2020, 12, 20), only=("position", "avg_points_L5"))
    assert keys.columns == ["player_id", "target_date", "position", "avg_points_L5"]
    assert sorted(keys.collect(), key=str) == sorted(batch.select(*keys.columns).collect(), key=str)


STORED = "player_id long, target_date date, x double, created_at timestamp, version string, season string"
KEYS, PARTS = ["player_id", "target_date", "version"], ["version", "season"]


def stored_rows(spark, *made):
    return spark.createDataFrame([(p, dt.date(2024, 1, 1) + dt.timedelta(days=k - 1), x, dt.datetime(2024, 2, t), v, s) for p, k, x, t, v, s in made], STORED)


def plain(df):
    return sorted(((r.player_id, r.target_date.day, r.x, r.version, r.season) for r in df.collect()), key=str)


def test_dealt_saves_move_only_rows_that_meet_stored_ones(spark, tmp_path, monkeypatch):
    path, merged = str(tmp_path / "t"), []
    merge = SK.merge_rows
    monkeypatch.setattr(SK, "merge_rows", lambda existing, updates, *a: merged.append(updates.count()) or merge(existing, updates, *a))

    def save(*made):
        merged.clear()
        SK.upsert_partitioned(spark, path, stored_rows(spark, *made), KEYS, PARTS, "created_at", fixed_partitions=True, deal_by=["player_id"])
        return plain(SK.read_table(spark, path))

    a, b = ("v1", "s1"), ("v1", "s 2/x")
    assert save((1, 1, 1.0, 1, *a), (2, 1, 2.0, 1, *a), (1, 2, 3.0, 1, *b)) == [(1, 1, 1.0, *a), (1, 2, 3.0, *b), (2, 1, 2.0, *a)]
    first = {p.name for p in (tmp_path / "t" / "version=v1" / "season=s1").iterdir()}
    # other days and another version: stored files stay
    assert len(save((3, 3, 4.0, 1, *a), (1, 1, 9.0, 1, "v2", "s1"))) == 5 and not merged
    assert first < {p.name for p in (tmp_path / "t" / "version=v1" / "season=s1").iterdir()}
    # all rows of a partition anew, with a NULL key as well; the new files alone
    assert (1, 1, 10.0, "v2", "s1") in save((1, 1, 10.0, 2, "v2", "s1"), (None, 1, 11.0, 2, "v2", "s1")) and not merged
    # some rows of it: merged by row; an older save changes nothing; of two rows of a key the newest
    assert (2, 1, 20.0, *a) in save((2, 1, 20.0, 2, *a), (9, 9, 1.0, 1, "v3", "s1")) and merged == [1]
    assert (2, 1, 20.0, *a) in save((2, 1, 30.0, 1, *a)) and merged == [1]
    got = save((7, 7, 1.0, 1, "v4", "s1"), (7, 7, 2.0, 3, "v4", "s1"), (7, 7, 3.0, 2, "v4", "s1"))
    assert [r for r in got if r[3] == "v4"] == [(7, 7, 2.0, "v4", "s1")] and len(got) == 8


def test_added_files_of_a_cut_off_save_are_taken_over(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    args = (KEYS, PARTS, "created_at")
    old, new = [(p, 1, 1.0, 1, "v1", "s") for p in range(4)], [(p, 2, 2.0, 1, "v1", "s") for p in range(4)]
    SK.upsert_partitioned(spark, path, stored_rows(spark, *old), *args, fixed_partitions=True, deal_by=["player_id"])
    SK.decide_dealt(spark, path, stored_rows(spark, *new).repartition(3), *args, ["player_id"])
    move, moved = SK.move_path, []

    def once(spark, frm, to):
        if moved:
            raise OSError("stopped")
        moved.append(to)
        move(spark, frm, to)

    monkeypatch.setattr(SK, "move_path", once)
    with pytest.raises(OSError):
        SK.recover(spark, path)
    monkeypatch.setattr(SK, "move_path", move)
    assert SK.recover(spark, path) and plain(SK.read_table(spark, path)) == plain(stored_rows(spark, *old, *new))


def test_correlated_series_are_lists_of_plain_numbers(spark, monkeypatch):
    r, rows = random.Random(4), []
    for p in range(1, 6):
        for k in range(40):
            rows += [(p, dt.date(2024, 1, 1) + dt.timedelta(days=k), round(r.uniform(0, 60), 2)) for _ in range(2 if p == 2 and k % 7 == 0 else r.random() < 0.8)]
    logs = spark.createDataFrame(rows, "player_id long, game_date date, dfs_points_dk double")
    staged, cut = [], RD.cut_lineage
    monkeypatch.setattr(RD, "cut_lineage", lambda df: staged.append(cut(df)) or staged[-1])
    got = {(x.player_a, x.player_b): x.correlation for x in RD.correlation_matrix(logs, logs.select("player_id")).collect()}
    series = staged[-1]
    assert [f.dataType.simpleString() for f in series.schema.fields[1:]] == ["array<int>"] + ["array<double>"] * 3
    assert {x.player_id: (x.n is None, x.m2 is None) for x in series.collect()} == {p: (p != 2, p != 2) for p in range(1, 6)}
    assert len(got) == 25
    for a in range(1, 6):
        for b in range(1, 6):
            if a != b:
                pairs = [(x, y) for p, d, x in rows if p == a for q, e, y in rows if q == b and d == e]
                assert got[a, b] == pytest.approx(statistics.correlation(*zip(*pairs)))
