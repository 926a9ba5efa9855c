import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.operators import sinks as SK
from courtline.plans import exports as EX
from courtline.plans import features as FT
from courtline.plans import reads as RD
from courtline.plans.cleaned import etl_domain
from courtline.session import scratch_path
from courtline.sources import files as FS
from courtline.sources.adapter import Domain


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_and_slate_plans_have_no_pair_joins(spark, sf_dir):
    d = Domain(spark, sf_dir)
    players, teams, logs = etl_domain(d)
    feats = FT.generate_features(logs, players, d.games, d.injuries, d.dfs_salaries, "1997-01-01", "1997-03-01")
    slate = RD.dfs_slate(d.dfs_salaries, players, teams, d.games)
    for df in (feats, slate):
        p = plan_text(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_parquet_pushdown_and_pruning(spark, sf_dir, tmp_path):
    d = Domain(spark, sf_dir)
    q = d.raw("lineitem").where(F.col("l_quantity") >= 45).select("l_orderkey")
    p = plan_text(q)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,45.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p
    _, _, logs = etl_domain(d)
    path = str(tmp_path / "logs")
    EX.export_logs(logs, d.players, path)
    pruned = FS.read_parquet(spark, path).where((F.col("season") == "1996-97") & (F.col("month") == 3))
    pp = plan_text(pruned)
    assert "PartitionFilters" in pp and "season" in pp
    assert pruned.count() == logs.where((F.month("game_date") == 3) & (F.year("game_date") == 1997)).count()


def test_flatten_odds_and_salaries(spark, tmp_path):
    docs = [{"body": [
        {"gameID": "g1", "gameDate": "20240101", "homeTeam": "A", "awayTeam": "B", "teamIDHome": "1", "teamIDAway": "2",
         "sportsBooks": [{"sportsBook": "x", "odds": {"totalOver": "210.5", "totalOverOdds": "-110", "homeTeamMLOdds": "abc"}},
                         {"sportsBook": "y", "odds": {}}]},
        {"gameID": "g2", "gameDate": "20240101", "sportsBooks": []}]}]
    p = tmp_path / "odds.json"
    p.write_text("\n".join(json.dumps(d) for d in docs))
    flat = FS.flatten_odds(FS.read_documents(spark, str(p), FS.ODDS_DOC))
    assert len(flat.columns) == 18 and flat.count() == 2  # the game without books gives no row
    t = SK.raw_odds(flat, "2024-01-01 00:00:00").where("sportsbook = 'x'").first()
    assert t.total_points == 210.5 and t.over_odds == -110 and t.home_moneyline is None
    sal = {"body": {"draftkings": [{"playerID": "7", "salary": "5000", "pos": "PG"}], "fanduel": [],
                    "superdraft": None}}
    ps = tmp_path / "sal.json"
    ps.write_text(json.dumps(sal))
    s = FS.flatten_salaries(FS.read_documents(spark, str(ps), FS.SALARY_DOC)).collect()
    assert [(r.playerID, r.platform, r.dfs_salary) for r in s] == [("7", "DraftKings", "5000")]


def test_write_dataset_rules(spark, tmp_path):
    empty = SK.empty(spark, T.StructType([T.StructField("a", T.LongType())]))
    assert SK.write_dataset(empty, str(tmp_path / "e")) is False
    with pytest.raises(ValueError):
        SK.write_dataset(spark.range(3), str(tmp_path / "x"), "xml")
    assert SK.write_dataset(spark.range(3), str(tmp_path / "c"), "csv") is True


def test_csv_folder_skips_consolidated_and_unions_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("player_id,status\n1,Out\n")
    (tmp_path / "b.csv").write_text("status,player_id,body_part\nQuestionable,2,knee\n")
    (tmp_path / "all_data.csv").write_text("player_id,status\n9,Out\n")
    df = FS.read_csv_dir(spark, str(tmp_path))
    got = sorted((r.player_id, r.status, r.body_part) for r in df.collect())
    assert got == [("1", "Out", None), ("2", "Questionable", "knee")]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, 1, 2024, 10), (1, 2, 2024, 11), (2, 3, 2023, 5)], "p long, g long, y int, v int")
    path = scratch_path(spark, f"t-upsert-{uuid.uuid4().hex}")
    SK.write_partitioned(base, path, ["y"])
    upd = spark.createDataFrame([(1, 2, 2024, 99, 2), (3, 4, 2024, 7, 1), (1, 2, 2024, 98, 1)], "p long, g long, y int, v int, _seq int")
    for _ in range(3):
        SK.upsert_partitioned(spark, path, upd, ["p", "g"], ["y"], "_seq")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("p", "g", "y", "v").collect())
    assert got == [(1, 1, 2024, 10), (1, 2, 2024, 99), (2, 3, 2023, 5), (3, 4, 2024, 7)]


def test_upsert_moves_keys_and_ignores_the_sessions_overwrite_mode(spark):
    base = spark.createDataFrame([(1, 2019, 10), (2, 2019, 11), (3, 2020, 5), (4, 2021, 6)], "p long, y int, v int")
    path = scratch_path(spark, f"t-moved-{uuid.uuid4().hex}")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        SK.write_partitioned(base, path, ["y"])
        upd = spark.createDataFrame([(1, 2020, 12, 1), (4, 2020, 7, 1)], "p long, y int, v int, _seq int")
        SK.upsert_partitioned(spark, path, upd, ["p"], ["y"], "_seq")       # 2021 is left empty
        got = sorted(tuple(r) for r in spark.read.parquet(path).select("p", "y", "v").collect())
        assert got == [(1, 2020, 12), (2, 2019, 11), (3, 2020, 5), (4, 2020, 7)]
        SK.write_partitioned(base.where("y = 2019"), path, ["y"], replace_all=True)
        assert spark.read.parquet(path).count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_touched_partitions_prune_the_scan(spark):
    path = scratch_path(spark, f"t-prune-{uuid.uuid4().hex}")
    SK.write_partitioned(spark.range(20).withColumn("y", (F.col("id") % 5).cast("int")), path, ["y"])
    some = spark.read.parquet(path).where(SK.partition_filter([{"y": 1}, {"y": 3}], ["y"]))
    assert "y#" in plan_text(some).split("PartitionFilters: [")[1].split("]")[0]


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from courtline import session
    monkeypatch.setattr(session, "is_local", lambda s: False)

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Bare)
    assert session.checkpoint_root(spark)


def test_feature_store_saves_days_one_by_one(spark, tmp_path):
    rows = [(1, dt.date(2019, 1, 5), 1.0), (1, dt.date(2019, 1, 6), 2.0), (2, dt.date(2019, 1, 6), 3.0)]
    feats = spark.createDataFrame(rows, "player_id long, target_date date, x double")
    path = str(tmp_path / "days")
    for day in ("2019-01-06", "2019-01-05", "2019-01-06"):
        EX.store_features(feats.where(F.col("target_date") == day), path)
    got = sorted((r.player_id, r.target_date, r.x) for r in EX.read_features(spark, path).collect())
    assert got == sorted(rows)
    some = EX.read_features(spark, path, start="2019-01-01", end="2019-02-01")
    assert "season" in plan_text(some).split("PartitionFilters")[1].split("PushedFilters")[0] and some.count() == 3


def test_logical_names(spark):
    names = ["player_logs_20211019_game_20211019_BKN@MIL.parquet", "player_logs_20211019_game_x_BKN@MIL.parquet",
             "player_logs_20211019_game_401.parquet", "players_2024_current_20240101_000000.parquet", "injuries_20230405_to_20230430.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(FS.logical_name(F.col("n")).alias("x"))
    assert [r.x for r in df.collect()] == ["player_logs_20211019_BKN@MIL.parquet"] * 2 + ["player_logs_20211019_401.parquet",
                                           "players_current.parquet", "injuries_20230405_to_20230430.parquet"]


def test_season_and_recent_ranges():
    assert FS.season_range(2024) == (dt.date(2023, 10, 1), dt.date(2024, 4, 30))
    assert FS.recent_range(7, dt.date(2024, 3, 10)) == (dt.date(2024, 3, 3), dt.date(2024, 3, 10))
    assert FS.recent_range(7, dt.date(2024, 3, 10), end=dt.date(2025, 1, 1))[1] == dt.date(2024, 3, 10)
    with pytest.raises(ValueError):
        FS.recent_range(7, dt.date(2024, 3, 10), start=dt.date(2024, 5, 1))


def test_ownership_edges(spark):
    slate = spark.createDataFrame([(dt.date(2024, 1, 1), 1, "a", "PG", 3000), (dt.date(2024, 1, 1), 2, "b", "PG", 5000),
                                   (dt.date(2024, 1, 1), 3, "c", "C", 4000), (dt.date(2024, 1, 1), 4, "d", None, 4000)],
                                  "game_date date, player_id long, player_name string, position string, salary int")
    got = {r.player_id: r.ownership_projection for r in RD.ownership_projections(slate).collect()}
    assert got == {1: 5.0, 2: 25.0, 3: 15.0, 4: None}


def test_correlation_edges(spark):
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    rows = [(1, x, float(i)) for i, x in enumerate(d)] + [(2, x, float(2 * i + 1)) for i, x in enumerate(d)] + \
           [(3, x, 4.0) for x in d] + [(4, d[0], 1.0)]
    logs = spark.createDataFrame(rows, "player_id long, game_date date, dfs_points_dk double")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "player_id long")
    got = {(r.player_a, r.player_b): r.correlation for r in RD.correlation_matrix(logs, ids).collect()}
    assert got[(1, 2)] == pytest.approx(1.0) and got[(1, 1)] == 1.0
    assert got[(1, 3)] is None and got[(3, 3)] is None and got[(4, 4)] is None
    assert (1, 4) in got and got[(1, 4)] is None  # one shared date


def test_feature_store_point_read_prunes(spark, tmp_path):
    rows = [(1, dt.date(2020, 11, 3), 1.5), (2, dt.date(2021, 11, 3), 2.5), (1, dt.date(2021, 11, 4), 3.5)]
    feats = spark.createDataFrame(rows, "player_id long, target_date date, avg_points_L5 double")
    path = str(tmp_path / "store")
    EX.store_features(feats, path, version="v1")
    EX.store_features(feats.withColumn("avg_points_L5", F.lit(0.0)), path, version="v2")
    one = EX.read_features(spark, path, version="v1", player_id=2, day="2021-11-03")
    p = plan_text(one)
    assert "PartitionFilters" in p and "feature_set_version" in p and "season" in p
    assert [(r.player_id, r.avg_points_L5) for r in one.collect()] == [(2, 2.5)]
    # rewriting a version replaces only its partitions (dynamic overwrite): v2 is untouched
    EX.store_features(feats.withColumn("avg_points_L5", F.lit(9.0)), path, version="v1")
    got = sorted((r.feature_set_version, r.avg_points_L5) for r in spark.read.parquet(path).collect())
    assert got == [("v1", 9.0)] * 3 + [("v2", 0.0)] * 3
