import datetime as dt
import gzip
import statistics
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.operators import frames as FR
from courtline.operators import sinks as SK
from courtline.operators import storage as ST
from courtline.plans import exports as EX
from courtline.plans import features as FT
from courtline.plans import reads as RD
from courtline.session import path_exists, scratch_path
from courtline.sources import files as FS
from courtline.streaming import ingest as SS

D = dt.date


def path_for(spark, name):
    return scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- correlation and wide series --------------------------------------------------------------


def logs_of(spark, series):
    rows = [(p, 10 * p + i, D(2024, 1, 1) + dt.timedelta(i), v) for p, values in series.items() for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "player_id long, game_id long, game_date date, dfs_points_dk double")


def test_constant_series_have_no_correlation_whatever_their_value(spark):
    up = [float(i) for i in range(7)]
    logs = logs_of(spark, {1: [0.1] * 7, 2: up, 3: [1e9 + x for x in up], 4: [1e15] * 7, 5: [5.0] * 6 + [5.0000001], 6: [-x for x in up]})
    ids = logs.select("player_id")
    got = {(r.player_a, r.player_b): r.correlation for r in RD.correlation_matrix(logs, ids).collect()}
    assert all(got[k] is None for k in got if 1 in k or 4 in k)
    assert got[(2, 3)] == pytest.approx(1, abs=1e-9) and got[(3, 6)] == pytest.approx(-1, abs=1e-9) and got[(5, 5)] == 1.0
    want = np.corrcoef(up, [0] * 6 + [1])[0, 1]
    assert got[(2, 5)] == pytest.approx(want, abs=1e-6) and all(v is None or -1 <= v <= 1 for v in got.values())


def test_wide_series_is_the_full_outer_join(spark):
    logs = logs_of(spark, {1: [1.0, None, 3.0], 2: [None, 5.0, 6.0]}).unionByName(
        spark.createDataFrame([(1, 99, D(2024, 1, 1), 9.0)], "player_id long, game_id long, game_date date, dfs_points_dk double"))
    wide = RD.wide_series(logs, [2, 1, 7])
    assert wide.columns == ["game_date", "game_of_day", "player_2", "player_1", "player_7"]
    got = sorted((r.game_date.day, r.game_of_day, r.player_2, r.player_1, r.player_7) for r in wide.collect())
    assert got == [(1, 1, None, 1.0, None), (1, 2, None, 9.0, None), (2, 1, 5.0, None, None), (3, 1, 6.0, 3.0, None)]
    assert "Join" not in plan_text(wide)


# ---- CSV folders ------------------------------------------------------------------------------

SCHEMA = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])


def test_columns_in_another_order_are_not_swapped(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    (tmp_path / "c.csv").write_text("y,z\n4,9\n")
    df = FS.read_csv_dir(spark, str(tmp_path), schema=SCHEMA)
    assert sorted(((r.x, r.y) for r in df.collect()), key=str) == [(1, 2), (1, 2), (None, 4)]


def test_bad_files_and_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "good.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "cut.csv").write_text("x,y\n5,6\n7")
    (tmp_path / "typed.csv").write_text("x,y\nn/a,1\n8,9\n")
    (tmp_path / "junk.csv").write_bytes(bytes(range(256)))
    (tmp_path / "names.csv").write_text("x,x\n1,2\n")
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("x,y\n")
    (tmp_path / "all_x.csv").write_text("x,y\n99,99\n")
    whole = gzip.compress(b"x,y\n10,11\n" + b"12,13\n" * 50_000)
    (tmp_path / "whole.csv.gz").write_bytes(whole)
    (tmp_path / "broken.csv.gz").write_bytes(whole[:-20])
    folder = FS.scan_csv_dir(spark, str(tmp_path), schema=SCHEMA)
    got = {r.file.rsplit("/", 1)[1]: (r.status, r.records, r.bad_records, r.reason) for r in folder.files.collect()}
    assert got == {"good.csv": ("ok", 2, 0, None), "cut.csv": ("partial", 1, 1, None), "typed.csv": ("partial", 1, 1, None),
                   "junk.csv": ("skipped", 0, 0, "header is not text"), "names.csv": ("skipped", 0, 0, "header with a repeated name"),
                   "other.csv": ("skipped", 0, 0, "header without a known column"), "empty.csv": ("empty", 0, 0, None), "head.csv": ("ok", 0, 0, None),
                   "whole.csv.gz": ("ok", 50_001, 0, None), "broken.csv.gz": ("skipped", 0, 0, "compressed file breaks off")}
    rows = folder.rows.groupBy("x", "y").count().collect()
    assert {(r.x, r.y): r["count"] for r in rows} == {(1, 2): 1, (3, 4): 1, (5, 6): 1, (8, 9): 1, (10, 11): 1, (12, 13): 50_000}
    assert sorted(r.line for r in folder.bad_rows.collect()) == ["7", "n/a,1"]


def test_folders_without_files(spark, tmp_path):
    assert FS.scan_csv_dir(spark, str(tmp_path)) is None and FS.read_csv_dir(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty.csv").write_text("")
    folder = FS.scan_csv_dir(spark, str(tmp_path), schema=SCHEMA)
    assert folder.rows.count() == 0 and folder.rows.columns == ["x", "y"] and folder.files.first().status == "empty"


# ---- status from footers ----------------------------------------------------------------------


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("p", (F.col("id") % 3).cast("int")).write.partitionBy("p").parquet(path)
    count = FS.footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)))
    assert "PushedAggregation: [COUNT(*)]" in plan_text(count)
    got = {r.dataset: r for r in FS.dataset_status(spark, {"t": path, "no": str(tmp_path / "no")}).collect()}
    assert got["t"].records == 1000 and got["t"].n_columns == 2 and got["t"].files >= 3 and got["no"].status == "not_collected"
    assert got["total"].status == "incomplete" and got["total"].records == 1000


# ---- formats, overflow, layout ----------------------------------------------------------------


def test_an_empty_frame_replaces_nothing_and_the_plan_runs_once(spark, tmp_path):
    path, seen = str(tmp_path / "d"), spark.sparkContext.accumulator(0)

    def touch(batches):
        seen.add(1)
        yield from batches
    assert SK.write_dataset(spark.range(5).coalesce(1).mapInArrow(touch, "id long"), path) and seen.value == 1
    assert SK.write_dataset(spark.range(0), path) is False and spark.read.parquet(path).count() == 5
    assert SK.write_dataset(spark.range(3), path) and spark.read.parquet(path).count() == 3
    assert SK.write_dataset(spark.range(2), path, mode="append") and spark.read.parquet(path).count() == 5
    assert not [x for x in tmp_path.iterdir() if ".new-" in x.name]


def test_overflow_is_counted_by_the_export(spark, tmp_path):
    sal = spark.createDataFrame([(1, D(2024, 1, 1), "DraftKings", 2 ** 40, "C", True), (2, D(2024, 1, 1), "DraftKings", 500, "C", True),
                                 (3, D(2024, 1, 1), "DraftKings", None, "C", True)],
                                "player_id long, game_date date, platform string, salary long, position string, is_available boolean")
    assert EX.export_salaries(sal, str(tmp_path / "s")) == {"salary": 1}
    assert sorted((r.player_id, r.salary) for r in spark.read.parquet(str(tmp_path / "s")).collect() if r.salary) == [(2, 500)]
    assert EX.export_salaries(sal.where("salary = 500"), str(tmp_path / "t")) == {}
    assert ST.storage_ranges("logs")["plus_minus"] == (-128, 127) and "minutes" not in ST.storage_ranges("logs")


def test_clustered_files_are_skipped_by_either_column(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 200).alias("player_id"), F.date_add(F.lit(D(2020, 1, 1)), (F.col("id") / 200).cast("int")).alias("game_date"))
    path = str(tmp_path / "z")
    ST.write_clustered(rows.repartition(4), path, ["player_id", "game_date"], rows_per_group=1000)
    back = spark.read.parquet(path)
    assert back.count() == 40_000

    def read(where):
        df = back.where(where)
        assert df.collect()
        scan = df._jdf.queryExecution().executedPlan()
        while scan.children().size():
            scan = scan.children().apply(0)
        return scan.metrics().apply("numOutputRows").value()
    assert read("player_id = 17") < 20_000 and read("game_date = DATE'2020-03-05'") < 20_000


def test_bucketed_tables_exchange_the_logs_once(spark):
    f = spark.createDataFrame([(i, D(2024, 1, 1 + i % 9), "C", float(i)) for i in range(50)], "player_id long, target_date date, position string, a double")
    s = f.select("player_id", F.col("target_date").alias("game_date"), F.lit("DraftKings").alias("platform"), F.lit(4000).alias("salary"), F.lit("PG").alias("position"))
    l = f.select("player_id", F.col("target_date").alias("game_date"), F.col("a").alias("dfs_points_dk"), F.lit(30.0).alias("minutes"), F.lit(1).alias("points"),
                 F.lit(1).alias("rebounds_total"), F.lit(1).alias("assists"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = RD.training_from_buckets(spark, f, l, s, path_for(spark, "buckets"), 4)
        assert t.count() == 50 and plan_text(t).count("Exchange hashpartitioning") == 1
        assert {r.position for r in t.collect()} == {"PG"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ---- sweep line, moments ----------------------------------------------------------------------


def test_sweep_line_equals_counting_day_by_day(spark):
    import random
    rng = random.Random(3)
    inj = [(p, D(2023, 11, 1) + dt.timedelta(rng.randrange(120))) for p in (1, 2, 3, None) for _ in range(12)] + [(1, D(2023, 12, 31))] * 3
    df = spark.createDataFrame(inj, "player_id long, d date")
    steps = FR.active_counts(df, ["player_id"], F.date_add("d", 1), F.date_add("d", 31)).collect()
    for p in (1, 2, 3, None):
        own = sorted((r.day, r.n, r.latest) for r in steps if r.player_id == p)
        for k in range(170):
            t = D(2023, 10, 25) + dt.timedelta(k)
            held = [d for q, d in inj if q == p and 0 < (t - d).days <= 30]
            now = [x for x in own if x[0] <= t]
            assert (now[-1][1] if now else 0) == len(held)
            assert not held or now[-1][2] == max(held) + dt.timedelta(1)
    assert len(steps) <= 2 * len(inj)


def test_intervals_are_cut_where_steps_change(spark):
    ivs = spark.createDataFrame([(1, 10, D(2024, 1, 1), D(2024, 1, 10)), (1, 11, D(2024, 1, 10), None), (2, 12, D(2024, 1, 5), D(2024, 1, 6))],
                                "k long, g long, lo date, hi date")
    steps = spark.createDataFrame([(1, D(2024, 1, 2), 1), (1, D(2024, 1, 5), 2), (1, D(2024, 1, 11), 3), (1, D(2024, 2, 1), 0), (3, D(2024, 1, 1), 9)], "k long, day date, n int")
    got = sorted((r.k, r.g, r.lo, r.hi or D.max, r.n) for r in FR.split_intervals(ivs, ["k"], ["g"], "lo", "hi", steps, "day", ["n"]).collect())
    assert got == [(1, 10, D(2024, 1, 1), D(2024, 1, 4), 1), (1, 10, D(2024, 1, 4), D(2024, 1, 10), 2), (1, 11, D(2024, 1, 10), D(2024, 1, 31), 3),
                   (1, 11, D(2024, 1, 31), D.max, 0), (2, 12, D(2024, 1, 5), D(2024, 1, 6), None)]


def test_no_sliding_deviation_is_left(spark):
    cols = {src for _, src in FT.ROLL_AVG} | {c for _, m, a in FT.ROLL_PCT for c in (m, a)}
    rows = [(1, 100 + i, D(2024, 1, 1) + dt.timedelta(i), 1, True, *[(7.3 if i < 8 else float(i)) for _ in sorted(cols)]) for i in range(12)]
    logs = spark.createDataFrame(rows, "player_id long, game_id long, game_date date, rest_days int, is_home boolean, " + ", ".join(f"{c} double" for c in sorted(cols)))
    states = FT.log_states(logs, windows=(5,))
    assert "stddev" not in plan_text(states)
    got = [r.std_points_L5 for r in states.orderBy("game_date").collect()]
    assert got[4:8] == [0.0] * 4 and got[11] == pytest.approx(statistics.stdev([7.3, 8, 9, 10, 11]), abs=1e-9)


# ---- rest days of a stream --------------------------------------------------------------------


def test_rest_days_touch_only_partitions_with_changed_rows(spark, monkeypatch):
    target = path_for(spark, "rest")
    players = spark.createDataFrame([(1, True), (2, True), (3, False)], "player_id long, is_active boolean")
    schema = "player_id long, game_id long, game_date date, rest_days int, year int, _seq int"

    def batch(*rows):
        return spark.createDataFrame([(p, g, d, None, d.year, 1) for p, g, d in rows], schema)
    sink = SS.rest_days_sink(target, players, ["player_id", "game_id"], ["year"], "_seq", fixed_partitions=True)
    sink(batch((1, 1, D(2020, 1, 1)), (1, 2, D(2023, 1, 10)), (2, 3, D(2020, 5, 1)), (2, 4, D(2021, 1, 1)), (3, 5, D(2020, 1, 1)), (3, 6, D(2021, 1, 1))), 0)
    wanted = []
    kept = SK.upsert_partitioned

    def spied(s, t, updates, *a, **k):
        if t == target and k.get("update_cols"):
            wanted.append(sorted(r[0] for r in updates.select("year").distinct().collect()))
        return kept(s, t, updates, *a, **k)
    monkeypatch.setattr(SS, "upsert_partitioned", spied)
    sink(batch((1, 7, D(2020, 1, 5)), (1, 8, D(2022, 12, 31))), 1)     # before and between
    got = {r.game_id: r.rest_days for r in SK.read_table(spark, target).collect()}
    assert got == {1: 0, 7: 3, 8: 1090, 2: 9, 3: 0, 4: 244, 5: None, 6: None}
    assert wanted == [[2020, 2022, 2023]]
    assert path_exists(spark, f"{target}_days")
