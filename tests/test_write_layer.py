import uuid

import pytest
from pyspark.sql import functions as F

from courtline.operators import sinks as SK
from courtline.plans import exports as EX
from courtline.session import path_exists, read_text, scratch_path, write_text
from courtline.streaming import ingest as SS

ROWS = "p long, y int, v int"


def path_for(spark, name):
    return scratch_path(spark, f"t-{name}-{uuid.uuid4().hex}")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def stored(spark, path, *cols):
    return rows_of(SK.read_table(spark, path), *(cols or ("p", "y", "v")))


def table(spark, name, rows, schema=ROWS):
    path = path_for(spark, name)
    SK.write_partitioned(spark.createDataFrame(rows, schema), path, ["y"])
    return path


BASE = [(1, 2019, 10), (2, 2020, 11), (3, 2021, 5)]
MOVED = [(1, 2020, 12, 1), (3, 2022, 6, 1), (9, 2019, 1, 1)]
AFTER = [(1, 2020, 12), (2, 2020, 11), (3, 2022, 6), (9, 2019, 1)]


@pytest.mark.parametrize("stop", ["staged", "decided", "replaced", "removed", "noted"])
def test_a_writer_that_stops_anywhere_is_finished_by_the_next(spark, monkeypatch, stop):
    path = table(spark, "crash", BASE)
    batch = (spark.createDataFrame(MOVED, ROWS + ", _seq int"), ["p"], ["y"], "_seq")

    class Stop(Exception):
        pass

    def stopped(*a, **k):
        raise Stop
    broken = {"staged": ("write_text", stopped), "decided": ("replace_partitions", stopped), "replaced": ("remove_emptied", stopped),
              "removed": ("note", stopped)}
    if stop == "noted":
        kept, calls = SK.remove_path, []
        monkeypatch.setattr(SK, "remove_path", lambda s, p: stopped() if p.endswith(SK.RECORD) else kept(s, p))
    else:
        monkeypatch.setattr(SK, *broken[stop])
    with pytest.raises(Stop):
        SK.upsert_partitioned(spark, path, *batch)
    monkeypatch.undo()
    if stop != "staged":       # decided: the next writer finishes it, whatever it writes itself
        other = spark.createDataFrame([(2, 2020, 50, 1)], ROWS + ", _seq int")
        SK.upsert_partitioned(spark, path, other, *batch[1:])
        assert stored(spark, path) == sorted([(2, 2020, 50) if r[0] == 2 else r for r in AFTER])
    SK.upsert_partitioned(spark, path, *batch)
    assert [r for r in stored(spark, path) if r[0] != 2] == [r for r in AFTER if r[0] != 2]
    assert not path_exists(spark, f"{path}/{SK.PENDING}") and not SK.recover(spark, path)


def test_what_was_staged_without_a_record_is_dropped(spark):
    path = table(spark, "staged", BASE)
    SK.write_partitioned(spark.createDataFrame([(7, 2019, 7)], ROWS), f"{path}/{SK.PENDING}/rows", ["y"])
    assert stored(spark, path) == BASE          # readers don't see it
    assert SK.recover(spark, path) is False and stored(spark, path) == BASE


def test_null_keys_and_null_partitions_are_replaced(spark):
    path = path_for(spark, "nulls")
    rows = spark.createDataFrame([(None, None, 1, 1), (None, 2020, 2, 1), (4, None, 3, 1)], ROWS + ", _seq int")
    for _ in range(3):
        SK.upsert_partitioned(spark, path, rows, ["p", "y"], ["y"], "_seq")
    assert stored(spark, path) == sorted([(None, None, 1), (None, 2020, 2), (4, None, 3)], key=str)
    SK.upsert_partitioned(spark, path, spark.createDataFrame([(None, 2021, 9, 1), (4, 2021, 4, 1)], ROWS + ", _seq int"), ["p"], ["y"], "_seq")
    assert stored(spark, path) == sorted([(None, 2021, 9), (4, 2021, 4)], key=str)      # one null key left, moved


def test_versions_in_any_order(spark):
    schema = "p long, y int, v int, ver int"
    path = table(spark, "versions", [(1, 2020, 10, 2), (2, 2020, 20, None), (3, 2020, 30, 1), (3, 2020, 31, 3)], schema)

    def put(*rows):
        SK.upsert_partitioned(spark, path, spark.createDataFrame(rows, schema), ["p"], ["y"], "ver")
    put((1, 2020, 9, 1), (2, 2020, 21, None), (4, 2020, 40, None))
    assert stored(spark, path, "p", "v", "ver") == [(1, 10, 2), (2, 21, None), (3, 31, 3), (4, 40, None)]
    put((1, 2020, 12, 2), (2, 2020, 22, 1), (3, 2020, 32, None), (4, 2021, 41, 5))
    assert stored(spark, path, "p", "y", "v", "ver") == [(1, 2020, 12, 2), (2, 2020, 22, 1), (3, 2020, 31, 3), (4, 2021, 41, 5)]
    put((4, 2020, 39, 4))       # older, from another partition: nothing moves back
    assert stored(spark, path, "p", "y", "v") == [(1, 2020, 12), (2, 2020, 22), (3, 2020, 31), (4, 2021, 41)]


def test_new_columns_stay_and_types_that_do_not_fit_fail(spark):
    path = table(spark, "columns", BASE)
    more = spark.createDataFrame([(1, 2019, 10, "x", 1)], ROWS + ", note string, _seq int")
    SK.upsert_partitioned(spark, path, more, ["p"], ["y"], "_seq")
    assert stored(spark, path, "p", "note") == [(1, "x"), (2, None), (3, None)]
    SK.upsert_partitioned(spark, path, spark.createDataFrame([(2, 2020, 5, 1)], ROWS + ", _seq int"), ["p"], ["y"], "_seq")
    assert stored(spark, path, "p", "v", "note") == [(1, 10, "x"), (2, 5, None), (3, 5, None)]
    too_large = spark.createDataFrame([(2, 2020, 2 ** 40, 1)], "p long, y int, v long, _seq int")
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        SK.upsert_partitioned(spark, path, too_large, ["p"], ["y"], "_seq")
    SK.recover(spark, path)
    assert stored(spark, path, "p", "v") == [(1, 10), (2, 5), (3, 5)]


def test_listed_columns_only_and_inserts_whole(spark):
    path = table(spark, "listed", BASE)
    upd = spark.createDataFrame([(1, 2019, 99, "n", 1), (8, 2019, 8, "m", 1)], ROWS + ", note string, _seq int")
    SK.upsert_partitioned(spark, path, upd, ["p"], ["y"], "_seq", update_cols=["note"])
    assert stored(spark, path, "p", "v", "note") == [(1, 10, "n"), (2, 11, None), (3, 5, None), (8, 8, "m")]


def test_feature_versions_have_their_own_columns(spark):
    path = path_for(spark, "features")
    f1 = spark.createDataFrame([(1, "2024-01-02", 1.0), (2, "2024-01-02", 2.0)], "player_id long, d string, a double") \
        .withColumn("target_date", F.to_date("d")).drop("d")
    f2 = f1.withColumns({"b": F.col("a") * 2, "c": F.lit("x")})
    EX.store_features(f1, path, "v1", created_at="2024-02-01 00:00:00")
    EX.store_features(f2, path, "v2", created_at="2024-02-01 00:00:00")
    EX.store_features(f1.withColumn("a", F.lit(-1.0)), path, "v1", created_at="2024-01-31 00:00:00")     # an earlier save comes late
    v1, v2 = EX.read_features(spark, path, "v1"), EX.read_features(spark, path, "v2", day="2024-01-02")
    assert "b" not in v1.columns and rows_of(v1, "player_id", "a") == [(1, 1.0), (2, 2.0)]
    assert rows_of(v2, "player_id", "a", "b", "c") == [(1, 1.0, 2.0, "x"), (2, 2.0, 4.0, "x")]
    assert EX.read_features(spark, path, "v3").count() == 0


def test_a_stream_batch_that_comes_again_is_passed_over(spark):
    path = path_for(spark, "replay")
    batch = spark.createDataFrame([(1, 2020, 1, 1)], ROWS + ", _seq int")
    sink = SS.upsert_sink(path, ["p"], ["y"], "_seq")
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q1")
    try:
        sink(batch, 0)
        sink(batch.withColumn("v", F.lit(2)), 1)
        sink(batch, 1)
        assert stored(spark, path) == [(1, 2020, 2)]
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q2")     # a new checkpoint counts from 0
        sink(batch.withColumn("v", F.lit(3)), 0)
        assert stored(spark, path) == [(1, 2020, 3)]
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_small_files_are_whole(spark):
    path = path_for(spark, "text") + "/a/b.json"
    assert read_text(spark, path) is None
    for text in ("one", "zwei é"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
