"""What the third round's findings on streams asked for: batches of a run are merged together, whole rows are moved once."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from courtline.operators import sinks as SK
from courtline.session import path_exists, scratch_path
from courtline.streaming import ingest as SS

ROWS = "p long, g long, y int, v int"


def stored(spark, path):
    return sorted((tuple(r) for r in SK.read_table(spark, path).select("p", "g", "y", "v").collect()), key=str)


def of_query(spark, name):
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", name)


def test_a_run_of_many_batches_rewrites_its_table_a_few_times(spark, monkeypatch):
    root = scratch_path(spark, f"t-{uuid.uuid4().hex}")
    rows = spark.range(1600).selectExpr("id % 40 as p", "id as g", "cast(2000 + id % 4 as int) as y", "cast(id % 7 as int) as v")
    rows.repartition(16, "g").write.parquet(f"{root}/landing")
    merges, kept = [], SS.upsert_partitioned

    def spied(s, target, *a, **k):
        merges.append(target)
        return kept(s, target, *a, **k)
    monkeypatch.setattr(SS, "upsert_partitioned", spied)
    src = SS.stream_landing(spark, f"{root}/landing", rows.schema, max_files_per_trigger=1).withColumn("_seq", F.lit(1))
    handle = SS.run_available_now(src, SS.upsert_sink(f"{root}/table", ["p", "g"], ["y"], "_seq"), f"{root}/cp")
    assert len([q for q in handle.recentProgress if q.numInputRows]) == 16
    assert 2 <= len(merges) <= 7 and not path_exists(spark, f"{root}/table_waiting")
    assert stored(spark, f"{root}/table") == sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("order", ["_seq", "version"])
def test_batches_merged_together_give_the_table_of_batches_merged_in_turn(spark, order):
    r = random.Random(3)
    schema = f"{ROWS}, {order} int"
    batches = [[(r.choice([1, 2, 3, None]), r.randrange(6), r.choice([2000, 2001, None]), 100 * b + i, r.choice([None, 1, 2])) for i in range(12)] for b in range(5)]
    frames = [spark.createDataFrame(b, schema).dropDuplicates(["p", "g"]) for b in batches]
    frames = [f.persist() for f in frames]
    one, all_ = (scratch_path(spark, f"t-{uuid.uuid4().hex}/table") for _ in range(2))
    try:
        of_query(spark, "q1")
        for i, f in enumerate(frames):
            SS.upsert_sink(one, ["p", "g"], ["y"], order)(f, i)
        held = SS.upsert_sink(all_, ["p", "g"], ["y"], order)
        held(frames[0], 0)
        for i, f in enumerate(frames):
            held.hold(f, i)
        assert stored(spark, all_) == sorted((tuple(x)[:4] for x in frames[0].collect()), key=str)      # the run is cut off here
        again = SS.upsert_sink(all_, ["p", "g"], ["y"], order)
        again.hold(frames[1], 1)                                                                          # handed over again
        again.settle(spark)
        again(frames[2], 2)
    finally:
        of_query(spark, None)
    assert stored(spark, all_) == stored(spark, one) and not path_exists(spark, f"{all_}_waiting")
    assert SK.table_notes(spark, all_)["batches"] == {"q1": 4}


def test_narrow_updates_meet_the_stored_rows_where_they_are_dealt(spark):
    r = random.Random(4)
    old = spark.createDataFrame([(r.choice([1, 2, None]), g, 2000 + g % 3, g) for g in range(30) for _ in range(1 + g % 2)], ROWS)
    new = spark.createDataFrame([(r.choice([1, 2, None]), g, 2000 + g % 3, 100 + g, i) for g in range(5, 40) for i in range(2)], ROWS + ", _o int")
    new = new.select("p", "g", "y", "v", "_o")
    dealt = SK.merge_rows(old, new, ["p", "g"], "_o", ["v"], ["y"], ["p", "g"])
    want = SK.merge_rows(old, new, ["p", "g"], "_o", ["v"], ["y"])
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, dealt.collect())) == sorted(map(str, want.collect())) and dealt.count() > 30
    assert plan.count("Exchange hashpartitioning") == 1
    assert "_rank" not in next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line) and "max_by" not in plan[plan.index("Exchange hashpartitioning"):]


def test_one_exchange_where_no_key_moves(spark, monkeypatch):
    old = spark.createDataFrame([(1, 1, 2000, 1), (1, 2, 2001, 1), (None, 3, None, 1)], ROWS)
    for y, moves in ((2000, False), (2002, True), (None, True)):
        assert SK.keys_move([old, spark.createDataFrame([(1, 1, y, 5)], ROWS)], old.schema, ["p", "g"], ["y"]) is moves
    assert not SK.keys_move([old, spark.createDataFrame([(None, 3, None, 5), (9, 9, 2005, 1)], ROWS)], old.schema, ["p", "g"], ["y"])
    assert SK.keys_move([old, spark.createDataFrame([(9, 9, 2000, 5), (9, 9, 2001, 1)], ROWS)], old.schema, ["p", "g"], ["y"])
    ways, kept = [], SK.merge_rows
    monkeypatch.setattr(SK, "merge_rows", lambda *a: ways.append(list(a[-1])) or kept(*a))
    path = scratch_path(spark, f"t-{uuid.uuid4().hex}/table")
    for y in (2000, 2000, 2003):
        SK.upsert_partitioned(spark, path, spark.createDataFrame([(1, 1, y, 5, 1), (2, 2, 2002, 5, 1)], ROWS + ", _seq int"), ["p", "g"], ["y"], "_seq")
    assert ways == [["p", "g"], []] and stored(spark, path) == [(1, 1, 2003, 5), (2, 2, 2002, 5)]
