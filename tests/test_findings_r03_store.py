"""Feature store and feature batch: rows are moved once, each on rows of its own."""

import datetime as dt
import re

import pytest

from courtline.operators import sinks as SK
from courtline.plans import exports as EX
from courtline.plans import features as FT

ROWS = "player_id long, target_date date, x double, created_at timestamp, version string, season string"


def rows(spark, *made):
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    return spark.createDataFrame([(p, day(k), x, dt.datetime(2024, 2, t), "v1", "2023-24") for p, k, x, t in made], ROWS)


def exchanges(df):
    """Exchanges of the plan, made anew: after a run it is printed twice."""
    df = df.select("*")
    return len(re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()))


def test_dealt_rows_are_merged_like_others(spark):
    keys, by, parts = ["player_id", "target_date", "version"], ["player_id"], ["version", "season"]
    old = rows(spark, (1, 0, 1.0, 1), (1, 1, 2.0, 5), (2, 0, 3.0, 1))
    new = rows(spark, (1, 0, 10.0, 2), (1, 0, 11.0, 3), (1, 1, 20.0, 4), (3, 0, 30.0, 1))
    plain, dealt = SK.merge_rows(old, new, keys, "created_at"), SK.merge_rows(old, new, keys, "created_at", None, parts, by)
    assert sorted(dealt.collect()) == sorted(plain.collect()) and exchanges(dealt) == 1
    some = new.drop("x")
    plain, dealt = SK.merge_rows(old, some, keys, "created_at"), SK.merge_rows(old, some, keys, "created_at", None, parts, by)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect())) and exchanges(dealt) == 1
    first = SK.dedup_dealt(new, keys, "created_at", parts, by)
    assert sorted(first.collect()) == sorted(SK.dedup_updates(new, keys, "created_at").select(*new.columns).collect())
    assert exchanges(first) == 1


def test_deal_columns_are_of_a_key_that_keeps_its_partition(spark, tmp_path):
    made = rows(spark, (1, 0, 1.0, 1))
    for by, fixed in ((["x"], True), (["player_id"], False)):
        with pytest.raises(ValueError):
            SK.upsert_partitioned(spark, f"{tmp_path}/t", made, ["player_id"], ["season"], "created_at", fixed_partitions=fixed, deal_by=by)


def test_pending_folders_are_moved_not_written_again(spark, tmp_path):
    path = f"{tmp_path}/store"
    feats = rows(spark, (1, 0, 1.0, 1), (2, 300, 2.0, 1)).select("player_id", "target_date", "x")
    EX.store_features(feats, path, created_at="2024-02-01")
    record = SK.decide_upsert(spark, path, feats.selectExpr("player_id", "target_date", "x + 1 AS x", "'v1' AS feature_set_version",
                                                            "timestamp'2024-03-01' AS created_at", "IF(player_id = 1, '2023-24', '2024-25') AS season"),
                              ["player_id", "target_date", "feature_set_version"], list(EX.FEATURE_PARTITIONS), "created_at", None, True, ["player_id"])
    SK.replace_partitions(spark, path, record)
    SK.replace_partitions(spark, path, record)          # again: nothing is pending, nothing is lost
    assert not list((tmp_path / "store" / SK.PENDING / "rows").rglob("*.parquet"))
    assert SK.recover(spark, path)
    assert sorted((r.player_id, r.x) for r in EX.read_features(spark, path).collect()) == [(1, 2.0), (2, 3.0)]


def test_a_reader_of_few_features_has_only_those_computed(spark, sf_dir):
    from courtline.plans.catalog import features_for
    some = features_for(spark, sf_dir).select("player_id", "target_date", "position")
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert "fg_pct_L30" not in plan and "minutes0" not in plan
