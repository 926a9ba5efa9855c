import os
import sys
import uuid

from pyspark.sql import functions as F

from courtline.operators.etl import advanced_stats, fix_invalid, score_platform
from courtline.session import scratch_path
from courtline.sources.adapter import Domain
from courtline.streaming import ingest as SS


def test_stream_equals_batch_and_replay_is_idempotent(spark, sf_dir):
    logs = Domain(spark, sf_dir).player_game_logs.withColumn("year", F.year("game_date"))
    root = scratch_path(spark, f"t-stream-{uuid.uuid4().hex}")
    logs.where("year < 1997").write.parquet(f"{root}/landing")
    logs.where("year >= 1996").write.mode("append").parquet(f"{root}/landing")   # overlap = replayed rows
    src = SS.stream_landing(spark, f"{root}/landing", logs.schema, max_files_per_trigger=2)
    scored = SS.stream_score(src).withColumn("_seq", F.lit(1))
    sink = SS.upsert_sink(f"{root}/table", ["player_id", "game_id"], ["year"], "_seq")
    SS.run_available_now(scored, sink, f"{root}/cp")
    SS.run_available_now(scored, sink, f"{root}/cp")  # restart: nothing new, nothing changes
    got = spark.read.parquet(f"{root}/table").select("player_id", "game_id", "dfs_points_dk", "dfs_points_fd")
    want = score_platform(score_platform(advanced_stats(fix_invalid(logs)), "DraftKings"), "FanDuel") \
        .select("player_id", "game_id", "dfs_points_dk", "dfs_points_fd")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["player_id", "avg_dfs_points_l5"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40
