import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from courtline.operators.frames import asof_join, chunk_with_halo, explode_intervals, positions_from_end, season_chunk


def _skewed(spark, seed=3):
    """One hot key holding most rows, spread over several seasons, with same-day ties."""
    rnd = random.Random(seed)
    rows, gid = [], 0
    base = dt.date(2019, 1, 1)
    for key, n in ((1, 900), (2, 40), (3, 7)):
        day = 0
        for _ in range(n):
            day += rnd.choice([0, 1, 1, 2, 3, 40])
            gid += 1
            rows.append((key, base + dt.timedelta(days=day), gid, float(rnd.randint(0, 30))))
    return spark.createDataFrame(rows, "k long, d date, g long, v double")


@pytest.mark.parametrize("lookback", [1, 4, 49])
def test_halo_frames_equal_plain_frames(spark, lookback):
    df = _skewed(spark)
    plain_w = Window.partitionBy("k").orderBy("d", "g").rowsBetween(-lookback, 0)
    plain = df.select("g", F.sum("v").over(plain_w).alias("s"), F.count(F.lit(1)).over(plain_w).alias("n"),
                      F.lead("d").over(Window.partitionBy("k").orderBy("d", "g")).alias("nx"))
    framed = chunk_with_halo(df, ["k"], ["d", "g"], season_chunk("d"), lookback=lookback, next_of="d")
    w = Window.partitionBy("k", "_chunk").orderBy("d", "g")
    chunked = (framed.select("g", "_own", F.sum("v").over(w.rowsBetween(-lookback, 0)).alias("s"),
                             F.count(F.lit(1)).over(w.rowsBetween(-lookback, 0)).alias("n"),
                             F.coalesce(F.lead("d").over(w), F.col("_next_chunk_first")).alias("nx"))
               .where("_own").drop("_own"))
    a = {r.g: (r.s, r.n, r.nx) for r in plain.collect()}
    b = {r.g: (r.s, r.n, r.nx) for r in chunked.collect()}
    assert a == b
    # the hot key is split: several chunks, each much smaller than the key
    sizes = framed.groupBy("k", "_chunk").count().where("k = 1").collect()
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 900


def _brute_asof(left, right, strict):
    out = {}
    for lid, k, t in left:
        cands = [(rt, ro, v) for rk, rt, ro, v in right if rk == k and (rt < t if strict else rt <= t)]
        out[lid] = max(cands)[2] if cands else None
    return out


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_matches_brute_force(spark, strict):
    rnd = random.Random(7)
    base = dt.date(2018, 6, 1)
    right = [(rnd.randint(1, 3), base + dt.timedelta(days=rnd.randint(0, 900)), i, f"v{i}") for i in range(300)]
    left = [(i, rnd.randint(1, 4), base + dt.timedelta(days=rnd.randint(-20, 950))) for i in range(200)]
    L = spark.createDataFrame(left, "lid long, k long, t date")
    R = spark.createDataFrame(right, "k long, rt date, ro long, v string")
    got = asof_join(L, R, ["k"], "t", "rt", ["v"], right_order=["ro"], strict=strict,
                    granularity="year")
    res = {r.lid: r.v for r in got.collect()}
    assert res == _brute_asof(left, right, strict)


def test_positions_from_end(spark):
    df = _skewed(spark)
    got = positions_from_end(df, ["k"], ["d", "g"], season_chunk("d"), alias="p")
    ref = df.select("g", (F.row_number().over(Window.partitionBy("k").orderBy(F.desc("d"), F.desc("g"))) - 1).alias("p"))
    assert {r.g: r.p for r in got.collect()} == {r.g: r.p for r in ref.collect()}


def test_explode_intervals(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 4)), (dt.date(2024, 1, 4), dt.date(2024, 1, 4)),
                                (dt.date(2024, 1, 9), None)], "lo date, hi date")
    out = explode_intervals(df, F.col("lo"), F.col("hi"), "2024-01-02", "2024-01-11").select("target_date").collect()
    days = sorted(r.target_date.day for r in out)
    assert days == [2, 3, 4, 10, 11]


def test_asof_join_across_new_year(spark):
    """Weeks of the year are not in order of time around New Year; buckets must be."""
    import datetime as dt
    days = [dt.datetime(2020, 12, 20) + dt.timedelta(days=i, hours=i % 5) for i in range(0, 40, 2)]
    df = spark.createDataFrame([(1, d, i) for i, d in enumerate(days)], "k long, t timestamp, v long")
    right = df.select("k", F.col("t").alias("rt"), F.col("v").alias("prev"))
    for granularity in (None, "week", "month", "year", "season"):
        got = {r.v: r.prev for r in asof_join(df, right, ["k"], "t", "rt", ["prev"], strict=True, granularity=granularity).collect()}
        assert got == {i: i - 1 if i else None for i in range(len(days))}
