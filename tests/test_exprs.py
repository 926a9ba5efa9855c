import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.functions import exprs as X


def test_safe_casts(spark):
    vals = ["12", "12.9", "-0.5", "", None, "abc", "30:12", "nan", "1e2", "1_000", "12d", " 7 "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: (r.i, r.f) for r in df.select("s", X.safe_int("s").alias("i"), X.safe_float("s").alias("f")).collect()}
    assert got["12"] == (12, 12.0)
    assert got["12.9"] == (12, 12.9)          # int(float(x)) truncates
    assert got["-0.5"] == (0, -0.5)
    assert got["1e2"] == (100, 100.0)
    assert got[" 7 "] == (7, 7.0)
    for bad in ("", None, "abc", "30:12", "nan", "1_000", "12d"):
        assert got[bad] == (None, None), bad


def test_text_true_and_safe_div(spark):
    df = spark.createDataFrame([("True", 1.0, 0.0), ("false", 4.0, 2.0), (None, None, 1.0)], "s string, a double, b double")
    r = df.select(X.text_true("s").alias("t"), X.safe_div(F.col("a"), F.col("b")).alias("d")).collect()
    assert [x.t for x in r] == [True, False, False]
    assert [x.d for x in r] == [0.0, 2.0, 0.0]


@pytest.mark.parametrize("d,label,start", [
    ("2021-10-19", "2021-22", "2021-10-01"), ("2000-01-02", "1999-00", "1999-10-01"),
    ("2021-09-30", "2020-21", "2020-10-01"), ("2021-10-01", "2021-22", "2021-10-01"),
    ("2024-02-29", "2023-24", "2023-10-01"), ("1999-12-31", "1999-00", "1999-10-01")])
def test_season(spark, d, label, start):
    r = spark.createDataFrame([(dt.date.fromisoformat(d),)], "d date").select(
        X.season_label("d").alias("l"), X.season_start("d").alias("s")).first()
    assert r.l == label and r.s == dt.date.fromisoformat(start)


def test_score_bonuses(spark):
    rows = [(10, 10, 0, 0, 0, 0), (10, 10, 10, 0, 0, 2), (9, 10, 10, 10, 0, 1), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "points int, rebounds_total int, assists int, steals int, blocks int, turnovers int")
    r = df.select(X.dfs_score(X.DK_WEIGHTS).alias("dk"), X.dfs_score(X.FD_WEIGHTS).alias("fd"),
                  X.count_at_least().alias("n")).collect()
    assert r[0].dk == 10 + 12.5 + 1.5 and r[0].n == 2
    assert r[1].dk == 10 + 12.5 + 15 - 2 + 1.5 + 3.0 and r[1].n == 3
    assert r[2].dk == round(9 + 12.5 + 15 + 30 - 1 + 1.5 + 3.0, 2)
    assert r[3].dk == 0.0 and r[3].fd == 0.0
    assert r[1].fd == round(10 + 12.0 + 15 - 2, 2)


def test_unknown_platform():
    with pytest.raises(ValueError):
        X.weights_for("SuperDraft")


def test_array_slope_matches_polyfit(spark):
    rng = np.random.default_rng(1)
    arrs = [list(map(float, rng.normal(size=n))) for n in (2, 3, 7, 10)] + [[1.0, 2.0, 4.0], [5.0], []]
    df = spark.createDataFrame([(a,) for a in arrs], "a array<double>")
    got = [r.s for r in df.select(X.array_slope(F.col("a")).alias("s")).collect()]
    for a, g in zip(arrs, got):
        if len(a) < 2:
            assert g is None
        else:
            assert g == pytest.approx(np.polyfit(np.arange(len(a)), a, 1)[0], abs=1e-9)
    assert got[4] == pytest.approx(1.5)
    means = df.select(X.array_mean(F.col("a")).alias("m"), X.array_std_pop(F.col("a")).alias("s")).collect()
    for a, r in zip(arrs, means):
        if a:
            assert r.m == pytest.approx(np.mean(a)) and r.s == pytest.approx(np.std(a))
        else:
            assert r.m is None



def test_safe_long_keeps_every_digit(spark):
    rows = ["28268405032", "9007199254740993", " -7 ", "12.9", "1e3", "9223372036854775808", "abc", "", None]
    got = [r.x for r in spark.createDataFrame([(r,) for r in rows], "s string").select(X.safe_long("s").alias("x")).collect()]
    assert got == [28268405032, 9007199254740993, -7, 12, 1000, None, None, None, None]
