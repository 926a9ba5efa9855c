"""What the third round's findings asked for, each on rows of its own."""

import datetime as dt
import random

import numpy as np
import pytest

from courtline.operators import quality as Q
from courtline.plans import reads as RD


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_of_the_compact_types_hold_ids_too(spark, sf_dir):
    from courtline.plans.catalog import QUERIES
    rows = spark.createDataFrame([(70000, 30, 300, 5), (1, 300, -1, None), (65535, 255, 255, 0)],
                                 "player_id long, opponent_team_id long, points int, rest_days int")
    got = {r.column_name: (r.n_out_of_range, r.lo, r.hi) for r in Q.range_report(rows, Q.compact_log_ranges(rows.columns)).collect()}
    assert got == {"player_id": (1, 0, 65535), "opponent_team_id": (1, 0, 255), "points": (2, 0, 255), "rest_days": (0, 0, 255)}
    reported = {r.column_name for r in QUERIES["qual_range_logs"](spark, sf_dir).collect()}
    assert {"player_id", "opponent_team_id", "points"} <= reported and len(reported) == 18


def brute(logs):
    """Correlation of each two players over all pairs of their logs of a date."""
    out, ids = {}, sorted({p for p, _, _ in logs})
    series = {i: [(d, v) for p, d, v in logs if p == i and v is not None] for i in ids}
    for a in ids:
        for b in ids:
            if a == b:
                vs = [v for _, v in series[a]]
                if vs:
                    out[a, a] = 1.0 if len(vs) > 1 and min(vs) < max(vs) else None
                continue
            pairs = [(x, y) for d, x in series[a] for e, y in series[b] if d == e and d is not None]
            if pairs:
                x, y = map(np.array, zip(*pairs))
                varies = len(pairs) > 1 and x.min() < x.max() and y.min() < y.max()
                out[a, b] = float(np.corrcoef(x - x[0], y - y[0])[0, 1]) if varies else None
    return out


@pytest.mark.parametrize("size", [(64, 768), (1, 3)])
def test_correlation_of_blocks_equals_pairs_of_logs(spark, monkeypatch, size):
    monkeypatch.setattr(RD, "CORR_BLOCK", size)
    rng = random.Random(5)
    logs = [(p, day(rng.randrange(14)), float(rng.randrange(40))) for p in range(1, 8) for _ in range(12)]   # days with two games
    logs += [(8, day(k), 0.1) for k in range(14)] + [(9, day(k), 1e9 + 1e-3 * k) for k in range(14)]
    logs += [(10, day(k), 5.0 if k < 9 else 5.0000001) for k in range(14)] + [(11, day(k), float(k)) for k in range(9)]
    logs += [(12, day(k), 3.0 if k < 9 else 1e9) for k in range(14)]              # constant on the dates shared with 11
    logs += [(13, None, 1.0), (13, None, 2.0), (13, day(0), 4.0), (14, day(90), 1.0), (15, day(3), None)]
    frame = spark.createDataFrame([(p, k, d, v) for k, (p, d, v) in enumerate(logs)], "player_id long, game_id long, game_date date, dfs_points_dk double")
    found = RD.correlation_matrix(frame, frame.select("player_id"))
    got = {(r.player_a, r.player_b): r.correlation for r in found.collect()}
    want = brute(logs)
    assert got.keys() == want.keys()
    assert got[10, 11] is None and got[11, 12] is None and got[8, 9] is None
    for k, v in want.items():
        assert (got[k] is None) == (v is None), k
        assert v is None or got[k] == pytest.approx(v, abs=1e-6), k
    assert "Join" not in plan_text(found)                   # no row for a pair of players and a date
