import math
import random

import numpy as np
import pytest

from courtline.llm import kronecker_negatives as K

SCHEMA = "vec_id long, embedding array<float>, label int, score double, a_row string"


def brute(rows):
    """anchor, positive, rank, negative, scores by plain Python integers."""
    kept = []
    for i, (vec_id, vec, label, *_) in enumerate(rows):
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((i, vec_id, [math.floor(256 * float(np.float32(x))) for x in vec], label))
    last = lambda v: (v is None, v)
    out = []
    for i, vec_id, q, label in kept:
        if vec_id is None or vec_id % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, r)), last(rid), j, rl) for j, rid, r, rl in kept if j != i))
        for s, (_, pid), _, _ in [x for x in scored if x[3] == label][:5]:
            found = [x for x in scored if x[3] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(vec_id, pid, k, x[1][1], -s, -x[0]) for k, x in enumerate(found[:10], 1)]
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in K.hard_negatives(df, **kw).collect()), key=str)


def made(seed, n, dims=6, labels=3):
    rng = random.Random(seed)
    return [(i, [rng.choice([rng.gauss(0, 0.4), 0.25, -0.5]) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


def test_scores_are_exact_in_fields_of_any_width():
    rng = np.random.default_rng(3)
    for size, dtype in ((100, None), (10 ** 6, None), (1 << 27, None)):
        q, a = rng.integers(-size, size, (40, 9)), rng.integers(-size, size, 9)
        assert K.Pack(q).scores(a).tolist() == [sum(int(x) * int(y) for x, y in zip(r, a)) for r in q]
    q, a = np.array([[1 << 31, -(1 << 31)], [5, 0]]), np.array([1 << 29, -(1 << 31)])      # beyond 64 bits of a field
    assert K.Pack(q).scores(np.array([1 << 29, 3])).tolist() == [(1 << 60) - 3 * (1 << 31), 5 << 29]
    assert K.Pack(np.zeros((3, 0), np.int64)).scores(np.zeros(0, np.int64)).tolist() == [0, 0, 0]
    assert K.Pack(q[:1]).scores(a).tolist() == [(1 << 60) + (1 << 62)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(K, "PACK", 16)
    monkeypatch.setattr(K, "CANDIDATES", 90)
    rows = made(seed, 320)
    assert got(spark, rows) == brute(rows) != []


def test_many_blocks_of_anchors_give_the_same(spark, monkeypatch):
    rows = [(i * 100 if i % 3 else i, v, x) for i, v, x in made(9, 120)]
    monkeypatch.setattr(K, "ANCHORS", 7)
    monkeypatch.setattr(K, "CANDIDATES", 25)
    assert got(spark, rows) == brute(rows) != []


def test_rows_that_take_no_part_and_ties(spark):
    v, w = [0.5, 0.25], [0.25, 0.25]
    rows = [(0, v, 1), (1, v, 2), (3, w, 5), (2, w, 5), (4, w, 5), (None, v, 2), (None, w, 5), (5, None, 2), (6, v, None),
            (8, [0.5, None], 2), (9, [float("nan"), 1.0], 2), (10, [float("inf"), 1.0], 2), (100, v, 2), (100, v, 2), (200, [], 2),
            (11, [0.5], 5), (300, [-0.5, -0.25], 8), (7, v, 9)]
    want = brute(rows)
    assert got(spark, rows) == want and {r[0] for r in want} == {0, 100, 200}     # without components every score is 0
    assert {r[1] for r in want if r[0] == 100} >= {100, None}


def test_one_label_and_one_id_hold_a_third(spark, monkeypatch):
    monkeypatch.setattr(K, "CANDIDATES", 50)
    rows = made(4, 200, labels=2) + [(100, [0.5, 0.1, 0.0, 0.2, 0.3, -0.1], 1)] * 60
    assert got(spark, rows) == brute(rows)


def test_empty_and_lonely(spark):
    assert got(spark, []) == []
    assert got(spark, [(100, [1.0], 3)]) == []
    assert got(spark, [(100, [1.0], 3), (101, [1.0], 3)]) == []


def test_huge_components_take_no_part(spark):
    rows = [(0, [1.0, 0.5], 2), (1, [1.0, 0.5], 3), (3, [1e30, 0.5], 3), (4, [0.75, 0.25], 4)]
    assert got(spark, rows) == brute([r for r in rows if r[0] != 3]) != []
