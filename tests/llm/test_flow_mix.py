import itertools
import random

import pytest
from hypothesis import given, settings, strategies as st

from courtline.llm import flow_mix as X
from courtline.llm import queries


def fill(sizes):
    """Targets by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, left, open_ = {}, 1.5 * sum(sizes.values()), list(order)
    while open_:
        heavy = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / heavy > 2 * sizes[s]]
        if not over:
            return goal | {s: left * w[s] / heavy for s in open_}
        for s in over:
            goal[s] = 2.0 * sizes[s]
        left -= sum(goal[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return goal


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 10_000), max_size=9))
def test_targets_equal_resharing(sizes):
    assert X.targets(sizes) == pytest.approx(fill(sizes))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.sampled_from("abc"), min_size=1).map(sorted).map(tuple), st.integers(0, 4)), max_size=4, unique_by=lambda p: p[0]),
       st.fixed_dictionaries({s: st.integers(0, 6) for s in "abc"}))
def test_route_is_the_cheapest_maximum_flow(patterns, quotas):
    flows = X.route(patterns, quotas)
    for (members, size), f in zip(patterns, flows):
        assert set(f) == set(members) and sum(f.values()) <= 2 * size and min(f.values(), default=0) >= 0
    assert all(sum(f.get(s, 0) for f in flows) <= q for s, q in quotas.items())
    # by trial of all amounts: the largest total, then the least repeated words
    best = None
    for takes in itertools.product(*[range(2 * n + 1) for _, n in patterns]):
        # the amounts are routable if each set of sources can't be asked for too little (Hall's condition)
        ok = all(sum(t for (m, _), t in zip(patterns, takes) if set(m) <= set(sub)) <= sum(quotas[s] for s in sub)
                 for k in range(4) for sub in itertools.combinations("abc", k))
        if ok:
            cost = (-sum(takes), sum(max(0, t - n) for (_, n), t in zip(patterns, takes)))
            best = cost if best is None or cost < best else best
    mine = (-sum(sum(f.values()) for f in flows), sum(max(0, sum(f.values()) - n) for (_, n), f in zip(patterns, flows)))
    assert mine == best


def check(rows, docs):
    sizes = {}
    for doc, source, n in docs:
        sizes[source] = sizes.get(source, 0) + n
    goal, taken = fill(sizes), {}
    where = {doc: (source, n) for doc, source, n in docs}
    for r in rows:
        source, n = where[r.doc_id]
        assert r.size == n and r.source_size == sizes[source] and r.target == pytest.approx(goal[source]) and 0 <= r.taken <= 2 * n
        taken[source] = taken.get(source, 0) + r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)


def test_documents_table_and_rerun(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = queries.op4_mix(spark, sf_dir).collect()
    check(rows, [(r.doc_id, r.source, len(r.text.encode().split())) for r in docs.collect()])
    assert sorted(map(tuple, X.mix_documents(docs.repartition(7)).collect())) == sorted(map(tuple, rows))


def test_nulls_hot_source_empty_table(spark, monkeypatch):
    monkeypatch.setattr(X, "BUCKET_ROWS", 10)
    r = random.Random(3)
    docs = [(i, r.choice(["a", "a", "a", "b", None, "é", "z"]), r.randint(0, 30)) for i in range(500)]
    df = spark.createDataFrame([(i, "w " * n if n else None, s, 0) for i, s, n in docs], "doc_id long, text string, source string, size int")
    check(X.mix_documents(df).collect(), docs)
    assert X.mix_documents(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s"), (4, "c", "s"), (4, "c", None)], "doc_id long, text string, source string")
    assert sum(x.taken for x in X.mix_documents(odd).collect()) == round(1.5 * 6)


def test_overlapping_sources(spark):
    """Documents of two sources serve the one that is short; what is taken by source adds up."""
    docs = [(i, ["a"], 10) for i in range(30)] + [(100 + i, ["b", "a"], 10) for i in range(10)] + [(200, [], 10), (201, None, 10)]
    df = spark.createDataFrame(docs, "doc_id long, members array<string>, size long")
    rows = X.mix(df, "members", "size").collect()
    goal = X.targets({"a": 400, "b": 100}, total=400)
    got = {"a": 0, "b": 0}
    for r in rows:
        assert r.taken == sum(p.words for p in r.by_source) <= 2 * r.size
        for p in r.by_source:
            got[p.source] += p.words
    assert got["b"] <= round(goal["b"]) and got["a"] <= round(goal["a"]) and sum(got.values()) == min(800, round(goal["a"]) + round(goal["b"]))
    assert all(r.taken == 0 for r in rows if r.doc_id >= 200)
