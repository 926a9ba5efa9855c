from collections import Counter

import corpus_pipeline as P
from courtline.llm import flow_mix, toxicity
from test_minmax_neardup import brute as components, made


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __extra string")


def docs():
    out = [(i, t, "en", ["a", "b", None, "c"][i % 4], len(t or ""), "x") for i, t in enumerate(made(7))]
    out += [(None, "only null ids here today", None, None, None, None)] * 3 + [out[5], out[5], (5, "same id other text five six", "en", "a", 1, None)]
    return out


def test_exact_stage_equals_brute_force(spark):
    want = {}
    for r in docs():
        k = "".join(c.lower() if c.isascii() else c for c in r[1] or "")
        if k not in want or (r[0] is not None and (want[k][0] is None or r[0] > want[k][0])):
            want[k] = r
    got = rows_of(P.drop_exact_copies(spark, table(spark, docs()), ""))
    assert got == sorted(want.values(), key=str)


def test_near_stage_keeps_one_of_each_component(spark):
    rows = [r for r in docs() if r[0] is not None]
    by = {}
    labels = {doc: (n, root) for doc, n, root, _ in components([(i, r[1]) for i, r in enumerate(rows)], 5)}
    want = Counter()
    for i, r in enumerate(rows):
        n, root = labels[i]
        if n == 0:
            want[r] += 1
        else:
            by.setdefault(root, []).append(r)
    got = Counter(tuple(r) for r in P.drop_near_copies(spark, table(spark, rows), "").collect())
    assert all(got[r] == k for r, k in want.items())
    rest = got - want
    assert sum(rest.values()) == len(by)
    for group in by.values():
        assert sum(rest[r] for r in set(group) if r[0] == min(g[0] for g in group)) == 1
    nulls = table(spark, [r for r in docs() if r[0] is None])
    assert P.drop_near_copies(spark, nulls, "").count() == 1


def test_mix_stage_repeats_what_the_mix_takes(spark):
    rows = docs()
    df = table(spark, rows)
    got = Counter(tuple(r) for r in P.mix_sources(spark, df, "").collect())
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    goal = flow_mix.targets(sizes)
    for s in sizes:
        longest = max(len((r[1] or "").split()) for r in rows if r[3] == s)
        taken = sum(k * len(r[1].encode().split()) for r, k in got.items() if r[3] == s)
        assert abs(taken - goal[s]) <= longest
    assert all(0 < k <= 2 * rows.count(r) for r, k in got.items())


def test_stages_after_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
    clean = P.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    last = P.run(spark, sf_dir)
    assert last.count() > 0 and {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(last.columns)
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
