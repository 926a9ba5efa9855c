import random
from collections import defaultdict

import numpy as np

from courtline.llm import minmax_neardup as M
from courtline.llm.graph import components
from courtline.llm.rolling import shingle_set


def sets(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def roots(n, edges):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows, words, percent=80):
    s = [sets(t, words) for _, t in rows]
    by = defaultdict(list)
    for i, x in enumerate(s):
        for t in x:
            by[t].append(i)
    pairs = {(i, j) for v in by.values() for i in v for j in v if i < j}
    root = roots(len(rows), [(i, j) for i, j in pairs if 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])])
    low = {}
    for (doc, _), r in zip(rows, root):
        if doc is not None:
            low[r] = min(low.get(r, doc), doc)
    return sorted(((doc, len(x), low.get(r), doc is not None and doc == low.get(r)) for (doc, _), x, r in zip(rows, s, root)), key=str)


def run(spark, rows, words):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in M.near_duplicates(df, words=words).collect()), key=str)


def made(seed):
    r = random.Random(seed)
    prose = lambda n: " ".join(r.choice("abcdefgh") + r.choice("xyzuvw") + r.choice("123456789") for _ in range(n))
    base = [prose(n) for n in (6, 30, 80, 80, 200)]
    rows = [None, "", " \n\t", "One", "one", "one two", "ONE TWO", "one\ttwo three", "É é", "é É"]
    for b in base:
        w, rows = b.split(), rows + [b, b, b.upper()]
        for _ in range(25):                                          # copies of the original, and of copies
            w = w if r.random() < .5 else b.split()
            w = [x if r.random() > .05 else "new" + str(r.random())[:4] for x in w]
            rows.append(" ".join(w))
    r.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    for words, seed in ((2, 1), (5, 2)):
        rows = list(enumerate(made(seed)))
        assert run(spark, rows, words) == brute(rows, words)


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert sorted((tuple(r) for r in M.near_duplicates(docs, words=2).collect()), key=str) == brute([tuple(r) for r in docs.collect()], 2)


def test_null_and_repeated_ids_empty_table_other_columns(spark):
    rows = [(None, "a b c"), (None, "x y z"), (4, "a b c"), (4, "a b c"), (4, "q r s t"), (9, "a b c"), (2, None), (2, None)]
    assert run(spark, rows, 2) == brute(rows, 2)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, node int, component string")
    assert M.near_duplicates(df, words=2).count() == len(rows)
    assert M.near_duplicates(df.limit(0)).count() == 0


def test_values_match_with_the_probability_of_similarity():
    r = np.random.default_rng(1)
    both, a, b = (r.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    x, y = np.unique(np.concatenate((both, a))), np.unique(np.concatenate((both, b)))
    hits = []
    for i in range(60):
        s = np.uint64(i * 7919 + 1)
        p, q = M.mixed(x ^ s), M.mixed(y ^ s)
        hits += [p.min() == q.min(), p.max() == q.max()]
    assert abs(np.mean(hits) - 0.75) < 0.1


def test_shingles_equal_python_sets():
    for text in made(3):
        for words in (1, 2, 5):
            assert len(shingle_set((text or "").encode(), words)) == len(sets(text, words))


def test_components_of_chains_and_stars(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(600, 700)] + [(r.randrange(40), r.randrange(40)) for _ in range(25)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots(1000, edges)
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}


def test_clusters_in_blocks_and_parts(spark, monkeypatch):
    """Groups whose members are far from the centre, held block by block."""
    monkeypatch.setattr(M, "BLOCK_ROWS", 7)
    monkeypatch.setattr(M, "PART_ROWS", 11)
    monkeypatch.setattr(M, "GROUP_ROWS", 3)
    r = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(r.choice([2, 6, 9, 12, 15])):
            w[r.randrange(len(w))] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(w)))
    want = brute(rows, 2)
    assert len({x[2] for x in want}) > 5
    assert run(spark, rows, 2) == want
