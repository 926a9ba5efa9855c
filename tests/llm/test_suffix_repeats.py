import hashlib
import random
from collections import Counter

from hypothesis import given, settings, strategies as st

from courtline.llm import suffix_repeats as S


def brute(texts):
    """Every byte in a 200-byte string that starts anywhere else."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def made(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (20, 40, 45, 60, 200)]
    base = prose(300)
    texts = [None, "", "x" * 199, "x" * 200, "y" * 900, prose(3000) + passages[0] * 5, base, base, "ab" * 400]
    for i in range(60):
        p = r.choice(passages)
        texts.append(prose(r.randint(0, 80)) + p[r.randint(0, 60):len(p) - r.randint(0, 60)] + prose(r.randint(0, 80)))
    for _ in range(25):                                             # near copies
        w = base.split()
        for _ in range(4):
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return texts + [texts[12], texts[13]]


def run(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = S.remove_repeats(df, **how).collect()
    assert len(rows) == len(texts)
    return [tuple(r)[1:5] for r in sorted(rows)]


def test_equals_brute_force(spark):
    texts = made()
    assert run(spark, texts) == brute(texts)


def test_frequent_grams_take_the_other_route(spark):
    texts = made(5)
    assert run(spark, texts, hot_rows=8) == brute(texts)


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id")
    got = sorted(S.remove_repeats(docs).collect())
    assert [tuple(r)[1:5] for r in got] == brute([r.text for r in docs.collect()])


def test_null_and_repeated_ids_empty_table_other_columns(spark):
    texts = ["q" * 250, None, "w" * 100]
    rows = [(None, texts[0], 1), (None, texts[0], 2), (5, texts[1], 3), (5, texts[1], 4), (7, texts[2], 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place int")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in S.remove_repeats(df).collect())
    assert got == Counter({(None, 250, 250, 1): 2, (5, 0, 0, 0): 2, (7, 100, 0, 0): 1})
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_segments_of_long_texts(monkeypatch):
    import numpy as np
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8) % 7
    whole = S.anchors(data)
    monkeypatch.setattr(S, "SEGMENT", 333)
    parts = S.anchors(data)
    assert set(zip(whole[0].tolist(), whole[1].tolist())) == set(zip(parts[0].tolist(), parts[1].tolist()))
    runs = sorted(zip(parts[2].tolist(), parts[3].tolist()))
    assert runs[0][0] == 0 and runs[-1][1] == len(data) - 200
    assert all(a[1] + 1 == b[0] for a, b in zip(runs, runs[1:]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=5), st.binary(min_size=2, max_size=6)), min_size=2, max_size=7).map(
    lambda x: [(bytes(c % 2 for c in a), b"k" + bytes(c % 2 for c in b)) for a, b in x]), st.integers(2, 8))
def test_repeat_groups_list_all_occurrences(items, least):
    """The reach of each member equals that of comparing all pairs."""
    left, right = [a for a, _ in items], [b for _, b in items]
    got = [[0, 0] for _ in items]
    for n, r, members in S.repeat_groups(left, right, least):
        assert n + r >= least and len(members) > 1
        assert len({left[i][:n] for i in members}) == 1 and len({right[i][:r] for i in members}) == 1
        for i in members:
            got[i] = [max(got[i][0], n), max(got[i][1], r)]
    for i in range(len(items)):
        pairs = [(S._common(left[i], left[j]), S._common(right[i], right[j])) for j in range(len(items)) if j != i]
        good = [p for p in pairs if sum(p) >= least]
        assert got[i] == ([max(p[0] for p in good), max(p[1] for p in good)] if good else [0, 0])
