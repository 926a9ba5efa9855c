import hashlib
import random

from hypothesis import given, settings, strategies as st

from courtline.llm import cuckoo_dedup as C


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(fold(text), []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[fold(text)]
        keep = max((d for d in ids if d is not None), default=None)
        out.append((doc, keep, len(ids), doc is not None and doc == keep, hashlib.sha256(fold(text).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, group_size int").repartition(5)
    return sorted((tuple(r) for r in C.exact_dedup(df, **how).collect()), key=str)


def test_equals_brute_force(spark):
    r = random.Random(1)
    texts = ["", None, "a", "A", "Ä", "ä", "İ", "i", "x" * 100_000] + [f"Text {i}" for i in range(40)]
    rows = [(i, r.choice(texts)) for i in range(400)] + [(i, "hot text") for i in range(1000, 1600)] + [(3, "a"), (None, "A"), (None, "null only"), (7, "hot text"), (7, "hot text")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert C.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_documents_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_takedown_deletes_live_digests(spark):
    rows = [(1, "keep"), (2, "drop"), (3, "DROP"), (4, "keep")]
    down = spark.createDataFrame([(hashlib.sha256(b"drop").hexdigest(),), (hashlib.sha256(b"absent").hexdigest(),), (None,)], "text_sha256 string")
    got = {r[0]: r[1:4] for r in run(spark, rows, takedown=down)}
    assert got == {1: (4, 2, False), 2: (None, 0, False), 3: (None, 0, False), 4: (4, 2, True)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 300), st.integers(0, 9)), max_size=600))
def test_index_equals_a_dictionary(steps):
    index, plain = C.CuckooIndex(2), {}
    for put, key, doc in steps:
        digest = hashlib.sha256(str(key).encode()).digest()
        if put:
            index.put(digest, doc, 1)
            old = plain.get(digest, [doc, 0])
            plain[digest] = [max(old[0], doc), old[1] + 1]
        else:
            assert index.remove(digest) == (plain.pop(digest, None) is not None)
    assert {k: [d, n] for k, d, n in index.rows()} == plain
    assert all(index.get(k) == v for k, v in plain.items())


def test_overflow_resizes_and_fingerprints_may_clash():
    index = C.CuckooIndex(2)
    keys = [bytes(2) + i.to_bytes(30, "little") for i in range(500)]        # one fingerprint, many homes
    for i, k in enumerate(keys):
        index.put(k, i, 1)
    assert index.resizes > 0 and all(index.get(k) == [i, 1] for i, k in enumerate(keys))
    for k in keys[::2]:
        assert index.remove(k)
    assert [index.get(k) is None for k in keys] == [True, False] * 250
