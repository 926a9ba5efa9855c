import hashlib
from collections import Counter

from courtline.llm import imatch as M


def edited(rows):
    """n_chars and digest of the edited text, by place in descending id order."""
    out = {}
    for i, (doc, text) in enumerate(rows):
        n = len(text)
        start = rows[(i + 1) % len(rows)][1][:n // 3]
        out[doc] = (n, hashlib.sha256((text[:n - n // 3] + start).encode()).hexdigest())
    return out


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in M.fingerprints(docs).collect()}
    assert {k: (r.n_chars, r.edited_sha256) for k, r in got.items()} == edited(rows)
    prints, texts = {}, dict(rows)
    for doc, r in got.items():
        assert prints.setdefault(texts[doc], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len(set(prints.values())) > 0.95 * len(prints)
    long = [r for r in got.values() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    assert sum(r.near_edited for r in long) / len(long) > 0.1 > sum(r.near_next for r in long) / len(long)


def test_fingerprint_equals_plain_computation(spark):
    """Same terms in the same subsets give the same entries; other words, order and repetition don't matter."""
    texts = ["a b c d", "d c b a a", "D  C\nb a", "a b c e", "", None, "   ", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in M.fingerprints(df).collect()}
    assert got[0] == got[1] == got[2] != got[3] and got[4] == got[5] == got[6] != got[7]


def test_order_repeats_and_single_document(spark):
    rows = [(None, "null id one two three"), (7, "abcdef"), (7, "abcdef"), (9, "uvwxyz"), (7, None), (1, "é\U0001f600ß")]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, row int, copies int")
    got = Counter((r.doc_id, r.n_chars) for r in M.fingerprints(df).collect())
    assert got == Counter((d, len(t or "")) for d, t in rows)
    one = M.fingerprints(df.where("doc_id = 9")).collect()
    assert [(r.edited_sha256, r.near_next) for r in one] == [(hashlib.sha256(b"uvwxuv").hexdigest(), 1.0)]
    assert M.fingerprints(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = M.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
