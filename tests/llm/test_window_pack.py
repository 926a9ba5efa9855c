import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st

from courtline.llm import window_pack as K

FILES = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILES[0])
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs, plain):
    """Pieces give back every document; sequences are gapless and little padded."""
    ids, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        got = np.frombuffer(r.ids, "<u4").tolist()
        assert len(got) == r.length > 0
        ids[r.doc_id].append((r.start, got, r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(ids) == set(docs)
    for doc, text in docs.items():
        flat = []
        for start, got, n in sorted(ids[doc]):
            assert start == len(flat)
            flat += got
        assert flat == plain(text) and {n for _, _, n in ids[doc]} == {len(flat)}
    padding = used = 0
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= 2048
        used += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= K.MAX_GAP * len(seqs)
    return padding, used


def test_documents_table(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = K.pack(docs.repartition(3), *FILES).collect()
    check(rows, {r.doc_id: r.text for r in docs.collect()}, plain)


def test_rounds_of_merging(spark, plain, monkeypatch):
    monkeypatch.setattr(K, "FAN", 2)
    r = random.Random(2)
    docs = {i: " ".join("word" * r.randint(0, 3) + str(i) for _ in range(r.choice([0, 3, 40, 3000]))) for i in range(60)}
    docs |= {100: None, 101: "", 102: "a<|endoftext|>b", 103: "é  \x85x᠎ y​ z　 \U0001f600 I'll 'LL ½²٣"}
    df = spark.createDataFrame([(i, t, 1, False) for i, t in docs.items()], "doc_id long, text string, source int, open boolean").repartition(9)
    check(K.pack(df, *FILES).collect(), docs, plain)
    assert K.pack(df.limit(0), *FILES).count() == 0


def test_rows_that_repeat_an_id(spark, plain):
    df = spark.createDataFrame([(None, "a b"), (3, "c d"), (3, "c d"), (3, "e")], "doc_id long, text string")
    rows = K.pack(df, *FILES).collect()
    assert sum(r.length for r in rows) == sum(len(plain(t)) for t in ("a b", "c d", "c d", "e"))


def test_both_libraries_agree_on_every_character(plain):
    encode = K.encoder(*FILES)
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}{chr(c)} {chr(c)}1\n{chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert encode(text).tolist() == plain(text)[:-1], hex(start)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40), st.integers(1, 6))
def test_packer_bounds_space_and_keeps_all(lengths, limit):
    p, done = K.Packer(32, limit, 2), []
    for i, n in enumerate(lengths):
        done += p.add(i, np.arange(n, dtype="<u4"))
        assert len(p.order) <= limit and len(p.windows) == len(p.order)
    assert all(32 - 2 <= K._length(w) <= 32 for w in done)
    full, left = K.merged(p.rest(), 32)
    assert all(K._length(w) == 32 for w in full) and K._length(left) < 32
    tail = K.powers(left)
    assert all(K._length(w).bit_count() == 1 for w in tail)
    got = defaultdict(list)
    for w in done + full + tail:
        for doc, start, ids, n in w:
            assert ids.tolist() == list(range(start, start + len(ids))) and n == lengths[doc]
            got[doc] += ids.tolist()
    assert all(sorted(got[i]) == list(range(n)) for i, n in enumerate(lengths))


def test_query_digest(spark, sf_dir, plain):
    from courtline.llm import queries
    rows = queries.op6_pack(spark, sf_dir).limit(50).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in rows:
        ids = np.array(plain(docs[r.doc_id])[r.start:r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
