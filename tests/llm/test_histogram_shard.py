import zlib
from collections import Counter, defaultdict

import pytest

from courtline.llm import histogram_shard as H


def laws(rows, shards, texts, slack=H.TOLERANCE):
    """Sizes, checksums and slots are right; shards are as near equal as whole documents allow."""
    total, by, slots, groups = 0, Counter(), defaultdict(list), defaultdict(set)
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    known = defaultdict(set)
    for d, t in texts:
        body = (t or "").encode()
        known[d].add((len(body) + 8, zlib.crc32(body)))
    for r in rows:
        assert (r.size, r.text_crc32) in known[r.doc_id] and r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by[r.shard] += r.size
        total += r.size
        slots[r.shard].append(r.slot)
        groups[r.text_crc32].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    most = max(r.size for r in rows)
    assert all(abs(by[i] - total / shards) <= most + 2 * slack * total / shards for i in range(shards))
    # equal texts are neighbours: they lie in shards that follow each other
    assert all(max(v) - min(v) + 1 == len(v) for v in groups.values())


def test_documents_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    for shards in (1, 2, 24):
        laws(H.histogram_shards(docs.repartition(4), shards).collect(), shards, texts)


def test_a_hot_text_is_cut_by_its_ids(spark):
    texts = [(i * 7 - 500, "the same text again and again" if i % 3 else f"own text {i}") for i in range(900)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    rows = H.histogram_shards(df, 10).collect()
    laws(rows, 10, texts)
    assert len({r.shard for r in rows if r.size == 37}) > 3
    again = H.histogram_shards(df.repartition(3), 10).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_null_ids_repeats_empty_table_clashing_columns(spark):
    rows = [(None, "a", 1, 1, 1), (None, None, 1, 1, 1), (5, "b", 2, 2, 2), (5, "b", 2, 2, 2), (5, "", 3, 3, 3), (9, "é" * 40_000, 4, 4, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h long, shard int, part int")
    got = H.histogram_shards(df, 3).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert all(sorted(r.slot for r in got if r.shard == i) == list(range(sum(r.shard == i for r in got))) for i in range(3))
    assert H.histogram_shards(df.limit(0), 3).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_splitters_don_t_depend_on_the_probes(spark, bits):
    texts = [(i, f"text {i % 40}" * (i % 7 + 1)) for i in range(300)]
    keys = H._keys(spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text").cache()
    cuts = H.splitters(keys, 8, tolerance=0.0, bits=bits)
    rows = sorted((r.h, r.k, r.size) for r in keys.collect())
    total, places = sum(r[2] for r in rows), [0]
    for r in rows:
        places.append(places[-1] + r[2])
    for i, cut in enumerate(cuts, 1):
        below = sum(s for h, k, s in rows if (h, k) < cut)
        assert abs(below - total * i / 8) == min(abs(p - total * i / 8) for p in places)
    keys.unpersist()


def test_native_plan(spark, sf_dir):
    plan = H.histogram_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
