import random
import zlib
from hashlib import sha256

import pytest

from courtline.llm import merkle_log as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Levels of the tree, leaves first."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def leaf(row):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    doc_id, text, lang, source, n_chars = row[:5]
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    for of in by.values():
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {k: tree([leaf(r) for r in by[k]]) for k in langs}
    top = tree([trees[k][-1][0] for k in langs])
    out = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            now = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                now[4] += 1
            node, proof = leaf(now), []
            for levels, at in ((trees[lang], i), (top, t)):
                for level in levels[:-1]:
                    pair = level[at & ~1:(at & ~1) + 2]
                    proof += [x for k, x in enumerate(pair) if k != at & 1]
                    pair[at & 1] = node
                    node, at = H(*pair), at // 2
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], H(*proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(spark, rows, bits):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = M.verified_manifest(df, bits)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("n", [*range(1, 20), 31, 32, 33, 63, 64, 65, 100])
def test_places_and_proofs_of_one_log(n):
    leaves = [H(str(i)).encode() for i in range(n)]
    log, levels = M.append_log(leaves, M.height_of(n)), tree([x.decode() for x in leaves])
    assert len(log) == sum(map(len, levels)) and log[-1].decode() == levels[-1][0]
    for h, level in enumerate(levels):
        for j, x in enumerate(level):
            assert log[M.place(h, min(n, (j + 1) << h) - 1)].decode() == x
    for i in range(n):
        steps = M.path(log, i, n, M.height_of(n))
        assert M.fold(leaves[i], steps) == log[-1] and M.fold(b"other", steps) != log[-1]


def made(seed, n):
    rng = random.Random(seed)
    return [(i, "é" * rng.randrange(9) + str(i), rng.choice(["en"] * 6 + ["de", "fr", None, "zz", "é", ""]), rng.choice(["a", None, "b:1"]),
             rng.choice([None, 0, 9, 99, 5])) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_equals_brute_force_and_finds_what_was_tampered_with(spark, bits):
    rows = made(bits, 150)
    found = got(spark, rows, bits)
    assert found == brute(rows)
    bad = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None}
    assert {r[0] for r in found if not r[6]} == bad != set()


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, "a", "en", "s", 1)] * 4 + [(5, "b", "en", "s", 1), (None, "c", "en", None, 2),
            (7, "", "en", "", 0), (8, "x" * 300_000, "en", "s", 300_000), (-3, "neg", "en", "s", -1), (2 ** 62, "big", "de", "s", 2 ** 63 - 1)]
    assert got(spark, rows, 2) == brute(rows)


def test_small_and_empty(spark):
    assert got(spark, [], 3) == []
    one = [(1, "only", "en", "s", 4)]
    assert got(spark, one, 3) == brute(one)
    assert brute(one)[0][4] == H() and brute(one)[0][2] == brute(one)[0][3]


def test_the_log_is_a_gapless_postorder(spark):
    rows = [(i, str(i), "en" if i % 5 else "de", "s", 1) for i in range(83)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    leaves, tiers, _ = M.manifest(df, 2)
    logs = {}
    for r in M.whole_log(tiers, 2).collect():
        logs.setdefault(r.tree, {})[r.place] = r.digest
    assert len(tiers) > 2
    for key, log in logs.items():
        of = [r.leaf for r in leaves.where(leaves.tree == key).orderBy("pos").collect()]
        whole = M.append_log([bytes(x) for x in of], M.height_of(len(of)))
        assert [log[i] for i in range(len(log))] == [x.decode() for x in whole]
