import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from courtline.llm import nce_language_model as L

SCHEMA = "doc_id long, text string, n_tokens string, word long, block string"


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def tokens(text):
    out, word = [], b""
    for c in (text or "").encode():
        if c in (0x20, 9, 10, 11, 12, 13):
            out, word = out + [word] * bool(word), b""
        else:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
    return out + [word] * bool(word)


def corpus(rows):
    counts = Counter(w for i, t in rows if not is_held_out(i) for w in [*tokens(t), None])
    return counts, sum(counts.values()), len(counts)


def made(seed, n):
    rng = random.Random(seed)
    langs = [["the", "of", "and", "to", "river", "Stone"], ["der", "die", "und", "zu", "fluss", "stein"]]
    return [(i, " ".join(rng.choice(langs[i % 2] + [f"w{rng.randrange(400)}{'ab'[i % 2]}"] * 3) for _ in range(rng.randrange(5, 60)))) for i in range(n)]


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    return L.language_scores(df).collect()


def by_row(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


def brute(rows):
    c, n, v = corpus(rows)
    out = []
    for i, t in rows:
        ts = [*tokens(t), None]
        out.append((i, is_held_out(i), len(ts), sum(c[w] > 0 for w in ts), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ts), 6)))
    return sorted(out, key=str)


def plain_score(model, counts, text):
    """log10 probability of a text, a token at a time."""
    w, v, seen, total = model.weights, model.vocabulary, [L.START] * L.FAR, 0.0
    for token in [*tokens(text), None]:
        s = L.END if token is None else v.symbol(token)
        e = [w.context[x].astype(float) for x in seen[-L.FAR:]]
        h = w.mix[L.NEAR] * sum(e) / L.FAR + sum(w.mix[i - 1] * e[-i] for i in range(1, L.NEAR + 1))
        z = w.output.astype(float) @ h + w.bias
        total += (z[s] - math.log(np.exp(z).sum())) / math.log(10)
        if s > L.HEADS:
            of = [n for x, n in counts.items() if x is not None and v.symbol(x) == s]
            total += math.log10((counts[token] + 1) / (sum(of) + len(of) + 1))
        seen.append(s)
    return total


def test_counts_and_scores_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(L, "DICTIONARY", 40)
    monkeypatch.setattr(L, "BLOCK_DOCS", 20)
    rows = made(1, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, coded = L.train(df)
    assert 0 < len(model.vocabulary.counts) <= 40
    found = L.score(model, coded).collect()
    assert by_row(found) == brute(rows)
    texts, counts = dict(rows), corpus(rows)[0]
    for r in found[::10]:
        assert r.score == pytest.approx(plain_score(model, counts, texts[r.doc_id]), rel=1e-4)


def test_probabilities_add_up_to_one(spark):
    rows = made(2, 60)
    model, _ = L.train(spark.createDataFrame(rows, "doc_id long, text string"))
    before = [3, 40, 7, 100]
    p = [model.weights.log_probabilities(np.array([L.START] * L.FAR + before + [s]))[-1] for s in range(L.SYMBOLS)]
    assert np.exp(p).sum() == pytest.approx(1, abs=1e-4)
    counts = corpus(rows)[0]
    for s in range(1 + L.HEADS, L.SYMBOLS):     # the words of a class and one that was never seen
        of = [n for x, n in counts.items() if x is not None and model.vocabulary.symbol(x) == s]
        assert sum(n + 1 for n in of) + 1 == model.vocabulary.room[s]


def test_gradients_of_noise_contrastive_estimation():
    rng = np.random.default_rng(5)
    w = L.Weights.first([5] * L.SYMBOLS)
    for a in w.arrays():
        a += rng.standard_normal(a.shape).astype(np.float32) * 0.2
    w = L.Weights(*(a.astype(np.float64) for a in w.arrays()))
    seq = np.array([L.START] * L.FAR + rng.integers(0, L.SYMBOLS, 70).tolist() + [L.START] * 3 + [1, 2])
    noise, share = rng.integers(0, L.SYMBOLS, 8), np.full(L.SYMBOLS, 1 / L.SYMBOLS)
    _, grads = w.gradients(seq, noise, share)
    for a, g in zip(w.arrays(), grads):
        for at in [int(x) for x in rng.integers(0, a.size, 6)] + [int(np.abs(g).argmax())]:
            old, ends = a.flat[at], []
            for d in (1e-3, -1e-3):
                a.flat[at] = old + d
                ends.append(w.gradients(seq, noise, share, True)[0])
            a.flat[at] = old
            assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(g.flat[at], rel=0.02, abs=2e-5)


def test_beats_add_one_on_held_out_documents(spark, sf_dir):
    rows = L.language_scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score - r.base_score for r in held) / n > 0.1
    assert sum(r.score > r.base_score for r in held) > 0.9 * len(held)


def test_edges(spark):
    rows = [(None, None), (None, "a b"), (1, ""), (2, " \t\n"), (3, "A\x0bb c  É"), (4, "word " * 3000), (5, "x" * 70_000 + " y"),
            (3, "A\x0bb c  É"), (3, "A\x0bb c  É")] + made(3, 30)[6:]
    assert by_row(got(spark, rows)) == brute(rows)
    assert got(spark, [], 1) == []


def test_long_texts_are_taken_in_pieces(spark, monkeypatch):
    rows = made(4, 12)
    rows.append((99, " ".join(t for _, t in rows) * 3))
    whole = got(spark, rows, 1)
    monkeypatch.setattr(L, "PIECE", 50)
    assert [tuple(r) for r in whole] == [tuple(r) for r in got(spark, rows, 1)]
    assert b" ".join(w for piece in L.words(b" ab  Cd\tef " * 40) for w in piece) == b" ".join([b"ab", b"cd", b"ef"] * 40)


def test_nothing_to_train_on(spark):
    held = [(i, f"some words {i}") for i in range(40) if is_held_out(i)]
    found = got(spark, held)
    assert by_row(found) == brute(held) and all(r.train_tokens == 0 and math.isfinite(r.score) for r in found)
