import random
import zlib

from courtline.llm import toxicity as T


def test_folding():
    cyrillic, wide = "\u0455tu\u0440\u0456d", "".join(chr(ord(c) + 0xFEE0) for c in "stupid")
    assert T.words(f"St\u00fcpid $TUP1D {cyrillic} {wide} st\u00adupid\u200b x_y a-b") == ["st\u00fcpid"] + ["stupid"] * 4 + ["x", "y", "a", "b"]
    assert T.words("e\u0301t\u00e9") == ["\u00e9t\u00e9"] and T.words("") == []


def test_terms_weights_and_exceptions():
    m = T.Matcher({" stup": 3.0, " stupid ": 4.0, " clown ": 2.0}, ["clown fish"])
    assert [(w, p) for _, w, p in m.hits(T.words("a stupid clown"))] == [(4.0, ["a stupid", "stupid clown"]), (2.0, ["stupid clown"])]
    assert m.features("the clown fish swims")[0] == 0.0 and m.features("the clown swims")[0] == 1.0
    assert m.features("astupid")[0] == 0.0 and m.features("$tup1dity")[0] == 1.0
    assert m.features("stupid " + "word " * 900)[2] < m.features("stupid word")[2]
    assert T.Matcher({}).features("anything") == (0.0, 0.0, 0.0)


def test_short_words_and_scripts_without_spaces(spark):
    r = random.Random(8)
    thai, han = "\u0e01\u0e02\u0e04\u0e07\u0e08\u0e0a\u0e14\u0e15\u0e16\u0e17\u0e19\u0e1a\u0e1b\u0e1e\u0e1f\u0e21\u0e22\u0e23", "".join(map(chr, range(0x4e00, 0x4e40)))
    bad = {"latin": "zq", "thai": "\u0e2b\u0e35\u0e49\u0e22", "han": "\u6ed3\u86cb"}
    docs, labels = [], []
    for i in range(900):
        kind = ("latin", "thai", "han")[i % 3]
        words = ["".join(r.choice({"latin": "abcdefgh", "thai": thai, "han": han}[kind]) for _ in range(r.randint(2, 9))) for _ in range(r.randint(3, 25))]
        toxic = int(r.random() < .3)
        if toxic:
            words.insert(r.randrange(len(words)), bad[kind])
        docs.append((i, (" " if kind == "latin" else "").join(words)))
        labels.append((i, toxic))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = T.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert " zq " in model["lexicon"]
    got = [(r.doc_id % 3, r.predicted, labels[r.doc_id][1]) for r in T.toxicity(d, model).collect() if r.held_out]
    for kind in range(3):
        assert sum(p == t for k, p, t in got if k == kind) >= 0.97 * sum(k == kind for k, _, _ in got)
    m = T.Matcher({"\u6ed3\u86cb": 2.0, " zq ": 1.0})
    assert [w for _, w, _ in m.hits(T.words("\u4e00\u6ed3\u86cb\u4e01\u6ed3\u86cb zq zqa"))] == [2.0, 2.0, 1.0]


def made(n, seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words, toxic = [r.choice(vocabulary) for _ in range(r.randint(3, 60))], int(r.random() < .2)
        if toxic:
            for _ in range(1 + len(words) // 20):
                words.insert(r.randrange(len(words)), r.choice(["stupid", "moron", "zzkrr" + r.choice(vocabulary), "ѕсum"]))
        elif r.random() < .2:
            words += ["moron", "beetle"]
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_accuracy_and_fold(spark):
    docs, labels = made(1500, 3)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = T.train(d, lab)
    assert any(t.startswith(" zzkr") for t in model["lexicon"]) and "moron beetle" in model["exceptions"]
    rows, truth = T.toxicity(d, model).collect(), dict(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    out = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out]
    assert sum(p == t for p, t in out) > 0.97 * len(out)
    # labels of the held-out fold change nothing
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    assert T.train(d, spark.createDataFrame(flipped, "doc_id long, toxic int")) == model


def test_nulls_repeats_empty_tables_no_labels(spark):
    rows = [(None, None), (1, ""), (1, "stupid"), (1, "stupid"), (2, "word " * 50_000)]
    d = spark.createDataFrame([(*r, 0.5, "q") for r in rows], "doc_id long, text string, score double, toxic string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = T.toxicity(d, T.train(d, none)).collect()
    assert len(got) == 5 and all(r.predicted == 0 for r in got)
    assert T.toxicity(d.limit(0), T.train(d.limit(0), none)).count() == 0
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    assert T.train(d, odd)["lexicon"] == {}
