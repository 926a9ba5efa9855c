"""Toxicity by a weighted lexicon that Aho-Corasick matches in folded text.

Folding: compatibility forms and look-alike letters of other scripts become Latin letters, digits and signs
that stand for letters become those letters, invisible characters go, words are runs of letters. The lexicon
holds stems (word beginnings), whole words and, for scripts without spaces, short runs of characters with a weight each, learned from labelled rows: the log of how
much more often toxic documents hold them, kept where a likelihood-ratio test that allows for the number of
candidates finds them telling. An exception phrase (a term with the word before or after it) takes its hit
back. A document's weight sum, alone and per length, becomes a score between 0 and 1 by a logistic curve that
is fitted on the same rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship, staged

TRAIN_ROWS = 12_000        # labelled rows that are learned from at most, chosen by the hash of their id
MAX_TERMS = 20_000         # candidates, and so the lexicon, of words and as many of runs of characters
MAX_PHRASES = 2_000
STEMS = range(4, 8)        # letters of a stem
GRAMS = range(1, 5)        # characters of a term within text of a script without spaces
LEAST = 3                  # toxic documents, and different neighbours in them, of a term
THRESHOLD = 0.3

# Letters that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e",
    "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "|": "l"}
EXCEPTIONS = ("clown fish", "trash can", "trash bin")

_WORDS = re.compile(r"[^\W\d_]+")
# Vowel signs and tone marks of Thai, Lao, Burmese and Khmer belong to their words.
_MARKS = "\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u0eb1\u0eb4-\u0ebc\u0ec8-\u0ecd\u102b-\u103e\u17b4-\u17d3"
_MARKED_WORDS = re.compile(rf"[^\W\d_]+(?:[{_MARKS}]+[^\W\d_]*)*")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff]")


class _Fold(dict):
    """Character table that works out and keeps the fold of each character it meets."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        out = "" if unicodedata.category(c) == "Cf" else unicodedata.normalize("NFKC", c).lower()
        out = "".join(LOOKALIKES.get(x, SUBSTITUTES.get(x, x)) for x in out)
        self[code] = out
        return out


_fold = _Fold()


def words(text: str) -> list[str]:
    """Words of the folded text, in order."""
    if text.isascii():
        return _WORDS.findall(text.translate(_fold))
    return _MARKED_WORDS.findall(unicodedata.normalize("NFC", text.translate(_fold)))


def unspaced(word: str) -> bool:
    return not word.isascii() and _UNSPACED.search(word) is not None


def terms(found: list[str]) -> set[str]:
    """Whole words of any length (" abcd "), stems of the longer ones (" abcd") and, in scripts without spaces, runs of
    characters anywhere in a word ("ab") of a document."""
    out = set()
    for w in set(found):
        out.add(f" {w} ")
        if unspaced(w):
            out.update(w[i:i + n] for n in GRAMS for i in range(len(w) - n + 1))
        else:
            out.update(f" {w[:n]}" for n in STEMS if n <= len(w))
    return out


def _counted(count: Callable[[list[str], int, Counter], None]):
    """Counts over a partition's labelled texts: (term, toxic documents, clean documents)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                count(words(text), toxic, seen[toxic])
        keys = sorted(seen[0] | seen[1])
        for i in range(0, len(keys), 20_000):
            part = keys[i:i + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())] + [pa.array([seen[t][k] for k in part], pa.int64()) for t in (1, 0)],
                                             ["term", "toxic", "clean"])
    return run


COUNTS = "term string, toxic long, clean long"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, word before it) of a batch's texts, each once. A term's support is at most its number of different
    neighbours: copies of a document repeat its words with the same ones, and must not make them look telling."""
    for batch in batches:
        seen = set()
        for text in batch.column("text"):
            found = words(text.as_py())
            for before, word in zip(["", *found], found):
                if unspaced(word):                      # what stands before is in the word itself, or the word before it
                    seen.add((f" {word} ", before))
                    seen.update((word[i:i + n], word[max(0, i - 4):i] or f"{before} ") for n in GRAMS for i in range(len(word) - n + 1))
                else:
                    seen.update((t, before) for t in terms([word]))
        rows = sorted(seen)
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[i:i + 20_000])], ["term", "before"])


def _ratio(a: int, n: int, b: int, m: int) -> float:
    """Likelihood ratio (G squared) of the shares a of n and b of m."""
    def part(x: int, share: float) -> float:
        return x * math.log(share) if x else 0.0
    p, q, r = (a + b) / (n + m), a / n, b / m
    return 2 * (part(a, q) + part(n - a, 1 - q) + part(b, r) + part(m - b, 1 - r)
                - part(a + b, p) - part(n + m - a - b, 1 - p))


def choose_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weighted lexicon; a longer term stays only if it tells more than its stem does."""
    need = 2 * math.log(max(2, len(counts))) + 6
    lexicon: dict[str, float] = {}
    for term, t, c in sorted(counts, key=lambda x: (len(x[0]), x[0])):
        weight = math.log((t + .5) / (toxic + 1)) - math.log((c + .5) / (clean + 1))
        if weight <= 0 or _ratio(t, toxic, c, clean) < need:
            continue
        if term[0] == " ":
            shorter = {term[:n] for n in range(2, len(term))} | ({term.strip()} if unspaced(term) else set())
        else:
            shorter = {term[i:i + n] for n in range(1, len(term)) for i in range(len(term) - n + 1)}
        stem = max((lexicon[t] for t in shorter if t in lexicon), default=0.0)
        if weight > stem + (0.7 if stem else 0.0):
            lexicon[term] = weight
    return lexicon


class Matcher:
    """Aho-Corasick over the lexicon's terms; a word counts once, by its heaviest term, one of a script without spaces by each
    run of characters that is a term."""

    def __init__(self, lexicon: dict[str, float], exceptions=()):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.items():
            self.automaton.add_word(term, (len(term), weight))
        if lexicon:
            self.automaton.make_automaton()
        self.exceptions = frozenset(" ".join(words(p)) for p in exceptions)

    def hits(self, found: list[str]) -> list[tuple[int, float, list[str]]]:
        """(place in the line of words, weight, phrases with the neighbours) of each hit; one within a word has no phrases."""
        if not len(self.automaton) or not found:
            return []
        line, best, inner = f" {' '.join(found)} ", {}, {}
        for end, (length, weight) in self.automaton.iter(line):
            start = end - length + 1
            if line[start] == " ":
                best[start] = max(weight, best.get(start, 0.0))
            else:
                inner[start] = max((weight, end + 1), inner.get(start, (0.0, 0)))
        out, done = [], 0
        for start, (weight, stop) in sorted(inner.items()):     # within words that aren't a hit as a whole
            if start >= done and line.rfind(" ", done, start) not in best:
                out.append((start, weight, []))
                done = stop
        for start, weight in best.items():
            stop = line.index(" ", start + 1)
            after = line[start + 1:max(stop, line.find(" ", stop + 1))]
            before = line[line.rfind(" ", 0, start) + 1:stop] if start else ""
            out.append((start, weight, [p for p in (before, after) if " " in p]))
        return sorted(out)

    def features(self, text: str) -> tuple[float, float, float]:
        """Any hit, their weight, their weight per length."""
        found = words(text)
        total = sum(w for _, w, phrases in self.hits(found) if not self.exceptions.intersection(phrases))
        return float(total > 0), math.log1p(total), math.log1p(100 * total / (len(found) + 50))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> list[float]:
    """Logistic regression by Newton steps; an intercept first."""
    x = np.column_stack((np.ones(len(x)), x))
    beta, shrink = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink, x.T @ (y - p) - shrink @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta.tolist()


def held_out(doc_id) -> "F.Column":
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, exceptions=EXCEPTIONS) -> dict:
    """Lexicon, exception phrases and curve from at most ``rows`` labelled rows outside the held-out fold.

    The driver gets counts of at most MAX_TERMS terms of each kind and MAX_PHRASES phrases and three numbers a labelled row."""
    ship(docs.sparkSession)
    chosen = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = staged(chosen, "train-labels")
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    known = staged(known, "train-rows")                 # whole texts of at most ``rows`` ids
    sizes = dict(known.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon, phrases, curve = {}, list(exceptions), [-6.0 if not toxic else math.log(toxic / max(1, clean)), 0.0, 0.0, 0.0]
    if toxic and clean:
        def count_terms(found, label, into):
            into.update(terms(found))
        bad = known.where("toxic = 1")
        near = bad.mapInArrow(_neighbours, "term string, before string").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("near"))
        held = bad.mapInArrow(_counted(count_terms), COUNTS).groupBy("term").agg(F.sum("toxic").alias("toxic")).join(near, "term") \
            .select("term", F.least("toxic", "near").alias("toxic")).where(F.col("toxic") >= LEAST)
        held = staged(held, "train-terms")
        spaced = F.col("term").startswith(" ")          # runs of characters are ranked apart, they would crowd out the words
        held = {r.term: r.toxic for kind in (spaced, ~spaced)
                for r in held.where(kind).orderBy(F.col("toxic").desc(), "term").limit(MAX_TERMS).collect()}
        candidates = frozenset(held)

        def count_candidates(found, label, into):
            into.update(terms(found) & candidates)
        other = known.where("toxic = 0").mapInArrow(_counted(count_candidates), COUNTS).groupBy("term").agg(F.sum("clean").alias("clean"))
        other = {r.term: r.clean for r in other.collect()}
        lexicon = choose_lexicon([(t, n, other.get(t, 0)) for t, n in held.items()], toxic, clean)
        benign = known.mapInArrow(_counted(_phrases(lexicon)), COUNTS).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
            .where((F.col("clean") >= LEAST) & (F.col("clean") * toxic >= 4 * F.col("toxic") * clean)).orderBy(F.col("clean").desc(), "term").limit(MAX_PHRASES)
        phrases += [r.term for r in benign.collect()]
        model = {"lexicon": lexicon, "exceptions": phrases, "curve": curve}
        points = known.select("doc_id", "text", F.col("toxic").cast("double").alias("toxic")).mapInArrow(
            _feature_rows(model), "toxic double, any double, total double, dense double").toPandas().to_numpy()
        curve = fit(points[:, 1:], points[:, 0])
    return {"lexicon": lexicon, "exceptions": phrases, "curve": curve}


def _phrases(lexicon: dict[str, float]):
    made: list[Matcher] = []

    def count(found, label, into):
        if not made:
            made.append(Matcher(lexicon))
        into.update({p for _, _, around in made[0].hits(found) for p in around})
    return count


def _feature_rows(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model["lexicon"], model["exceptions"])
        for batch in batches:
            got = [matcher.features(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic")] + [pa.array(c, pa.float64()) for c in (zip(*got) if got else ([], [], []))],
                                             ["toxic", "any", "total", "dense"])
    return run


def _score(model: dict, matcher: Matcher, text: str) -> float:
    base, *slope = model["curve"]
    z = base + sum(a * b for a, b in zip(slope, matcher.features(text)))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _score_rows(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model["lexicon"], model["exceptions"])
        for batch in batches:
            out = [_score(model, matcher, text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], ["doc_id", "score"])
    return run


def toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    A null text is empty; empty texts get the curve's value without a hit. Null ids are carried. Each row is
    scored by its text alone. An empty table gives no row; other columns are ignored. Without labelled rows of
    both kinds the lexicon is empty and every score is the same low one.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_score_rows(model), "doc_id long, score double").select(
        F.col("doc_id").alias(id_col), held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, whole, whose score is below ``threshold``; a null text is scored as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model["lexicon"], model["exceptions"])
        for batch in batches:
            yield batch.filter(pa.array([_score(model, matcher, t.as_py() or "") < threshold for t in batch.column(text_col)], pa.bool_()))
    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
