"""Language-model scores from a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model predicts symbols: the most frequent words, the end of a text, and classes of all other words by their last
two bytes. A context is the symbols before a place. Its vector is linear in theirs: the nearest have weights of their
own by distance, the last FAR share one. A symbol's score is its vector's product with the context's plus a bias;
the softmax over all symbols, a batch of contexts times the matrix of symbols, gives normalised probabilities. Within
a class a word has its add-one share of the class's tokens, one place being kept for words that were never seen.

Training: every task starts from the same weights and runs over its own documents. A batch of contexts is held
against noise symbols that it shares (so both sides are matrix products), and the classifier that tells data from
noise moves the weights (AdaGrad). After each round the tasks' weights are averaged by their tokens. The rounds share
out the documents, so each training document is seen once. Biases begin at the logarithm of the corpus frequencies.

Counts are exact and cover the corpus. The words of the dictionary (the most frequent ones, DICTIONARY at most) go to
the tasks with their counts; any other word is looked up by a join, from blocks of documents that name each such word
once.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship, staged

HEADS, CLASSES = 31, 96             # words that are symbols of their own, classes of all other words
DIMENSIONS = 16
NEAR, FAR = 2, 64                   # symbols before a place with a weight by distance, and with one weight
NOISE = 16                          # noise symbols of a batch
BATCH = 512
RATE = 0.2
ROUNDS = 3
DICTIONARY, LONGEST = 1 << 18, 64   # words that the tasks get with their counts, and their bytes, at most
BLOCK_BYTES, BLOCK_DOCS = 16 << 20, 8192
FLUSH = 400_000                     # distinct words that a task counts before it hands them on
PIECE = 1 << 20                     # bytes of a text that are split into words at a time
END = 0                             # symbol of the end of a text; HEADS words, then the classes follow
SYMBOLS = 1 + HEADS + CLASSES
START = SYMBOLS                     # stands before a text
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---- words ------------------------------------------------------------------------------------


def words(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased (A-Z) words of a text, a piece at a time."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        yield text[at:end].lower().split()
        at = end


def class_of(word: bytes) -> int:
    """Symbol of a word that is none itself."""
    return 1 + HEADS + zlib.crc32(word[-2:]) % CLASSES


def _class_column(word: Column) -> Column:
    ending = F.when(F.octet_length(word) <= 2, word).otherwise(F.substring(word, F.octet_length(word) - 1, F.lit(2)))
    return (F.pmod(F.crc32(ending), F.lit(CLASSES)) + 1 + HEADS).cast("int")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the batches' texts; the null word counts the texts."""
    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            seen[None] += 1
            for piece in words(text.as_py()):
                seen.update(piece)
                if len(seen) > FLUSH:
                    yield table()
                    seen.clear()
    yield table()


@dataclass
class Vocabulary:
    """``tokens`` and ``types`` of the training corpus, ``ends`` among them; the dictionary's ``counts``; symbols of
    the head words; by symbol the corpus ``frequency`` and, of a class, ``room``: its tokens, types and one."""
    tokens: int
    types: int
    ends: int
    counts: dict[bytes, int]
    heads: dict[bytes, int]
    frequency: list[int]
    room: list[int]

    def symbol(self, word: bytes) -> int:
        return self.heads.get(word) or class_of(word)


def _vocabulary(counts: DataFrame) -> Vocabulary:
    """From all counts; the driver gets DICTIONARY words at most, and a row for each class."""
    tokens, types, ends = counts.agg(F.sum("n"), F.count(F.lit(1)), F.max(F.when(F.col("word").isNull(), F.col("n")))).first()
    size = F.floor(F.log2("n") * 16)
    short = counts.where(F.octet_length("word") <= LONGEST)
    by_size = sorted(((r.size, r.many) for r in short.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("many")).collect()), reverse=True)
    least, total = None, 0
    for at, many in by_size:
        if (total := total + many) > DICTIONARY:
            break
        least = at
    known = {} if least is None else {bytes(r.word): r.n for r in short.where(size >= least).collect()}
    heads = {w: i for i, w in enumerate(sorted(known, key=lambda w: (-known[w], w))[:HEADS], 1)}
    others = counts.where(F.col("word").isNotNull())
    if heads:
        others = others.where(~F.col("word").isin(list(heads)))
    frequency, room = [0] * SYMBOLS, [1] * SYMBOLS
    frequency[END] = ends or 0
    for w, i in heads.items():
        frequency[i] = known[w]
    for r in others.groupBy(_class_column(F.col("word")).alias("symbol")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect():
        frequency[r.symbol], room[r.symbol] = r.n, r.n + r.types + 1
    return Vocabulary(tokens or 0, types, ends or 0, known, heads, frequency, room)


# ---- texts as symbols -------------------------------------------------------------------------

CODED = ("block long, place int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, symbols binary, "
         "word binary, places array<int>, times array<int>")
_CODED = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("n_known", pa.int64()), ("base", pa.float64()), ("within", pa.float64()), ("symbols", pa.binary()),
                    ("word", pa.binary()), ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])


class _Block(dict):
    """The dictionary's words by place in it, and after them the other words of a block of documents as they come up,
    with the symbol of each."""

    def __init__(self, v: Vocabulary):
        super().__init__((w, i) for i, w in enumerate(v.counts))
        self.size, self.others = len(self), []
        self.symbols = bytearray(map(v.symbol, v.counts))

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.others.append(word)
        self.symbols.append(class_of(word))
        return place

    def clear_others(self) -> None:
        for word in self.others:
            del self[word]
        self.others = []
        del self.symbols[self.size:]


def _other_words(block: int, held: list[tuple[int, np.ndarray]], words_: list[bytes]) -> pa.RecordBatch:
    """A row of CODED for each of a block's other words: the documents that hold it and how often. ``held``: place of
    a document and its occurrences of such words."""
    word = np.concatenate([w for _, w in held]) if held else np.zeros(0, np.int64)
    place = np.repeat(np.array([p for p, _ in held], np.int64), [len(w) for _, w in held])
    pair, times = np.unique(word.astype(np.int64) << 32 | place, return_counts=True)
    starts = np.searchsorted(pair >> 32, np.arange(len(words_) + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(starts, pa.array(x.astype(np.int32))) for x in (pair & 0xFFFFFFFF, times)]
    n = len(words_)
    nothing = [pa.nulls(n, _CODED.field(i).type) for i in range(1, 9)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), *nothing, pa.array(words_, pa.binary()), *lists], schema=_CODED)


def _coder(v: Vocabulary) -> Callable:
    """Texts to rows of CODED: one a document, with the sums over the dictionary's words, and one for each other word
    of a block of documents."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Block(v)
        symbol = np.frombuffer(bytes(index.symbols), np.uint8)
        logs = np.log10(np.array(list(v.counts.values()), np.float64) + 1)
        inside = -np.log10(np.array(v.room, np.float64))
        # a head word is a symbol of its own, any other has its share of its class
        within = np.where(symbol > HEADS, logs, 0.0)
        by_symbol = np.where(np.arange(SYMBOLS) > HEADS, inside, 0.0)
        block, size, docs, held = TaskContext.get().partitionId() << 32, 0, [], []
        look, ends, end_log = index.__getitem__, int(v.ends > 0), math.log10(v.ends + 1)

        def flush() -> Iterator[pa.RecordBatch]:
            yield from pa.Table.from_pylist(docs, _CODED).to_batches()
            yield _other_words(block, held, index.others)

        for batch in batches:
            for doc_id, out, text in zip(*(batch.column(c) for c in ("doc_id", "held_out", "text"))):
                text, place = text.as_py(), len(docs)
                n, known, base, inner, parts = 1, ends, end_log, 0.0, []
                for piece in words(text):
                    at = np.fromiter(map(look, piece), np.int32, len(piece))
                    part = np.frombuffer(index.symbols, np.uint8)[at]     # the view ends here, so the table may grow
                    inner += float(by_symbol[part].sum())
                    of_dictionary = at < index.size
                    if not of_dictionary.all():
                        held.append((place, at[~of_dictionary] - index.size))
                        at = at[of_dictionary]
                    n, known = n + len(part), known + len(at)
                    base, inner = base + float(logs[at].sum()), inner + float(within[at].sum())
                    parts.append(part.tobytes())
                docs.append({"block": block, "place": place, "doc_id": doc_id.as_py(), "held_out": out.as_py(), "n_tokens": n, "n_known": known,
                             "base": base, "within": inner, "symbols": b"".join(parts) + bytes([END])})
                size += len(text)
                if size >= BLOCK_BYTES or len(docs) >= BLOCK_DOCS:
                    yield from flush()
                    index.clear_others()
                    block, size, docs, held = block + 1, 0, [], []
        if docs:
            yield from flush()
    return code


# ---- the model --------------------------------------------------------------------------------


def _sum_by(symbols: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` that share a symbol, by symbol."""
    order = np.argsort(symbols.astype(np.uint8), kind="stable")
    ranked = symbols[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    out = np.zeros((n, values.shape[1]), values.dtype)
    out[ranked[starts]] = np.add.reduceat(values[order], starts, axis=0)
    return out


@dataclass
class Weights:
    """``context`` (symbols and START, by dimension), ``output`` (symbols), ``bias``, ``mix`` (by distance, last the
    shared one), and AdaGrad's sums of squares for each."""
    context: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    mix: np.ndarray
    squares: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def first(cls, frequency: list[int], seed: int = 1) -> "Weights":
        share = (np.array(frequency, np.float64) + 1) / (sum(frequency) + SYMBOLS)
        rng = np.random.default_rng(seed)
        context = (rng.standard_normal((SYMBOLS + 1, DIMENSIONS)) * 0.3).astype(np.float32)
        mix = np.full((NEAR + 1, DIMENSIONS), 1 / (NEAR + 1), np.float32)
        mix[NEAR] = 1
        out = cls(context, np.zeros((SYMBOLS, DIMENSIONS), np.float32), np.log(share).astype(np.float32), mix)
        out.squares = [np.full_like(a, 1e-3) for a in out.arrays()]
        return out

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.output, self.bias, self.mix]

    def dump(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (*self.arrays(), *self.squares)])

    def load(self, values: np.ndarray) -> "Weights":
        shapes, at, out = [a.shape for a in (*self.arrays(), *self.squares)], 0, []
        for shape in shapes:
            n = math.prod(shape)
            out.append(values[at:at + n].reshape(shape).astype(np.float32))
            at += n
        return Weights(*out[:4], squares=out[4:])

    def hidden(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors of the symbols, means of the last FAR before each place, and vectors of the contexts. The first
        FAR places have none."""
        e = self.context[seq]
        sums = np.cumsum(e, axis=0)
        mean = np.zeros_like(e)
        mean[FAR:] = sums[FAR - 1:-1]
        mean[FAR + 1:] -= sums[:-FAR - 1]
        mean /= FAR
        h = self.mix[NEAR] * mean
        for i in range(1, NEAR + 1):
            h[FAR:] += self.mix[i - 1] * e[FAR - i:-i]
        return e, mean, h

    def log_probabilities(self, seq: np.ndarray) -> np.ndarray:
        """Natural logarithms for the symbols of ``seq`` from place FAR on, given those before; 0 for START, which is
        never predicted."""
        at = np.flatnonzero(seq[FAR:] != START)
        scores = self.hidden(seq)[2][at + FAR] @ self.output.T
        scores += self.bias
        if float(scores.max(initial=0)) > 60:
            scores -= scores.max(axis=1, keepdims=True)
        own = scores[np.arange(len(at)), seq[at + FAR]]
        np.exp(scores, out=scores)
        out = np.zeros(len(seq) - FAR, np.float32)
        out[at] = own - np.log(scores.sum(axis=1))
        return out

    def gradients(self, seq: np.ndarray, noise: np.ndarray, share: np.ndarray, with_loss: bool = False) -> tuple[float, list[np.ndarray]]:
        """Mean loss (if asked for) of noise-contrastive estimation over the places from FAR on that hold a symbol, and
        its gradients. ``noise``: symbols drawn by ``share``, the same for each place."""
        e, mean, h = self.hidden(seq)
        at = np.flatnonzero(seq[FAR:] != START) + FAR
        if not len(at):
            return 0.0, [np.zeros_like(a) for a in self.arrays()]
        h, target, n = h[at], seq[at], np.float32(len(at))
        expected = np.log(share * len(noise)).astype(np.float32)
        odds = np.einsum("ij,ij->i", h, self.output[target]) + (self.bias - expected)[target]
        odds_noise = h @ self.output[noise].T + (self.bias - expected)[noise]
        is_noise = 1 / (1 + np.exp(np.clip(odds, -30, 30)))             # of the data
        is_data = 1 / (1 + np.exp(-np.clip(odds_noise, -30, 30)))       # of the noise
        loss = float(-(np.log(1 - is_noise).sum() + np.log(1 - is_data).sum()) / n) if with_loss else 0.0
        is_noise, is_data = -is_noise / n, is_data / n
        to_h = is_noise[:, None] * self.output[target] + is_data @ self.output[noise]
        output = _sum_by(target, is_noise[:, None] * h, SYMBOLS)
        bias = (np.bincount(target, is_noise, SYMBOLS) + np.bincount(noise, is_data.sum(axis=0), SYMBOLS)).astype(h.dtype)
        np.add.at(output, noise, is_data.T @ h)
        g = np.zeros_like(e)
        g[at] = to_h
        to_e, mix = np.zeros_like(e), np.zeros_like(self.mix)
        for i in range(1, NEAR + 1):
            to_e[FAR - i:-i] += self.mix[i - 1] * g[FAR:]
            mix[i - 1] = np.einsum("ij,ij->j", g[FAR:], e[FAR - i:-i])
        mix[NEAR] = np.einsum("ij,ij->j", g, mean)
        later = np.cumsum((self.mix[NEAR] / FAR * g)[::-1], axis=0)[::-1]
        to_e[:-1] += later[1:]
        to_e[:-FAR - 1] -= later[FAR + 1:]
        return loss, [_sum_by(seq, to_e, SYMBOLS + 1), output, bias, mix]

    def step(self, gradients: list[np.ndarray]) -> None:
        for a, s, g in zip(self.arrays(), self.squares, gradients):
            s += g * g
            a -= RATE * g / np.sqrt(s)


_BEFORE = np.full(FAR, START, np.uint8)


def windows(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts in a row, START before each, cut into ``size`` places with the FAR before them; and the text of each
    place."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        parts += [_BEFORE, np.frombuffer(t, np.uint8)]
        owner.append(FAR + len(t))
    row, owner = np.concatenate([_BEFORE, *parts]), np.repeat(np.arange(len(texts)), owner)
    for at in range(0, len(owner), size):
        yield row[at:at + size + FAR].astype(np.intp), owner[at:at + size]


def _grouped(column: pa.Array, places: int) -> Iterator[list[bytes]]:
    """Texts of a batch, some ``places`` long together."""
    held, n = [], 0
    for x in column:
        held.append(x.as_py())
        n += len(held[-1]) + FAR
        if n >= places:
            yield held
            held, n = [], 0
    if held:
        yield held


TRAINED = "part long, tokens double, values binary"


def _trainer(weights: Weights, frequency: list[int], round_: int) -> Callable:
    share = (np.array(frequency, np.float64) + 1) / (sum(frequency) + SYMBOLS)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng, own, seen = np.random.default_rng([round_, part]), weights.load(weights.dump()), 0
        up = np.cumsum(share)
        for batch in batches:
            for texts in _grouped(batch.column("symbols"), 64 * BATCH):
                for seq, _ in windows(texts, BATCH):
                    noise = np.minimum(np.searchsorted(up, rng.random(NOISE) * up[-1], side="right"), SYMBOLS - 1)
                    own.step(own.gradients(seq, noise, share)[1])
                seen += sum(map(len, texts))
        if seen:
            yield pa.RecordBatch.from_pydict({"part": [part], "tokens": [float(seen)], "values": [own.dump().astype("<f4").tobytes()]},
                                             pa.schema([("part", pa.int64()), ("tokens", pa.float64()), ("values", pa.binary())]))
    return train


def _average(rows: pa.Table) -> pa.Table:
    """One row of a group of tasks' weights: their mean by tokens."""
    rows = rows.sort_by("part")
    tokens = rows.column("tokens").to_numpy()
    total = sum(t * np.frombuffer(v.as_py(), "<f4").astype(np.float64) for t, v in zip(tokens, rows.column("values")))
    return pa.Table.from_pydict({"part": [rows.column("part")[0].as_py()], "tokens": [tokens.sum()], "values": [(total / tokens.sum()).astype("<f4").tobytes()]},
                                pa.schema([("part", pa.int64()), ("tokens", pa.float64()), ("values", pa.binary())]))


def estimate(coded: DataFrame, v: Vocabulary) -> Weights:
    """Weights from the coded documents that are not held out. Each round's average is taken in groups of a thousand
    tasks, then over the groups."""
    weights = Weights.first(v.frequency)
    texts = coded.where(F.col("word").isNull() & ~F.col("held_out"))
    for r in range(ROUNDS):
        of_round = texts.where(F.pmod(F.xxhash64("block", "place"), F.lit(ROUNDS)) == r).select("symbols")
        trained = of_round.mapInArrow(_trainer(weights, v.frequency, r), TRAINED)
        for _ in range(2):
            trained = trained.withColumn("of", F.floor(F.col("part") / 1024)).groupBy("of").applyInArrow(_average, TRAINED) \
                .withColumn("part", F.floor(F.col("part") / 1024).cast("long"))
        means = sorted((x.part, x.tokens, bytes(x.values)) for x in trained.collect())      # one, of a million tasks
        if means:
            total = sum(t for _, t, _ in means)
            weights = weights.load(sum(t / total * np.frombuffer(x, "<f4").astype(np.float64) for _, t, x in means))
    return weights


# ---- scores -----------------------------------------------------------------------------------


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    counts: DataFrame       # word (null: end of a text), n
    weights: Weights


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    key = F.col(id_col).cast("long")
    return docs.select(key.alias("doc_id"), held_out(key).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def _coded(texts: DataFrame, v: Vocabulary) -> DataFrame:
    return staged(texts.mapInArrow(_coder(v), CODED), "lm-coded")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[LanguageModel, DataFrame]:
    """The model from the documents that are not held out, and all documents coded for it."""
    ship(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    counts = staged(texts.where(~F.col("held_out")).select("text").mapInArrow(_count, "word binary, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")
    v = _vocabulary(counts)
    coded = _coded(texts, v)
    return LanguageModel(v, counts, estimate(coded, v)), coded


SCORED = "block long, place int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scorer(weights: Weights) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for texts in _grouped(batch.column("symbols"), 64 * BATCH):
                sums = np.zeros(len(texts))
                for seq, owner in windows(texts, 2 * BATCH):
                    sums += np.bincount(owner, weights.log_probabilities(seq), len(texts))
                own.append(sums / math.log(10))
            score = np.concatenate(own) + batch.column("within").to_numpy() if own else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "place", "doc_id", "held_out", "n_tokens", "n_known", "base")),
                                              pa.array(score, pa.float64())], ["block", "place", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"])
    return score


def _joined(tokens: int, types: int) -> Callable:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in RESULT.split(", ")])

    def join(docs: pa.Table, others: pa.Table) -> pa.Table:
        """Documents of a block with the logarithms of the counts of the words outside the dictionary."""
        docs = docs.sort_by("place")
        extra, known = np.zeros(docs.num_rows), np.zeros(docs.num_rows, np.int64)
        if others.num_rows:
            places, times = (pc.list_flatten(others.column(c)).to_numpy() for c in ("places", "times"))
            many = np.repeat(others.column("n").to_numpy(), pc.list_value_length(others.column("places")).to_numpy())
            # by count, so that sums don't depend on the order of arrival
            pair, back = np.unique(places.astype(np.int64) << 40 | np.minimum(many, (1 << 40) - 1), return_inverse=True)
            times = np.bincount(back, times)
            extra += np.bincount(pair >> 40, times * np.log10((pair & (1 << 40) - 1) + 1.0), docs.num_rows)
            known += np.bincount(pair >> 40, times, docs.num_rows).astype(np.int64)
        n = docs.column("n_tokens").to_numpy()
        base = docs.column("base").to_numpy() + extra - n * math.log10(tokens + types + 1)
        return pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), docs.column("n_tokens"),
                                     pa.array(docs.column("n_known").to_numpy() + known), pa.array([tokens] * len(n), pa.int64()),
                                     pa.array(base), pa.array(docs.column("score").to_numpy() + extra)], schema=schema)
    return join


def score(model: LanguageModel, coded: DataFrame) -> DataFrame:
    """Coded documents with their scores."""
    texts = coded.where(F.col("word").isNull()).drop("word", "places", "times").mapInArrow(_scorer(model.weights), SCORED)
    others = coded.where(F.col("word").isNotNull()).select("block", "word", "places", "times").join(model.counts, "word") \
        .select(F.col("block").alias("block"), "places", "times", "n")
    return texts.groupBy("block").cogroup(others.groupBy("block")).applyInArrow(_joined(model.vocabulary.tokens, model.vocabulary.types), RESULT)


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its log10 probability under the model (``score``) and under add-one unigrams
    (``base_score``): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty: its one token is the end. A null id counts as an empty one, so it trains and is carried. Rows
    that repeat are documents of their own, in training too. Without training documents all counts are 0 and the model
    stays as it began. An empty table gives no row; other columns are ignored. A very long text is taken in pieces;
    a block of documents is 16 MB of texts, or one text. Weights, and so the last digits of scores, depend on how the
    table is partitioned, as each task trains on its own part; a task that runs again gives the same.
    """
    model, coded = train(docs, id_col, text_col)
    return score(model, coded).withColumnRenamed("doc_id", id_col)
