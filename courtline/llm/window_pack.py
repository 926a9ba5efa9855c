"""Packing of tokenised documents by bounded-space online best fit.

A task keeps a fixed number of open windows. A document's rest (what is left after its full windows) goes
into the open window that it fits best. When it fits none, the fullest window is emitted, topped up with
the front of the document unless its gap is a few tokens, and a new one is opened. What is still open at the
end of a task is merged in rounds of 64 tasks, where the emptiest windows fill the gaps of the fullest, so one
partly filled window is left of each group and at last one of all; that one is cut into powers of two, which
need no padding.
"""

from __future__ import annotations

import base64
import json
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import batch_bytes, give_back, ship, staged

WINDOW = 2048
OPEN = 64                  # windows a task keeps open
FAN = 64                   # tasks whose leftovers are merged together
MAX_GAP = 16               # padding that is left in an emitted window
END_ID = 1                 # closes each document
BATCH_BYTES = 8 << 20      # of texts that a task is handed at a time (one longer text is handed alone)
PIECE = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, open boolean, source long"

Piece = tuple  # (doc_id, start, ids, doc_tokens)
_encoders: dict = {}


def encoder(tokenizer_json: str, ranks: str | None, pattern: str | None) -> Callable[[str], np.ndarray]:
    """Text to ids as the tokenizer file gives them without special tokens added.

    With ``ranks`` (the same vocabulary as byte ranks) texts go through the faster library that reads those;
    texts with the string of one of the tokenizer's own added tokens always go through the tokenizer file."""
    key = (tokenizer_json, ranks, pattern)
    if key not in _encoders:
        made: list = []

        def slow():
            if not made:        # with ranks few texts need it, and it is large
                from tokenizers import Tokenizer
                made.append(Tokenizer.from_file(tokenizer_json))
            return made[0]

        if ranks:
            import tiktoken
            with open(tokenizer_json, encoding="utf-8") as file:
                added = [t["content"] for t in json.load(file).get("added_tokens") or []]
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

            def encode(text: str) -> np.ndarray:
                if any(t in text for t in added):
                    return np.array(slow().encode(text, add_special_tokens=False).ids, "<u4")
                return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        else:
            def encode(text: str) -> np.ndarray:
                return np.array(slow().encode(text, add_special_tokens=False).ids, "<u4")
        _encoders[key] = encode
    return _encoders[key]


class Packer:
    """Open windows of one task; ``add`` returns the windows that it emits, each a list of pieces."""

    def __init__(self, size: int = WINDOW, limit: int = OPEN, max_gap: int = MAX_GAP):
        self.size, self.limit, self.max_gap = size, limit, max_gap
        self.order: list[tuple[int, int]] = []          # (free tokens, number), ascending
        self.windows: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list[Piece]]:
        n, at = len(ids), 0
        while n - at >= self.size:
            yield [(doc, at, ids[at:at + self.size], n)]
            at += self.size
        while at < n:
            need = n - at
            i = bisect_left(self.order, (need, -1))
            if i == len(self.order) and len(self.order) >= self.limit:
                free, number = self.order.pop(0)        # none fits: the fullest goes
                if free > self.max_gap:
                    self.windows[number].append((doc, at, ids[at:at + free], n))
                    at += free
                yield self.windows.pop(number)
                continue
            if i < len(self.order):
                free, number = self.order.pop(i)        # best fit
            else:
                free, number, self.made = self.size, self.made, self.made + 1
                self.windows[number] = []
            self.windows[number].append((doc, at, ids[at:], n))
            if free > need:
                insort(self.order, (free - need, number))
            else:
                yield self.windows.pop(number)
            return

    def rest(self) -> list[list[Piece]]:
        return [self.windows[number] for _, number in self.order]


def _length(window: list[Piece]) -> int:
    return sum(len(p[2]) for p in window)


def merged(windows: list[list[Piece]], size: int = WINDOW) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the one that is left: pieces of the emptiest fill the gaps of the fullest."""
    windows = sorted((list(w) for w in windows if w), key=_length)
    full, i, j = [], 0, len(windows) - 1
    while i < j:
        free = size - _length(windows[j])
        while free and i < j:
            doc, start, ids, n = windows[i].pop()
            if len(ids) > free:
                windows[i].append((doc, start, ids[:-free], n))
                start, ids = start + len(ids) - free, ids[-free:]
            windows[j].append((doc, start, ids, n))
            free -= len(ids)
            i += not windows[i]
        if not free:
            full.append(windows[j])
            j -= 1
    left = windows[j] if windows and i == j else []
    return (full + [left], []) if _length(left) == size else (full, left)


def powers(window: list[Piece]) -> list[list[Piece]]:
    """The window as windows whose lengths are powers of two."""
    out, left = [], list(window)
    total = _length(left)
    while total:
        size = 1 << (total.bit_length() - 1)
        part, free = [], size
        while free:
            doc, start, ids, n = left.pop(0)
            if len(ids) > free:
                left.insert(0, (doc, start + free, ids[free:], n))
                ids = ids[:free]
            part.append((doc, start, ids, n))
            free -= len(ids)
        out.append(part)
        total -= size
    return out


def _batch(windows: list[tuple[int, list[Piece]]], is_open: bool, source: int) -> pa.RecordBatch:
    rows = []
    for number, window in windows:
        offset = 0
        for doc, start, ids, n in window:
            rows.append((doc, start, len(ids), n, ids.tobytes(), number, offset, is_open, source))
            offset += len(ids)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in PIECE.split(", ")])


def _batches(windows: list[list[Piece]], first: int, is_open: bool, source: int) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(windows), 512):
        yield _batch([(first + i + k, w) for k, w in enumerate(windows[i:i + 512])], is_open, source)


def _pack_rows(tokenizer_json: str, ranks: str | None, pattern: str | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, source = encoder(tokenizer_json, ranks, pattern), Packer(size), TaskContext.get().partitionId()
        give_back()         # what earlier tasks of this worker have left
        number, out = source << 32, []
        end = np.array([END_ID], "<u4")
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                out += packer.add(doc, np.concatenate((encode(text.as_py()), end)))
                if len(out) >= 512:
                    yield from _batches(out, number, False, source)
                    number, out = number + len(out), []
        yield from _batches(out, number, False, source)
        yield from _batches(packer.rest(), number + len(out), True, source)
        give_back()
    return run


def _merge_rows(level: int, last: bool, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces come sorted by group, then window and offset."""
        def close(source: int, windows: dict[int, list[Piece]]) -> Iterator[pa.RecordBatch]:
            full, left = merged(list(windows.values()), size)
            if last:
                full, left = full + powers(left), []
            first = (level << 56) + (source << 32)
            yield from _batches(full, first, False, source)
            if left:
                yield from _batches([left], first + len(full), True, source)

        source, windows = None, {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["source"] != source:
                    if windows:
                        yield from close(source, windows)
                    source, windows = r["source"], {}
                windows.setdefault(r["sequence_id"], []).append((r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        if windows:
            yield from close(source, windows)
    return run


def pack(docs: DataFrame, tokenizer_json: str, ranks: str | None = None, pattern: str | None = None, size: int = WINDOW,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), sequence_id, offset.

    A document is its ids and the closing id; a null text is empty, so its document is that one id. Each row is a
    document of its own, whatever its id. Sequences hold at most ``size`` tokens (a power of two), and offsets in
    them have no gap. An empty table gives no row; other columns are ignored. The tokenizer's files must be at the
    given paths on the executors.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        made = staged(rows.mapInArrow(_pack_rows(tokenizer_json, ranks, pattern, size), PIECE), "packed")
    out, level = made.where("not open"), 0
    left = made.where("open")
    highest = left.agg(F.max("source")).first()[0]
    while highest is not None:
        level, highest = level + 1, highest // FAN
        group = left.withColumn("source", F.floor(F.col("source") / FAN).cast("long"))
        made = staged(group.repartition("source").sortWithinPartitions("source", "sequence_id", "offset")
                      .mapInArrow(_merge_rows(level, highest == 0, size), PIECE), "merged")
        out, left = out.unionByName(made.where("not open")), made.where("open")
        if highest == 0:
            break
    return out.drop("open", "source").withColumnRenamed("doc_id", id_col)
