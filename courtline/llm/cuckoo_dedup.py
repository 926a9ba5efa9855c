"""Exact deduplication with a cuckoo-filter index of live digests.

Each task keeps a cuckoo filter (two candidate buckets of four slots, 16-bit fingerprints) over the
digests that are live in its partition. A fingerprint hit is verified against the full digest stored in
the bucket; an overflow doubles the table and re-inserts the stored keys. The index runs twice: over the
input partitions, where it folds repeated digests before the shuffle (a group of copies of any size
becomes one row per task), and over the partitions of the digest, where the partial groups meet.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import attach, lower_ascii, ship, staged

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Live digests of one partition. ``put`` inserts or merges, ``remove`` deletes, ``get`` verifies."""

    def __init__(self, buckets: int = 256):
        self.keys: list[bytes | None] = []     # stored content, by record number
        self.values: list[list[int]] = []
        self.free: list[int] = []
        self.resizes = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.fps = array("H", bytes(2 * SLOTS * buckets))
        self.recs = array("q", bytes(8 * SLOTS * buckets))

    @staticmethod
    def _fp(key: bytes) -> int:
        return int.from_bytes(key[:2], "little") or 1

    def _home(self, key: bytes) -> int:
        return int.from_bytes(key[2:10], "little") & self.mask

    def _other(self, bucket: int, fp: int) -> int:
        return (bucket ^ (fp * 0x5BD1E995)) & self.mask

    def _find(self, key: bytes) -> int:
        """Slot that holds ``key`` or -1: fingerprints first, then the stored digest."""
        fp, a = self._fp(key), self._home(key)
        for bucket in (a, self._other(a, fp)):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.fps[slot] == fp and self.keys[self.recs[slot]] == key:
                    return slot
        return -1

    def get(self, key: bytes) -> list[int] | None:
        slot = self._find(key)
        return None if slot < 0 else self.values[self.recs[slot]]

    def put(self, key: bytes, doc: int | None, n: int) -> None:
        """Add ``n`` rows of which ``doc`` has the largest id (a null id loses against any other)."""
        slot = self._find(key)
        if slot >= 0:
            live = self.values[self.recs[slot]]
            live[1] += n
            if doc is not None and (live[0] is None or doc > live[0]):
                live[0] = doc
            return
        if self.free:
            rec = self.free.pop()
            self.keys[rec], self.values[rec] = key, [doc, n]
        else:
            rec = len(self.keys)
            self.keys.append(key)
            self.values.append([doc, n])
        if not self._place(rec):
            self._grow()

    def remove(self, key: bytes) -> bool:
        """Delete a live digest; False if it isn't in the index."""
        slot = self._find(key)
        if slot < 0:
            return False
        rec = self.recs[slot]
        self.fps[slot] = 0
        self.keys[rec], self.values[rec] = None, [None, 0]
        self.free.append(rec)
        return True

    def _place(self, rec: int) -> bool:
        fp, bucket = self._fp(self.keys[rec]), self._home(self.keys[rec])
        for kick in range(MAX_KICKS):
            for b in (bucket, self._other(bucket, fp)):
                for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                    if not self.fps[slot]:
                        self.fps[slot], self.recs[slot] = fp, rec
                        return True
            bucket = self._other(bucket, fp)
            slot = bucket * SLOTS + kick % SLOTS
            self.fps[slot], fp = fp, self.fps[slot]
            self.recs[slot], rec = rec, self.recs[slot]
        return False

    def _grow(self) -> None:
        """Overflow: double the table until every stored key has a slot."""
        size = self.mask + 1
        while True:
            size *= 2
            self.resizes += 1
            self._clear(size)
            if all(self._place(rec) for rec, key in enumerate(self.keys) if key is not None):
                return

    def rows(self) -> Iterator[tuple[bytes, int | None, int]]:
        return ((k, v[0], v[1]) for k, v in zip(self.keys, self.values) if k is not None)


FOLDED = "digest binary, keep_id long, group_size long"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per live digest of the partition. A group_size below zero takes the digest down."""
    index, down = CuckooIndex(), []
    for batch in batches:
        for key, doc, n in zip(*(batch.column(c).to_pylist() for c in ("digest", "keep_id", "group_size"))):
            if n < 0:
                down.append(key)
            else:
                index.put(key, doc, n)
    for key in down:
        index.remove(key)
    rows = list(index.rows())
    for i in range(0, len(rows), 20_000):
        part = rows[i:i + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part], pa.binary()), pa.array([r[1] for r in part], pa.int64()),
             pa.array([r[2] for r in part], pa.int64())], ["digest", "keep_id", "group_size"])


def _digest(text_col: str):
    return F.unhex(F.sha2(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256))


def _live(marks: DataFrame, takedown: DataFrame | None = None) -> DataFrame:
    """Index of the live digests (digest, keep_id, group_size) of marks (doc_id, digest)."""
    ship(marks.sparkSession)
    folded = marks.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")).mapInArrow(_fold, FOLDED)
    if takedown is not None:
        folded = folded.unionByName(takedown.where("text_sha256 is not null").select(
            F.unhex("text_sha256").alias("digest"), F.lit(None).cast("long").alias("keep_id"), F.lit(-1).cast("long").alias("group_size")))
    return staged(folded.repartition("digest").mapInArrow(_fold, FOLDED), "live")


def exact_dedup(docs: DataFrame, takedown: DataFrame | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the largest id stays. ``takedown``
    (column ``text_sha256``) deletes digests from the live index: their documents get a null keep_id, size 0
    and kept false. Null and empty texts are equal. Rows that repeat an id count separately; those with the
    kept id are all kept. A null id is smaller than any other; a group of null ids only has a null keep_id
    and keeps none. An empty table gives no row; other columns are ignored.
    """
    marks = staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(text_col).alias("digest")), "digests")
    live = _live(marks, takedown)
    return attach(marks, live, ["digest"], "group_size", "left" if takedown is not None else "inner").select(
        F.col("doc_id").alias(id_col), "keep_id",
        F.coalesce("group_size", F.lit(0).cast("long")).alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of equal texts the row with the largest id, whole, once; a group without ids keeps one too."""
    live = _live(docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(text_col).alias("digest")))
    keepers = live.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__id"))
    rows = docs.withColumn("__d", _digest(text_col))
    rows = rows.join(keepers, (F.col("__d") == F.col("__digest")) & F.col(id_col).cast("long").eqNullSafe(F.col("__id")), "left_semi")
    return rows.dropDuplicates(["__d"]).drop("__d")


ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
