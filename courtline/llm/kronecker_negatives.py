"""Hard-negative mining with Kronecker-packed products.

The quantised components of a thousand candidates are biased to be non-negative and laid side by side into fields of
one wide integer, one such integer a component. Multiplying it by the anchor's component and adding up over the
components leaves each candidate's whole inner product in its own field; the fields are wide enough that none runs
over into the next, so the scores that are unpacked are exact.

Anchors are a fixed share of the rows, so neither side is broadcast. Rows are dealt into cells of bounded size,
(block of anchors) x (group of candidates); a cell returns the best few of each anchor, and the best of those are
taken by rank. Nothing is gathered by label: a label that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import ship, staged

SCALE = 256
ANCHORS, CANDIDATES = 4096, 8192            # rows of a cell, at most
COMPONENTS = 1 << 21                        # of the candidates of a cell, on average
PACK = 1024                                 # candidates side by side in one wide integer
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90                          # percent of the positive's score


# ---- wide integers ---------------------------------------------------------------------------


def packed(values: np.ndarray, width: int) -> list[int]:
    """One wide integer for each column of ``values`` (rows x components, not negative), a field of ``width`` bytes a row."""
    fields = np.zeros((values.shape[1], values.shape[0], max(1, width // 8)), f"<u{min(width, 8)}")
    fields[:, :, 0] = values.T
    return [int.from_bytes(column.tobytes(), "little") for column in fields]


class Pack:
    """Candidates side by side. ``scores(anchor)`` are their inner products with it, as int64."""

    def __init__(self, q: np.ndarray):
        self.low = int(q.min(initial=0))
        biased = q - self.low
        self.sums, self.top, self.n = biased.sum(axis=1), int(biased.max(initial=0)), len(q)
        self.biased, self.wide = biased, {}

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        low = int(anchor.min(initial=0))
        factors = (anchor - low).tolist()
        largest = sum(factors) * self.top
        width = 4 if largest < 1 << 32 else 8 if largest < 1 << 63 else 16      # a sum fits its field
        if width not in self.wide:
            self.wide[width] = packed(self.biased, width)
        total = sum(wide * x for wide, x in zip(self.wide[width], factors) if x)
        fields = np.frombuffer(total.to_bytes(self.n * width, "little"), f"<u{min(width, 8)}")
        if width == 16:     # vectors of very different lengths and sizes
            fields = np.array([int(high) << 64 | int(low) for low, high in fields.reshape(-1, 2)], object)
            return (fields + low * self.sums.astype(object) + self.low * int(anchor.sum())).astype(np.int64)
        return fields.astype(np.int64) + low * self.sums + self.low * int(anchor.sum())


# ---- cells ------------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """floor(256 x) of a list column, missing components 0."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype(np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _cell(anchors: pa.Table, rows: pa.Table) -> Iterator[tuple[int, int, np.ndarray, list["_Group"]]]:
    """Each anchor with its label and the candidates, in packs of one label each."""
    if not anchors.num_rows or not rows.num_rows:       # a side without rows has no columns either
        return
    dims = max(pc.max(pc.list_value_length(t.column("vec"))).as_py() or 0 for t in (anchors, rows))
    q, a = _matrix(rows.column("vec"), dims), _matrix(anchors.column("vec"), dims)
    label, ids, row = (rows.column(c).to_numpy() for c in ("label", "id", "row"))
    order = np.argsort(label, kind="stable")
    ends = np.flatnonzero(np.diff(label[order])) + 1
    groups = []
    for of in np.split(order, ends) if len(order) else []:
        for start in range(0, len(of), PACK):
            at = of[start:start + PACK]
            groups.append(_Group(int(label[at[0]]), Pack(q[at]), ids[at], row[at]))
    for i, own in enumerate(anchors.column("label").to_numpy()):
        yield i, int(own), a[i], groups


class _Group:
    def __init__(self, label: int, pack: Pack, ids: np.ndarray, row: np.ndarray):
        self.label, self.pack, self.ids, self.row = label, pack, ids, row


def _best(score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by score (higher first), id, row."""
    if len(score) > 4 * k:
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return near[np.lexsort((row[near], ids[near], -score[near]))][:k]
    return np.lexsort((row, ids, -score))[:k]


POSITIVE = "a_row long, a_id long, p_row long, p_id long, p_score long"
NEGATIVE = POSITIVE + ", n_row long, n_id long, n_score long"
_TYPES = {s: pa.schema([(x.split()[0], pa.int64()) for x in s.split(", ")]) for s in (POSITIVE, NEGATIVE)}


def _table(columns: list[list[np.ndarray]], kind: str) -> pa.Table:
    arrays = [np.concatenate(c) if c else np.array([], np.int64) for c in columns]
    return pa.Table.from_arrays([pa.array(a, pa.int64()) for a in arrays], schema=_TYPES[kind])


def _positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of each anchor the best rows of its label in this cell."""
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    for i, own, a, groups in _cell(anchors, rows):
        a_row, a_id = anchors.column("row")[i].as_py(), anchors.column("id")[i].as_py()
        same = [g for g in groups if g.label == own]
        if not same:
            continue
        score, ids, row = (np.concatenate(x) for x in ([g.pack.scores(a) for g in same], [g.ids for g in same], [g.row for g in same]))
        other = row != a_row
        score, ids, row = score[other], ids[other], row[other]
        at = _best(score, ids, row, POSITIVES)
        for c, x in zip(out, (np.full(len(at), a_row), np.full(len(at), a_id), row[at], ids[at], score[at])):
            c.append(x)
    return _table(out, POSITIVE)


def _negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of each anchor and positive the best rows of other labels in the band, in this cell."""
    out: list[list[np.ndarray]] = [[] for _ in range(8)]
    for i, own, a, groups in _cell(anchors, rows):
        a_row, a_id = anchors.column("row")[i].as_py(), anchors.column("id")[i].as_py()
        positives = [p for p in anchors.column("positives")[i].as_py() if p["p_score"] >= 0]    # below zero the band is empty
        if not positives:
            continue
        least = min(LOW * p["p_score"] for p in positives)
        found = []
        for g in groups:
            if g.label != own:
                score = g.pack.scores(a)
                at = np.flatnonzero(100 * score >= least)
                found.append((score[at], g.ids[at], g.row[at]))
        if not found:
            continue
        score, ids, row = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((row, ids, -score))
        score, ids, row = score[order], ids[order], row[order]
        for p in positives:
            first = np.searchsorted(-100 * score, -HIGH * p["p_score"])
            after = np.searchsorted(-100 * score, -LOW * p["p_score"], side="right")
            at = slice(first, min(after, first + NEGATIVES))
            n = max(0, at.stop - at.start)
            for c, x in zip(out, [*(np.full(n, v) for v in (a_row, a_id, p["p_row"], p["p_id"], p["p_score"])), row[at], ids[at], score[at]]):
                c.append(x)
    return _table(out, NEGATIVE)


# ---- plan -------------------------------------------------------------------------------------


def _taking_part(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that take part, with the changed labels; an own number each."""
    vec, label, key = F.col(vector_col), F.col(label_col).cast("long"), F.col(id_col).cast("long")
    # beyond this a sum of products may not fit a long
    limit = F.sqrt(F.lit(float(1 << 60)) / F.greatest(F.size(vec), F.lit(1))) / (2 * SCALE)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) > limit))
    changed = F.when(F.coalesce(key % 7 == 0, F.lit(False)), (label + 1) % 10).otherwise(label)
    # a null id sorts last
    return rows.where(label.isNotNull() & vec.isNotNull()).where(~bad).select(
        key.alias("real_id"), F.coalesce(key, F.lit((1 << 63) - 1)).alias("id"), changed.alias("label"), vec.alias("vec"),
        F.monotonically_increasing_id().alias("row"))


def _first(rows: DataFrame, by: list[str], kind: str, k: int) -> DataFrame:
    w = W.partitionBy(*by).orderBy(F.desc(f"{kind}_score"), F.asc(f"{kind}_id"), F.asc(f"{kind}_row"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchors_every: int = 100) -> DataFrame:
    """The hard negatives of each anchor (id divisible by ``anchors_every``) and each of its positives: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector, or a null or non-finite component take no part; neither do rows with a
    component so large that a score might not fit a long. A shorter vector counts as filled up with zeros. A null id
    is no anchor, and sorts last among equal scores. Rows that repeat an id are rows of their own: anchors each, and
    each other's positives. An anchor without positives, and a positive without a row in its band, give no row. An
    empty table gives no row; other columns are ignored.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = staged(_taking_part(rows, id_col, vector_col, label_col), "mining-rows")
    anchor = F.coalesce(F.col("real_id") % anchors_every == 0, F.lit(False))
    n, n_anchors, components = rows.agg(F.count(F.lit(1)), F.count_if(anchor), F.sum(F.size("vec").cast("long"))).first()
    blocks, groups = -(-n_anchors // ANCHORS) or 1, max(1, -(-n // CANDIDATES), -(-(components or 0) // COMPONENTS))

    def over(many: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")))

    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("long").alias("block")
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(groups)).cast("long").alias("cell")
    # columns of their own: both sides of the cells come from one table, which cogroup would mix up
    own = [F.col(c).alias(c) for c in ("row", "id", "label", "vec")]
    candidates = rows.select(*own, group).select("*", over(blocks).alias("block"))
    chosen = rows.where(anchor).select("row", "id", "label", "vec", block)

    def cells(chosen: DataFrame):
        return chosen.select("*", over(groups).alias("cell")).groupBy("block", "cell").cogroup(candidates.groupBy("block", "cell"))

    positives = _first(cells(chosen).applyInArrow(_positives, POSITIVE), ["a_row"], "p", POSITIVES)
    positives = positives.groupBy("a_row").agg(F.collect_list(F.struct("p_row", "p_id", "p_score")).alias("positives"))
    positives = staged(positives, "mining-positives")
    known = chosen.join(positives.withColumnRenamed("a_row", "row"), "row")
    found = _first(cells(known).applyInArrow(_negatives, NEGATIVE), ["a_row", "p_row"], "n", NEGATIVES)
    real = [F.when(F.col(c) < (1 << 63) - 1, F.col(c)).alias(name) for c, name in (("p_id", "positive_id"), ("n_id", "negative_id"))]
    return found.select(F.col("a_id").alias("anchor_id"), real[0], F.col("rank").cast("int").alias("rank"), real[1],
                        F.col("p_score").alias("positive_score"), F.col("n_score").alias("negative_score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
