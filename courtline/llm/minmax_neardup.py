"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle space gives two values, its minimum and its maximum over the document's
set, so half the hash evaluations fill a signature, and both values match with the probability of the
Jaccard similarity. A band is made of the minima and maxima of two permutations; documents that share a
band are candidates, and a link is confirmed on the full shingle sets.

Documents with equal sets are one class from the start. Within a band's bucket all classes are compared
with a centre, the one that shares most buckets with others, which links nearly all of a group of copies.
A bucket is settled once its other classes are in one component. The classes of unsettled buckets form
clusters; in each, those outside the cluster's largest component are held, a block at a time, against all
others through an index of their shingles, which gives exact intersections without forming pairs as rows.
So every pair of classes that share a band is linked, connected through others or refuted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD, attach, row_hash, ship, staged
from .graph import components
from .rolling import mixed, shingle_set

BANDS = 32                 # of 2 permutations, 4 values: a pair of similarity 0.8 is missed once in 10^7
GROUP_ROWS = 500           # members that are confirmed against one centre together
BLOCK_ROWS = 1_000         # classes of a cluster that are indexed together
PART_ROWS = 5_000          # classes that are held against such a block in one task
_SEEDS = mixed(np.arange(1, 2 * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]


def bands(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band: of the minima and the maxima of its two permutations."""
    low = np.full(2 * BANDS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(2 * BANDS, np.uint64)
    for i in range(0, len(shingles), 4096):
        x = (shingles[None, i:i + 4096] ^ _SEEDS) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    out = np.arange(BANDS, dtype=np.uint64)
    for part in (low[:BANDS], high[:BANDS], low[BANDS:], high[BANDS:]):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return out.view(np.int64)


def _sketch_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, band = [], [], []
            for text in batch.column("body"):
                found = shingle_set(text.as_py(), words)
                n.append(len(found))
                key.append(mixed(found).sum(dtype=np.uint64).view(np.int64))    # equal sets, equal keys
                band.append(bands(found) if len(found) else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, band)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), pa.array(np.array(key, np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *band])))],
                ["doc_id", "row", "n_shingles", "node", "bands"])
    return run


def _confirmed(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted: a centre (``x`` is null), then the members that are tested against it."""
        centre, own = None, None
        for batch in batches:
            a, b = [], []
            for c, x, text in zip(*(batch.column(k).to_pylist() for k in ("c", "x", "body"))):
                if x is None:
                    centre, own = c, shingle_set(text, words)
                    continue
                assert c == centre
                other = shingle_set(text, words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    a.append(c)
                    b.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (c, x) whose sets are similar enough. A centre's members are split into groups of bounded size."""
    groups = pairs.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("groups"))
    members = pairs.join(groups, "c").withColumn("part", F.pmod(F.hash("x"), "groups")).drop("groups") \
        .join(texts, F.col("x") == F.col("node")).select("c", "part", "x", "body")
    centres = groups.join(texts, F.col("c") == F.col("node")) \
        .select("c", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(None).cast("long").alias("x"), "body")
    return members.unionByName(centres).repartition("c", "part").sortWithinPartitions("c", "part", F.col("x").asc_nulls_first()) \
        .mapInArrow(_confirmed(words, percent), "a long, b long")


def _block_links(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (cluster, block, part): the block (``held``), then the classes it is held against."""
        key, block, index = None, [], None
        for batch in batches:
            a, b = [], []
            for *at, held, node, component, text in zip(*(batch.column(k).to_pylist() for k in (
                    "cluster", "block", "part", "held", "node", "component", "body"))):
                if at != key:
                    key, block, index = at, [], None
                own = shingle_set(text, words)
                if held:
                    block.append((node, component, own))
                    continue
                if not block:                           # the hash may leave a block empty
                    continue
                if index is None:
                    tokens = np.concatenate([x[2] for x in block])
                    order = np.argsort(tokens, kind="stable")
                    owner = np.repeat(np.arange(len(block)), [len(x[2]) for x in block])[order]
                    index = (tokens[order], owner, np.array([len(x[2]) for x in block]), np.array([x[1] for x in block]), [x[0] for x in block])
                tokens, owner, sizes, components_, nodes = index
                first, last = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                runs = last - first
                found = np.repeat(first - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
                both = np.bincount(owner[found], minlength=len(nodes))
                near = (100 * both >= percent * (sizes + len(own) - both)) & (components_ != component)
                for i in np.flatnonzero(near):
                    a.append(nodes[i])
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _links(spots: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) after confirming enough links to connect whatever is connected among the classes that share
    buckets. ``spots``: bucket, node, n_shingles, popular (what the node's buckets hold together)."""
    centre = F.max_by(F.struct("node", "n_shingles"), F.struct("popular", "node"))
    chosen = staged(spots.groupBy("bucket").agg(centre.alias("centre"), F.count(F.lit(1)).alias("n")), "centres")
    met = staged(attach(spots, chosen, ["bucket"], "n").where(F.col("node") != F.col("centre.node")), "met")
    small, large = F.least("n_shingles", "centre.n_shingles"), F.greatest("n_shingles", "centre.n_shingles")
    pairs = met.where(100 * small >= percent * large) \
        .groupBy(F.least("node", "centre.node").alias("lo"), F.greatest("node", "centre.node").alias("hi")) \
        .agg(F.max("centre.node").alias("c"))                       # each pair once, whichever is the centre
    pairs = pairs.select("c", F.when(F.col("c") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("x"))
    links = staged(_confirm(staged(pairs, "pairs"), texts, words, percent), "links")
    together = staged(components(links), "components")
    # the centre has met its whole bucket; the rest is settled if it is in one component
    rest = met.select("bucket", "node").join(together, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rest = staged(rest, "rest")
    open_ = staged(rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("node").alias("first"),
                                              F.count(F.lit(1)).alias("n")).where("lo <> hi").select("bucket", "first", "n"), "unsettled")
    if open_.isEmpty():
        return together
    rest = staged(attach(rest, open_, ["bucket"], "n").select("node", "component", "first").distinct(), "open")
    clusters = components(rest.select(F.col("node").alias("a"), F.col("first").alias("b"))).withColumnRenamed("component", "cluster")
    nodes = staged(rest.select("node", "component").distinct().join(clusters, "node"), "clusters")
    groups = nodes.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"))
    sizes = staged(groups.groupBy("cluster").agg(F.max_by("component", F.struct("k", "component")).alias("largest"), F.sum("k").alias("n"),
                                                 (F.sum("k") - F.max("k")).alias("out")), "cluster-sizes")
    zero = F.lit(0).cast("long")
    nodes = attach(nodes, sizes, ["cluster"], "n") \
        .withColumns({"blocks": F.ceil(F.col("out") / BLOCK_ROWS), "parts": F.ceil(F.col("n") / PART_ROWS)})
    every = nodes.select("cluster", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("block"),
                         F.pmod(F.xxhash64("node"), "parts").alias("part"), F.lit(False).alias("held"), "node", "component")
    held = nodes.where("component <> largest").select(
        "cluster", F.pmod(F.xxhash64("node", F.lit(1)), "blocks").alias("block"),
        F.explode(F.sequence(zero, F.col("parts") - 1)).alias("part"), F.lit(True).alias("held"), "node", "component")
    more = every.unionByName(held).join(texts, "node").repartition("cluster", "block", "part") \
        .sortWithinPartitions("cluster", "block", "part", F.col("held").desc()).mapInArrow(_block_links(words, percent), "a long, b long")
    return staged(components(links.unionByName(staged(more, "more-links"))), "components")


def _components(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches of the rows (doc_id, row, n_shingles, node: class of equal sets), classes (node, first_id, copies,
    component: a node) and components (component, component_id, n: classes)."""
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body"), row_hash(id_col, text_col).alias("row"))
    sketch = staged(base.mapInArrow(_sketch_rows(words), "doc_id long, row long, n_shingles long, node long, bands array<long>"), "sketch")
    some = sketch.where("n_shingles > 0")
    classes = staged(some.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "classes")
    rows = attach(some, classes.withColumnRenamed("row", "own"), ["node"], "copies")
    reps = staged(rows.where("row = own").select("node", "row", "n_shingles", "bands").dropDuplicates(["node"]), "class-bands")
    spots = reps.select("node", "n_shingles", F.posexplode("bands")).select("node", "n_shingles", F.xxhash64("pos", "col").alias("bucket"))
    shared = staged(spots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    spots = staged(attach(spots, shared, ["bucket"], "n"), "spots")
    popular = spots.groupBy("node").agg(F.sum("n").alias("popular"))
    spots = staged(spots.drop("n").join(popular, "node"), "spots")
    wanted = spots.select("node").distinct().join(reps.select("node", "row"), "node")
    texts = staged(base.select("row", "body").join(wanted, "row").dropDuplicates(["row"]).select("node", "body"), "texts")
    together = _links(spots, texts, words, percent)
    nodes = staged(classes.select("node", "first_id", "copies").join(together, "node", "left")
                   .withColumn("component", F.coalesce("component", "node")), "nodes")
    firsts = staged(nodes.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "firsts")
    return sketch.drop("bands"), nodes, firsts


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id that links reach, its own included), kept (it is that id).

    Linked are documents with ``100 * intersection >= percent * union`` of their sets of distinct ``words``-word
    shingles (words: runs without ASCII white space, A-Z lower-cased; fewer words are one shingle). Null texts and
    texts without words have 0 shingles and no link. Rows that share an id are documents of their own. A null id is
    never the smallest: its row may link others, its component_id is null only if no id is reached, kept is false.
    An empty table gives no row; other columns are ignored.
    """
    sketch, nodes, firsts = _components(docs, words, percent, id_col, text_col)
    nodes = staged(attach(nodes, firsts, ["component"], "n").select("node", "component_id", "copies"), "named")
    found = attach(sketch.where("n_shingles > 0").select("doc_id", "node", "n_shingles"), nodes, ["node"], "copies") \
        .select("doc_id", "n_shingles", "component_id")
    none = sketch.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(none).select(F.col("doc_id").alias(id_col), "n_shingles", "component_id",
                                          F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id, whole, once (without any id: one of them). Rows without words stay."""
    sketch, nodes, _ = _components(docs, words, percent, id_col, text_col)
    rows = attach(sketch.where("n_shingles > 0"), nodes.select("node", "component", "copies"), ["node"], "copies")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    keepers = rows.groupBy("component").agg(F.min(first).alias("first")).select(F.col("first.row").alias("__keeper"))
    blank = ~F.coalesce(F.col(text_col), F.lit("")).rlike(WORD)
    kept = docs.where(~blank).withColumn("__row", row_hash(id_col, text_col)).join(keepers, F.col("__row") == F.col("__keeper"), "left_semi")
    return kept.dropDuplicates(["__row"]).drop("__row").unionByName(docs.where(blank))


#: The same in DuckDB, for ``words=2`` and ``percent=80``.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links
    UNION SELECT r.u, CASE WHEN l.a = r.v THEN l.b ELSE l.a END FROM reach r JOIN links l ON l.a = r.v OR l.b = r.v),
low AS (SELECT u, min(v) AS v FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(v, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(v, doc_id)) AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.u = doc_id
"""
