"""Merkle dataset manifest as a postorder append log.

The leaves of a dataset (one tree a dataset) are numbered in their order. A builder takes an aligned run of leaves
and appends each node to its log at the moment it is complete: leaf 0, leaf 1, their parent, leaf 2, ... So the log is
a postorder of the tree, and the place of a node follows from the sizes of the subtrees that were complete before it:
the subtrees within the first e leaves have 2e - popcount(e) nodes, which makes the place of the node of height h whose
last leaf is e equal to 2e - popcount(e) + h. Proofs are cut from the log by these places alone; nothing is searched.

Builders are aligned, so the roots of their runs are the leaves of the next tier, of a thousandth of the size, until
one node is left in each dataset; the roots of the datasets are the leaves of a last tree. A proof goes the other way:
each tier hands down the siblings above it, so a leaf finds the lower part of its proof in the log of its own run and
the rest in one short row that all leaves of the run share.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import attach, ship, staged

BITS = 10                           # a builder takes 2 ** BITS leaves
#: An entry of a path: which side the sibling is on (b"N" for none, where a last node is alone) and its digest.
ENTRY = 65
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: bytes) -> bytes:
    return sha256(parts).hexdigest().encode()


# ---- one log ----------------------------------------------------------------------------------


def place(height: int, last: int) -> int:
    """Place in the log of the node of this height whose last leaf is ``last``."""
    return 2 * last - last.bit_count() + height


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    return (leaves - 1).bit_length()


def append_log(leaves: Sequence[bytes], height: int) -> list[bytes]:
    """Digests of the tree of this height over the leaves, in the order in which they are complete. A node of an
    uneven last pair is hashed alone."""
    log: list[bytes] = []
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        ended = i == len(leaves) - 1
        for h in range(1, height + 1):
            first = (i >> h) << h
            if not ended and i != first + (1 << h) - 1:
                break
            middle = first + (1 << (h - 1)) - 1         # last leaf of the left child
            left = log[place(h - 1, middle)] if middle < i else b""
            log.append(digest(left + log[-1]))
    return log


def siblings(i: int, leaves: int, height: int) -> Iterator[tuple[bytes, int]]:
    """From leaf ``i`` up: the side of the sibling and its place in the log, or no side."""
    for h in range(height):
        at = (i >> h) ^ 1
        if at << h >= leaves:
            yield b"N", -1
        else:
            yield (b"L" if at < i >> h else b"R"), place(h, min(leaves, (at + 1) << h) - 1)


def path(log: Sequence[bytes], i: int, leaves: int, height: int) -> bytes:
    """The proof of leaf ``i`` within this log, an ENTRY a level."""
    return b"".join(side + (log[at] if at >= 0 else b"-" * 64) for side, at in siblings(i, leaves, height))


def entries(steps: bytes) -> Iterator[tuple[bytes, bytes]]:
    for at in range(0, len(steps), ENTRY):
        yield steps[at:at + 1], steps[at + 1:at + ENTRY]


def fold(node: bytes, steps: bytes) -> bytes:
    """The root that a node leads to by a proof."""
    for side, other in entries(steps):
        node = digest(other + node if side == b"L" else node + other if side == b"R" else node)
    return node


def proof_digest(steps: bytes) -> bytes:
    return digest(b"".join(other for side, other in entries(steps) if side != b"N"))


# ---- tiers ------------------------------------------------------------------------------------

LOG = "tree string, block long, n long, leaves long, height int, log binary, root binary"
_LOG = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("leaves", pa.int64()), ("height", pa.int32()),
                  ("log", pa.binary()), ("root", pa.binary())])


def _builder(bits: int):
    """Appends the nodes of one aligned run (tree, block): its leaves come with ``pos`` and ``leaf``; ``size`` is the
    number of leaves that the tree has in this tier, ``leaves`` in the first."""
    def build(run: pa.Table) -> pa.Table:
        run = run.sort_by("pos")
        tree, block, size, leaves = (run.column(c)[0].as_py() for c in ("tree", "block", "size", "leaves"))
        height = min(bits, height_of(size))
        log = append_log([x.as_py() for x in run.column("leaf")], height)
        return pa.Table.from_pylist([{"tree": tree, "block": block, "n": run.num_rows, "leaves": leaves, "height": height,
                                      "log": b"".join(log), "root": log[-1]}], _LOG)
    return build


def _tier(nodes: DataFrame, bits: int) -> DataFrame:
    """The logs of one tier's aligned runs. ``nodes``: tree, pos, leaf (64 hex digits as binary), size, leaves."""
    runs = nodes.select("tree", F.shiftright("pos", bits).alias("block"), "pos", "leaf", "size", "leaves")
    return runs.groupBy("tree", "block").applyInArrow(_builder(bits), LOG)


def _digests(log: bytes) -> list[bytes]:
    return [log[at:at + 64] for at in range(0, len(log), 64)]


def whole_log(tiers: list[DataFrame], bits: int = BITS) -> DataFrame:
    """Every node of each tree with its place in the tree's log: tree, place, digest. The places are gapless from 0."""
    def nodes(below: int):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for run in batch.to_pylist():
                    log, places = _digests(run["log"]), []
                    for i in range(run["n"]):
                        last = min(run["leaves"], ((run["block"] << bits) + i + 1) << below) - 1
                        for h in range(run["height"] + 1):
                            if h and i < run["n"] - 1 and (i + 1) % (1 << h):
                                break
                            places.append(place(below + h, last) if h or not below else -1)
                    kept = [(at, x.decode()) for at, x in zip(places, log) if at >= 0]      # the leaves of an upper tier are below it
                    yield pa.RecordBatch.from_arrays([pa.array([run["tree"]] * len(kept), pa.string()), pa.array([at for at, _ in kept], pa.int64()),
                                                      pa.array([x for _, x in kept], pa.string())], ["tree", "place", "digest"])
        return of

    parts = [t.mapInArrow(nodes(bits * i), "tree string, place long, digest string") for i, t in enumerate(tiers)]
    return reduce(DataFrame.unionByName, parts)


PATHS = "tree string, pos long, steps binary, top binary"
_PATHS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("steps", pa.binary()), ("top", pa.binary())])


def _paths(logs: DataFrame, given: DataFrame, bits: int) -> DataFrame:
    """For each leaf of a run its path to the root: the part within the run's log, then what the run was ``given``
    (tree, pos = block, steps, top)."""
    def handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.to_pylist():
                log = _digests(run["log"])
                rows = [{"tree": run["tree"], "pos": (run["block"] << bits) + i, "top": run["top"],
                         "steps": path(log, i, run["n"], run["height"]) + run["steps"]} for i in range(run["n"])]
                yield from pa.Table.from_pylist(rows, _PATHS).to_batches()

    given = given.select("tree", F.col("pos").alias("block"), "steps", "top")
    return logs.drop("root").join(given, ["tree", "block"]).mapInArrow(handed_down, PATHS)


# ---- numbering --------------------------------------------------------------------------------


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (gapless from 0 in each tree by ``order``) and ``size`` of the tree: one range exchange,
    which cuts a large tree by its order, then running sums over one row for each tree and range partition."""
    low = (1 << 33) - 1
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = staged(ranged.withColumn("__part", F.spark_partition_id())
                    .withColumn("__row", F.monotonically_increasing_id().bitwiseAND(F.lit(low))), "merkle-leaves")
    runs = placed.groupBy(tree, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    of_tree = W.partitionBy(tree)
    before = of_tree.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")) - F.col("__first")) \
        .withColumn("size", F.sum("__n").over(of_tree)).drop("__first")
    joined = attach(placed, staged(runs, "merkle-runs"), [tree, "__part"], "__n")
    return joined.withColumn("pos", F.col("__row") + F.col("__offset")).drop("__part", "__row", "__offset", "__n")


# ---- manifest ---------------------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(_field(v) for v in values)).cast("binary"), 256)


def _trees(leaves: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The logs of all tiers over numbered leaves, and the root of each tree."""
    tiers = [staged(_tier(leaves.withColumn("leaves", F.col("size")), bits), "merkle-log")]
    many = leaves.agg(F.max("size")).first()[0] or 0
    while many > 1 << bits:
        many = -(-many >> bits)
        size = F.ceil(F.col("leaves") / F.lit(1 << (bits * len(tiers)))).alias("size")
        nodes = tiers[-1].select("tree", F.col("block").alias("pos"), F.col("root").alias("leaf"), size, "leaves")
        tiers.append(staged(_tier(nodes, bits), "merkle-log"))
    top = tiers[-1].select("tree", F.col("root").alias("leaf"))
    return tiers, top


def manifest(docs: DataFrame, bits: int = BITS, fields: Sequence[str] = FIELDS, tree_col: str = "lang", id_col: str = "doc_id",
             count_col: str = "n_chars") -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """The numbered leaves of ``docs``, the logs of the trees (one for each value of ``tree_col``) by tier, and those
    of the tree over their roots.

    A log row is an aligned run of 2 ** ``bits`` nodes of the tier below: their digests and those of the nodes built
    over them in the order of completion (``log``, 64 hex digits each), and the run's root. ``whole_log`` gives the
    nodes their places in the log of the whole tree."""
    ship(docs.sparkSession)
    values = [F.col(c) for c in fields]
    key = F.col(id_col).cast("string")
    hit = F.coalesce(F.crc32(key.cast("binary")) % 7 == 0, F.lit(False))
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == count_col else F.col(c) for c in fields]
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       # null first, then by UTF-8 bytes
                       F.when(F.col(tree_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col(tree_col).cast("string"))).alias("tree"),
                       leaf_digest(values).alias("leaf"), F.when(hit, leaf_digest(changed)).alias("tampered"))
    leaves = numbered(staged(rows, "merkle-digests"), "tree", ["id", "leaf"])
    leaves = staged(leaves.select("id", "tree", "pos", "size", F.col("leaf").cast("binary").alias("leaf"), F.col("tampered").cast("binary").alias("tampered")),
                    "merkle-numbered")
    tiers, tops = _trees(leaves, bits)
    # the tree over the trees: one row a dataset
    roots = numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "leaf"), "tree", ["of"])
    roots = staged(roots, "merkle-roots")
    upper, _ = _trees(roots, bits)
    return leaves, tiers, [*upper, roots]


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_RESULT = pa.schema([(x.split()[0], {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[x.split()[1]]) for x in RESULT.split(", ")])


def _proofs(leaves: pa.Table, run: pa.Table) -> pa.Table:
    """Proof of each document of a run, checked with the leaf as it is now."""
    out = []
    given = run.to_pylist()[0]
    log = _digests(given["log"])
    for row in leaves.to_pylist():
        i = row["pos"] - (given["block"] << given["bits"])
        steps = path(log, i, given["n"], given["height"]) + given["steps"]
        folded = fold(row["tampered"] or row["leaf"], steps)
        out.append({"doc_id": row["id"], "leaf": row["leaf"].decode(), "subroot": given["subroot"].decode(), "root": given["top"].decode(),
                    "proof_sha256": proof_digest(steps).decode(), "folded_root": folded.decode(), "verified": folded == given["top"]})
    return pa.Table.from_pylist(out, _RESULT)


def verified_manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Every document with its leaf, its language's subroot, the root, the digest of its proof, and the root that the
    proof leads to from the document as it may have been tampered with: doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    A null language is a tree of its own, before all others; a null field counts as ``-``; null ids come first in
    their tree and are never tampered with. Rows that share an id are leaves of their own, in the order of their
    digests; equal rows have equal leaves and a proof each. An empty table gives no row; other columns are ignored.
    """
    leaves, tiers, over = manifest(docs, bits)
    *upper, roots = over
    # down through the tree of trees, then through each tree: the top has nothing above it
    above = upper[-1].select("tree", F.col("block").alias("pos"), F.lit(b"").alias("steps"), F.col("root").alias("top"))
    for logs in reversed(upper):
        above = staged(_paths(logs, above, bits), "merkle-paths")
    subroots = roots.select("pos", F.col("of").alias("tree"), F.col("leaf").alias("subroot"))
    above = above.select("pos", "steps", "top").join(subroots, "pos")
    above = staged(above.select("tree", F.lit(0).cast("long").alias("pos"), "steps", "top", "subroot"), "merkle-paths")
    subroots = above.select("tree", "subroot")
    above = above.drop("subroot")
    for logs in reversed(tiers[1:]):
        above = staged(_paths(logs, above, bits), "merkle-paths")
    given = above.select("tree", F.col("pos").alias("block"), "steps", "top")
    runs = tiers[0].drop("root").join(given, ["tree", "block"]).join(subroots, "tree").withColumn("bits", F.lit(bits))
    # columns of their own: both sides come from the numbered leaves
    own = [F.col(c).alias(c) for c in ("id", "pos", "leaf", "tampered", "tree")]
    cells = leaves.select(*own, F.shiftright("pos", bits).alias("block")).groupBy("tree", "block")
    return cells.cogroup(runs.groupBy("tree", "block")).applyInArrow(_proofs, RESULT)


#: crc32 bit by bit: a byte is taken in by an operation of its own value, a bit is shifted out by -1.
ORACLE = """
WITH RECURSIVE
c AS MATERIALIZED (
  SELECT *, doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END),
      4294967295::BIGINT) % 7 = 0 AS hit
  FROM documents),
f AS (
  SELECT doc_id, lang, hit, n_chars IS NULL AS no_count,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS count,
    coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') AS count_now,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS body
  FROM c),
l AS (
  SELECT doc_id, lang, sha256(head || count || body) AS leaf,
    sha256(head || CASE WHEN hit THEN count_now ELSE count END || body) AS leaf_now
  FROM f),
d AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM l),
nodes AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM d
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
trees AS MATERIALIZED (
  SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, h FROM trees
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
walk AS (
  SELECT lang, pos AS leaf_pos, 0 AS lvl, pos, n, leaf_now AS h, '' AS proof FROM d
  UNION ALL
  SELECT w.lang, w.leaf_pos, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || s.h END), w.proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.pos = w.pos + 1 - 2 * (w.pos % 2)
  WHERE w.n > 1),
over_trees AS (
  SELECT w.lang, w.leaf_pos, 0 AS lvl, t.pos, t.n, w.h, w.proof FROM walk w JOIN trees t ON t.lang IS NOT DISTINCT FROM w.lang WHERE w.n = 1
  UNION ALL
  SELECT w.lang, w.leaf_pos, w.lvl + 1, w.pos // 2, (w.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || s.h END), w.proof || coalesce(s.h, '')
  FROM over_trees w LEFT JOIN tops s ON s.lvl = w.lvl AND s.pos = w.pos + 1 - 2 * (w.pos % 2)
  WHERE w.n > 1)
SELECT d.doc_id, d.leaf, t.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
FROM d JOIN trees t ON t.lang IS NOT DISTINCT FROM d.lang
JOIN over_trees o ON o.lang IS NOT DISTINCT FROM d.lang AND o.leaf_pos = d.pos AND o.n = 1
JOIN tops r ON r.n = 1
"""
