"""Sharding by histogram sort: exact byte counts below candidate key boundaries, refined round by round
until every splitter meets the tolerance, then one range exchange of the narrow keys.

The sort key is (hash of the text, doc_id), so equal texts are neighbours and are only split where a
splitter has to cut their group. A round counts bytes for 2^PROBE_BITS sub-ranges of each unresolved
splitter's range; only rows inside those ranges take part, so the rounds after the first are tiny. What
the driver sees is (splitters x 2^PROBE_BITS) sums, whatever the input. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import staged

PROBE_BITS = 12
TOLERANCE = 0.001          # of a shard's ideal size


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")).alias("k"))


def _counts(rows: DataFrame, group: Column, probe: Column) -> dict[int, list[tuple[int, int]]]:
    """Exact bytes in each sub-range, by range: at most (ranges x probes) rows."""
    out: dict[int, list[tuple[int, int]]] = {}
    for g, p, n in rows.select(group.alias("g"), probe.alias("p"), "size").where("g is not null") \
            .groupBy("g", "p").agg(F.sum("size").alias("n")).collect():
        out.setdefault(g, []).append((p, n))
    return {g: sorted(v) for g, v in out.items()}


def _locate(sums: list[tuple[int, int]], below: int, target: float) -> tuple[int, int, int]:
    """(probe range that holds the target, bytes below it, its bytes)."""
    for p, n in sums[:-1]:
        if below + n > target:
            return p, below, n
        below += n
    return *((sums[-1][0], below, sums[-1][1])),


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE, bits: int = PROBE_BITS) -> list[tuple[int, int]]:
    """``shards - 1`` boundaries (hash, id): a row is below a boundary if its (h, k) is smaller.

    A boundary whose bytes below are within the tolerance is final; a range that holds one key only can't be
    cut further, there the nearer end is taken."""
    lowest, highest = -(1 << 63), (1 << 63) - 1
    total, least, most = keys.agg(F.sum("size"), F.min("k"), F.max("k")).first()
    if not total:
        return [(highest, highest)] * (shards - 1)
    slack = tolerance * total / shards
    targets = [total * i / shards for i in range(1, shards)]
    done: dict[int, tuple[int, int]] = {}
    # by hash: the range of a splitter is a prefix of the hash
    open_, depth = {i: (0, 0) for i in range(len(targets))}, 0      # splitter: prefix, bytes below it
    inside: dict[int, tuple[int, int, int, int]] = {}               # splitter: hash, first id, last id, below
    while open_:
        deeper = min(64, depth + bits)
        group = F.shiftright("h", 64 - depth) if depth else F.lit(0).cast("long")
        rows = keys.where(group.isin(*{p for p, _ in open_.values()})) if depth else keys
        sums = _counts(rows, group, F.shiftright("h", 64 - deeper) if deeper < 64 else F.col("h"))
        ahead = {}
        for i, (prefix, below) in open_.items():
            p, under, n = _locate(sums[prefix], below, targets[i])
            first, after = p << (64 - deeper), (p + 1) << (64 - deeper)
            if min(targets[i] - under, under + n - targets[i]) <= slack:
                near = first if targets[i] - under <= under + n - targets[i] else after
                done[i] = (near, lowest) if near <= highest else (highest, highest)
            elif deeper == 64:
                inside[i] = (p, least, most, under)
            else:
                ahead[i] = (p, under)
        open_, depth = ahead, deeper
    # by id inside one hash, i.e. one group of equal texts
    while inside:
        ranges = sorted({v[:3] for v in inside.values()})
        group = reduce(lambda c, r: c.when((F.col("h") == r[1][0]) & F.col("k").between(*r[1][1:]), F.lit(r[0])),
                       enumerate(ranges), F.when(F.lit(False), F.lit(0)))
        step = {r: max(1, -(-(r[2] - r[1] + 1) >> bits)) for r in ranges}
        at = reduce(lambda c, r: c.when(group == r[0], F.floor((F.col("k") - r[1][1]) / step[r[1]])),
                    enumerate(ranges), F.when(F.lit(False), F.lit(0)))
        sums = _counts(keys.where(F.col("h").isin(*{r[0] for r in ranges})), group, at.cast("long"))
        ahead = {}
        for i, (h, lo, hi, below) in inside.items():
            r = (h, lo, hi)
            p, under, n = _locate(sums[ranges.index(r)], below, targets[i])
            first = lo + p * step[r]
            left, right = targets[i] - under, under + n - targets[i]
            if step[r] == 1 or min(left, right) <= slack:
                done[i] = (h, first if left <= right else first + step[r])
            else:
                ahead[i] = (h, first, min(hi, first + step[r] - 1), under)
        inside = ahead
    return [done[i] for i in range(len(targets))]


def shard_of(cuts: list[tuple[int, int]]) -> Column:
    """Shard of a row from its key columns ``h`` and ``k``: the number of boundaries at or below it."""
    above = [F.when((F.col("h") > h) | ((F.col("h") == h) & (F.col("k") >= k)), 1).otherwise(0) for h, k in cuts]
    return reduce(lambda a, b: a + b, above, F.lit(0)).cast("int")


def histogram_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                     tolerance: float = TOLERANCE) -> DataFrame:
    """Every row with its shard and its slot (position in the shard by key, gapless from 0).

    The shards are near equal in bytes (text in UTF-8 plus 8 a row): each splitter is within ``tolerance`` of a
    shard, or as near as whole documents allow. Null text: size 8 and checksum 0. A null id sorts as -1. Rows
    equal in id and text stay together and share out their slots. An empty table gives no row; other columns
    are ignored.
    """
    keys = staged(_keys(docs, id_col, text_col), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    # the one exchange: range partitions of the key; a hot text is cut by its ids
    ranged = keys.withColumn("shard", shard_of(cuts)).repartitionByRange("h", "k") \
        .sortWithinPartitions("h", "k", "size", "text_crc32")
    low = (1 << 33) - 1
    placed = staged(ranged.withColumn("part", F.spark_partition_id())
                    .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(low))), "shard-rows")
    # (range partitions + shards) rows at most: a shard is a run of partitions
    runs = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))
    return placed.join(F.broadcast(runs), ["shard", "part"]).select(
        F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
