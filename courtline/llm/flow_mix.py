"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). The flow network has
one node per pattern and per source: the start feeds each pattern once per allowed repetition, at a cost
that rises with the repetition (convex), a pattern feeds each of its sources, and each source drains its
quota. The cheapest flow therefore repeats text only where a quota can't be met otherwise. Its solution,
the words that each pattern gives to each source, is laid out along the pattern's documents in a seeded
order, so selection is a running sum.

The network has as many nodes as there are sources and observed combinations of them; documents stay in
Spark.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import DataFrame, Window as W, functions as F

from .common import WORD, repeated, row_hash, staged

SHARE = 1.5                # of all sizes
CAP = 2                    # times a source's (and a document's) size
WEIGHTS = (5, 2, 1)        # repeating, sources by code point, null last
SEED = 20
BUCKET_ROWS = 1_000        # rows of a pattern that are put in order together


def targets(sizes: dict[str | None, int], share: float = SHARE, cap: int = CAP, weights=WEIGHTS,
            total: int | None = None) -> dict[str | None, float]:
    """Target of each source: weights share ``share`` of all sizes, no target above ``cap`` times its source,
    the excess reshared by weight. Closed form: sources by cap per weight; those below the water level are full."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    caps = {s: float(cap * sizes[s]) for s in order}
    left, heavy = share * (sum(sizes.values()) if total is None else total), float(sum(w.values()))
    level = math.inf
    for s in sorted(order, key=lambda s: (caps[s] / w[s], order.index(s))):
        level = left / heavy
        if caps[s] / w[s] >= level:
            break
        left, heavy, level = left - caps[s], heavy - w[s], math.inf
    return {s: min(caps[s], w[s] * level) for s in order}


def min_cost_flow(edges: list[tuple[int, int, int, int]], start: int, end: int, nodes: int) -> list[int]:
    """Flow on each (from, to, capacity, cost) edge of the cheapest maximum flow: successive shortest paths."""
    head: list[list[int]] = [[] for _ in range(nodes)]
    to, left, cost = [], [], []
    for a, b, c, w in edges:
        for x, y, cap, price in ((a, b, c, w), (b, a, 0, -w)):
            head[x].append(len(to))
            to.append(y)
            left.append(cap)
            cost.append(price)
    while True:
        dist, via, queue = [math.inf] * nodes, [-1] * nodes, deque([start])
        dist[start], waiting = 0, {start}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in head[x]:
                if left[e] and dist[x] + cost[e] < dist[to[e]]:
                    dist[to[e]], via[to[e]] = dist[x] + cost[e], e
                    if to[e] not in waiting:
                        waiting.add(to[e])
                        queue.append(to[e])
        if via[end] < 0:
            return [left[2 * i + 1] for i in range(len(edges))]
        path, x = [], end
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(left[e] for e in path)
        for e in path:
            left[e] -= push
            left[e ^ 1] += push


def route(patterns: list[tuple[tuple, int]], quotas: dict, cap: int = CAP) -> list[dict]:
    """Words that each pattern (its sources, its size) gives to each source."""
    names = list(quotas)
    node = {s: 1 + len(patterns) + i for i, s in enumerate(names)}
    end = 1 + len(patterns) + len(names)
    edges = [(0, 1 + i, size, times) for i, (_, size) in enumerate(patterns) for times in range(cap)]
    first = len(edges)
    links = [(i, s) for i, (members, _) in enumerate(patterns) for s in members]
    edges += [(1 + i, node[s], cap * patterns[i][1], 0) for i, s in links]
    edges += [(node[s], end, quotas[s], 0) for s in names]
    flow = min_cost_flow(edges, 0, end, end + 1)
    out: list[dict] = [{} for _ in patterns]
    for (i, s), f in zip(links, flow[first:]):
        out[i][s] = f
    return out


def mix(docs: DataFrame, members: str, size: str, id_col: str = "doc_id", share: float = SHARE, cap: int = CAP,
        weights=WEIGHTS, seed: int = SEED) -> DataFrame:
    """``docs`` (id, ``members``: array of sources, ``size``: words) with columns taken (words taken, repeats
    counted), by_source (the same by source) and, for each source of the document, source_size and target.

    A pattern's documents stand in order of md5(id:seed), then id; its allotment runs along them, again from the
    start for a repetition, so at most one document per pattern and repetition is taken in part. The same input and
    seed give the same result. A null source is a source of its own; no members or null members: a document
    nothing is taken from. Size 0: taken 0. Rows that repeat an id share its place in the order. No row in, no row out.
    """
    spark = docs.sparkSession
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array().cast("array<string>")))).alias("members"),
        F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary")).alias("prio")),
        "mix-rows")
    found = [(tuple(r.members), r.size, r.n) for r in
             rows.groupBy("members").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()]
    found.sort(key=lambda p: [(s is None, s or "") for s in p[0]])
    sizes: dict[str | None, int] = {}
    for sources, n, _ in found:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes, share, cap, weights, sum(n for sources, n, _ in found if sources))
    quotas = {s: math.floor(t + 0.5) for s, t in goal.items()}
    flows = route([(p, n) for p, n, _ in found], quotas, cap)
    plan = []
    for (sources, total, n), flow in zip(found, flows):
        at, parts = 0, []
        for s in sources:
            parts.append((s, at, at + flow[s]))
            at += flow[s]
        plan.append((list(sources), total, at, max(1, -(-n // BUCKET_ROWS)), parts, [(s, sizes[s], goal[s]) for s in sources]))
    plan = spark.createDataFrame(plan, "members array<string>, total long, allotted long, buckets long, "
                                       "parts array<struct<source:string,lo:long,hi:long>>, "
                                       "sources array<struct<source:string,size:long,target:double>>")
    slim = F.broadcast(plan.select("members", "buckets"))      # one row per pattern
    place = F.floor(F.conv(F.substring("prio", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(2.0 ** 32)).cast("long")
    rows = rows.join(slim, "members").withColumn("bucket", place).drop("buckets")
    sums = rows.groupBy("members", "bucket").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("members").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("members", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("base"))
    inside = W.partitionBy("members", "bucket").orderBy("prio", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long"))) \
        .join(sums, ["members", "bucket"]).join(F.broadcast(plan), "members")
    at = F.col("base") + F.col("inner")

    def overlap(lo, hi):
        """Words of the document's places, one for each repetition, that lie in [lo, hi) of the pattern's line."""
        return sum((F.greatest(F.lit(0).cast("long"), F.least(hi, at + F.col("size") + F.col("total") * t)
                               - F.greatest(lo, at + F.col("total") * t)) for t in range(cap)), F.lit(0).cast("long"))

    return rows.select(
        F.col("doc_id").alias(id_col), "size", "members", "sources",
        overlap(F.lit(0).cast("long"), F.col("allotted")).alias("taken"),
        F.transform("parts", lambda p: F.struct(p.source.alias("source"), overlap(p.lo, p.hi).alias("words"))).alias("by_source"))


def count_words(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """``mix`` over a table of documents with one source each: doc_id, size, source_size, target, taken."""
    own = docs.select("doc_id", F.array("source").alias("members"), count_words("text").alias("size"))
    return mix(own, "members", "size", **how).select(
        "doc_id", "size", F.col("sources")[0]["size"].alias("source_size"), F.col("sources")[0]["target"].alias("target"), "taken")


def keep_taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows, whole, as often as the mix takes them; of a row that is taken in part half or more counts as once.

    Rows without words are not taken. Rows equal in id and text stand for each other."""
    marks = docs.select(row_hash(id_col, text_col).alias("doc_id"), F.array(source_col).alias("members"), count_words(text_col).alias("size"))
    taken = mix(marks, "members", "size", **how).where("size > 0") \
        .select("doc_id", F.floor(F.col("taken") / F.col("size") + 0.5).cast("long").alias("times"))
    taken = taken.groupBy(F.col("doc_id").alias("__row")).agg(F.sum("times").alias("__times")).where("__times > 0")
    rows = docs.withColumn("__row", row_hash(id_col, text_col)).join(taken, "__row").dropDuplicates(["__row"])
    return repeated(rows, "__times").select(*docs.columns)


ORACLE = rf"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
      [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM d GROUP BY source),
o AS (SELECT *, 2.0::DOUBLE * source_size / w AS ratio, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k FROM s),
r AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                 - coalesce(sum(2 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o),
v AS (SELECT coalesce(min_by(level, k), 'inf'::DOUBLE) AS level FROM r WHERE ratio >= level),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, w * v.level) AS target FROM o, v),
c AS (SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS allot,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR || ':{SEED}'), doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, allot - before)) + greatest(0, least(size, allot - source_size - before)))::BIGINT AS taken FROM c
"""
