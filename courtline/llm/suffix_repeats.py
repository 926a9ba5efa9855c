"""Removal of long repeated passages with the common-prefix interval tree of a sparse suffix array.

Every string of ``min_len`` bytes owns one anchor, the k-gram with the smallest hash inside it, so equal
strings have their anchors at the same place. Suffixes are sorted only at anchors, and only within the
group of equal anchors and of equal bytes on the longer side of them, which Spark shuffles together:

1. anchors of each distinct text, with the run of strings that own them; of equal runs in one batch of a task
   one goes on, as all are known to repeat; anchors that occur once are out;
2. the context of each remaining anchor (the bytes of its run) is sent to the group of its k-gram;
3. in a group the right contexts are sorted (suffix array) with their common-prefix lengths; a stack scan
   yields the intervals of the prefix tree; inside an interval the left contexts are sorted and scanned the
   same way, so that members which extend differently to the left part ways. What comes out are groups of
   occurrences with a common string, maximal on both sides within the context, all occurrences listed;
4. occurrences of ``min_len`` bytes or more are merged per text and cut out.

Texts that occur as a whole more than once are settled by their digest. K-grams that are too frequent for
one task (estimated from a sample, which only decides the route) compare the hashes of their strings
instead, by an aggregation that combines before the shuffle; both routes are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import attach, ship, staged
from .rolling import prefix_sums, span_hashes

MIN_LEN = 200
GRAM = 48
HOT_ROWS = 20_000           # occurrences of a k-gram (7 MB of contexts, 10 s of work) beyond which its strings are compared by hash
SEGMENT = 1 << 20           # bytes of a long text that are scanned at a time
SAMPLE_ROWS = 2_000_000     # anchors (at least 1 in 100) from which frequent k-grams are estimated
_POS = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, min_len: int = MIN_LEN, k: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, position, first and last string start, hash of the run) of each anchor; each string of ``min_len`` bytes
    lies in the run of exactly one anchor: the smallest k-gram hash in it, the leftmost of equals.

    A string reaches further to one side of its k-gram. Its key is the hash of the k-gram and of the bytes on that side
    that all such strings hold, so a run has one or two rows, and what meets under a key has more than half of
    ``min_len`` bytes in common: a line that many texts share but that is shorter than that brings none together."""
    width, strings = min_len - k + 1, len(data) - min_len + 1
    more = (min_len - k) // 2
    out = []
    for start in range(0, strings, SEGMENT):
        part = data[start:start + SEGMENT + min_len - 1]
        sums = prefix_sums(part)
        grams = span_hashes(sums, slice(len(part) - k + 1), slice(k, None))
        n = len(part) - min_len + 1
        keys = np.full(-(-len(grams) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        keys[:len(grams)] = (grams & ~_POS) | np.arange(len(grams), dtype=np.uint64)
        blocks = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & _POS).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], n) - 1
        place = place[first]
        # strings with the longer side to the right of the k-gram, then those with it to the left
        turn = place - more
        for side in (0, 1):
            a, b = (np.maximum(first, turn), last) if side == 0 else (first, np.minimum(last, turn - 1))
            some = a <= b
            a, b, at = a[some], b[some], place[some]
            key = span_hashes(sums, at, at + k + more) if side == 0 else ~span_hashes(sums, at - more - 1, at + k)
            out.append((key.view(np.int64), at + start, a + start, b + start, span_hashes(sums, a, b + min_len)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def prefix_intervals(texts: Sequence[bytes], least: int) -> Iterator[tuple[int, list[int]]]:
    """Interval tree of the sorted ``texts``: (length of the common prefix, all members) of each node with a
    common prefix of ``least`` or more that some member extends differently (or not at all)."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    stack: list[list[int]] = []                         # [common prefix, first place]
    for i in range(1, len(order) + 1):
        depth = _common(texts[order[i - 1]], texts[order[i]]) if i < len(order) else -1
        first = i - 1
        while stack and stack[-1][0] > depth:
            length, first = stack.pop()
            yield length, order[first:i]
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append([depth, first])


def repeat_groups(left: Sequence[bytes], right: Sequence[bytes], min_len: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats around one anchor: (bytes to the left, bytes to the right, all occurrences).

    ``left`` are the reversed bytes before the anchor, ``right`` those from it on. Each interval of the right
    contexts is split by its left extensions; intervals of at least ``min_len`` bytes in all come out."""
    if len(left) == 2:
        r = _common(right[0], right[1])
        if r + min(len(left[0]), len(left[1])) >= min_len and (n := _common(left[0], left[1])) + r >= min_len:
            yield n, r, [0, 1]
        return
    reach = max(map(len, left), default=0)
    for r, members in prefix_intervals(right, max(1, min_len - reach)):
        for n, inner in prefix_intervals([left[i] for i in members], max(0, min_len - r)):
            yield n, r, [members[i] for i in inner]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts of a partition; a text that was there before in the partition adds nothing.

    Of a batch's anchors with equal runs only the first goes on (``alone`` false, ``sent`` true); what the others
    cover is known already (``alone`` and ``sent`` false). So a passage that many documents share sends a few rows."""
    seen = set()
    for batch in batches:
        rows = []
        for d1, d2, text in zip(batch.column("d1").to_pylist(), batch.column("d2").to_pylist(), batch.column("body")):
            if (d1, d2) in seen:
                continue
            seen.add((d1, d2))
            grams, place, first, last, run = anchors(np.frombuffer(text.as_buffer(), np.uint8))
            rows.append((np.full(len(grams), d1), np.full(len(grams), d2, np.int32), grams, place, first, last, run))
        if not rows:
            continue
        d1, d2, grams, place, first, last, run = (np.concatenate(c) for c in zip(*rows))
        back, ahead = (place - first).astype(np.int16), (last - place + MIN_LEN).astype(np.int16)
        order = np.lexsort((ahead, back, run, grams))
        same = np.ones(len(order), bool)
        for c in (grams, run, back, ahead):
            same[1:] &= c[order[1:]] == c[order[:-1]]
        same[:1] = False
        sent, alone = np.empty(len(order), bool), np.empty(len(order), bool)
        sent[order], alone[order] = ~same, ~same & ~np.append(same[1:], False)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (grams, d1, d2, place, back, ahead, sent, alone)],
                                         ["gram", "d1", "d2", "place", "back", "ahead", "sent", "alone"])


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each anchor of a text: from its first string's start to its last string's end."""
    for batch in batches:
        rows = []
        for d1, d2, text, found in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "body", "found"))):
            rows += [(a["gram"], d1, d2, a["place"], a["back"], text[a["place"] - a["back"]:a["place"] + a["ahead"]], a["hot"]) for a in found]
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[i:i + 20_000]), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int16(), pa.binary(), pa.bool_()))],
                ["gram", "d1", "d2", "place", "back", "context", "hot"])


def _covered(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """(text, first byte, end) of what the occurrences of the maximal repeats of one k-gram cover, one row an anchor."""
    rows = list({r[1:4]: r for r in rows}.values())
    if len(rows) < 2:
        return
    alike: dict[tuple[bytes, int], list[tuple]] = {}
    for r in rows:
        alike.setdefault((r[5], r[4]), []).append(r)    # equal contexts are one member of the array
    keys = list(alike)
    reach = [[0, 0] if len(alike[k]) == 1 or len(k[0]) < MIN_LEN else [k[1], len(k[0]) - k[1]] for k in keys]
    if len(keys) > 1:
        for back, ahead, members in repeat_groups([c[:b][::-1] for c, b in keys], [c[b:] for c, b in keys], MIN_LEN):
            for i in members:
                reach[i] = [max(reach[i][0], back), max(reach[i][1], ahead)]
    for key, (back, ahead) in zip(keys, reach):
        if ahead:
            for r in alike[key]:
                yield r[1], r[2], r[3] - back, r[3] + ahead


def _cover_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by k-gram; a group may run over batches."""
    names = ("gram", "d1", "d2", "place", "back", "context")
    group: list[tuple] = []
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if group and group[0][0] != row[0]:
                out += _covered(group)
                group = []
            group.append(row)
        if out:
            yield _spans(out)
    if group and (out := list(_covered(group))):
        yield _spans(out)


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                      ["d1", "d2", "start", "stop"])


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string in the run of an anchor by its digest (the route of too frequent k-grams)."""
    for batch in batches:
        rows = [(hashlib.blake2b(r["context"][i:i + MIN_LEN], digest_size=16).digest(), r["d1"], r["d2"], r["place"] - r["back"] + i)
                for r in batch.to_pylist() for i in range(len(r["context"]) - MIN_LEN + 1)]
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 20_000]), (pa.binary(), pa.int64(), pa.int32(), pa.int64()))],
                                             ["string", "d1", "d2", "start"])


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text without its spans: bytes removed, runs removed, digest of the rest; spans come unordered."""
    for batch in batches:
        out = []
        for d1, d2, text, spans in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "body", "spans"))):
            kept, at, merged = hashlib.sha256(), 0, []
            for s in sorted(spans, key=lambda s: s["start"]):
                if merged and s["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["stop"])
                else:
                    merged.append([s["start"], s["stop"]])
            for start, stop in merged:
                kept.update(text[at:start])
                at = stop
            kept.update(text[at:])
            out.append((d1, d2, sum(b - a for a, b in merged), len(merged), kept.hexdigest(), merged))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
            pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))))],
            ["d1", "d2", "n_removed", "n_spans", "kept_sha256", "removed"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and removed (the cut byte ranges, ascending).

    Cut is every byte in a string of 200 bytes that starts anywhere else too, in the same document or another
    one, overlaps included. Null text is empty; texts under 200 bytes lose nothing; a text that occurs twice as
    a whole, in any rows, is cut whole if it has 200 bytes. Ids are only carried, so null and repeated ids are
    fine. An empty table gives no row; other columns are ignored.
    """
    ship(docs.sparkSession)
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")).alias("rid"),
                       body.alias("body"), F.xxhash64(body).alias("d1"), F.hash(F.lit(7), body).alias("d2"))
    marks = staged(base.select("doc_id", "rid", "d1", "d2", F.octet_length("body").cast("long").alias("n_bytes"),
                               F.sha2("body", 256).alias("whole")), "repeat-marks")
    copies = staged(marks.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"), F.min("rid").alias("rid")), "repeat-copies")
    texts = base.where(F.octet_length("body") >= MIN_LEN).select("rid", "d1", "d2", "body")
    texts = texts.where("rid is not null and d1 is not null and d2 is not null")
    found = staged(texts.mapInArrow(_anchor_rows, "gram long, d1 long, d2 int, place long, back short, ahead short, sent boolean, alone boolean"), "anchors")
    known = found.where("not alone").select("d1", "d2", (F.col("place") - F.col("back")).alias("start"), (F.col("place") + F.col("ahead")).alias("stop"))
    found = found.where("sent").drop("sent", "alone")
    share = max(0.01, min(1.0, SAMPLE_ROWS / max(1, found.count())))
    frequent = found.sample(share, seed=1).groupBy("gram").count().where(F.col("count") >= max(8, hot_rows * share)).select("gram")
    frequent = staged(frequent, "frequent-grams")       # at most 1 row for each max(8 / share, hot_rows) anchors
    cold = found.join(frequent, "gram", "left_anti")
    mine = F.xxhash64("d1", "d2", "place")
    of = W.partitionBy("gram")
    cold = cold.withColumn("lo", F.min(mine).over(of)).withColumn("hi", F.max(mine).over(of)).where("lo <> hi") \
        .select(*found.columns, F.lit(False).alias("hot"))
    every = cold.unionByName(found.join(frequent, "gram", "left_semi").withColumn("hot", F.lit(True)))
    # one row a text; a text stands for its copies by the row with the smallest id
    wanted = every.groupBy("d1", "d2").agg(F.collect_list(F.struct("gram", "place", "back", "ahead", "hot")).alias("found")) \
        .join(copies, ["d1", "d2"]).select("rid", "d1", "d2", "found")
    around = texts.join(wanted, ["rid", "d1", "d2"]).select("d1", "d2", "body", "found") \
        .mapInArrow(_context_rows, "gram long, d1 long, d2 int, place long, back short, context binary, hot boolean")
    if frequent.isEmpty():
        hot_spans = None
    else:
        around = staged(around, "contexts")
        strings = around.where("hot").drop("hot").mapInArrow(_string_rows, "string binary, d1 long, d2 int, start long")
        strings = staged(strings, "strings")
        own = F.xxhash64("d1", "d2", "start")
        many = strings.groupBy("string").agg(F.min(own).alias("lo"), F.max(own).alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi")
        hot_spans = attach(strings, staged(many.select("string", "n"), "repeated-strings"), ["string"], "n") \
            .select("d1", "d2", "start", (F.col("start") + MIN_LEN).alias("stop"))
    spans = around.where("not hot").drop("hot").repartition("gram").sortWithinPartitions("gram") \
        .mapInArrow(_cover_rows, "d1 long, d2 int, start long, stop long")
    spans = spans.unionByName(known)
    if hot_spans is not None:
        spans = spans.unionByName(hot_spans)
    cut = spans.groupBy("d1", "d2").agg(F.collect_list(F.struct("start", "stop")).alias("spans")) \
        .join(copies.where("copies = 1"), ["d1", "d2"]).select("rid", "d1", "d2", "spans")
    # the same exchange of the texts as above serves this join
    cut = texts.join(cut, ["rid", "d1", "d2"]).select("d1", "d2", "body", "spans") \
        .mapInArrow(_cut_rows, "d1 long, d2 int, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>")
    rows = attach(marks, copies.drop("rid"), ["d1", "d2"], "copies")
    zero = F.lit(0).cast("long")
    gone = rows.where(F.col("copies") > 1)
    long = F.col("n_bytes") >= MIN_LEN
    gone = gone.select(F.col("doc_id").alias(id_col), "n_bytes", F.when(long, F.col("n_bytes")).otherwise(zero).alias("n_removed"),
                       F.when(long, F.lit(1)).otherwise(0).cast("long").alias("n_spans"),
                       F.when(long, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("whole")).alias("kept_sha256"),
                       F.when(long, F.array(F.array(zero, F.col("n_bytes")))).otherwise(F.array().cast("array<array<long>>")).alias("removed"))
    rest = rows.where(F.col("copies") == 1).join(cut, ["d1", "d2"], "left").select(
        F.col("doc_id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), F.coalesce("removed", F.array().cast("array<array<long>>")).alias("removed"))
    return gone.unionByName(rest)
