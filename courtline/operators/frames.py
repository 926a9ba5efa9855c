"""Skew-safe building blocks for per-key ordered computations.

* ``chunk_with_halo``: split each key's ordered rows into coarse time chunks (a season by default)
  and copy into every chunk the few rows that precede it, so a bounded frame
  (``rowsBetween(-lookback, 0)``) evaluated per (key, chunk) equals the frame evaluated per key.
  A key that holds a third of all rows is spread over many tasks instead of one.
* ``asof_join``: for each left row, the latest right row of the same key at or before (or strictly
  before) its time. A union + ``last(ignorenulls)`` scan per (key, chunk), plus a carry of the
  previous chunk's last state for left rows that have none in their own chunk. Linear in
  |left| + |right|: no range join, no pairs.
* ``explode_intervals``: turn per-row validity intervals into one row per covered day inside a
  [start, end] range (a generator, not a join).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _season(d: Column) -> Column:
    return F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1)


def season_chunk(day_col: str) -> Column:
    """Season start year of a date (October starts a season): the default chunk of a player's history."""
    return _season(F.col(day_col))


def chunk_with_halo(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                    lookback: int, next_of: str | None = None) -> DataFrame:
    """Assign rows to (key, chunk) groups with a halo of up to ``lookback`` preceding rows.

    Adds ``_chunk`` (group the copy belongs to), ``_own`` (True for the row's own chunk; halo copies
    are False) and, when ``next_of`` is given, ``_next_chunk_first``: the ``next_of`` value of the
    first row of the key's next non-empty chunk (to finish a ``lead`` across chunk borders).

    ``chunk`` must be non-decreasing in ``order`` within a key.
    """
    base = df.withColumn("_src", chunk)
    if lookback <= 0 and next_of is None:
        return base.withColumn("_chunk", F.col("_src")).withColumn("_own", F.lit(True)).drop("_src")
    ws = Window.partitionBy(*keys, "_src").orderBy(*[F.col(c).desc() for c in order])
    base = base.withColumn("_after", F.row_number().over(ws) - 1)

    aggs = [F.count(F.lit(1)).alias("_n")]
    if next_of is not None:
        aggs.append(F.min(next_of).alias("_first"))
    stats = base.groupBy(*keys, "_src").agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy("_src")
    stats = stats.withColumn("_cum", F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, 0)))
    succ = F.collect_list(F.struct(F.col("_src").alias("c"), (F.col("_cum") - F.col("_n")).alias("cb"))) \
        .over(wk.rowsBetween(1, max(lookback, 1)))
    cols = [*keys, "_src", "_cum", succ.alias("_succ")]
    if next_of is not None:
        cols.append(F.lead("_first").over(wk).alias("_next_chunk_first"))
    stats = stats.select(*cols)
    # keep only successor chunks that can need any row of this chunk (its last row has _after = 0)
    stats = stats.withColumn("_succ", F.filter("_succ", lambda s: s["cb"] - F.col("_cum") < lookback))

    j = base.join(stats, [*keys, "_src"])
    needed = F.filter("_succ", lambda s: F.col("_after") + s["cb"] - F.col("_cum") < lookback)
    targets = F.concat(F.array(F.col("_src")), F.transform(needed, lambda s: s["c"]))
    out = (j.withColumn("_chunk", F.explode(targets))
           .withColumn("_own", F.col("_chunk") == F.col("_src"))
           .drop("_succ", "_cum", "_after", "_src"))
    return out


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
              right_cols: Sequence[str], right_order: Sequence[str] = (), strict: bool = True,
              granularity: str | None = None, prefix: str = "") -> DataFrame:
    """Left join each left row to the latest right row of the same ``by`` key whose time is
    strictly before (``strict``) or at/before the left time. Ties on time are broken by
    ``right_order`` (the largest wins). Right columns come back NULL when no right row qualifies.

    With a ``granularity`` ('season', or one that ``date_trunc`` knows: 'week', 'month', 'year', ...) time is
    cut into buckets of it, which ascend with time; the scan then runs per (key, bucket) and a small carry
    table hands over the last state of earlier buckets. Without one, a key is one group.
    """
    left_cols = left.columns
    lk, rk = (0, 1) if strict else (1, 0)
    def bucket(c: Column) -> Column:
        if granularity is None:
            return F.lit(0)
        return _season(c) if granularity == "season" else F.date_trunc(granularity, c)

    r = (right.where(F.col(right_time).isNotNull())
         .select(*[F.col(k) for k in by], F.col(right_time).alias("_t"),
                 F.struct(*[F.col(c) for c in right_order] or [F.lit(0)]).alias("_o"),
                 F.struct(*[F.col(c).alias(prefix + c) for c in right_cols]).alias("_s")))
    r = r.where(F.lit(True) if not by else F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in by)))
    r = r.withColumn("_b", bucket(F.col("_t")))
    s_type = r.schema["_s"].dataType
    o_type = r.schema["_o"].dataType
    l = left.select(*[F.col(k) for k in by], F.col(left_time).alias("_t"),
                    F.struct(*[F.col(c) for c in left_cols]).alias("_l"))
    l = l.withColumn("_b", bucket(F.col("_t")))
    l_type = l.schema["_l"].dataType

    u = (l.select(*by, "_b", "_t", F.lit(lk).alias("_k"), F.lit(None).cast(o_type).alias("_o"),
                  F.lit(None).cast(s_type).alias("_s"), "_l")
         .unionByName(r.select(*by, "_b", "_t", F.lit(rk).alias("_k"), "_o", "_s",
                               F.lit(None).cast(l_type).alias("_l"))))
    w = (Window.partitionBy(*by, "_b").orderBy("_t", "_k", "_o")
         .rowsBetween(Window.unboundedPreceding, -1))
    local = (u.withColumn("_s", F.when(F.col("_k") == lk, F.last("_s", ignorenulls=True).over(w)))
             .where(F.col("_k") == lk).select(*by, "_b", "_s", "_l"))

    # hand-over between buckets: last state of every (key, bucket), as-of on the bucket number
    last_state = r.groupBy(*by, "_b").agg(F.max_by("_s", F.struct("_t", "_o")).alias("_s"))
    wanted = l.select(*by, "_b").distinct()
    cu = (wanted.select(*by, "_b", F.lit(0).alias("_k"), F.lit(None).cast(s_type).alias("_s"))
          .unionByName(last_state.select(*by, "_b", F.lit(1).alias("_k"), "_s")))
    wc = Window.partitionBy(*by).orderBy("_b", "_k").rowsBetween(Window.unboundedPreceding, -1)
    carry = (cu.withColumn("_cs", F.last("_s", ignorenulls=True).over(wc)).where("_k = 0")
             .select(*by, "_b", "_cs"))
    joined = local.join(carry, [*by, "_b"], "left")
    s = F.coalesce(F.col("_s"), F.col("_cs"))
    return joined.select(*[F.col("_l")[c].alias(c) for c in left_cols],
                         *[s[prefix + c].alias(prefix + c) for c in right_cols])


def explode_intervals(df: DataFrame, lo_exclusive: Column, hi_inclusive: Column, start, end,
                      alias: str = "target_date") -> DataFrame:
    """One output row per day t with lo < t <= hi (hi NULL = open ended) and start <= t <= end."""
    s, e = F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end)))
    first = F.greatest(F.date_add(lo_exclusive, 1), s)
    last = F.least(F.coalesce(hi_inclusive, e), e)
    return (df.where(first <= last)
            .withColumn(alias, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY")))))


def active_counts(df: DataFrame, keys: Sequence[str], first: Column, after: Column, alias: str = "day",
                  granularity: Column | None = None) -> DataFrame:
    """Sweep line over the intervals [``first``, ``after``) of each key: a row for each day on which the number of
    intervals that hold it changes, with that number ``n`` (0 where none does) and ``latest``, the last day on which
    any interval of the key has begun so far. Between two rows of a key both stay as they are, so at most two rows an
    interval say what one row for each interval and day would.

    Beginnings count +1, ends -1; they are added up by day map-side, then along the days. The running sums go per
    (key, year) with the sums of earlier years handed over, so a key with a large share of the intervals is spread."""
    begins = df.select(*keys, first.alias(alias), F.lit(1).alias("_d"), first.alias("_began"))
    ends = df.select(*keys, after.alias(alias), F.lit(-1).alias("_d"), F.lit(None).cast(begins.schema["_began"].dataType).alias("_began"))
    steps = begins.unionByName(ends).groupBy(*keys, alias).agg(F.sum("_d").alias("_d"), F.max("_began").alias("_began"))
    steps = steps.withColumn("_part", F.year(alias) if granularity is None else granularity)
    parts = steps.groupBy(*keys, "_part").agg(F.sum("_d").alias("_pd"), F.max("_began").alias("_pb"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, "_part", F.coalesce(F.sum("_pd").over(earlier), F.lit(0)).alias("_before"), F.max("_pb").over(earlier).alias("_last"))
    so_far = Window.partitionBy(*keys, "_part").orderBy(alias).rowsBetween(Window.unboundedPreceding, 0)
    here = steps.withColumns({"_n": F.sum("_d").over(so_far), "_l": F.max("_began").over(so_far)})
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys] + [F.col("h._part") == F.col("p._part")]
    joined = here.alias("h").join(parts.alias("p"), same)
    return joined.select(*[F.col(f"h.{k}").alias(k) for k in keys], F.col(f"h.{alias}").alias(alias), (F.col("_n") + F.col("_before")).alias("n"),
                         F.greatest("_l", "_last").alias("latest"))


def split_intervals(df: DataFrame, by: Sequence[str], ident: Sequence[str], lo: str, hi: str, steps: DataFrame, step_day: str,
                    values: Sequence[str], granularity: str = "season") -> DataFrame:
    """Intervals (``lo``, ``hi``] of a key, disjoint as states that follow each other are, cut where ``steps`` (rows of
    the key that hold from ``step_day`` on) change: columns ``by``, ``ident``, ``values`` and the cut ``lo`` and ``hi``.

    Two as-of joins: each interval takes the step that holds on its first day, and each step that falls inside an
    interval begins a part of it. Linear in intervals and steps; no day is written out."""
    known = df.select(*by, *ident, lo, hi, F.date_add(lo, 1).alias("_from"))
    starts = asof_join(known, steps.select(*by, step_day, *values), by, "_from", step_day, values, strict=False, granularity=granularity)
    inner = asof_join(steps.select(*by, F.col(step_day).alias("_from"), *values), known.drop("_from"), by, "_from", lo,
                      [lo, *ident, hi], right_order=ident, strict=True, granularity=granularity, prefix="_a_")
    inner = inner.where(F.col(f"_a_{lo}").isNotNull() & (F.col("_from") > F.date_add(f"_a_{lo}", 1))
                        & (F.col(f"_a_{hi}").isNull() | (F.col("_from") <= F.col(f"_a_{hi}"))))
    inner = inner.select(*by, *[F.col(f"_a_{c}").alias(c) for c in (*ident, hi)], "_from", *values)
    parts = starts.select(*by, *ident, hi, "_from", *values).unionByName(inner)
    following = F.lead("_from").over(Window.partitionBy(*by, *ident).orderBy("_from"))
    return parts.select(*by, *ident, F.date_sub("_from", 1).alias(lo), F.coalesce(F.date_sub(following, 1), F.col(hi)).alias(hi), *values)


def positions_from_end(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                       alias: str = "pos_from_end", also: tuple[str, Column] | None = None) -> DataFrame:
    """Number of rows of the same key that come after each row in ``order`` (0 = newest), without a
    window over a whole key: rows after inside the row's chunk (a per-(key, chunk) window) plus the
    rows of all later chunks (a suffix sum over the small per-chunk count table). ``also`` (a name and a
    condition) counts, in the same pass, only the later rows that meet the condition."""
    counted = {alias: F.lit(1)} | ({also[0]: F.when(also[1], 1).otherwise(0)} if also else {})
    ws = Window.partitionBy(*keys, "_src").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    wk = Window.partitionBy(*keys).orderBy(F.col("_src").desc()).rowsBetween(Window.unboundedPreceding, -1)
    base = df.withColumn("_src", chunk).withColumns({f"_one_{n}": c for n, c in counted.items()})
    counts = base.groupBy(*keys, "_src").agg(*[F.sum(f"_one_{n}").alias(f"_n_{n}") for n in counted])
    counts = counts.select(*keys, "_src", *[F.coalesce(F.sum(f"_n_{n}").over(wk), F.lit(0)).alias(f"_later_{n}") for n in counted])
    base = base.withColumns({f"_after_{n}": F.coalesce(F.sum(f"_one_{n}").over(ws), F.lit(0)) for n in counted})
    out = base.join(counts, [*keys, "_src"]).withColumns({n: F.col(f"_after_{n}") + F.col(f"_later_{n}") for n in counted})
    return out.drop("_src", *[f"_{k}_{n}" for k in ("one", "after", "later") for n in counted])


def lag_across_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, col: str,
                      alias: str) -> DataFrame:
    """``lag(col, 1)`` over each key's rows in ``order``, computed per (key, chunk): the first row of a
    chunk takes the last value of the key's previous non-empty chunk from a small per-chunk aggregate
    (``max_by`` + ``lag`` over chunks). No row is copied and no task sees a whole key. Rows with a NULL key or chunk
    have no place in an order and are left out.

    The window comes before the join, whose order it brings, so rows are sorted once; the join is a left one on a
    unique key, so a reader that doesn't use ``alias`` has neither in its plan."""
    placed = F.col("_src").isNotNull()
    for k in keys:
        placed = placed & F.col(k).isNotNull()
    base = df.withColumn("_src", chunk).where(placed)
    last = (base.groupBy(*keys, "_src")
            .agg(F.max_by(F.col(col), F.struct(*[F.col(c) for c in order])).alias("_last")))
    wk = Window.partitionBy(*keys).orderBy("_src")
    carry = last.select(*keys, "_src", F.lag("_last").over(wk).alias("_prev_chunk_last"))
    w = Window.partitionBy(*keys, "_src").orderBy(*order)
    out = base.withColumn("_in_chunk", F.lag(col).over(w)).join(carry, [*keys, "_src"], "left")
    return out.withColumn(alias, F.coalesce("_in_chunk", "_prev_chunk_last")).drop("_src", "_in_chunk", "_prev_chunk_last")
