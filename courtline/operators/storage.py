"""How stored tables keep their rows: one table of storage types for exports and quality reports, counted overflow,
bucketed tables that meet without an exchange, and the order of rows within files."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The narrowest Spark type that holds the stored range of a column (unsigned bytes need a smallint,
# unsigned 16-bit values an int); ids stay long, dates and flags as they are.
_COUNTS = ("points field_goals_made field_goals_attempted three_pointers_made three_pointers_attempted free_throws_made "
           "free_throws_attempted rebounds_offensive rebounds_defensive rebounds_total assists steals blocks turnovers "
           "personal_fouls rest_days").split()
_SHARES = "dfs_points_dk dfs_points_fd usage_rate true_shooting_percentage player_efficiency_rating effective_field_goal_percentage".split()
_TEAM_COUNTS = ("points field_goals_made field_goals_attempted three_pointers_made three_pointers_attempted free_throws_made "
                "free_throws_attempted rebounds_total assists steals blocks turnovers personal_fouls rest_days").split()
_TEAM_SHARES = ("field_goal_percentage three_point_percentage free_throw_percentage pace offensive_rating defensive_rating net_rating "
                "true_shooting_percentage effective_field_goal_percentage turnover_rate offensive_rebound_rate defensive_rebound_rate").split()
STORAGE_TYPES: dict[str, dict[str, str]] = {
    "logs": {**{c: "smallint" for c in _COUNTS}, "plus_minus": "tinyint", "dfs_salary_dk": "int", "dfs_salary_fd": "int",
             **{c: "float" for c in ("minutes", *_SHARES)}},
    "odds": {"home_spread": "float", "away_spread": "float", "home_spread_odds": "smallint", "away_spread_odds": "smallint",
             "home_moneyline": "smallint", "away_moneyline": "smallint", "total_points": "float", "over_odds": "smallint",
             "under_odds": "smallint"},
    "salaries": {"salary": "int"},
    "injuries": {"games_missed": "smallint"},
    "team_logs": {**{c: "smallint" for c in _TEAM_COUNTS}, **{c: "float" for c in _TEAM_SHARES}},
}
RANGES = {"tinyint": (-(1 << 7), (1 << 7) - 1), "smallint": (-(1 << 15), (1 << 15) - 1), "int": (-(1 << 31), (1 << 31) - 1)}


def storage_ranges(dataset: str, columns: Sequence[str] | None = None) -> dict[str, tuple[int, int]]:
    """Bounds of the whole-number columns of a dataset, as its storage types have them."""
    return {c: RANGES[t] for c, t in STORAGE_TYPES[dataset].items() if t in RANGES and (columns is None or c in columns)}


def _fitting(df: DataFrame, col: str, kind: str) -> "F.Column":
    """A column in its storage type, NULL where it doesn't fit. Whole numbers are compared with the type's bounds:
    ``try_cast`` raises and catches an error for each value outside them, which takes longer than all else."""
    if kind in RANGES and df.schema[col].dataType.typeName() in ("byte", "short", "integer", "long"):
        return F.when(F.col(col).between(*RANGES[kind]), F.col(col).cast(kind))
    return F.col(col).try_cast(kind)


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """PRJ-CAST: columns in their storage type. A value outside its range becomes NULL instead of failing the
    export; ``overflowing`` counts those in the same pass."""
    return df.withColumns({c: _fitting(df, c, t) for c, t in types.items() if c in df.columns})


def overflowing(df: DataFrame, dataset: str) -> tuple[DataFrame, Observation]:
    """The frame in its dataset's storage types, and an observation that counts, while the frame is written, the values
    of each whole-number column that don't fit. The plan runs once."""
    watch, types = Observation(), STORAGE_TYPES[dataset]
    counted = [c for c in storage_ranges(dataset) if c in df.columns]
    if not counted:
        return typed(df, types), watch
    counts = [F.count_if(F.col(c).isNotNull() & _fitting(df, c, types[c]).isNull()).alias(c) for c in counted]
    return typed(df.observe(watch, F.count(F.lit(1)).alias("_rows"), *counts), types), watch


def overflow_counts(watch: Observation) -> dict[str, int]:
    """Columns with values that became NULL, and how many, once the observed frame has been written."""
    return {c: n for c, n in watch.get.items() if c != "_rows" and n}


# ---------------------------------------------------------------------------------------------
# layout


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table whose files are dealt by the hash of ``keys`` and sorted by them. Tables with the same keys and number
    of buckets are joined on those keys without an exchange. All join columns together are the key, so a player with a
    third of the rows is spread over all buckets."""
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def interleaved(columns: Sequence["F.Column"], bits: int = 16) -> "F.Column":
    """Place on a Z curve: the bits of the columns' ranks (whole numbers below 2 ** ``bits``) in turn, highest first."""
    out = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for c in columns:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")))
    return out


def _rank(df: DataFrame, col: str, bits: int) -> "F.Column":
    """A column's rank among its quantiles, from 0 to 2 ** ``bits`` - 1."""
    value = F.unix_date(col) if df.schema[col].dataType.typeName() == "date" else F.col(col)
    steps = (1 << bits) - 1
    cuts = df.select(value.cast("double").alias("v")).agg(F.percentile_approx("v", [i / steps for i in range(1, steps + 1)], 10 * steps)).first()[0]
    if not cuts:
        return F.lit(0)
    edges = F.array(*[F.lit(float(x)) for x in cuts])
    return F.coalesce(F.size(F.filter(edges, lambda e: e < value.cast("double"))), F.lit(0))


def write_clustered(df: DataFrame, path: str, by: Sequence[str], partition_cols: Sequence[str] = (), rows_per_group: int = 50_000, bits: int = 5) -> None:
    """SNK-PART with an order within files: rows lie along a Z curve over the ranks of ``by``, so files and row groups
    cover a small range of each of those columns and a read by any of them skips most. The curve is cut into range
    partitions; a value that holds many rows is cut by the other columns."""
    place = interleaved([_rank(df, c, bits) for c in by], bits)
    laid = df.withColumn("_z", place)
    order = [*partition_cols, "_z", *by]
    (laid.repartitionByRange(*order).sortWithinPartitions(*order).drop("_z").write.mode("overwrite")
     .option("parquet.block.row.count.limit", rows_per_group).partitionBy(*partition_cols).parquet(path))


