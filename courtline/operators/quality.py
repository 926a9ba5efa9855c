"""Data-quality reports as one-pass aggregates.

Every report scans its input once: all checks are conditional counts in a single ``agg`` (partial
aggregation map-side, a single tiny final merge), then unpivoted to one row per check with
``stack``. Key and foreign-key checks are a grouped count and an anti join.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.operators.storage import STORAGE_TYPES, storage_ranges

# Storage ranges of the compact export types (unsigned / small ints).
STORAGE_RANGES = {
    "UInt8": (0, 255), "UInt16": (0, 65535), "Int8": (-128, 127), "Int16": (-32768, 32767),
}

# Compact export type per game-log column (the reference's storage plan), ids included. It is narrower than
# the Spark types in which the rows are stored, which have no unsigned ones.
LOG_STORAGE_TYPES = {
    "player_id": "UInt16", "opponent_team_id": "UInt8",
    "points": "UInt8", "field_goals_made": "UInt8", "field_goals_attempted": "UInt8",
    "three_pointers_made": "UInt8", "three_pointers_attempted": "UInt8", "free_throws_made": "UInt8",
    "free_throws_attempted": "UInt8", "rebounds_offensive": "UInt8", "rebounds_defensive": "UInt8",
    "rebounds_total": "UInt8", "assists": "UInt8", "steals": "UInt8", "blocks": "UInt8",
    "turnovers": "UInt8", "personal_fouls": "UInt8", "plus_minus": "Int8", "rest_days": "UInt8",
}


def compact_log_ranges(columns: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Bounds of the compact export types of those of the columns that have one."""
    return {c: STORAGE_RANGES[t] for c, t in LOG_STORAGE_TYPES.items() if c in columns}


def _unpivot(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) AS ({label}, {value})")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG-NULLS: one row per column with its NULL count (one scan)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(row, cols, "column_name", "null_count")


def range_report(df: DataFrame, ranges: Mapping[str, tuple] | None = None, dataset: str = "logs") -> DataFrame:
    """QUAL-RANGE: per column, how many non-NULL values fall outside [lo, hi]; by default the bounds are those of the
    types in which the export stores the dataset."""
    if ranges is None:
        ranges = storage_ranges(dataset, df.columns)
    cols = list(ranges)
    row = df.agg(*[F.count_if(~F.col(c).between(lo, hi)).alias(c) for c, (lo, hi) in ranges.items()])
    out = _unpivot(row, cols, "column_name", "n_out_of_range")
    bounds = df.sparkSession.createDataFrame([(c, int(lo), int(hi)) for c, (lo, hi) in ranges.items()],
                                             "column_name string, lo long, hi long")
    return out.join(F.broadcast(bounds), "column_name")  # bounded: one row per checked column


def key_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """QUAL-KEY: keys that occur more than once, with their count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def fk_report(df: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """QUAL-FK: child rows whose key has no parent row (NULL keys are not violations)."""
    pk = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return df.where(F.col(key).isNotNull()).join(pk, key, "left_anti")


REQUIRED_LOG_COLUMNS = ("player_id", "game_id", "game_date", "points", "dfs_points_dk")
LOG_KEY_COLUMNS = ("player_id", "game_id", "game_date")
EXPORTED_LOG_TYPES = {"player_id": "bigint", "points": STORAGE_TYPES["logs"]["points"]}


def validate_logs(df: DataFrame, required: Sequence[str] = REQUIRED_LOG_COLUMNS,
                  key_cols: Sequence[str] = LOG_KEY_COLUMNS, types: Mapping[str, str] = EXPORTED_LOG_TYPES) -> DataFrame:
    """QUAL-EXPORT: report (check, severity, n_bad) for an exported log table: non-empty and required
    columns (errors), columns that are not in their storage type and NULLs in key columns (warnings). One scan."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    keys = [c for c in key_cols if c in found]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in keys])
    checks = [("non_empty", "error", F.when(F.col("_rows") == 0, 1).otherwise(0))]
    checks += [(f"required_column:{c}", "error", F.lit(int(c not in found))) for c in required]
    checks += [(f"type:{c}", "warning", F.lit(int(found[c] != t))) for c, t in types.items() if c in found]
    checks += [(f"nulls:{c}", "warning", F.col(f"null_{c}")) for c in keys]
    report = [F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), n.cast("long").alias("n_bad")) for name, severity, n in checks]
    return row.select(F.explode(F.array(*report)).alias("c")).select("c.*")
