"""Sinks, keyed upserts on plain parquet, raw-row mapping for ingestion and gap detection.

Upserts never read and overwrite the same files in one job: the merged rows of the touched partitions are
first written to a folder of the table that readers pass over (``_pending``), with a record of what is to be
replaced and removed. From then on the upsert is decided: its partitions' folders are moved over those of the
table, as the commit of a dynamic partition overwrite does, files of emptied partitions are removed, and the
record goes last. A writer that finds a record finishes it before it does anything else, so
a driver that stops at any point leaves a table that the next writer brings to the same state. One writer a
table at a time is assumed, as with any plain parquet folder.

Touched are the partitions of the new rows and those that hold an older row of an updated key. A table's
schema is kept beside its rows (``_table``): batches may bring new columns, which are NULL in older rows.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.exprs import safe_float, safe_int, safe_long, season_label, text_true, ymd
from courtline.session import (files_in, leaf_folders, move_path, path_exists, read_text, remove_path, scratch_path, settings, shuffles_dropped,
                               write_text)

FORMATS = ("parquet", "csv", "json")


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> bool:
    """SNK-FMT: write parquet, csv (with header) or json; an empty frame writes nothing (returns
    False); any other format is an error.

    The plan runs once: rows are counted while they are written, beside the dataset, which is replaced only if there
    are any. Other modes than ``overwrite`` ask first whether there is a row."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    spark, watch = df.sparkSession, Observation()
    beside = mode == "overwrite"
    if not beside and df.isEmpty():
        return False
    made = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:8]}" if beside else path
    w = df.observe(watch, F.count(F.lit(1)).alias("rows")).write.mode("error" if beside else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(made)
    if not beside:
        return True
    if watch.get["rows"] == 0:
        remove_path(spark, made)
        return False
    if path_exists(spark, path):
        move_path(spark, path, f"{made}-old")
    move_path(spark, made, path)
    remove_path(spark, f"{made}-old")
    return True


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000, replace_all: bool = False) -> None:
    """SNK-PART: hive-partitioned snappy parquet. Overwrite replaces only the partitions present in ``df``
    (whatever the session's overwrite mode is); ``replace_all`` replaces the whole table. Rows are clustered
    by the partition columns with a ``rebalance`` hint: AQE splits a partition value that holds a large share
    of the rows over several tasks (a plain ``repartition(cols)`` would put all of it in one task) and merges
    small ones, so each partition directory gets few, large files."""
    (df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols)
     .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
     .option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file).parquet(path))


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-CSV: a CSV dataset with a header (a directory of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """SNK-EMPTY: an empty frame with the declared schema (writes a valid, empty parquet dataset)."""
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------------------------------------
# upsert


def dealt(df: DataFrame, partition_cols: Sequence[str], by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The rows of each partition dealt over tasks by the hash of ``by``, and the columns they are dealt by: one
    exchange that serves both the merge by key and the write by partition, for tables whose partition follows from
    the key. Rows of the same ``by`` lie together, so what they share is stored once."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on = [*partition_cols, "_deal"]
    return df.withColumn("_deal", F.pmod(F.xxhash64(*by), F.lit(tasks))).repartition(*on), on


def write_dealt(df: DataFrame, path: str, cols: Sequence[str], max_records_per_file: int = 5_000_000) -> None:
    """SNK-PART of rows that ``dealt`` has clustered already: no further exchange."""
    (df.write.mode("overwrite").partitionBy(*cols).option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .option("maxRecordsPerFile", max_records_per_file).parquet(path))


def write_as_dealt(df: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Rows to their partitions' folders as they lie: neither exchanged nor sorted. A task keeps a file open for each of its
    partitions (beyond 64 it sorts), with row groups small enough for that."""
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "64", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.partitionBy(*cols).option("compression", "snappy").option("parquet.block.size", 32 << 20).parquet(path)


def dedup_updates(updates: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One update per key: the one with the largest ``order_col``; of equal ones a hash of the row decides, so a
    rerun takes the same row. Combines map-side, a key of any size."""
    rest = [c for c in updates.columns if c not in keys]
    rank = F.struct(F.col(order_col), F.xxhash64(*[F.col(c) for c in updates.columns]))
    best = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_u"))
    return best.select(*keys, *[F.col("_u")[c].alias(c) for c in rest])


def stored_columns(existing: T.StructType, updates: T.StructType, order_col: str) -> T.StructType:
    """The table's columns after an upsert: its own, then those that the updates bring. An order column whose name
    starts with an underscore serves the merge only."""
    new = [f for f in updates.fields if f.name not in existing.names and not (f.name == order_col and order_col.startswith("_"))]
    return T.StructType([*existing.fields, *(T.StructField(f.name, f.dataType, True) for f in new)])


def dedup_dealt(updates: DataFrame, keys: Sequence[str], order_col: str, partition_cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``dedup_updates`` of rows ``dealt`` for their write."""
    rows, on = dealt(updates, partition_cols, by)
    first = Window.partitionBy(*on, *keys).orderBy(F.col(order_col).desc_nulls_last(), F.xxhash64(*[F.col(c) for c in updates.columns]).desc())
    return rows.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(*updates.columns)


def merge_rows(existing: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str,
               update_cols: Sequence[str] | None = None, partition_cols: Sequence[str] = (), deal_by: Sequence[str] = ()) -> DataFrame:
    """UP-MERGE as a frame operation, one row a key: an update replaces the listed columns of the stored row with
    its key (other columns keep their stored value), new keys are inserted, other rows stay.

    Of several updates of a key the last in ``order_col`` wins. Where that is a column of the table (a version, a
    time), a stored row with a larger value stays as it is, so updates may come late or again; a NULL order is the
    oldest. An order column that is not stored lets the update win. NULL keys are keys like any other. Should the
    table hold a key twice, its last row by the order is kept. Columns that only the updates have are added, NULL in
    rows without an update; values are cast to the stored type, and one that doesn't fit is an error.

    Both sides meet by key in one exchange, which treats NULLs as equal. Whole rows compete by their order, the
    first of each key stays (trimmed map-side); where an update has only some of the columns, an aggregation that
    combines map-side brings both rows together. Either way a key of any size is safe. With ``deal_by`` that exchange
    is the one of ``dealt``.
    """
    columns = stored_columns(existing.schema, updates.schema, order_col)
    ordered = order_col in columns.names
    if update_cols is None and set(existing.columns) <= set(updates.columns):
        return _newest_rows(existing, updates, keys, order_col, columns, partition_cols, deal_by)

    if deal_by:
        both = _paired_rows(existing, updates, keys, order_col, columns, partition_cols, deal_by)
    else:
        def side(df: DataFrame, name: str) -> DataFrame:
            order = F.col(order_col) if order_col in df.columns else F.lit(0)
            rank = F.struct(order, F.xxhash64(*[F.col(c) for c in df.columns]))
            return df.select(*[F.col(c).cast(columns[c].dataType).alias(c) for c in keys], F.struct(*df.columns).alias(name), rank.alias(f"{name}_rank"))

        both = side(existing, "_old").unionByName(side(updates, "_new"), allowMissingColumns=True)
        both = both.groupBy(*keys).agg(F.max_by("_old", "_old_rank").alias("_old"), F.max_by("_new", "_new_rank").alias("_new"))
    known, updated = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    if ordered and order_col in existing.columns:
        stays = known & F.coalesce(F.col("_new")[order_col] < F.col("_old")[order_col],
                                   F.col("_new")[order_col].isNull() & F.col("_old")[order_col].isNotNull())
        updated = updated & ~stays
    out = []
    for f in columns.fields:
        c = f.name
        old = F.col("_old")[c] if c in existing.columns else F.lit(None).cast(f.dataType)
        if c in keys:
            out.append(F.col(c))
        elif c not in updates.columns:
            out.append(old.alias(c))
        else:
            new = F.col("_new")[c].cast(f.dataType)
            takes = updated if update_cols is None or c in update_cols else ~known
            out.append(F.when(takes, new).otherwise(old).alias(c))
    return both.select(*out)


def _paired_rows(existing: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str, columns: T.StructType,
                 partition_cols: Sequence[str], deal_by: Sequence[str]) -> DataFrame:
    """A row for each key with its stored row (``_old``) and its update (``_new``), NULL where there is none. Rows are dealt
    as they are; they are ranked and meet where they lie then."""
    def side(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in placed]
        return df.select(*[F.col(c).cast(columns[c].dataType).alias(c) for c in placed],
                         F.struct(F.lit(True).alias("_here"), *rest).alias(name))

    def whole(df: DataFrame, name: str):
        return F.when(F.col(name).isNotNull(), F.struct(*[(F.col(c) if c in placed else F.col(name)[c]).alias(c) for c in df.columns]))

    def rank(df: DataFrame, name: str):
        order = F.col(name)[order_col] if order_col in df.columns else F.lit(0)
        return F.when(F.col(name).isNotNull(), F.struct(order, F.xxhash64(*[F.col(name)[c] for c in df.columns])))

    placed = list(dict.fromkeys([*keys, *partition_cols]))
    both, on = dealt(side(existing, "_old").unionByName(side(updates, "_new"), allowMissingColumns=True), partition_cols, deal_by)
    both = both.withColumns({"_old": whole(existing, "_old"), "_new": whole(updates, "_new")})
    both = both.withColumns({"_old_rank": rank(existing, "_old"), "_new_rank": rank(updates, "_new")})
    same = Window.partitionBy(*dict.fromkeys([*on, *keys]))
    both = both.withColumn("_update", F.max_by("_new", "_new_rank").over(same))
    both = both.withColumn("_place", F.row_number().over(same.orderBy(F.col("_old").isNull(), F.col("_old_rank").desc()))).where("_place = 1")
    return both.withColumn("_new", F.col("_update"))


def _newest_rows(existing: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str, columns: T.StructType,
                 partition_cols: Sequence[str], deal_by: Sequence[str]) -> DataFrame:
    """Of the stored and the new rows of each key the one that a merge of whole rows leaves."""
    def side(df: DataFrame, new: int) -> DataFrame:
        order = F.col(order_col) if order_col in df.columns else F.lit(None).cast(updates.schema[order_col].dataType)
        whole = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns.fields]
        return df.select(*whole, order.alias("_by"), F.lit(new).alias("_is_new"), F.xxhash64(*[F.col(c) for c in df.columns]).alias("_tie"))

    by, new, tie = F.col("_by").desc_nulls_last(), F.col("_is_new").desc(), F.col("_tie").desc()
    first = (by, new, tie) if order_col in existing.columns else (new, by, tie)
    rows = side(existing, 0).unionByName(side(updates, 1))
    rows, on = dealt(rows, partition_cols, deal_by) if deal_by else (rows, [])
    same = Window.partitionBy(*dict.fromkeys([*on, *keys]))
    rows = rows.withColumn("_place", F.row_number().over(same.orderBy(*first))).where("_place = 1")
    return rows.select(*columns.names)


def partition_filter(parts: Sequence, cols: Sequence[str]) -> "F.Column":
    """Rows of the given partitions as a filter of literals, which prunes directories while the scan is planned."""
    def one(row):
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) if row[c] is None else F.col(c) == F.lit(row[c]) for c in cols])
    return reduce(lambda a, b: a | b, [one(r) for r in parts], F.lit(False))


# What a table keeps beside its rows; readers of parquet pass over names with an underscore.
TABLE_NOTES, PENDING, RECORD = "_table", "_pending", "record.json"


def table_notes(spark: SparkSession, target: str) -> dict:
    """The notes of a table (its schema, feature sets, stream batches), empty if it has none."""
    text = read_text(spark, f"{target}/{TABLE_NOTES}/notes.json")
    return json.loads(text) if text else {}


def note(spark: SparkSession, target: str, notes: dict) -> None:
    write_text(spark, f"{target}/{TABLE_NOTES}/notes.json", json.dumps(notes))


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A table that upserts write, with its whole schema: columns that came later are NULL in older files. No file is
    opened to find the schema out."""
    schema = table_notes(spark, target).get("schema")
    return spark.read.schema(T.StructType.fromJson(schema)).parquet(target) if schema else spark.read.parquet(target)


def replace_partitions(spark: SparkSession, target: str, record: dict) -> None:
    """The pending folder of each partition takes the place of the table's; files of one that is only ``added`` to go beside
    the table's. May be done again: what was moved before is no longer pending."""
    rows = f"{target}/{PENDING}/rows"
    for part in leaf_folders(spark, rows, len(record["partition_cols"])):
        if part in record.get("added", ()) and path_exists(spark, f"{target}/{part}"):
            for name in files_in(spark, f"{rows}/{part}"):
                move_path(spark, f"{rows}/{part}/{name}", f"{target}/{part}/{name}")
            continue
        if path_exists(spark, f"{target}/{part}"):
            remove_path(spark, f"{target}/{part}")
        move_path(spark, f"{rows}/{part}", f"{target}/{part}")


def remove_emptied(spark: SparkSession, target: str, record: dict) -> None:
    """Files of partitions that a moved key has emptied: the merge gives them no row that would replace them."""
    for path in record["gone"]:
        remove_path(spark, path)


def recover(spark: SparkSession, target: str) -> bool:
    """Finish an upsert that was decided but not ended; what was staged without being decided is dropped. Returns
    whether there was something to finish. Every writer begins with it; after a crash it may also be called alone."""
    if not path_exists(spark, f"{target}/{PENDING}"):
        return False
    text = read_text(spark, f"{target}/{PENDING}/{RECORD}")
    if text:
        record = json.loads(text)
        replace_partitions(spark, target, record)
        remove_emptied(spark, target, record)
        note(spark, target, {**table_notes(spark, target), "schema": record["schema"]})
        remove_path(spark, f"{target}/{PENDING}/{RECORD}")
    remove_path(spark, f"{target}/{PENDING}")
    return bool(text)


def keys_move(rows: Sequence[DataFrame], schema: T.StructType, keys: Sequence[str], partition_cols: Sequence[str]) -> bool:
    """Whether a key lies in more than one partition, in the frames together; found in one exchange of the key and partition
    columns, combined map-side."""
    apart = [c for c in partition_cols if c not in keys]
    if not apart:
        return False
    names = dict.fromkeys([*keys, *apart])
    both = reduce(DataFrame.unionByName, [df.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in names]) for df in rows])
    differs = [(F.min(c) < F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))) for c in apart]
    return not both.groupBy(*keys).agg(reduce(lambda a, b: a | b, differs).alias("_apart")).where("_apart").isEmpty()


def decide_upsert(spark: SparkSession, target: str, updates: DataFrame, keys: Sequence[str], partition_cols: Sequence[str],
                  order_col: str, update_cols: Sequence[str] | None = None, fixed_partitions: bool = False,
                  deal_by: Sequence[str] = (), staged: bool = False) -> dict:
    """Merge and stage the touched partitions and write the record that decides the upsert; ``recover`` ends it."""
    made = scratch_path(spark, f"updates-{uuid.uuid4().hex}")
    if not staged:
        updates.write.parquet(made)
        updates = spark.read.schema(updates.schema).parquet(made)
    current = read_table(spark, target)
    touched = updates.select(*[F.col(c).cast(current.schema[c].dataType).alias(c) for c in partition_cols])
    stays = bool(deal_by) or (not fixed_partitions and not keys_move([current, updates], current.schema, keys, partition_cols))
    if not fixed_partitions and not stays:
        same = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys])
        stored = current.select(*dict.fromkeys([*keys, *partition_cols])).alias("s")
        touched = touched.unionByName(stored.join(updates.select(*keys).distinct().alias("u"), same, "left_semi").select(*partition_cols))
    parts = touched.distinct().collect()
    existing = current.where(partition_filter(parts, partition_cols))
    if stays or (fixed_partitions and not keys_move([existing, updates], current.schema, keys, partition_cols)):
        deal_by = deal_by or keys       # each key lies in one partition, so one exchange serves merge and write
    schema = stored_columns(current.schema, updates.schema, order_col)
    merged = merge_rows(existing, updates, keys, order_col, update_cols, partition_cols, deal_by).select(*schema.names)
    rows = f"{target}/{PENDING}/rows"
    (write_dealt if deal_by else write_partitioned)(merged, rows, partition_cols)
    filled = spark.read.schema(schema).parquet(rows).select(*partition_cols).distinct().collect()
    gone = []
    if emptied := {tuple(r) for r in parts} - {tuple(r) for r in filled}:
        where = partition_filter([dict(zip(partition_cols, r)) for r in emptied], partition_cols)
        gone = [r.file_path for r in current.where(where).select("_metadata.file_path").distinct().collect()]
    record = {"schema": schema.jsonValue(), "partition_cols": list(partition_cols), "gone": gone}
    write_text(spark, f"{target}/{PENDING}/{RECORD}", json.dumps(record))
    remove_path(spark, made)
    return record


def decide_dealt(spark: SparkSession, target: str, updates: DataFrame, keys: Sequence[str], partition_cols: Sequence[str], order_col: str,
                 deal_by: Sequence[str]) -> None:
    """``decide_upsert`` of whole rows whose partition is fixed, so that wide rows are moved only where they have to be.

    The updates are written to their partitions' pending folders as they come. Keys and order alone are then exchanged: a
    partition none of whose stored keys is updated keeps its files and takes the new ones beside them, one all of whose rows
    are replaced takes the new files alone, and only the others are merged row by row. The first write finds no rows."""
    rows, known = f"{target}/{PENDING}/rows", bool(table_notes(spark, target).get("schema") or leaf_folders(spark, target, len(partition_cols)))
    current = read_table(spark, target) if known else spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType, True)
                                                                                              for f in updates.schema.fields]))
    schema = stored_columns(current.schema, updates.schema, order_col)
    if not set(current.columns) <= set(updates.columns):
        decide_upsert(spark, target, updates, keys, partition_cols, order_col, None, True, deal_by)
        return
    write_as_dealt(updates.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), rows, partition_cols)
    new = spark.read.schema(schema).parquet(rows)
    parts = new.select(*partition_cols).distinct().collect()
    stored = current.where(partition_filter(parts, partition_cols)) if known else current
    names = list(dict.fromkeys([*partition_cols, *keys]))
    folder = F.regexp_extract("_metadata.file_path", rf"/{PENDING}/rows/(.+)/[^/]+$", 1)
    sides = new.select(*names, F.col(order_col).alias("_by"), F.lit(1).alias("_new"), folder.alias("_folder")).unionByName(
        stored.select(*names, F.col(order_col).alias("_by"), F.lit(0).alias("_new"), F.lit(None).cast("string").alias("_folder")))
    n, by, old_by = F.sum("_new"), F.max(F.when(F.col("_new") == 1, F.col("_by"))), F.max(F.when(F.col("_new") == 0, F.col("_by")))
    of_key = sides.groupBy(*names).agg(n.alias("n"), (F.count(F.lit(1)) - n).alias("o"), F.coalesce(by < old_by, by.isNull() & old_by.isNotNull()).alias("stays"),
                                       F.max("_folder").alias("_folder"))
    hit, kept = (F.col("n") > 0) & (F.col("o") > 0), F.col("n") == 0
    clash = (F.col("n") > 1) | (F.col("o") > 1) | (hit & F.col("stays"))
    found = of_key.groupBy(*partition_cols).agg(F.max("_folder").alias("_folder"), F.max(hit).alias("hit"), F.max(kept).alias("kept"),
                                                F.max(clash).alias("clash")).collect()
    written = set(leaf_folders(spark, rows, len(partition_cols)))
    mixed = [r for r in found if r.clash or (r.hit and r.kept) or r["_folder"] not in written]
    added = [r["_folder"] for r in found if r not in mixed and not r.hit]
    if mixed:
        where, made = partition_filter(mixed, partition_cols), f"{target}/{PENDING}/merged"
        merged = merge_rows(stored.where(where), new.where(where).select(*updates.columns), keys, order_col, None, partition_cols, deal_by).select(*schema.names)
        with shuffles_dropped(spark):
            write_dealt(merged, made, partition_cols)
        for part in leaf_folders(spark, made, len(partition_cols)):
            remove_path(spark, f"{rows}/{part}")
            move_path(spark, f"{made}/{part}", f"{rows}/{part}")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    record = {"schema": nullable.jsonValue(), "partition_cols": list(partition_cols), "gone": [], "added": added}
    write_text(spark, f"{target}/{PENDING}/{RECORD}", json.dumps(record))


def upsert_partitioned(spark: SparkSession, target: str, updates: DataFrame, keys: Sequence[str],
                       partition_cols: Sequence[str], order_col: str, update_cols: Sequence[str] | None = None,
                       fixed_partitions: bool = False, deal_by: Sequence[str] = (), staged: bool = False) -> None:
    """Keyed upsert into a partitioned parquet table (``merge_rows``): read only the touched partitions, merge, stage,
    then replace exactly those. An upsert that an earlier writer decided but didn't end is finished first.

    The updates are staged once, unless the caller has them in files already (``staged``). Touched partitions are those of
    the updates and, unless the caller knows that a key never changes partition (``fixed_partitions``), those that hold an
    updated key now, found by a scan of the key columns alone. Their list, and that of files to remove, goes through the driver, as the directory list of any
    partitioned table does. An order column whose name starts with an underscore is not stored.

    ``deal_by``, with ``fixed_partitions``, names columns of the key of which no value holds a large share of a
    partition: rows are then dealt by them in the one exchange that the merge and the write need (``dealt``). Without it
    the whole key serves, if no key is found in two partitions. Whole rows that are dealt are only exchanged where stored
    rows and updates have to be told apart row by row (``decide_dealt``).
    """
    if deal_by and not (fixed_partitions and set(deal_by) <= set(keys)):
        raise ValueError(f"rows are dealt by columns of the key, whose partition is fixed: {list(deal_by)}")
    recover(spark, target)
    if deal_by and update_cols is None and not staged and not order_col.startswith("_"):
        decide_dealt(spark, target, updates, keys, partition_cols, order_col, deal_by)
        recover(spark, target)
        return
    if not path_exists(spark, target):  # the first write creates the table; cut off, its rest is inserted by the next call
        if staged and not deal_by and not keys_move([updates], updates.schema, keys, partition_cols):
            deal_by = keys
        first = dedup_dealt(updates, keys, order_col, partition_cols, deal_by) if deal_by else dedup_updates(updates, keys, order_col)
        first = first.drop(order_col) if order_col.startswith("_") else first
        note(spark, target, {"schema": T.StructType([T.StructField(f.name, f.dataType, True) for f in first.schema.fields]).jsonValue()})
        (write_dealt if deal_by else write_partitioned)(first, target, partition_cols)
        return
    decide_upsert(spark, target, updates, keys, partition_cols, order_col, update_cols, fixed_partitions, deal_by, staged)
    recover(spark, target)


def stub_players(logs_raw: DataFrame, players: DataFrame) -> DataFrame:
    """UP-STUB: a minimal player row for every player id in box-score rows that has no player row
    (name, team, position from the box score, active)."""
    new = (logs_raw.select("player_id", "name", "team_id", "position")
           .join(players.select("player_id"), "player_id", "left_anti")
           .groupBy("player_id").agg(F.min_by(F.struct("name", "team_id", "position"), F.col("name")).alias("s")))
    return new.select(F.col("player_id").alias("id"), "player_id", F.col("s.name").alias("name"),
                      F.col("s.team_id").alias("team_id"), F.col("s.position").alias("position"),
                      F.lit(True).alias("is_active"))


# ---------------------------------------------------------------------------------------------
# raw rows (strings from the API) to table rows

BOX_SCORE_FIELDS = ("playerID", "longName", "playerName", "teamID", "pos", "min", "pts", "fgm", "fga", "fg_pct",
                    "tpm", "tpa", "tp_pct", "ftm", "fta", "ft_pct", "oreb", "dreb", "reb", "ast", "stl", "blk",
                    "tov", "pf", "plusMinus", "fantasyPoints", "starter")
_BOX_INT = (("points", "pts"), ("field_goals_made", "fgm"), ("field_goals_attempted", "fga"),
            ("three_pointers_made", "tpm"), ("three_pointers_attempted", "tpa"), ("free_throws_made", "ftm"),
            ("free_throws_attempted", "fta"), ("rebounds_offensive", "oreb"), ("rebounds_defensive", "dreb"),
            ("rebounds_total", "reb"), ("assists", "ast"), ("steals", "stl"), ("blocks", "blk"),
            ("turnovers", "tov"), ("personal_fouls", "pf"), ("plus_minus", "plusMinus"))
_BOX_FLOAT = (("minutes", "min"), ("field_goal_percentage", "fg_pct"), ("three_point_percentage", "tp_pct"),
              ("free_throw_percentage", "ft_pct"), ("dfs_points_dk", "fantasyPoints"))


def box_scores_to_logs(box: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """UP-BOX: box-score rows (strings, with ``gameID``) to typed game logs: safe casts, ``is_home``
    = the row's team is the home team, opponent = the other side, starter flag from text. Rows with
    a player id <= 0 (or unparsable) go to the second frame (quarantine)."""
    pid = safe_long("playerID")
    team = F.when(F.col("teamID").isNotNull() & (F.col("teamID") != ""), safe_long("teamID"))
    g = games.select(F.col("game_id").cast("string").alias("gameID"), F.col("game_id"), "game_date",
                     "home_team_id", "away_team_id")
    j = box.join(g, "gameID")
    is_home = F.coalesce(F.coalesce(team, F.lit(0)) == F.col("home_team_id"), F.lit(False))
    cols = [pid.alias("player_id"), F.col("game_id"), F.col("game_date")]
    cols += [safe_float(src).alias(dst) for dst, src in _BOX_FLOAT]
    cols += [safe_int(src).alias(dst) for dst, src in _BOX_INT]
    cols += [is_home.alias("is_home"),
             F.when(is_home, F.col("away_team_id")).otherwise(F.col("home_team_id")).alias("opponent_team_id"),
             text_true("starter").alias("is_starter"),
             F.coalesce(F.col("longName"), F.col("playerName"), F.lit("")).alias("name"),
             team.alias("team_id"), F.coalesce(F.col("pos"), F.lit("")).alias("position")]
    typed = j.select(*cols)
    ok = F.coalesce(F.col("player_id") > 0, F.lit(False))
    return typed.where(ok), typed.where(~ok)


def raw_games(rows: DataFrame, date_col: str = "date_str") -> DataFrame:
    """UP-GAME: game rows with defaults ('Regular Season', 'Scheduled', '') and the season label."""
    d = ymd(date_col)
    return rows.select(F.col("gameID").cast("string").alias("game_id"), d.alias("game_date"),
                       season_label(d).alias("season"),
                       F.coalesce(F.col("seasonType"), F.lit("Regular Season")).alias("season_type"),
                       F.coalesce(safe_long("homeTeamID"), F.lit(0)).alias("home_team_id"),
                       F.coalesce(safe_long("awayTeamID"), F.lit(0)).alias("away_team_id"),
                       safe_int("homeScore").alias("home_score"), safe_int("awayScore").alias("away_score"),
                       F.coalesce(F.col("gameStatus"), F.lit("Scheduled")).alias("game_status"),
                       F.coalesce(F.col("gameTime"), F.lit("")).alias("game_time"))


def raw_injuries(rows: DataFrame) -> DataFrame:
    """UP-INJ: injury rows; a blank injury date is skipped, and so is a player id that does not parse
    (``rejected`` has those rows)."""
    d = ymd("injDate")
    return (rows.where(F.col("injDate").isNotNull() & (F.col("injDate") != "") & d.isNotNull() & safe_long("playerID").isNotNull())
            .select(safe_long("playerID").alias("player_id"), d.alias("injury_date"),
                    F.coalesce(F.col("status"), F.lit("")).alias("status"),
                    F.coalesce(F.col("description"), F.lit("")).alias("description"),
                    F.coalesce(F.col("bodyPart"), F.lit("")).alias("body_part")))


def raw_salaries(rows: DataFrame, date_col: str = "date_str") -> DataFrame:
    """UP-SAL: salary rows; salary, platform and a player id that parses are required (``rejected`` has the
    rows whose id doesn't)."""
    return (rows.where(safe_float("salary").isNotNull() & F.col("platform").isNotNull() & safe_long("playerID").isNotNull())
            .select(safe_long("playerID").alias("player_id"),
                    ymd(date_col).alias("game_date"), "platform", safe_int("salary").alias("salary"),
                    F.coalesce(F.col("pos"), F.lit("")).alias("position"), F.lit(True).alias("is_available")))


def rejected(rows: DataFrame, id_col: str = "playerID") -> DataFrame:
    """Raw rows whose id does not parse: the quarantine of the mappings that skip them."""
    return rows.where(safe_long(id_col).isNull())


def raw_players(rows: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Player ingest: raw rows (strings) to player rows; an id that parses is required. ``carry`` names columns
    that are passed on, such as the order of the ingest."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.where(safe_long("playerID").isNotNull()).select(
        safe_long("playerID").alias("id"), safe_long("playerID").alias("player_id"),
        F.coalesce(F.col("longName"), F.col("playerName"), F.lit("")).alias("name"), safe_long("teamID").alias("team_id"),
        text("pos").alias("position"), ymd("bDay").alias("birth_date"),
        (F.lower(text("status")) != "inactive").alias("is_active"), *carry)


def raw_teams(rows: DataFrame) -> DataFrame:
    """Team ingest: raw rows (strings) to team rows; an id that parses is required."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.where(safe_long("teamID").isNotNull()).select(
        safe_long("teamID").alias("team_id"), F.upper(text("teamAbv")).alias("abbreviation"),
        F.trim(F.concat_ws(" ", text("teamCity"), text("teamName"))).alias("name"),
        text("conference").alias("conference"), text("division").alias("division"))


PLAYER_UPDATES = ("name", "team_id", "position", "is_active")     # an update keeps id and birth_date


def upsert_players(players: DataFrame, raw: DataFrame, order_col: str) -> DataFrame:
    """The player table after an ingest of raw rows: known players take the new name, team, position and
    activity and keep id and birth date, new ones are inserted whole."""
    return merge_rows(players, raw_players(raw, [order_col]), ["player_id"], order_col, PLAYER_UPDATES)


def raw_odds(rows: DataFrame, ts) -> DataFrame:
    """UP-ODDS: flattened odds rows to table rows; totals from ``totalOver``, over/under prices
    from ``totalOverOdds`` / ``totalUnderOdds``."""
    return rows.select(F.col("gameID").alias("game_id"), F.col("sportsbook"), F.lit(ts).cast("timestamp").alias("timestamp"),
                       safe_float("homeTeamSpread").alias("home_spread"), safe_float("awayTeamSpread").alias("away_spread"),
                       safe_int("homeTeamSpreadOdds").alias("home_spread_odds"),
                       safe_int("awayTeamSpreadOdds").alias("away_spread_odds"),
                       safe_int("homeTeamMLOdds").alias("home_moneyline"), safe_int("awayTeamMLOdds").alias("away_moneyline"),
                       safe_float("totalOver").alias("total_points"), safe_int("totalOverOdds").alias("over_odds"),
                       safe_int("totalUnderOdds").alias("under_odds"))


# ---------------------------------------------------------------------------------------------
# gaps


def missing(wanted: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-ANTI / GAP-DATES / SO-MINUS: wanted keys that are not present yet."""
    return wanted.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def with_parent(df: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-SEMI: rows that have a matching parent row (the complement is ``missing``)."""
    return df.join(parent.select(*keys), list(keys), "left_semi")


def days_with_odds(odds: DataFrame, games: DataFrame) -> DataFrame:
    """JN-ODDSGAME: days that already have odds, through the odds' games (feeds ``missing``)."""
    g = games.select(F.col("game_id").cast("string").alias("game_id"), "game_date")
    return odds.select(F.col("game_id").cast("string").alias("game_id")).join(g, "game_id").select("game_date").distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SO-UNION: concatenate frames by column name; a column missing in some frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
