"""File sources: parquet datasets, folders of CSV files, JSON API documents and their flatteners,
date helpers, snapshot selection and dataset summaries."""

from __future__ import annotations

import csv
import datetime as dt
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.session import cut_lineage, hadoop_fs

# ---------------------------------------------------------------------------------------------
# parquet


def read_parquet(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """SRC-PARQ: a parquet file or a (hive-partitioned) dataset directory; partition columns are
    discovered, filters on them prune directories."""
    r = spark.read
    if base_path:
        r = r.option("basePath", base_path)
    return r.parquet(path)


# ---------------------------------------------------------------------------------------------
# CSV folders


def list_files(spark: SparkSession, directory: str, suffix: str = "") -> list[str]:
    """File names under a directory (metadata only, through the cluster's file system)."""
    fs, p = hadoop_fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName().endswith(suffix))


def csv_headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by their header line, read by one Spark job: the first line of each file's first block. An empty file has
    none; of a file that breaks off, the lines before the break count."""
    at = F.monotonically_increasing_id()
    lines = (spark.read.option("ignoreCorruptFiles", True).text(list(files)).where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file"), "value", at.alias("at")))
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    groups: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():
        groups.setdefault(r.line.strip().removeprefix("\ufeff"), []).append(r.file)
    return groups


def _broken_archives(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Compressed files that can't be read to their end, with the reason. Each is one task's work, as it is in a scan."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rest, reason = memoryview(content.as_py()), None
                try:
                    while len(rest):
                        member = zlib.decompressobj(31)
                        while not member.eof and len(rest):
                            piece, rest = rest[:1 << 20], rest[1 << 20:]
                            while len(piece) and not member.eof:
                                member.decompress(piece, 1 << 20)
                                piece = member.unconsumed_tail
                        if not member.eof:
                            reason = "compressed file breaks off"
                        elif member.unused_data:
                            rest = memoryview(bytes(member.unused_data) + bytes(rest))
                except zlib.error:
                    reason = "not a compressed file"
                if reason:
                    bad.append({"path": path, "reason": reason})
            yield pa.RecordBatch.from_pylist(bad, pa.schema([("path", pa.string()), ("reason", pa.string())]))

    if not files:
        return {}
    raw = spark.read.format("binaryFile").load(list(files)).select("path", "content")
    return {_plain_path(r.path): r.reason for r in raw.mapInArrow(check, "path string, reason string").collect()}


def _plain_path(path: str) -> str:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path)


@dataclass
class CsvFolder:
    """What a folder of CSV files holds. ``rows``: the well-formed rows; ``bad_rows``: file and line of each row that
    doesn't have the header's fields or whose values don't fit the schema; ``files``: a report of every file (file,
    status, records, bad_records, reason) with the status ``ok``, ``partial``, ``empty`` or ``skipped``."""
    rows: DataFrame
    bad_rows: DataFrame
    files: DataFrame


_BAD, _FILE = "__bad_line", "__file"


def _header_fault(names: list[str], schema: T.StructType | None) -> str | None:
    if any("\ufffd" in n or not n.isprintable() for n in names):
        return "header is not text"
    low = [n.strip().lower() for n in names]
    if not all(low):
        return "header with an empty name"
    if len(set(low)) < len(low):
        return "header with a repeated name"
    if schema is not None and not set(low) & {n.lower() for n in schema.names}:
        return "header without a known column"
    return None


def scan_csv_dir(spark: SparkSession, directory: str | Sequence[str], exclude: Sequence[str] = ("all_",),
                 schema: T.StructType | None = None) -> CsvFolder | None:
    """SRC-CSV: every CSV (``.csv``, ``.csv.gz``) of a folder except consolidated outputs (names starting with an
    ``exclude`` prefix), with what can't be read set apart and reported instead of stopping the run. None for a folder
    without files.

    Files are grouped by header and each group is read by its own order of columns, so files whose columns are in
    another order mix rightly; the groups are united by name, missing columns NULL. With a ``schema`` values have its
    types and only its columns are kept; without one all are text. A file is skipped whole if its header is no header
    or if it is compressed and breaks off. The parsed rows are staged once, so report and rows come from one scan.
    """
    dirs = [directory] if isinstance(directory, str) else list(directory)
    files = [f for d in dirs for f in list_files(spark, d) if f.endswith((".csv", ".csv.gz"))
             and not any(f.rsplit("/", 1)[-1].startswith(x) for x in exclude)]
    if not files:
        return None
    skipped = _broken_archives(spark, [f for f in files if f.endswith(".gz")])
    frames, text = [], T.StringType()
    seen = set()
    for header, group in csv_headers(spark, files).items():
        seen |= {_plain_path(f) for f in group}
        names = next(csv.reader([header]), [])
        if fault := _header_fault(names, schema) if names else None:
            skipped |= {_plain_path(f): skipped.get(_plain_path(f), fault) for f in group}
        good = [f for f in group if _plain_path(f) not in skipped]
        if not names or not good:
            continue
        names = [n.strip() for n in names]
        known = {f.name.lower(): f for f in schema.fields} if schema is not None else {}
        read = T.StructType([T.StructField(*((k.name, k.dataType) if (k := known.get(n.lower())) else (n, text)), True) for n in names] + [T.StructField(_BAD, text)])
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
              .option("enforceSchema", True).schema(read).csv(good))
        frames.append(df.select(*read.names, F.col("_metadata.file_path").alias(_FILE)))
    report = T.StructType([T.StructField("file", text), T.StructField("reason", text), T.StructField("empty", T.BooleanType())])
    listed = spark.createDataFrame([(p, skipped.get(p), p not in seen) for p in map(_plain_path, files)], report)
    if frames:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    else:
        rows = spark.createDataFrame([], T.StructType([*(schema.fields if schema is not None else []), T.StructField(_BAD, text), T.StructField(_FILE, text)]))
    if schema is not None:
        rows = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], _BAD, _FILE)
    rows = cut_lineage(rows.withColumn(_FILE, F.regexp_replace(_FILE, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")))
    bad = F.col(_BAD).isNotNull()
    counts = rows.groupBy(F.col(_FILE).alias("file")).agg(F.count_if(~bad).alias("records"), F.count_if(bad).alias("bad_records"))
    status = F.when(F.col("reason").isNotNull(), "skipped").when(F.col("empty"), "empty").when(F.col("bad_records") > 0, "partial").otherwise("ok")
    zero = F.lit(0).cast("long")
    filed = listed.join(counts, "file", "left").select("file", status.alias("status"), F.coalesce("records", zero).alias("records"),
                                                       F.coalesce("bad_records", zero).alias("bad_records"), "reason")
    return CsvFolder(rows.where(~bad).drop(_BAD, _FILE), rows.where(bad).select(F.col(_FILE).alias("file"), F.col(_BAD).alias("line")), filed)


def read_csv_dir(spark: SparkSession, directory: str | Sequence[str], exclude: Sequence[str] = ("all_",),
                 schema: T.StructType | None = None) -> DataFrame | None:
    """SRC-CSV: the well-formed rows of a folder of CSV files (``scan_csv_dir`` also gives the rest and a report)."""
    folder = scan_csv_dir(spark, directory, exclude, schema)
    return folder.rows if folder is not None else None


# ---------------------------------------------------------------------------------------------
# API documents

def body_schema(element: T.DataType, array: bool = True) -> T.StructType:
    return T.StructType([T.StructField("body", T.ArrayType(element) if array else element)])


S = T.StringType()
ODDS_FIELDS = ("totalOver", "totalUnder", "totalOverOdds", "totalUnderOdds", "homeTeamSpread", "awayTeamSpread",
               "homeTeamSpreadOdds", "awayTeamSpreadOdds", "homeTeamMLOdds", "awayTeamMLOdds")
GAME_FIELDS = ("gameID", "gameDate", "homeTeam", "awayTeam", "teamIDHome", "teamIDAway", "last_updated_e_time")
ODDS_DOC = body_schema(T.StructType(
    [T.StructField(f, S) for f in GAME_FIELDS]
    + [T.StructField("sportsBooks", T.ArrayType(T.StructType([
        T.StructField("sportsBook", S),
        T.StructField("odds", T.StructType([T.StructField(f, S) for f in ODDS_FIELDS]))])))]))
SALARY_ROW = T.StructType([T.StructField(f, S) for f in ("playerID", "longName", "pos", "team", "teamID", "salary")])
PLATFORM_ARRAYS = (("draftkings", "DraftKings"), ("fanduel", "FanDuel"), ("superdraft", "SuperDraft"))
SALARY_DOC = body_schema(T.StructType([T.StructField(k, T.ArrayType(SALARY_ROW)) for k, _ in PLATFORM_ARRAYS]),
                         array=False)


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """API response documents (one JSON document per line or per file) with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_body(spark: SparkSession, path: str, element: T.StructType) -> DataFrame:
    """SRC-JSON: one row per element of each document's ``body`` array."""
    docs = read_documents(spark, path, body_schema(element))
    return docs.select(F.explode("body").alias("b")).select("b.*")


def flatten_odds(docs: DataFrame) -> DataFrame:
    """SRC-ODDS: one row per (game, sportsbook) with 18 columns; a game without books gives no
    row (``explode``, not ``explode_outer``)."""
    g = docs.select(F.explode("body").alias("g"))
    b = g.select("g.*", F.explode("g.sportsBooks").alias("book"))
    return b.select(*GAME_FIELDS, F.col("book.sportsBook").alias("sportsbook"),
                    *[F.col(f"book.odds.{f}").alias(f) for f in ODDS_FIELDS])


def flatten_salaries(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """SRC-DFS: the per-platform arrays as one table tagged with ``platform`` plus a copy of
    ``salary`` as ``dfs_salary``; a missing or empty array gives no rows. ``carry`` names columns of the
    documents that each row keeps."""
    parts = []
    for key, platform in PLATFORM_ARRAYS:
        p = docs.select(*carry, F.explode(F.col(f"body.{key}")).alias("r")).select(*carry, "r.*")
        parts.append(p.withColumns({"platform": F.lit(platform), "dfs_salary": F.col("salary")}))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------------------------------------
# dates


def date_spine_between(df: DataFrame, lo: str, hi: str, alias: str = "d") -> DataFrame:
    """SRC-DATES: every day between the min of ``lo`` and the max of ``hi`` of a frame (bounds computed by Spark)."""
    b = df.agg(F.min(lo).alias("_a"), F.max(hi).alias("_b"))
    return b.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias(alias))


def season_range(season_year: int) -> tuple[dt.date, dt.date]:
    """SRC-SEASON: season Y runs from Oct 1 of Y-1 to Apr 30 of Y."""
    return dt.date(season_year - 1, 10, 1), dt.date(season_year, 4, 30)


def recent_range(days: int, as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None,
                 all_history: bool = False) -> tuple[dt.date, dt.date]:
    """SRC-RECENT: the last ``days`` days ending at ``as_of`` (``all_history`` starts 2020-01-01);
    an end after ``as_of`` is clamped; a start after the end is an error."""
    e = min(end or as_of, as_of)
    s = dt.date(2020, 1, 1) if all_history else (start or (e - dt.timedelta(days=days)))
    if s > e:
        raise ValueError(f"start {s} is after end {e}")
    return s, e


# ---------------------------------------------------------------------------------------------
# files as data: snapshots and summaries

# Collection timestamp suffix and per-type logical names of landing files.
TIMESTAMP_SUFFIX = r"_20\d{6}_\d{6}(?=(\.parquet)?$)"
LOGICAL_NAME_RULES = (
    (r"^player_logs_(\d{8})_game_\d{8}_(.+)\.parquet$", "player_logs_$1_$2.parquet"),
    (r"^player_logs_(\d{8})_game_(?:.*_)?([^_]+)\.parquet$", "player_logs_$1_$2.parquet"),
    (r"^(teams|players)_.*current.*\.parquet$", "$1_current.parquet"),
)


def logical_name(name_col) -> "F.Column":
    """SC-REGEX: strip the collection timestamp (of any year from 2000 on) at the name's end, a game date before it
    stays; then normalise per data type."""
    c = F.regexp_replace(name_col, TIMESTAMP_SUFFIX, "")
    for pattern, repl in LOGICAL_NAME_RULES:
        c = F.when(c.rlike(pattern), F.regexp_replace(c, pattern, repl)).otherwise(c)
    return c


def newest_per_key(df: DataFrame, key_col: str = "_file_key") -> DataFrame:
    """SNK-NEWEST re-aimed: rows of a file-backed frame restricted to the newest snapshot of every logical name.
    A snapshot is a folder of part files or a file of its own; its time is that of its last written file, ties go
    by path. All files of the snapshot stay. Works on the distinct file list, then a semi join."""
    with_meta = df.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_name").alias("_fn"),
                          F.col("_metadata.file_modification_time").alias("_fm"))
    is_part = F.col("_fn").startswith("part-")
    files = with_meta.select("_fp", "_fn", "_fm").distinct().select(
        "_fp", "_fm", F.when(is_part, F.regexp_replace("_fp", r"/[^/]+$", "")).otherwise(F.col("_fp")).alias("_snapshot"))
    files = files.withColumn(key_col, logical_name(F.regexp_extract("_snapshot", r"([^/]+)$", 1)))
    times = files.groupBy(key_col, "_snapshot").agg(F.max("_fm").alias("_fm"))
    newest = times.groupBy(key_col).agg(F.max_by("_snapshot", F.struct("_fm", "_snapshot")).alias("_snapshot"))
    keep = files.join(newest.select("_snapshot"), "_snapshot", "left_semi").select("_fp")
    return with_meta.join(keep, "_fp", "left_semi").drop("_fp", "_fn", "_fm")


def dataset_summary(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """SNK-SUMM: records per file (and per ``by`` columns, e.g. partition values) with file size;
    one scan of the data plus the file metadata Spark already has."""
    df = read_parquet(spark, path)
    cols = [*by, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")]
    return (df.select(*cols).groupBy(*by, "file_path")
            .agg(F.count(F.lit(1)).alias("records"), F.first("file_size").alias("file_size")))


def records_by(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """Record counts per partition value of a dataset (a summary independent of file layout)."""
    return read_parquet(spark, path).groupBy(*by).agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------------------------------------
# status of datasets

STATUS = "dataset string, status string, records long, n_columns long, files long, size_mb double, message string"


def _data_files(spark: SparkSession, path: str) -> list[int]:
    """Sizes of the data files of a dataset (metadata only); names that start with an underscore or a dot are none."""
    fs, root = hadoop_fs(spark, path)
    if not fs.exists(root):
        return []
    at, found, base = fs.listFiles(root, True), [], len(fs.makeQualified(root).toString())
    while at.hasNext():
        status = at.next()
        if not any(x[:1] in ("_", ".") for x in status.getPath().toString()[base:].split("/")):
            found.append(status.getLen())
    return found


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's whose parquet scans answer counts from the files' footers."""
    s = spark.newSession()
    s.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return s


def dataset_status(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """SNK-SUMM / AN-FACTS: a row for each dataset (name to path) and a ``total``: status, records, columns, files and
    size. ``not_collected`` is a dataset without files, ``error`` one that can't be read, with the message; neither
    stops the others. Counts come from the parquet footers (a pushed aggregate), no row is read; a row a dataset goes
    through the driver."""
    footers, out = footer_session(spark), []
    for name, path in datasets.items():
        sizes = _data_files(spark, path)
        row = {"dataset": name, "status": "not_collected", "records": None, "n_columns": None, "files": len(sizes),
               "size_mb": round(sum(sizes) / 2 ** 20, 2), "message": None}
        if sizes:
            try:
                df = footers.read.parquet(path)
                row |= {"records": df.agg(F.count(F.lit(1))).first()[0], "n_columns": len(df.columns), "status": "ok"}
            except Exception as e:  # noqa: BLE001 - whatever is wrong with one dataset is its status
                row |= {"status": "error", "message": str(e).split("\n")[0][:200]}
        out.append(row)
    total = {"dataset": "total", "status": "ok" if all(r["status"] == "ok" for r in out) else "incomplete", "n_columns": None, "message": None,
             "records": sum(r["records"] or 0 for r in out), "files": sum(r["files"] for r in out), "size_mb": round(sum(r["size_mb"] for r in out), 2)}
    names = [x.split()[0] for x in STATUS.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in [*out, total]], STATUS)
