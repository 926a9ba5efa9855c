"""Helpers shared by the operators: staged tables in the cluster's shared folder, hot-key-safe joins."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application: tasks import it wherever the driver found it. To be
    called before a Python function is put into a plan."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"courtline-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under ``spark.checkpoint.dir`` and read it back: a lineage cut that
    survives lost executors, is columnar and can be pruned by the branches that read it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batch_bytes(spark: SparkSession, size: int):
    """Arrow batches of ``size`` bytes at most (one larger row is a batch) for the jobs run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return freed memory of this worker to the system: workers are used again, and allocators keep what they had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # another C library has no such call
        pass


def lower_ascii(col) -> "F.Column":
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner",
           heavy: int = 1000) -> DataFrame:
    """``rows`` joined with one row per key of ``groups``, whose column ``size`` counts the rows of the key.

    Keys with at least 1/``heavy`` of all rows are joined by broadcast: there can be at most ``heavy`` of
    them, because their sizes add up to no more than the total. All other keys are small against the
    table and go through an ordinary shuffle join, so no task receives a hot key. Both inputs should be
    cheap to read twice (staged). ``how``: ``inner`` or ``left``; the join key is null-safe only in the
    sense that null keys match nothing."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    cut = max(2.0, total / heavy)
    big = groups.where(F.col(size) >= cut)
    rest = groups.where(F.col(size) < cut)
    hot = rows.join(F.broadcast(big), keys, "inner")
    cold = rows.join(F.broadcast(big.select(*keys)), keys, "left_anti").join(rest, keys, how)
    return hot.unionByName(cold)


def row_hash(id_col: str, text_col: str):
    """64-bit hash of a row's id and text; null and empty texts are equal, a null id differs from any other."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(-1).cast("long")), F.col(id_col).isNull(),
                      F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` (a long, dropped) says, a thousand at a time."""
    one = F.lit(1).cast("long")
    rows = rows.where(F.col(times) > 0).withColumn("__block", F.explode(F.sequence(one - 1, F.floor((F.col(times) - 1) / 1000).cast("long"))))
    rows = rows.withColumn("__again", F.explode(F.sequence(one, F.least(one * 1000, F.col(times) - 1000 * F.col("__block")))))
    return rows.drop("__block", "__again", times)
