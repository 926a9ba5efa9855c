"""SparkSession construction with the settings every plan in this package assumes.

The library never overrides settings a cluster already defines: ``get_session`` only fills in
values that are unset, so a spark-submit / cluster config always wins.
"""

from __future__ import annotations

import atexit
import logging
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings the plans rely on. ANSI stays on (errors instead of silent overflow); the session time
# zone is UTC so that dates derived from timestamps agree with the DuckDB oracle.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "courtline", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session or build one; only unset settings are filled in."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    from pyspark import SparkConf
    preset = dict(SparkConf().getAll())  # what spark-submit / the cluster already set
    conf = {k: v for k, v in DEFAULTS.items() if k not in preset}
    if shuffle_partitions is not None and "spark.sql.shuffle.partitions" not in preset:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})  # explicit arguments of the caller win
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process, so a machine-local folder is seen by all of them."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging tables: the cluster's ``spark.checkpoint.dir``.

    Only on a local master, when the session has none (local tests), a private scratch folder is made.
    On a cluster a missing setting is an error: executors don't see the driver's local folders.
    """
    cp = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if cp:
        return cp.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="courtline-cp-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make ``DataFrame.checkpoint()`` usable: point the context at the shared checkpoint root, if it has one."""
    if not is_local(spark) and not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        return None  # staging raises once it is needed
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


_scratch: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint root for staged tables (never a machine-local folder on a
    cluster). What is left under it when the driver's interpreter ends is removed."""
    if not _scratch:
        atexit.register(_sweep)
    path = f"{checkpoint_root(spark)}/courtline-staging/{name}"
    _scratch[path] = spark
    return path


def hadoop_fs(spark: SparkSession, path: str):
    """The cluster's file system for a path, and the path as it knows it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the cluster's file system (metadata only)."""
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def bytes_under(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path (metadata only), 0 if it does not exist."""
    fs, p = hadoop_fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or staged folder through the cluster's file system."""
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)
    _scratch.pop(path, None)


def leaf_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders so many levels under a path, relative to it (metadata only); none if the path does not exist."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    found = [("", p)]
    for _ in range(depth):
        found = [(f"{name}/{s.getPath().getName()}".lstrip("/"), s.getPath()) for name, at in found
                 for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
    return [name for name, _ in found]


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a folder (metadata only)."""
    fs, p = hadoop_fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder through the cluster's file system; folders above its new place are made."""
    fs, p = hadoop_fs(spark, path)
    fs.mkdirs(hadoop_fs(spark, to)[1].getParent())
    if not fs.rename(p, hadoop_fs(spark, to)[1]):
        raise OSError(f"{path} could not be moved to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or as it was before: written beside its place, then moved over it in one step."""
    fs, p = hadoop_fs(spark, path)
    _, beside = hadoop_fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    over = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), context._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), fs.makeQualified(p), over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is none."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _sweep() -> None:
    for path, spark in list(_scratch.items()):
        if spark.sparkContext._jsc is None:  # the session is stopped, its file system is gone
            return
        try:
            remove_path(spark, path)
        except Exception as e:  # noqa: BLE001 - a folder that can't be removed must not fail the exit
            log.debug("staging folder %s stays: %s", path, e)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for the queries run inside."""
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shuffles_dropped(spark: SparkSession):
    """The shuffle files of each query run inside are removed when it ends: what it wrote is read from now on."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def cut_lineage(df):
    """Stage ``df`` as parquet in the shared folder and read it back: a lineage cut that survives executor
    loss, is columnar and is pruned by each branch that reads it (never ``localCheckpoint``)."""
    path = scratch_path(df.sparkSession, f"cut-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
