"""Spark session settings and the shared checkpoint folder.

The builder only fills in settings that are still unset, so a cluster's own
configuration (shuffle partitions, checkpoint dir, memory) always wins.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine relies on: AQE re-plans joins and coalesces small shuffle
# partitions at runtime, splits skewed join partitions, and session time is UTC so
# DATE -> TIMESTAMP casts (month truncation, stream watermarks) are stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "quartermaster",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with DEFAULT_CONF.

    ``master`` and ``shuffle_partitions`` are only applied when given (tests and
    bench pass ``local[N]``); on a cluster the submitted configuration is kept.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # getOrCreate() on an existing session ignores builder options for
        # runtime-settable SQL confs; set those we own only where unset.
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; set a local one only if the session has none.

    On a cluster the folder is the shared one named in the submitted config; the
    local fallback exists for tests and the single-machine bench only.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: the star, "
                               "stream state and benchmark runs are written there")
        path = tempfile.mkdtemp(prefix="qm-ckpt-", dir=os.environ.get("QM_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return str(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on the (shared) file system of the session."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Give a finished folder its name: readers see all of its files or none.

    One rename, which is atomic on HDFS and POSIX file systems. A folder that is already
    there is a finished one of an earlier try and stays.
    """
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(dst):
        return
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst) and not fs.exists(dst):
        raise OSError(f"{staged} could not be renamed to {path}")


@contextmanager
def open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Writes by partition keep a file open for each of ``n`` folders, and need no sort by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def input_state(spark: SparkSession, path: str) -> str:
    """Size, file count and modification time of a table's path, as one text.

    Two calls to the file system whatever the number of files: a folder's own
    time changes when a file of it is added, removed or replaced.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    summary = fs.getContentSummary(p)
    return f"{summary.getLength()}-{summary.getFileCount()}-{fs.getFileStatus(p).getModificationTime()}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint dir for tables this engine writes itself.

    ``quartermaster.run.tag`` (set by tests and the bench) puts a run's files in
    their own folder, so a run never reuses or clears another run's files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tag = spark.conf.get("quartermaster.run.tag", "")
    return f"{base}/quartermaster/{tag + '/' if tag else ''}{name}"
