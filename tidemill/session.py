"""Session helpers.

The library never reads or writes a machine-local folder on its own: every
staging file, table version and checkpoint lives under the shared folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is unset (local
runs, tests) does :func:`work_dir` create a fresh folder and register it.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_lock = threading.Lock()


def is_local(master: str | None) -> bool:
    """Whether driver and executors are one process (``local``, ``local[8]``)."""
    return bool(master) and (master == "local" or master.startswith("local["))


def get_spark(master: str | None = None, app_name: str = "tidemill",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions or is_local(master):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    if is_local(master):  # a cluster's own settings stand
        builder = builder.config("spark.driver.memory", "16g")
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stages and table versions.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir); a fresh one is
    set only in local mode, and only where none is configured.
    """
    with _lock:
        try:
            sc = spark.sparkContext
        except Exception:  # noqa: BLE001 - Spark Connect sessions expose no context
            d = spark.conf.get("spark.checkpoint.dir", None)
            if not d:
                raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
            return d.rstrip("/")
        d = sc.getCheckpointDir()
        if not d:
            d = sc.getConf().get("spark.checkpoint.dir", None)
            if not d:
                if not is_local(sc.master):
                    raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
                d = tempfile.mkdtemp(prefix="tidemill-")
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        return d.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unique location under :func:`work_dir` (never reused)."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def spread(scan):
    """A table scan over all cores: one with fewer splits than cores is dealt out, any other stays as it is, unshuffled.

    For work that is heavy for its bytes, such as parsing pages. Only for plain scans: the splits of
    a plan with shuffles are known when it has run.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def stage(df, label: str = "stage"):
    """Write ``df`` once as Parquet under the shared work folder and read it back.

    For inputs that several jobs read (checks, then the load) and that are
    costly to re-derive — text sources above all: the text is parsed once, and
    the later jobs scan columns with pruning and pushdown. The staged copy also
    cuts the lineage, so a lost executor never re-parses the source.
    """
    return staged(df, label)[0]


def staged(df, label: str = "stage"):
    """:func:`stage`, and the folder, for :func:`discard` when no plan reads it any more."""
    path = fresh_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path), path


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Within this, a query's shuffle files are freed when it ends; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder under :func:`work_dir`, or a table's own, on the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def run_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which a later session finds again (:func:`work_dir` is a session's own in it);
    where it is unset, :func:`work_dir`."""
    return (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or work_dir(spark)).rstrip("/")
