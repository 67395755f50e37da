"""Session construction and shared-storage helpers.

Everything that depends on the cluster (checkpoint folder, shuffle width)
is read from the session; defaults are only filled in where a setting is
missing, which is the case in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on. Timestamps are parsed and
# reported in UTC (the plan files carry "...Z" instants), and AQE is on so
# that join strategy, partition coalescing and skew splitting are decided
# from runtime statistics instead of guesses.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "ratecraft",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Date parts of the plan dates are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session whose executors are this process (``local`` masters, as in
    tests) may go without the setting and gets a folder of its own, which is
    removed at exit.  Anywhere else a missing setting is an error: a folder
    on one machine's disk would lose data.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ratecraft-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


_HANDED_OUT: list[str] = []
_TABLES: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder; ``release_scratch`` deletes it."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _HANDED_OUT.append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete everything written under paths of ``scratch_path``, once no result is read from it any more."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _HANDED_OUT:
        path = jvm.org.apache.hadoop.fs.Path(_HANDED_OUT.pop())
        path.getFileSystem(conf).delete(path, True)


def dealt_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """The table written to the shared folder in buckets of a column, and read back.

    Windows, aggregates and joins on the column then need no shuffle.  The
    table is external and unique to the call; ``release_scratch`` drops it.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    _TABLES.append(table)
    df.repartition(n, column).write.bucketBy(n, column).sortBy(column).option("path", path).saveAsTable(table)
    return spark.table(table)


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside take tables dealt by one of their keys as they lie, not dealt again by all keys.

    The setting is the session's, so it is put back at the end, and what needs it is run (``landed``) inside.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def landed(df: DataFrame) -> DataFrame:
    """The table written once as Parquet to the shared folder and read back; ``release_scratch`` deletes it.

    For hourly rows and plan rows with their hours: stored by column and
    compressed they take some hundredths of a checkpoint, which holds plain
    rows and computes them twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "landed")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
