"""Files and intermediate tables in the cluster's shared folder.

The folder is the one named by ``spark.checkpoint.dir``.  Tables are written
and read by Spark; the few formats that Spark has no writer for (WARC
archives, flat token files, model levels) are written by tasks through
``pyarrow.fs`` under a final name that depends on the content's partition
only, by way of a temporary name and a rename, so a repeated or speculative
attempt replaces a file by the same bytes.
"""

from __future__ import annotations

import os
import uuid
import zipfile
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ratecraft.session import scratch_path


#: Rows per Arrow batch: documents are long, and a batch is held whole on both sides of the pipe.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code (once per context), as ``--py-files`` would, and bound Arrow batches."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_ratecraft_shipped", False):
        return
    import tempfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # the driver's own copy of the archive; Spark's file server hands it out
    archive = os.path.join(tempfile.mkdtemp(prefix="ratecraft-code-"), "ratecraft_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._ratecraft_shipped = True


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder."""
    ship(spark)
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or table_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column begins so, in upper or lower case."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = "_" + name
    return name


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]  # Spark's spelling of local paths
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    fs, path = resolve(uri)
    fs.create_dir(path, recursive=True)


@contextmanager
def publishing(uri: str):
    """A stream whose bytes appear under ``uri`` only when all are written."""
    fs, path = resolve(uri)
    folder, name = path.rsplit("/", 1)
    hidden = f"{folder}/_{name}.{uuid.uuid4().hex[:8]}"
    try:
        with fs.open_output_stream(hidden, compression=None) as out:
            yield out
        fs.move(hidden, path)
    except BaseException:
        if fs.get_file_info(hidden).type != pafs.FileType.NotFound:
            fs.delete_file(hidden)
        raise


def mapped(uri: str) -> pa.Buffer:
    """The bytes of a file: memory-mapped on a mounted folder, read from an object store otherwise."""
    fs, path = resolve(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(path) as m:
            return m.read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()
