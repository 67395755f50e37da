"""Separator scan: token counts of documents in flat, unindexed token files.

A flat file holds the ids of many documents one after the other, each ended
by a separator id; nothing says where they begin.  The files are cut into
blocks of equal size that any task can read; a block is searched for
separators with one vectorised comparison and reports their positions.

A document may span blocks.  Stitching is a prefix scan over the blocks of a
file (one small row per block): the running count of separators numbers the
documents, and the running maximum of the last separator's position is where
the document open at a block's beginning starts.

Defined cases: a null or empty text is a document that holds only its
separator; a text that spells the separator's name is ordinary text; ids
after the last separator of a file are an open document (``closed`` false);
empty files and tables give no rows.  A vocabulary whose ids don't fit ``dtype``
raises before anything is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .storage import make_folder, publishing, resolve, ship, stored, table_path

#: Ids below 65,536 fit two bytes, little-endian.
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 20


def write_flat(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, end_id: int = tokens.END_OF_TEXT, dtype: str = DTYPE,
) -> DataFrame:
    """Write one flat file of ids per task; returns which document is the nth of which file (part, nth, doc_id)."""
    tokens.require_width(dtype, end_id, tokenizer)
    ship(docs.sparkSession)
    make_folder(folder)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        with publishing(f"{folder}/part-{part:05d}.tok") as out:
            for b in batches:
                for _, _, ids, _ in tokens.encoded(b.column("text"), end_id, tokenizer):
                    out.write(ids.astype(dtype).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"),
                        pa.array(np.full(b.num_rows, part, np.int32)),
                        pa.array(np.arange(seen, seen + b.num_rows)),
                    ],
                    names=["doc_id", "part", "nth"],
                )
                seen += b.num_rows

    kind = src.schema["doc_id"].dataType.simpleString()
    return stored(src.mapInArrow(flat, f"doc_id {kind}, part int, nth long"), "flat-order")


def scan(
    spark: SparkSession, folder: str, end_id: int = tokens.END_OF_TEXT, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document of the flat files: part, nth, first_token, n_tokens (separator included), closed."""
    ship(spark)
    width = np.dtype(dtype).itemsize
    block_bytes = block_tokens * width
    blocks = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
        .filter("length > 0")
        .select(
            "path",
            F.regexp_extract("path", r"part-(\d+)\.tok$", 1).cast("int").alias("part"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {block_bytes}"))).alias("block"),
        )
    )
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, part, block in zip(*(b.column(c).to_pylist() for c in ("path", "part", "block")), strict=True):
                fs, path = resolve(uri)
                with fs.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(min(block_bytes, f.size() - block * block_bytes), block * block_bytes), dtype)
                at = np.flatnonzero(ids == end_id) + block * block_tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([block], pa.int64()),
                        pa.array([block * block_tokens + len(ids)], pa.int64()),
                        pa.array([len(at)], pa.int64()), pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                        pa.array([at], pa.list_(pa.int64())),
                    ],
                    names=["part", "block", "stop", "n_seps", "last_sep", "seps"],
                )

    found = stored(
        blocks.repartition(spread).mapInArrow(
            search, "part int, block long, stop long, n_seps long, last_sep long, seps array<long>"
        ),
        "separators",
    )
    # the prefix scan runs on one narrow row per block; the positions stay where they are
    scan_ = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select(
        "part", "block",
        F.coalesce(F.sum("n_seps").over(scan_), F.lit(0)).alias("nth0"),
        F.coalesce(F.max("last_sep").over(scan_) + 1, F.lit(0)).alias("open_at"),
    )
    ended = (
        found.filter("n_seps > 0")
        .join(carried, ["part", "block"])
        .select(
            "part", "nth0",
            F.posexplode(F.arrays_zip("seps", F.concat(F.array("open_at"), F.transform("seps", lambda x: x + 1)).alias("begins"))),
        )
        .filter(F.col("col.seps").isNotNull())
        .select(
            "part", (F.col("nth0") + F.col("pos")).alias("nth"), F.col("col.begins").alias("first_token"),
            (F.col("col.seps") + 1 - F.col("col.begins")).alias("n_tokens"), F.lit(True).alias("closed"),
        )
    )
    open_ = (
        found.groupBy("part")
        .agg(F.sum("n_seps").alias("nth"), F.coalesce(F.max("last_sep") + 1, F.lit(0)).alias("first_token"), F.max("stop").alias("stop"))
        .filter("stop > first_token")
        .select("part", "nth", "first_token", (F.col("stop") - F.col("first_token")).alias("n_tokens"), F.lit(False).alias("closed"))
    )
    return ended.unionByName(open_)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Write the documents as flat files, scan these, and give each document its count: doc_id, n_tokens, part, nth, first_token."""
    spark = docs.sparkSession
    folder = table_path(spark, "flat")
    order = write_flat(docs, folder, id_col, text_col, tokenizer)
    return order.join(scan(spark, folder), ["part", "nth"], "left").select(
        "doc_id", "n_tokens", "part", "nth", "first_token"
    )
