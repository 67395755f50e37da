"""Sharding by jump consistent hashing.

A stable 64-bit key (the hash of the document's id) is mapped to one of n
shards by the jump consistent hash: no ring table, and going from n to n + 1
shards moves 1 / (n + 1) of the rows, all of them into the new shard.

Slots (gapless positions inside a shard) need a count over all rows.  Each
task numbers its own rows per shard; the counts per (task, shard), which are
few, are summed up by a window over the tasks, and every row adds its task's
offset.  No shard's rows meet in one task.

Defined cases: a null key hashes to one fixed value, a null text has no
bytes and the checksum of the empty text, repeated rows get slots of their
own in the same shard, an empty table gives no rows; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import ship, stored

#: Bytes that a row takes besides its text.
ROW_BYTES = 16

_STEP = np.uint64(2862933555777941757)
_ONE = np.uint64(1)
_SHIFT = np.uint64(33)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys, vectorised."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    keys = keys.astype(np.uint64).copy()
    bucket = np.zeros(len(keys), dtype=np.int64)
    nxt = np.zeros(len(keys), dtype=np.int64)
    open_ = np.arange(len(keys))
    while len(open_):
        bucket[open_] = nxt[open_]
        k = keys[open_] * _STEP + _ONE
        keys[open_] = k
        leap = (bucket[open_] + 1) * (float(1 << 31) / ((k >> _SHIFT) + _ONE).astype(np.float64))
        nxt[open_] = leap.astype(np.int64)
        open_ = open_[nxt[open_] < shards]
    return bucket


def stable_key(*cols: str) -> Column:
    """The key that decides the shard; it depends on the columns' values alone."""
    return F.xxhash64(*cols)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key column."""

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        k = keys.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
        return pa.array(jump(k, shards).astype(np.int32))

    return place(key)


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        stable_key(id_col).alias("key"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for b in batches:
            key = b.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            shard = jump(key, shards)
            order = np.argsort(shard, kind="stable")
            s = shard[order]
            nth = np.empty(len(s), dtype=np.int64)
            nth[order] = np.arange(len(s)) - np.searchsorted(s, s) + seen[s]
            seen += np.bincount(shard, minlength=shards)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), b.column("size"), b.column("text_crc32"),
                    pa.array(shard.astype(np.int32)), pa.array(jump(key, shards + 1).astype(np.int32)),
                    pa.array(np.full(len(s), task, dtype=np.int32)), pa.array(nth),
                ],
                names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "task", "nth"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    placed = stored(
        rows.mapInArrow(
            place,
            f"doc_id {id_type}, size long, text_crc32 long, shard int, grown_shard int, task int, nth long",
        ),
        "shards",
    )
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "task")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    return placed.join(offsets, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.col("nth")).alias("slot"), "grown_shard",
    )


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``docs`` to one folder per shard; each task writes its rows of each shard, without a shuffle."""
    ship(docs.sparkSession)
    docs.withColumn("shard", shard_of(stable_key(id_col), shards)).write.partitionBy("shard").parquet(path)
