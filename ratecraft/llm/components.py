"""Connected components of an edge table, by contraction and pointer jumping.

1. Each partition unites its own edges (a union-find in one task over a
   partition's rows) and keeps a forest: an edge from each vertex to the
   smallest vertex of its part.  This is narrow, and a vertex is left with at
   most one edge per partition, however many it had.
2. The forests are dealt by their upper vertex and united again.  All edges
   of that vertex meet, so one parent remains; parts that met through it leave
   edges between their lower vertices, which are far fewer.  This repeats
   until no such edge appears, and every vertex has one parent.
3. Parents are smaller vertices; replacing each parent by its own parent,
   until nothing changes, gives every vertex its component's smallest.

Every round is written to the shared folder; edges never come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import ship, stored

EDGE = "u long, v long"


def unite(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, smallest vertex of each one's part) of an edge list."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return ids, ids[root]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up


def _edges(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _batch(u: np.ndarray, v: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"u": pa.array(u), "v": pa.array(v)} | {k: pa.array(x) for k, x in more.items()})


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, root = unite(*_edges(batches))
    yield _batch(ids[ids != root], root[ids != root])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = _edges(batches)
    ids, root = unite(u, v)
    mine = np.isin(ids, u)  # their edges are all here
    rest = ~mine & (ids != root)
    yield _batch(ids[mine | rest], root[mine | rest], settled=mine[mine | rest])


def stars(edges: DataFrame) -> DataFrame:
    """(u, root) with root < u for every vertex that isn't its component's smallest; ``edges`` has long columns u, v."""
    ship(edges.sparkSession)
    left = edges.select("u", "v").mapInArrow(_forest, EDGE)
    while True:
        found = stored(left.repartition("u").mapInArrow(_settle, EDGE + ", settled boolean"), "forest")
        left = found.select("u", "v")
        if found.filter("not settled").first() is None:
            break
    parents = left.withColumnRenamed("v", "root")
    while True:
        up = parents.select(F.col("u").alias("root"), F.col("root").alias("above"))
        jumped = stored(
            parents.join(up, "root", "left").select("u", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
            "parents",
        )
        parents = jumped.select("u", "root")
        if jumped.filter("moved").first() is None:
            return parents
