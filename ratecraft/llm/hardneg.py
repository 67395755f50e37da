"""Hard-negative mining with segment summaries.

For every anchor the best rows of its label are its positives, and for each
positive the best rows of other labels whose score lies in a band under the
positive's score are its hard negatives.  A score is an inner product of whole
numbers.  The result is exact.

1. Each vector is stored with summaries: for 1, 4 and 16 segments (``LEVELS``)
   the segments' means and deviations.  With x = mean + rest in every segment,
   an inner product is the sum of the means' products (times the length) and of the
   rests' products, and the latter are bounded by the products of the
   deviations, from above and below.
2. Anchors and rows meet in pairs of blocks of bounded size (an equi-join on the
   pair).  In a pair of blocks the bounds of one segment are computed first; rows
   that can't be among an anchor's best, or in any of its bands, go, and what is left is
   refined with more segments, then scored exactly.
3. Each pair of blocks names its best few for each anchor, and a window keeps
   the best of these.  The first visit finds the positives, the second one the
   negatives in the positives' bands.

Defined cases: rows with a null id, a null label, a null vector or a null or
non-finite component take no part; vectors of different lengths are compared
over the shorter one (the rest counts as 0), an empty vector scores 0; repeated rows
are rows of their own, so a copy of an anchor can be its positive; ties go to
the smaller id; scores beyond 64 bits count as the largest or smallest long; an empty table, or one without
anchors, gives no rows.  Texts are not read, and other columns, whatever their
names, are not either.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import ship, stored, table_path

#: Segments of a vector on each level of the summaries.
LEVELS = (1, 4, 16)
#: Expected rows and anchors of a block.
ROWS = 2048
ANCHORS = 512
#: Pairs of an anchor and a row worked on at a time.
CHUNK = 1 << 20
#: Share of pairs left under which they are scored one by one.
SPARSE = 0.1
#: Whole numbers up to this are exact as doubles.
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Mining:
    """``low`` to ``high`` percent of the positive's score is the band of its negatives."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    #: a component counts as floor(scale * x)
    scale: float = 256.0


def summaries(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means (times the root of the segment's length) and deviations of all levels' segments, one row per vector."""
    n, dims = v.shape
    means, devs = [], []
    for parts in LEVELS:
        edge = np.unique(np.linspace(0, dims, min(parts, max(dims, 1)) + 1).astype(int))
        at = np.zeros((n, parts)), np.zeros((n, parts))
        for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            mean = v[:, lo:hi].mean(axis=1)
            at[0][:, k] = mean * np.sqrt(hi - lo)
            at[1][:, k] = np.sqrt(((v[:, lo:hi] - mean[:, None]) ** 2).sum(axis=1))
        means.append(at[0])
        devs.append(at[1])
    return np.concatenate(means, axis=1), np.concatenate(devs, axis=1)


def _rows_of(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long binaries of doubles as a matrix."""
    values = col.to_pylist()
    return np.frombuffer(b"".join(values), dtype="<f8").reshape(len(values), -1) if values else np.empty((0, 0))


def _unpacked(col: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Stored vectors as a matrix of doubles."""
    out = np.zeros((len(col), dims))
    if not dims:
        return out
    for i, raw in enumerate(col.to_pylist()):
        out[i] = np.frombuffer(raw, dtype="<i4" if len(raw) == 4 * dims else "<f8")
    return out


def with_summaries(vectors: DataFrame, dims: int, scale: float) -> DataFrame:
    """(uid, id, label, anchor, embedding) to the stored form: whole components as bytes, and all levels' means and deviations."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("embedding")
            off = lists.offsets.to_numpy()
            size = np.diff(off)
            v = np.zeros((len(lists), dims))
            v[np.arange(dims) < size[:, None]] = np.floor(lists.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]].astype(np.float64) * scale)
            means, devs = summaries(v)
            small = (np.abs(v) < 2**31).all(axis=1)
            raw = [(x.astype("<i4") if s else x.astype("<f8")).tobytes() for x, s in zip(v, small.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("uid", "id", "label", "anchor")], pa.array(raw, pa.binary()),
                 pa.array([x.tobytes() for x in means], pa.binary()), pa.array([x.tobytes() for x in devs], pa.binary())],
                names=["uid", "id", "label", "anchor", "vector", "means", "devs"],
            )

    return vectors.mapInArrow(pack, "uid long, id long, label string, anchor boolean, vector binary, means binary, devs binary")


class Block:
    """Vectors of one side of a pair of blocks, with their summaries."""

    def __init__(self, t: pa.Table, dims: int):
        self.uid = t.column("uid").to_numpy()
        self.id = t.column("id").to_numpy()
        self.label = np.array(t.column("label").to_pylist(), dtype=object)
        self.v = _unpacked(t.column("vector"), dims)
        self.means, self.devs = _rows_of(t.column("means")), _rows_of(t.column("devs"))
        self.most = np.abs(self.v).max(initial=0.0)


def bounds(a: Block, i: np.ndarray, r: Block, j: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors i with rows j from the summaries of a level."""
    lo = sum(LEVELS[:level])
    at = slice(lo, lo + LEVELS[level])
    centre = a.means[i, at] @ r.means[j, at].T
    slack = a.devs[i, at] @ r.devs[j, at].T
    slack += 1e-9 * (np.abs(centre) + slack) + 1e-6  # rounding
    return centre - slack, centre + slack


def scores(a: Block, i: np.ndarray, r: Block, j: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, exact score) of the pairs that are alive, as places in i and j."""
    x, y = np.nonzero(alive)
    if a.most * r.most * max(a.v.shape[1], 1) >= _EXACT:
        whole = [sum(int(p) * int(q) for p, q in zip(a.v[i[m]], r.v[j[n]], strict=True)) for m, n in zip(x, y, strict=True)]
        return x, y, np.array([min(max(s, -_LONG), _LONG) for s in whole], dtype=np.int64)
    if len(x) < SPARSE * alive.size:
        s = np.einsum("ij,ij->i", a.v[i[x]], r.v[j[y]])
    else:
        s = (a.v[i] @ r.v[j].T)[x, y]
    return x, y, np.rint(s).astype(np.int64)


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, ~score, group))  # ~ turns the order round without overflow
    g = group[order]
    nth = np.arange(len(g)) - np.searchsorted(g, g)
    return order[nth < k]


def _kth(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity if there are fewer."""
    if x.shape[1] < k:
        return np.full(len(x), -np.inf)
    return np.partition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k]


def best_rows(a: Block, r: Block, same: bool, k: int, low: np.ndarray | None = None, high: np.ndarray | None = None):
    """(anchor, band, row, score) of the k best rows of each anchor, of its label (``same``) or of others, in each of its bands.

    ``low`` and ``high`` have a row per anchor and a column per band; without them there is one band without ends.
    """
    if low is None:
        low, high = np.full((len(a.uid), 1), -np.inf), np.full((len(a.uid), 1), np.inf)
    exact_low, exact_high, low, high = low, high, low.astype(np.float64), high.astype(np.float64)
    out = []
    for label in sorted(set(a.label.tolist())):
        mine, rows = np.flatnonzero(a.label == label), np.flatnonzero((r.label == label) == same)
        step = max(1, CHUNK // max(1, len(rows)))
        for at in range(0, len(mine), step):
            i, j = mine[at : at + step], rows
            least = low[i].copy()  # a row needs this score to matter in a band
            alive = a.uid[i][:, None] != r.uid[j][None, :]
            for level in range(len(LEVELS)):
                lo, hi = bounds(a, i, r, j, level)
                needed = np.zeros_like(alive)
                for band in range(low.shape[1]):
                    sure = alive & (lo >= low[i, band][:, None]) & (hi <= high[i, band][:, None])
                    least[:, band] = np.maximum(least[:, band], _kth(np.where(sure, lo, -np.inf), k))
                    needed |= (hi >= least[:, band][:, None]) & (lo <= high[i, band][:, None])
                alive &= needed
                some = alive.any(axis=0)
                j, alive = j[some], alive[:, some]
            x, y, s = scores(a, i, r, j, alive)
            for band in range(low.shape[1]):
                fits = np.flatnonzero((s >= exact_low[i[x], band]) & (s <= exact_high[i[x], band]))
                top = fits[first_of(x[fits], s[fits], r.id[j[y[fits]]], k)]
                out.append((i[x[top]], np.full(len(top), band), j[y[top]], s[top]))
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _paired(rows: DataFrame, anchors: DataFrame, row_blocks: int, anchor_blocks: int):
    """Rows and anchors grouped by the pair of their blocks."""
    block = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("*", block(row_blocks).alias("rb"), each(anchor_blocks).alias("ab"))
    right = anchors.select("*", block(anchor_blocks).alias("ab"), each(row_blocks).alias("rb"))
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb"))


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    cfg: Mining = Mining(),
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` says which rows are anchors."""
    spark = vectors.sparkSession
    ship(spark)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    dims = named.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    path = table_path(spark, "hardneg-vectors")
    rows = stored(with_summaries(named, dims, cfg.scale), "hardneg-vectors", path)
    count = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("anchor"), 1)).alias("anchors")).first()
    row_blocks, anchor_blocks = max(1, -(-count["rows"] // ROWS)), max(1, -(-count["anchors"] // ANCHORS))
    anchors = spark.read.schema(rows.schema).parquet(path).filter("anchor")  # read anew: both sides of a cogroup need columns of their own

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        a, r = Block(right, dims), Block(left, dims)
        i, _, j, s = best_rows(a, r, True, cfg.positives)
        return pa.table({"anchor_uid": a.uid[i], "anchor_id": a.id[i], "positive_id": r.id[j], "positive_score": s})

    found = _paired(rows, anchors, row_blocks, anchor_blocks).applyInArrow(
        positives, "anchor_uid long, anchor_id long, positive_id long, positive_score long"
    )
    by_score = Window.partitionBy("anchor_uid").orderBy(F.col("positive_score").desc(), "positive_id")
    best = stored(
        found.withColumn("nth", F.row_number().over(by_score)).filter(F.col("nth") <= cfg.positives),
        "hardneg-positives",
    )

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        a, r = Block(right, dims), Block(left, dims)
        # long doubles hold every long
        shape = (len(a.uid), cfg.positives)
        low, high = np.full(shape, np.inf, np.longdouble), np.full(shape, -np.inf, np.longdouble)
        for k, bands in enumerate(right.column("bands").to_pylist()):
            for b in bands:
                # the whole scores s with low * p <= 100 * s <= high * p
                low[k, b["nth"] - 1] = -(-cfg.low * b["positive_score"] // 100)
                high[k, b["nth"] - 1] = cfg.high * b["positive_score"] // 100
        i, band, j, s = best_rows(a, r, False, cfg.negatives, low, high)
        return pa.table({"anchor_uid": a.uid[i], "nth": (band + 1).astype(np.int32), "negative_id": r.id[j], "negative_score": s})

    bands = best.groupBy("anchor_uid").agg(F.collect_list(F.struct("nth", "positive_score")).alias("bands"))
    asked = anchors.join(bands, F.col("uid") == F.col("anchor_uid")).drop("anchor_uid")
    near = _paired(rows, asked, row_blocks, anchor_blocks).applyInArrow(
        negatives, "anchor_uid long, nth int, negative_id long, negative_score long"
    )
    by_score = Window.partitionBy("anchor_uid", "nth").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= cfg.negatives)
    return ranked.join(best, ["anchor_uid", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
