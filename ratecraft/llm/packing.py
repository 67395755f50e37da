"""Packing by non-negative least squares over the histogram of lengths.

1. Documents are tokenised and cut into pieces of at most one window: whole
   windows, and a remainder.  Lengths are counted in bins of a few tokens.
2. All shallow combinations (at most ``depth`` bins) that fill a window
   exactly are enumerated.  Non-negative least squares gives how often to use
   each so that the combinations' bins match the histogram; the counts are
   rounded to whole numbers that the histogram can serve.
   Only the histogram (one number per bin) comes to the driver.
3. Every piece has a rank in its bin (its task's offset plus its number in
   the task), and the plan's ranges of ranks name its sequence and place: no
   shuffle brings pieces together to be packed.
4. Pieces that the plan leaves over are ranked by falling length and dealt
   round-robin to groups of bounded size; each group is packed greedily (best
   fit, longest first) in one task.

Defined cases: a null or empty text is one piece that holds only the end id;
texts of any length are cut without loss; repeated rows are packed as often
as they come; a null id is kept; an empty table gives no rows.  A text that
spells a special token of the vocabulary has that token's id there, as the
tokenizer's own ``encode`` gives it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .storage import ship, stored


@dataclass(frozen=True)
class Packing:
    window: int = 1024
    #: tokens per bin of the histogram; must divide the window
    bin_tokens: int = 8
    #: most pieces in an enumerated combination
    depth: int = 4
    #: pieces that one task packs greedily at a time
    group: int = 4096
    #: id that ends each document
    end_id: int = 0

    @property
    def bins(self) -> int:
        return self.window // self.bin_tokens


def cut(
    docs: DataFrame, cfg: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents: doc_id, start, length, ids_crc32, doc_tokens, bin, task, nth (and ids, if asked for).

    ``nth`` numbers a task's pieces of one bin, so (task, bin, nth) names a piece.
    """
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    window, width, bins, end_id = cfg.window, cfg.bin_tokens, cfg.bins, cfg.end_id

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(bins + 1, dtype=np.int64)
        for b in batches:
            doc_ids = b.column("doc_id")
            for lo, hi, ids, off in tokens.encoded(b.column("text"), end_id, tokenizer, special=True):
                size = np.diff(off)
                n = -(-size // window)
                doc = np.repeat(np.arange(hi - lo), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
                length = np.minimum(size[doc] - start, window)
                begin = off[doc] + start
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                spans = [raw[4 * s : 4 * e] for s, e in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                crc = np.fromiter(map(zlib.crc32, spans), dtype=np.int64, count=len(doc))
                bin_ = -(-length // width)
                order = np.argsort(bin_, kind="stable")
                s = bin_[order]
                nth = np.empty(len(s), dtype=np.int64)
                nth[order] = np.arange(len(s)) - np.searchsorted(s, s) + seen[s]
                seen += np.bincount(bin_, minlength=bins + 1)
                cols = {
                    "doc_id": doc_ids.slice(lo, hi - lo).take(pa.array(doc)), "start": pa.array(start),
                    "length": pa.array(length), "ids_crc32": pa.array(crc), "doc_tokens": pa.array(size[doc]),
                    "bin": pa.array(bin_.astype(np.int32)), "task": pa.array(np.full(len(doc), task, np.int32)),
                    "nth": pa.array(nth),
                }
                if with_ids:
                    cols["ids"] = pa.array([x.tobytes() for x in spans], type=pa.binary())
                yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    kind = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, bin int, task int, nth long"
    return src.mapInArrow(pieces, schema + (", ids binary" if with_ids else ""))


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All sets of at most ``depth`` bins, falling, that add up to ``bins``."""

    def fill(left: int, most: int, slots: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif slots:
            for first in range(min(left, most), (left - 1) // slots, -1):
                for rest in fill(left - first, first, slots - 1):
                    yield (first, *rest)

    return list(fill(bins, bins, depth))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b| (active sets, after Lawson and Hanson)."""
    n = a.shape[1]
    x = np.zeros(n)
    passive: list[int] = []
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        w = a.T @ (b - a @ x)
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= tol:
            break
        passive.append(j)
        while True:
            z = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[passive] = z
                break
            xp = x[passive]
            neg = z <= 0
            step = float(np.min(xp[neg] / np.maximum(xp[neg] - z[neg], 1e-300)))
            xp = xp + step * (z - xp)
            x[:] = 0
            x[passive] = xp
            keep = [k for k, v in zip(passive, xp, strict=True) if v > 1e-12]
            if len(keep) == len(passive):
                keep = [k for k, bad in zip(passive, neg, strict=True) if not bad]
            x[[k for k in passive if k not in keep]] = 0
            passive = keep
            if not passive:
                break
    return x


@dataclass
class Plan:
    """Ranges of ranks per bin: ``begins[b]`` sorted first ranks; the range's combination starts at sequence
    ``base``, takes ``per`` pieces of this bin each, from place ``slot`` on.  ``used[b]`` ranks are served."""

    begins: dict[int, np.ndarray]
    base: dict[int, np.ndarray]
    per: dict[int, np.ndarray]
    slot: dict[int, np.ndarray]
    alone: dict[int, np.ndarray]
    used: np.ndarray
    spare_first: np.ndarray
    sequences: int
    spare: int


def plan(histogram: np.ndarray, cfg: Packing = Packing()) -> Plan:
    """Repeat counts for the combinations, from the number of pieces in each bin (index 0 is unused)."""
    bins = cfg.bins
    combos = combinations(bins, cfg.depth)
    a = np.zeros((bins + 1, len(combos)))
    for j, c in enumerate(combos):
        for part in c:
            a[part, j] += 1
    x = nnls(a, histogram.astype(float))
    left = histogram.astype(np.int64).copy()
    parts: dict[int, list[tuple[int, int, int, int, int]]] = {b: [] for b in range(bins + 1)}
    taken = np.zeros(bins + 1, dtype=np.int64)
    sequences = 0
    by_use = np.argsort(-x, kind="stable")
    # rounded counts first; then what a rounded-down plan can still serve
    for extra in (False, True):
        for j in by_use.tolist():
            if x[j] <= 0:
                break
            c = combos[j]
            need = {b: c.count(b) for b in c}
            most = min(int(left[b]) // m for b, m in need.items())
            times = most if extra else min(int(round(x[j])), most)
            if times <= 0:
                continue
            for b, m in need.items():
                parts[b].append((int(taken[b]), sequences, m, c.index(b), len(c) == 1))
                taken[b] += times * m
                left[b] -= times * m
            sequences += times
    spare_first = np.zeros(bins + 1, dtype=np.int64)
    spare_first[1:-1] = np.cumsum(left[:0:-1])[::-1][1:]  # longer bins come first
    cols = [{b: np.array([p[i] for p in ps], dtype=np.int64) for b, ps in parts.items() if ps} for i in range(5)]
    return Plan(*cols, used=taken, spare_first=spare_first, sequences=sequences, spare=int(left.sum()))


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """(bin, offset) of each length, longest first into the fullest bin that has room; and the number of bins."""
    room: list[tuple[int, int]] = []
    bin_, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            free, k = room.pop(at)
        else:
            free, k, n = window, n, n + 1
        bin_[i], offset[i] = k, window - free
        if free > lengths[i]:
            insort(room, (free - lengths[i], k))
    return bin_, offset, n


def pack(
    docs: DataFrame, cfg: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for)."""
    pieces = stored(cut(docs, cfg, id_col, text_col, tokenizer, with_ids), "pieces")
    counts = stored(pieces.groupBy("task", "bin").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = np.zeros(cfg.bins + 1, dtype=np.int64)
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # at most one row per bin
        histogram[r["bin"]] = r["n"]
    todo = plan(histogram, cfg)
    groups = max(1, -(-todo.spare // cfg.group))

    before = Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("bin", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["bin", "task"]).withColumn("rank", F.col("first") + F.col("nth"))

    @F.arrow_udf("sequence_id long, slot int, alone boolean, spare long")
    def place(bins: pa.Array, ranks: pa.Array) -> pa.Array:
        b, r = bins.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        seq, slot = np.full(len(b), -1, np.int64), np.zeros(len(b), np.int32)
        alone, spare = np.zeros(len(b), bool), np.full(len(b), -1, np.int64)
        for k in np.unique(b).tolist():
            at = np.flatnonzero(b == k)
            over = r[at] >= todo.used[k]
            spare[at[over]] = todo.spare_first[k] + r[at[over]] - todo.used[k]
            at = at[~over]
            if len(at):
                part = np.searchsorted(todo.begins[k], r[at], side="right") - 1
                t = r[at] - todo.begins[k][part]
                seq[at] = todo.base[k][part] + t // todo.per[k][part]
                slot[at] = todo.slot[k][part] + t % todo.per[k][part]
                alone[at] = todo.alone[k][part] > 0
        return pa.StructArray.from_arrays(
            [pa.array(seq), pa.array(slot), pa.array(alone), pa.array(spare)],
            names=["sequence_id", "slot", "alone", "spare"],
        )

    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else [])
    # written, so that its three branches below don't compute it three times
    placed = stored(
        ranked.withColumn("p", place.asNondeterministic()("bin", "rank")).select(*keep, "p.*"), "placed"
    )
    whole = placed.filter("alone").select(*keep, "sequence_id", F.lit(0).cast("long").alias("offset"))
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    planned = placed.filter("sequence_id >= 0 and not alone").select(
        *keep, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    )
    left = placed.filter("spare >= 0").withColumn("pack_group", F.col("spare") % groups)
    base, group, window = todo.sequences, cfg.group, cfg.window
    schema = whole.schema

    def greedy(t: pa.Table) -> pa.Table:
        t = t.sort_by([("spare", "ascending")])
        bin_, offset, _ = best_fit(t.column("length").to_pylist(), window)
        first_id = base + t.column("pack_group")[0].as_py() * (group + 1)
        return t.select(keep).append_column("sequence_id", pa.array([first_id + k for k in bin_], pa.int64())).append_column(
            "offset", pa.array(offset, pa.int64())
        )

    return whole.unionByName(planned).unionByName(left.groupBy("pack_group").applyInArrow(greedy, schema))
