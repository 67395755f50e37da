"""Token-ID matrices: best-fit-decreasing packing with a segment tree over capacities.

Documents are tokenised and split, without loss, into pieces of at most one
window.  A task packs its documents in blocks of bounded size, longest piece
first, each into the open row whose free room is the smallest that fits; a
segment tree over the capacities 0..window finds it in logarithmic time.

A packed row is written to a Parquet table as fixed-width binary ids (the id
matrix, a row at a time), the cumulative segment lengths, the places where
positions restart at 0, and which piece of which document each segment is.
Spark commits the table, so a lost executor's rows are written again by
another attempt and never twice.

Defined cases: a null or empty text is a piece that holds only the end id; a
text of any length is split; repeated rows are packed as often as they come;
a null id is kept, and ids keep their type; an empty table gives no rows; a
vocabulary whose ids don't fit ``dtype`` raises before anything is packed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import tokens
from .storage import ship, stored

WINDOW = 1024
#: Tokens that a task packs at a time.
BLOCK_TOKENS = 2 << 20
#: Ids below 65,536 fit two bytes, little-endian.
DTYPE = "<u2"


class CapacityTree:
    """Open rows by free room; ``take(n)`` gives the row with the least room that is at least n."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        count, i = self.count, least + self.size
        if not count[i]:
            # up to the first subtree on the right that has an open row, then down to its leftmost leaf
            while i > 1 and not (i & 1 == 0 and count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Row and offset of each piece, and the number of rows."""
    tree = CapacityTree(window)
    row, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        found = tree.take(size)
        if found is None:
            found, n = (window, n), n + 1
        room, k = found
        row[i], offset[i] = k, window - room
        if room > size:
            tree.put(room - size, k)
    return row, offset, n


MATRIX_SCHEMA = (
    "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<{kind}>, doc_starts array<long>, doc_tokens array<long>"
)


def pack_rows(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, end_id: int = tokens.END_OF_TEXT, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Packed rows (``MATRIX_SCHEMA``): ids padded with ``end_id`` to the window; cu_seqlens holds 0 and each segment's end."""
    tokens.require_width(dtype, end_id, tokenizer)
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    arrow_kind = to_arrow_type(src.schema["doc_id"].dataType)

    def block_rows(first: int, ids: np.ndarray, off: np.ndarray, doc_ids: pa.Array) -> pa.RecordBatch:
        size = np.diff(off)
        n = -(-size // window)
        doc = np.repeat(np.arange(len(size)), n)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
        length = np.minimum(size[doc] - start, window)
        row, offset, rows = best_fit_decreasing(length, window)
        matrix = np.full((rows, window), end_id, dtype=dtype)
        into = np.repeat(row * window + offset, length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        # pieces lie in `ids` in the order of (doc, start), so the ids are taken in order
        matrix.reshape(-1)[into] = ids
        order = np.lexsort((offset, row))
        edges = np.searchsorted(row[order], np.arange(rows + 1)).astype(np.int32)
        ends = (offset + length)[order].astype(np.int32)
        fill = np.zeros(rows, np.int32)
        np.maximum.at(fill, row, (offset + length).astype(np.int32))
        # one 0 before each row's ends
        cu = np.insert(ends, edges[:-1], np.int32(0))
        cu_edges = edges + np.arange(rows + 1, dtype=np.int32)
        as_list = lambda v, e: pa.ListArray.from_arrays(pa.array(e), v if isinstance(v, pa.Array) else pa.array(v))
        body = matrix.tobytes()
        step = window * matrix.dtype.itemsize
        return pa.RecordBatch.from_arrays(
            [
                pa.array(first + np.arange(rows)),
                pa.array([body[i : i + step] for i in range(0, len(body), step)], pa.binary()),
                pa.array(fill), as_list(cu, cu_edges), as_list(offset[order].astype(np.int32), edges),
                as_list(doc_ids.take(pa.array(doc[order])).cast(arrow_kind), edges), as_list(start[order], edges),
                as_list(size[doc[order]], edges),
            ],
            names=[c.strip().split(" ")[0] for c in MATRIX_SCHEMA.split(",")],
        )

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 36
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        amount = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            size = np.concatenate([np.diff(h[1]) for h in held])
            out = block_rows(next_row, ids, np.concatenate([[0], np.cumsum(size)]), pa.concat_arrays([h[2] for h in held]))
            held.clear()
            return out

        for b in batches:
            for lo, hi, ids, off in tokens.encoded(b.column("text"), end_id, tokenizer):
                held.append((ids, off, b.column("doc_id").slice(lo, hi - lo)))
                amount += len(ids)
                if amount >= block_tokens:
                    out, amount = flush(), 0
                    next_row += out.num_rows
                    yield out
        if held:
            yield flush()

    return src.mapInArrow(rows_of, MATRIX_SCHEMA.format(kind=kind))


def write_matrices(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the packed rows (to ``path`` or the shared folder) and read them back."""
    return stored(pack_rows(docs, **options), "matrices", path)


def segments(matrices: DataFrame, dtype: str = DTYPE) -> DataFrame:
    """One row per segment, from the written rows: doc_id, start, length, doc_tokens, row_id, offset, ids_crc32."""
    kind = matrices.schema["doc_ids"].dataType.elementType.simpleString()
    arrow_kind = to_arrow_type(matrices.schema["doc_ids"].dataType.elementType)
    ship(matrices.sparkSession)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            resets = b.column("position_resets")
            n = resets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), n)
            offset = resets.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            cu = b.column("cu_seqlens").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.delete(cu, np.cumsum(n + 1) - (n + 1))  # each row's leading 0
            bodies = b.column("ids").to_pylist()
            crc = []
            for r, s, e in zip(row.tolist(), offset.tolist(), end.tolist(), strict=True):
                crc.append(zlib.crc32(np.frombuffer(bodies[r], dtype)[s:e].astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_ids").flatten().cast(arrow_kind), b.column("doc_starts").flatten(), pa.array(end - offset),
                    b.column("doc_tokens").flatten(), b.column("row_id").take(pa.array(row)), pa.array(offset),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "row_id", "offset", "ids_crc32"],
            )

    return matrices.mapInArrow(
        explode,
        f"doc_id {kind}, start long, length long, doc_tokens long, row_id long, offset long, ids_crc32 long",
    )
