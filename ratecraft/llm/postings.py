"""Benchmark decontamination with a positional inverted index.

The index is partitioned by document into segments of bounded size.  A
segment holds its terms (sorted hashes), for each term the positions at which
it occurs (ascending, as differences, low bytes apart from high bytes so that
they compress), and where its documents begin.  It is one row of a table in
the shared folder: building it is one narrow pass without a shuffle, so a
frequent term is hot nowhere, and a lost executor's segments are written
again by another attempt.

A phrase is looked up in a segment from its rarest term on: positions of that
term, moved by its place in the phrase, are intersected with the positions of
the next rarest, until none is left or all terms are used.  A proximity match
asks that all terms of the phrase occur, in any order, within ``slop``
consecutive words of one document; it starts from the rarest term's positions too.

The test set is read in blocks of bounded size, each of which goes to all
segments (a stated query set against all rows); matches of the blocks are
merged per document afterwards.

Defined cases: a null or empty text has no words; an item without words
matches nothing; an item of fewer words than the window is one window; rows
repeated under an id are documents of their own; items repeated under an id
count once; an item without an id marks words but isn't counted or listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import text as tx
from .storage import free_name, ship, stored

WINDOW = 13
#: Test items that are searched at a time.
BLOCK_ITEMS = 4096
SLOP = 26

INDEX = (
    "segment long, doc_ids array<{kind}>, text_keys array<long>, n_words array<int>, terms binary, term_first binary, deltas binary"
)


def tokenise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased alphanumeric words, and the word offsets of the texts."""
    low = tx.LOWER[data]
    starts, lens, w_off = tx.words(low, offsets, tx.ALNUM_WORD)
    return tx.hash_spans(low, starts, lens), w_off


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional index of all documents, one row per segment (``INDEX``)."""
    ship(docs.sparkSession)
    src = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key")
    )
    kind = src.schema["doc_id"].dataType.simpleString()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = TaskContext.get().partitionId() << 32
        for b in batches:
            for lo, hi, data, offsets in tx.pieces(b.column("text")):
                terms, w_off = tokenise(data, offsets)
                order = np.argsort(terms, kind="stable")
                sorted_ = terms[order]
                fresh = np.ones(len(order), dtype=bool)
                fresh[1:] = sorted_[1:] != sorted_[:-1]
                deltas = np.diff(order, prepend=0)
                deltas[fresh] = order[fresh]
                planes = np.ascontiguousarray(deltas.astype("<u4").view(np.uint8).reshape(-1, 4).T)
                first = np.append(np.flatnonzero(fresh), len(order))
                one = lambda v, t: pa.array([v], t)
                yield pa.RecordBatch.from_arrays(
                    [
                        one(nth, pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), b.column("doc_id").slice(lo, hi - lo)),
                        pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), b.column("text_key").slice(lo, hi - lo)),
                        one(np.diff(w_off).astype(np.int32), pa.list_(pa.int32())),
                        one(sorted_[fresh].tobytes(), pa.binary()), one(first.astype("<i4").tobytes(), pa.binary()),
                        one(planes.tobytes(), pa.binary()),
                    ],
                    names=[c.strip().split(" ")[0] for c in INDEX.split(",")],
                )
                nth += 1

    return src.mapInArrow(segments, INDEX.format(kind=kind))


class Segment:
    """One segment of the index, opened; posting lists are decoded when asked for."""

    def __init__(self, n_words: np.ndarray, terms: bytes, term_first: bytes, deltas: bytes):
        self.terms = np.frombuffer(terms, np.uint64)
        self.first = np.frombuffer(term_first, "<i4").astype(np.int64)
        self.planes = np.frombuffer(deltas, np.uint8).reshape(4, -1)
        self.doc_first = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
        self.df = np.append(np.diff(self.first), 0)
        self.lists: dict[int, np.ndarray] = {}

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers; an absent term gets the number of terms, which has no positions."""
        at = np.searchsorted(self.terms, hashes)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == hashes[known]
        return np.where(known, at, len(self.terms))

    def positions(self, term: int) -> np.ndarray:
        got = self.lists.get(term)
        if got is None:
            p = self.planes[:, self.first[term] : self.first[term + 1]].astype(np.int64)
            got = self.lists[term] = np.cumsum(p[0] + (p[1] << 8) + (p[2] << 16) + (p[3] << 24))
        return got

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_first, positions, side="right") - 1

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """First positions of the exact phrase, in one document each."""
        found = None
        for k in np.argsort(self.df[terms], kind="stable").tolist():
            held = self.positions(int(terms[k])) - k
            if found is None:
                found = held
            else:
                at = np.searchsorted(held, found)
                ok = at < len(held)
                ok[ok] = held[at[ok]] == found[ok]
                found = found[ok]
            if not len(found):
                return found
        return found[self.doc_of(found) == self.doc_of(found + len(terms) - 1)]

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Documents that have all terms of the phrase, in any order, within ``slop`` consecutive words."""
        distinct = np.unique(terms)
        by_df = distinct[np.argsort(self.df[distinct], kind="stable")].tolist()
        found = self.positions(by_df[0])
        doc = self.doc_of(found)
        # from the rarest term on: every other term must be less than slop words away
        for term in by_df[1:]:
            held = self.positions(term)
            lo = np.maximum(found - slop + 1, self.doc_first[doc])
            hi = np.minimum(found + slop, self.doc_first[doc + 1])
            ok = np.searchsorted(held, hi) > np.searchsorted(held, lo)
            found, doc = found[ok], doc[ok]
            if not len(found):
                return found
        return np.array([d for d in np.unique(doc).tolist() if self._within(by_df, found[doc == d], d, slop)], dtype=np.int64)

    def _within(self, terms: list[int], around: np.ndarray, doc: int, slop: int) -> bool:
        """Whether a span of ``slop`` words around one of the positions has all terms."""
        for p in around.tolist():
            lo, hi = max(p - slop + 1, int(self.doc_first[doc])), min(p + slop, int(self.doc_first[doc + 1]))
            at, which = [], []
            for k, term in enumerate(terms):
                held = self.positions(term)
                some = held[np.searchsorted(held, lo) : np.searchsorted(held, hi)]
                at.append(some)
                which.append(np.full(len(some), k))
            at, which = np.concatenate(at), np.concatenate(which)
            order = np.argsort(at, kind="stable")
            last: dict[int, int] = {}
            for q, k in zip(at[order].tolist(), which[order].tolist(), strict=True):
                last[k] = q
                if len(last) == len(terms) and q - min(last.values()) < slop:
                    return True
        return False


@dataclass
class Block:
    """Some items of the test set: per window length the distinct windows' term hashes and who has them."""

    item_ids: list
    windows: list[tuple[np.ndarray, list[list[int]]]]

    @staticmethod
    def of(rows: list[tuple[object, str | None]], window: int) -> Block:
        ids = list(dict.fromkeys(i for i, _ in rows))
        number = {x: k for k, x in enumerate(ids)}
        by_size: dict[int, dict[bytes, set[int]]] = {}
        for item, text in rows:
            for _, _, data, offsets in tx.pieces(pa.array([text], pa.string())):
                words, _ = tokenise(data, offsets)
                size = min(window, len(words))
                for s in range(len(words) - size + 1 if size else 0):
                    by_size.setdefault(size, {}).setdefault(words[s : s + size].tobytes(), set()).add(number[item])
        out = []
        for size, found in sorted(by_size.items()):
            out.append((np.frombuffer(b"".join(found), np.uint64).reshape(-1, size), [sorted(v) for v in found.values()]))
        return Block(ids, out)


def blocks(items: DataFrame, window: int, id_col: str, text_col: str, block_items: int) -> Iterator[Block]:
    """The test set in blocks of bounded size; the driver holds one at a time."""
    held: list[tuple[object, str | None]] = []
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        held.append((r["i"], r["t"]))
        if len(held) == block_items:
            yield Block.of(held, window)
            held = []
    if held:
        yield Block.of(held, window)


MATCHES = "segment long, ord int, item_id {kind}, starts array<int>, ends array<int>, near boolean"


def search(
    index: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
    slop: int | None = SLOP, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Matches of the items' windows, one row per document and item: the union of the exact matches' word spans
    (relative to the document; empty if there is none) and whether a proximity match exists (never without ``slop``)."""
    spark = index.sparkSession
    kind = items.schema[id_col].dataType.simpleString()
    slim = index.select("segment", "n_words", "terms", "term_first", "deltas")
    item_type = to_arrow_type(items.schema[id_col].dataType)
    out = None
    for block in blocks(items, window, id_col, text_col, block_items):
        sent = spark.sparkContext.broadcast(block)  # bounded by block_items

        def look(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block: Block = sent.value
            for b in batches:
                for i in range(b.num_rows):
                    yield pa.RecordBatch.from_pylist(
                        list(_matches(block, b.slice(i, 1), slop)), schema=_match_schema(item_type)
                    )

        found = slim.mapInArrow(look, MATCHES.format(kind=kind))
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], MATCHES.format(kind=kind)) if out is None else out


def _match_schema(item: pa.DataType) -> pa.Schema:
    ints = pa.list_(pa.int32())
    return pa.schema(
        [("segment", pa.int64()), ("ord", pa.int32()), ("item_id", item), ("starts", ints), ("ends", ints), ("near", pa.bool_())]
    )


def _matches(block: Block, row: pa.RecordBatch, slop: int | None) -> Iterator[dict]:
    n_words = row.column("n_words").flatten().to_numpy(zero_copy_only=False)
    seg = Segment(n_words, *(row.column(c)[0].as_py() for c in ("terms", "term_first", "deltas")))
    exact: dict[tuple[int, int], list[np.ndarray]] = {}
    close: set[tuple[int, int]] = set()
    for hashes, owners in block.windows:
        size = hashes.shape[1]
        numbers = seg.find(hashes.reshape(-1)).reshape(hashes.shape)
        # a window with an absent term matches nowhere
        for w in np.flatnonzero((seg.df[numbers] > 0).all(axis=1)).tolist():
            starts = seg.phrase(numbers[w])
            if len(starts):
                doc = seg.doc_of(starts)
                for d in np.unique(doc).tolist():
                    spans = starts[doc == d] - seg.doc_first[d]
                    for item in owners[w]:
                        exact.setdefault((d, item), []).append(np.stack([spans, spans + size]))
            if slop is not None:
                for d in seg.near(numbers[w], slop).tolist():
                    close.update((d, item) for item in owners[w])
    segment = row.column("segment")[0].as_py()
    for d, item in exact.keys() | close:
        spans = exact.get((d, item))
        begin, end = union_of(np.concatenate(spans, axis=1)) if spans else ([], [])
        yield {
            "segment": segment, "ord": d, "item_id": block.item_ids[item], "starts": begin, "ends": end, "near": (d, item) in close,
        }


def union_of(spans: np.ndarray) -> tuple[list[int], list[int]]:
    """Disjoint spans that cover what the given ones (2 x n: starts, ends) cover."""
    order = np.argsort(spans[0], kind="stable")
    s, e = spans[0][order], np.maximum.accumulate(spans[1][order])
    fresh = np.ones(len(s), dtype=bool)
    fresh[1:] = s[1:] > e[:-1]
    return s[fresh].tolist(), e[np.append(np.flatnonzero(fresh)[1:] - 1, len(s) - 1)].tolist()


def report(index: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items, items (sorted as strings), n_near, contaminated."""
    docs = index.select(
        "segment",
        F.posexplode(F.arrays_zip("doc_ids", "text_keys", "n_words")).alias("ord", "d"),
    ).select("segment", "ord", F.col("d.doc_ids").alias("doc_id"), F.col("d.text_keys").alias("text_key"), F.col("d.n_words").cast("long").alias("n_words"))
    ship(matches.sparkSession)

    # a segment is of bounded size, and so are its documents' matches with one block
    def merge(t: pa.Table) -> pa.Table:
        per: dict[int, list] = {}
        for r in t.select(["ord", "item_id", "starts", "ends", "near"]).to_pylist():
            per.setdefault(r["ord"], []).append(r)
        seg, rows = t.column("segment")[0].as_py(), []
        for d, rs in per.items():
            spans = np.array([[s for r in rs for s in r["starts"]], [e for r in rs for e in r["ends"]]], dtype=np.int64)
            begin, end = union_of(spans) if spans.size else ([], [])
            rows.append(
                {
                    "segment": seg, "ord": d, "n_hit": sum(end) - sum(begin),
                    "items": sorted({str(r["item_id"]) for r in rs if r["starts"] and r["item_id"] is not None}),
                    "n_near": len({r["item_id"] for r in rs if r["near"] and r["item_id"] is not None}),
                    "starts": begin, "ends": end,
                }
            )
        ints = pa.list_(pa.int64())
        return pa.Table.from_pylist(
            rows,
            pa.schema([("segment", pa.int64()), ("ord", pa.int32()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("n_near", pa.int64()), ("starts", ints), ("ends", ints)]),
        )

    merged = matches.groupBy("segment").applyInArrow(
        merge, "segment long, ord int, n_hit long, items array<string>, n_near long, starts array<long>, ends array<long>"
    )
    hit = F.coalesce("n_hit", F.lit(0))
    items = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return docs.join(merged, ["segment", "ord"], "left").select(
        "doc_id", "text_key", "n_words", hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("starts", F.expr("cast(array() as array<bigint>)")).alias("hit_starts"),
        F.coalesce("ends", F.expr("cast(array() as array<bigint>)")).alias("hit_ends"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Build the index, store it, search it for the items and report per document."""
    index = stored(build(docs, id_col, text_col), "postings")
    return report(index, stored(search(index, items, **options), "matches"))


#: Lists of texts to drop up to this many rows are sent to all executors; larger ones are joined by a shuffle.
SMALL_ROWS = 1 << 20


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that aren't contaminated, with their own columns (the verdict depends on the text alone)."""
    judged = decontaminate(docs, items, id_col, text_col, slop=None, **options)
    name = free_name(docs, "_bad_text")
    bad = stored(judged.filter("contaminated").select(F.col("text_key").alias(name)).distinct(), "contaminated")
    side = F.broadcast(bad) if bad.count() <= SMALL_ROWS else bad
    return docs.join(side, F.xxhash64(F.coalesce(text_col, F.lit(""))) == F.col(name), "left_anti")
