"""Line dedup: maximal repeated runs of lines across all documents; later copies are deleted.

A document is a sequence of line ids (hashes of the whole lines; lines
without a word take no place in it and go with the line before them).  A run qualifies if its lines have at
least ``min_words`` words together.

Suffixes are compared by prefix doubling: the name of the run of 2^k lines at
a place is made of the names of its two halves, and a run of any length is
named by the two runs of 2^k lines that cover it (Karp, Miller, Rosenberg).
A place's suffix is named to the depth at which it first qualifies; the
suffixes that share such a name are one interval of the suffix array, with a
longest common prefix of at least that depth.  Equal names are all that the
decision needs, so the array's order between unequal suffixes is never
materialised: names travel once, in one shuffle, in place of one shuffle per
doubling round and a global sort.

Every maximal repeated run that qualifies is the union of the shortest
qualifying runs inside it, taken forward from each of its lines and backward
from each of its lines.  So the lines to delete are the union of the
occurrences of such runs, without the first occurrence of each (documents
ordered by id, then by place).

A run that very many documents share is a hot name: names are counted, and
first places taken, by aggregates that are combined before the shuffle, and the
joins back to the occurrences are left to Spark, which splits skewed joins.

Defined cases: null and empty texts have no lines and stay as they are; a
null id comes after all others; rows repeated under one id with one text
count as one document (all keep what the first keeps); documents of one id
with other texts are ordered by the hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .storage import ship, stored

MIN_WORDS = 50
#: Lists of lines to delete up to this many bytes are sent to all executors; larger ones are joined by a shuffle.
SMALL_BYTES = 32 << 20


def doubled_names(ids: np.ndarray, offsets: np.ndarray, most: int) -> list[np.ndarray]:
    """Names of the runs of 1, 2, 4, ... lines (up to ``most``) at each place; runs past a document's end read 0."""
    n = len(ids)
    levels = [ids]
    h = 1
    row_end = offsets[1:][tx.row_of(offsets)]
    while 2 * h <= most:
        name = np.zeros(n, dtype=np.uint64)
        at = np.flatnonzero(np.arange(n) + 2 * h <= row_end)
        name[at] = tx.combine(levels[-1][at], levels[-1][at + h])
        levels.append(name)
        h *= 2
    return levels


def run_names(levels: list[np.ndarray], first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Names of the runs [first, last], each from the two overlapping runs of 2^k lines that cover it."""
    size = last - first + 1
    k = np.frexp(size.astype(np.float64))[1] - 1  # 2^k <= size < 2^(k+1)
    out = np.zeros(len(first), dtype=np.uint64)
    for level in np.unique(k).tolist():
        at = np.flatnonzero(k == level)
        name = levels[level]
        pair = tx.combine(name[first[at]], name[last[at] - (1 << level) + 1])
        out[at] = tx.combine(pair, size[at].astype(np.uint64))
    return out


def qualifying_runs(data: np.ndarray, offsets: np.ndarray, min_words: int):
    """Shortest qualifying runs: (document, first line, last line, name); lines are numbered as in the text."""
    starts, lens, l_off = tx.lines(data, offsets)
    w_start, _, _ = tx.words(data, offsets, tx.SPACED_WORD)
    n_words = np.searchsorted(w_start, starts + lens) - np.searchsorted(w_start, starts)
    wordy = np.flatnonzero(n_words)
    row = tx.row_of(l_off)[wordy]
    number = wordy - l_off[row]
    off = np.searchsorted(row, np.arange(len(offsets)))
    ids = tx.hash_spans(data, starts[wordy], lens[wordy])
    total = np.concatenate([[0], np.cumsum(n_words[wordy])])
    here = np.arange(len(ids))
    lo, hi = off[row], off[row + 1] - 1
    # forward from each line: the first line at which the words suffice; backward: the last line from which they do
    ahead = np.searchsorted(total, total[:-1] + min_words) - 1
    back = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    fw, bw = np.flatnonzero(ahead <= hi), np.flatnonzero((total[1:] >= min_words) & (back >= lo))
    first = np.concatenate([here[fw], back[bw]])
    last = np.concatenate([ahead[fw], here[bw]])
    if not len(first):
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    order = np.lexsort((last, first))
    first, last = first[order], last[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    first, last = first[new], last[new]
    names = run_names(doubled_names(ids, off, int((last - first + 1).max())), first, last)
    # wordless lines go with the line before them
    reach = np.append(number[1:], 0) - 1
    reach[off[1:][off[1:] > off[:-1]] - 1] = (np.diff(l_off) - 1)[off[1:] > off[:-1]]
    return row[first], number[first], reach[last], names


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "first")


def later_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Occurrences of qualifying runs that an earlier place has too: doc_id, text_key, first, last (line numbers)."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("text_key"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, _, data, offsets in tx.pieces(b.column("text")):
                doc, first, last, name = qualifying_runs(data, offsets, min_words)
                at = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tx.signed(name)), b.column("doc_id").take(at), b.column("text_key").take(at),
                        pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    ],
                    names=["name", "doc_id", "text_key", "first", "last"],
                )

    kind = src.schema["doc_id"].dataType.simpleString()
    # written once: it is read to count the names and to find the rows of those that repeat, which are few
    found = stored(src.mapInArrow(runs, f"name long, doc_id {kind}, text_key long, first int, last int"), "line-runs")
    twice = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name")
    again = stored(found.join(twice, "name", "left_semi"), "repeated-runs")
    # written, so that the join below has plain inputs, which Spark splits where a name is hot
    origin = stored(again.groupBy("name").agg(F.min(_place()).alias("origin")), "first-places")
    return (
        again.join(origin, "name")
        .withColumn("place", _place())
        .filter(F.col("place") > F.col("origin"))
        .select("doc_id", "text_key", "first", "last")
    )


def cuts(runs: DataFrame) -> DataFrame:
    """Per document the lines to delete, as maximal runs: doc_id, text_key, begins, ends (ends exclusive)."""
    of_doc = Window.partitionBy("doc_id", "text_key").orderBy("first", "last")
    reached = F.max("last").over(of_doc.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("first") <= reached + 1, 0).otherwise(1)
    numbered = runs.withColumn("fresh", fresh).withColumn(
        "run", F.sum("fresh").over(of_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    merged = numbered.groupBy("doc_id", "text_key", "run").agg(F.min("first").alias("b"), (F.max("last") + 1).alias("e"))
    return (
        merged.groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_list(F.struct("b", "e"))).alias("m"))
        .select("doc_id", "text_key", F.col("m.b").alias("begins"), F.col("m.e").alias("ends"))
    )


DONE = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())]
)


@F.arrow_udf(DONE)
def _without(texts: pa.Array, begins: pa.Array, ends: pa.Array) -> pa.Array:
    out, n, gone = [], [], []
    for t, bs, es in zip(texts, begins, ends, strict=True):
        t, bs = t.as_py(), bs.as_py()
        if t is None:
            out.append(None)
            n.append(0)
            gone.append(0)
        elif not bs:
            out.append(t)
            n.append(t.count("\n") + 1)
            gone.append(0)
        else:
            lines, kept, at = t.split("\n"), [], 0
            for s, e in zip(bs, es.as_py(), strict=True):
                kept += lines[at:s]
                at = e
            kept += lines[at:]
            out.append("\n".join(kept))
            n.append(len(lines))
            gone.append(len(lines) - len(kept))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["text", "n_lines", "n_deleted"]
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, into: str = "_lines"
) -> DataFrame:
    """``docs`` with a struct column ``into``: text without the later copies, n_lines, n_deleted, begins, ends."""
    cut = stored(cuts(later_runs(docs, id_col, text_col, min_words)), "line-cuts").select(
        F.col("doc_id").alias(f"{into}_id"), F.col("text_key").alias(f"{into}_key"), "begins", "ends"
    ).select(f"{into}_id", f"{into}_key", F.struct("begins", "ends").alias(f"{into}_cut"))
    n_bytes = cut.agg(F.sum(F.lit(64) + 8 * F.size(f"{into}_cut.begins"))).first()[0] or 0
    side = F.broadcast(cut) if n_bytes <= SMALL_BYTES else cut  # checked just above; otherwise a shuffled join
    on = F.col(id_col).eqNullSafe(F.col(f"{into}_id")) & (text_key(F.col(text_col)) == F.col(f"{into}_key"))
    joined = docs.join(side, on, "left")
    c = F.col(f"{into}_cut")
    done = _without.asNondeterministic()(F.col(text_col), c["begins"], c["ends"])
    out = joined.withColumn(f"{into}_done", done)
    d = F.col(f"{into}_done")
    return out.withColumn(
        into, F.struct(d["text"].alias("text"), d["n_lines"].alias("n_lines"), d["n_deleted"].alias("n_deleted"), c["begins"].alias("begins"), c["ends"].alias("ends"))
    ).drop(f"{into}_id", f"{into}_key", f"{into}_cut", f"{into}_done")
