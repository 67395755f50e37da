"""Periodic runs in texts, found by block convolution.

A run of period q is a stretch of words in which words q apart are equal, that
no neighbouring word extends; runs of at least ``MIN_COPIES`` periods and
``MIN_WORDS`` words count, under their smallest period.

1. At scale B = 8, 16, 32, ... a text is cut into blocks of B words.  A run of
   period q with B <= q < 2B and three periods holds a whole block and the
   block's copy q words later, so looking for each block's copies at distances
   B to 2B finds it.  The first scale looks at distances 1 to 16.
2. The sum of squared differences between a block and the window that follows it
   is a convolution.  It is computed for all distances at once by number theoretic
   transforms, exact modulo a prime; equal words give zero, so no copy is
   missed.  Blocks with a word that does not come again within the window can have no
   copy and are left out.
3. Distances of zero mismatch are seeds.  A seed is extended to both sides by
   comparing names of stretches of 2^k words (prefix doubling), which is
   exact: a zero that only the modulus made does not extend to a run.  Seeds
   inside a run that a smaller scale has found are multiples of its period.
4. Stretches found under several periods are kept with the smallest one.

A document is decided from its own row: one narrow pass, no shuffle, no hot
key.  The documents of a piece of an Arrow batch share the transforms.

Defined cases: a null or empty text has no words and no runs, and its collapsed
text is empty; repeated rows are judged one by one; a text of any length is
read whole (names take 4 bytes a word and doubling); an empty table
gives no rows.  ``find_runs`` returns a column to be put under any name, so names of
the input can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

MIN_WORDS = 24
MIN_COPIES = 3
#: Words of the smallest block; a run of ``MIN_WORDS`` words and a period under twice that holds such a block and its copy.
BLOCK = 8
#: Prime of the transforms, 119 * 2^23 + 1, and a generator of its units.
PRIME = 998244353
GENERATOR = 3
#: Elements transformed at a time.
CHUNK = 1 << 18

_P = np.uint64(PRIME)

RUNS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "runs",
            T.ArrayType(
                T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]),
                False,
            ),
        ),
        T.StructField("collapsed", T.StringType()),
    ]
)


@lru_cache(maxsize=64)
def _powers(size: int, inverse: bool) -> np.ndarray:
    """Powers 0 to size / 2 - 1 of a root of unity of order ``size``."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    out = np.ones(max(1, size // 2), dtype=np.uint64)
    known = 1
    while known < len(out):
        out[known : 2 * known] = out[:known] * np.uint64(pow(root, known, PRIME)) % _P
        known *= 2
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Number theoretic transform of each row (a power of two long), in bit-reversed order."""
    rows, size = x.shape
    half = size // 2
    while half:
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1]
        out = np.empty_like(v)
        out[:, :, 0] = (a + b) % _P
        out[:, :, 1] = (a + (_P - b)) * _powers(2 * half, False) % _P
        x, half = out.reshape(rows, size), half // 2
    return x


def restore(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    rows, size = x.shape
    half = 1
    while half < size:
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0], v[:, :, 1] * _powers(2 * half, True) % _P
        out = np.empty_like(v)
        out[:, :, 0] = (a + b) % _P
        out[:, :, 1] = (a + (_P - b)) % _P
        x, half = out.reshape(rows, size), 2 * half
    return x * np.uint64(pow(size, PRIME - 2, PRIME)) % _P


def mismatch(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sum of squared differences, modulo the prime, of each block and its window at every offset.

    Rows are as long as the windows; a block fills the first places of its row.
    Offsets at which the block lies inside the window are right.
    """
    rows, width = windows.shape
    size = blocks.shape[1]
    padded = np.zeros_like(windows)
    # correlation is the product with the block turned round: place 0, then the last ones backwards
    padded[:, 0] = blocks[:, 0]
    padded[:, width - size + 1 :] = blocks[:, :0:-1]
    cross = restore(transform(padded) * transform(windows) % _P)
    squares = np.zeros((rows, width + 1), dtype=np.uint64)
    np.cumsum(windows * windows % _P, axis=1, out=squares[:, 1:])
    ends = np.minimum(np.arange(width) + size, width)
    energy = squares[:, ends] - squares[:, :width] + (blocks * blocks % _P).sum(axis=1, dtype=np.uint64)[:, None]
    return (energy + np.uint64(2) * (_P - cross)) % _P


def seeds(ids: np.ndarray, again: np.ndarray, offsets: np.ndarray, block: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins of aligned blocks and the distances ``shortest`` to 2 * block at which their copies may lie.

    ``again`` is the distance to the next place of the same word, ``offsets`` are the documents' word offsets.
    """
    length = np.diff(offsets)
    count = np.maximum(0, (length - shortest) // block)
    row = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][row] + nth * block
    if not len(begin):
        return begin, begin
    reach = np.maximum.reduceat(again, np.stack([begin, begin + block], axis=1).ravel().clip(max=len(again) - 1))[::2]
    open_ = reach <= 2 * block
    begin, row = begin[open_], row[open_]
    span = 2 * block - shortest + 1  # distances looked at
    width = 1 << int(span + block - 2).bit_length()
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, CHUNK // width)
    for lo in range(0, len(begin), step):
        b, stop = begin[lo : lo + step], offsets[1:][row[lo : lo + step]]
        blocks = ids[b[:, None] + np.arange(block)]
        at = b[:, None] + shortest + np.arange(width)
        inside = (at < stop[:, None]) & (np.arange(width) < span + block - 1)
        windows = np.where(inside, ids[np.minimum(at, len(ids) - 1)], np.uint64(0))  # no word has value 0
        i, d = np.nonzero(mismatch(blocks, windows)[:, :span] == 0)
        d = d + shortest
        real = b[i] + d + block <= stop[i]
        found.append((b[i][real], d[real]))
    if not found:
        return begin[:0], begin[:0]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def names_of(ids: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, ...: equal values where the next 2^k words are equal; stretches beyond a document's end are unlike any other."""
    n = len(ids)
    end = offsets[1:][tx.row_of(offsets)]
    levels = [np.unique(ids, return_inverse=True)[1].astype(np.int32)]
    h = 1
    while 2 * h <= int(np.diff(offsets).max(initial=0)):
        last = levels[-1]
        whole = np.flatnonzero(np.arange(n) + 2 * h <= end)
        name = -1 - np.arange(n, dtype=np.int32)
        name[whole] = np.unique((last[whole].astype(np.int64) << 32) | last[whole + h], return_inverse=True)[1]
        levels.append(name)
        h *= 2
    return levels


def extend(levels: list[np.ndarray], begin: np.ndarray, distance: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest [a, e) around ``begin`` in [lo, hi) in which each word equals the one ``distance`` later."""
    n = len(levels[0])
    e = begin.copy()
    for k in range(len(levels) - 1, -1, -1):
        h = 1 << k
        while True:  # the longest names may fit several times
            ok = e + distance + h <= hi
            ok &= levels[k][np.minimum(e, n - 1)] == levels[k][np.minimum(e + distance, n - 1)]
            e = e + np.where(ok, h, 0)
            if k < len(levels) - 1 or not ok.any():
                break
    a = begin.copy()
    for k in range(len(levels) - 1, -1, -1):
        h = 1 << k
        while True:
            ok = a - h >= lo
            ok &= levels[k][np.maximum(a - h, 0)] == levels[k][np.maximum(a - h, 0) + np.minimum(distance, n - 1 - np.maximum(a - h, 0))]
            a = a - np.where(ok, h, 0)
            if k < len(levels) - 1 or not ok.any():
                break
    return a, e


def _covered(begin: np.ndarray, end: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether [begin, end) lies inside one of the runs (start, end, period)."""
    if not len(runs):
        return np.zeros(len(begin), dtype=bool)
    by = np.argsort(runs[:, 0], kind="stable")
    furthest = np.maximum.accumulate(runs[by, 1])
    at = np.searchsorted(runs[by, 0], begin, side="right") - 1
    return (at >= 0) & (furthest[np.maximum(at, 0)] >= end)


def runs_of(keys: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, copies: int = MIN_COPIES) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period; places are those of the concatenated documents."""
    if min_words < 3 * BLOCK or copies < 3:
        raise ValueError("shorter runs need not hold a block and its copy")
    nothing = np.empty((0, 3), dtype=np.int64)
    n = len(keys)
    longest = int(np.diff(offsets).max(initial=0))
    if longest < min_words:
        return nothing
    row = tx.row_of(offsets)
    # words as values from 1 to the prime's end, spread so that sums of squares differ
    ids = tx.mix(keys ^ np.uint64(0x5BF03635)) % np.uint64(PRIME - 1) + np.uint64(1)
    order = np.lexsort((np.arange(n), keys, row))
    again = np.full(n, n + 1, dtype=np.int64)
    same = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    again[order[:-1][same]] = (order[1:] - order[:-1])[same]

    scales, block = [], BLOCK
    while block == BLOCK or copies * block <= longest:
        scales.append((block, *seeds(ids, again, offsets, block, 1 if block == BLOCK else block)))
        block *= 2
    # documents with a seed, one after the other
    docs = np.unique(row[np.concatenate([begin for _, begin, _ in scales])])
    if not len(docs):
        return nothing
    size = np.diff(offsets)[docs]
    own = np.concatenate([[0], np.cumsum(size)])
    moved = np.zeros(len(offsets) - 1, dtype=np.int64)
    moved[docs] = own[:-1] - offsets[docs]
    levels = names_of(keys[np.repeat(offsets[docs] - own[:-1], size) + np.arange(own[-1])], own)

    found = nothing
    for block, begin, distance in scales:
        order = np.lexsort((begin, distance))
        distance, at = distance[order], begin[order] + moved[row[begin[order]]]
        left = ~_covered(at, at + block + distance, found)
        distance, at = distance[left], at[left]
        doc = np.searchsorted(own, at, side="right") - 1
        a, e = extend(levels, at, distance, own[doc], own[doc + 1])
        length = e - a + distance
        good = (length >= min_words) & (length >= copies * distance) & (e > a)
        found = np.concatenate([found, np.stack([a[good], e[good] + distance[good], distance[good]], axis=1)])
        # one stretch under several periods: the smallest
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        first = np.ones(len(found), dtype=bool)
        first[1:] = (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])
        found = found[first]
    back = docs[np.searchsorted(own, found[:, 0], side="right") - 1]
    found[:, :2] -= moved[back][:, None]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words left when of each run only the first period stays; runs are (start, length, period)."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _documents(texts: pa.Array, min_words: int, copies: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    for _, _, data, offsets in tx.pieces(texts):
        starts, lens, w_off = tx.words(data, offsets, tx.SPACED_WORD)
        found = runs_of(tx.hash_spans(data, starts, lens), w_off, min_words, copies)
        r_off = np.searchsorted(found[:, 0], w_off)
        raw = data.tobytes()
        for i in range(len(offsets) - 1):
            mine = found[r_off[i] : r_off[i + 1]]
            runs = [(s - int(w_off[i]), e - s, p) for s, e, p in mine.tolist()]
            # bytes.split() parts at the same six bytes
            yield int(w_off[i + 1] - w_off[i]), runs, b" ".join(collapse(raw[offsets[i] : offsets[i + 1]].split(), runs))


def find_runs(text: Column, min_words: int = MIN_WORDS, copies: int = MIN_COPIES) -> Column:
    """A struct of ``RUNS``: the number of words, all runs by start and period, and the text without the runs' later periods.

    In the collapsed text words are joined by one space.  A session that ships
    the package's code (``storage.ship``) is needed on a cluster.
    """

    @F.arrow_udf(RUNS)
    def look(texts: pa.Array) -> pa.Array:
        n_words, runs, left = [], [], []
        for n, r, t in _documents(texts, min_words, copies):
            n_words.append(n)
            runs.append([{"start": s, "length": k, "period": p} for s, k, p in r])
            left.append(t)
        kind = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(left, pa.binary()).view(pa.string())], names=RUNS.names
        )

    return look.asNondeterministic()(text)  # keeps the optimiser from evaluating it twice


def best_run(runs: Column) -> Column:
    """Of runs sorted by start and period, the one with the greatest length / period (the first of equals); null if there is none."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )


def planted(doc_id: Column, text: Column) -> Column:
    """The text with words of every tenth document (by crc32 of the id) repeated periodically; a null id's are left."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def turn(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a), tail), F.lit(1), n), " ")).otherwise(text)

    # the words are bound once
    return F.when(F.pmod(h, F.lit(10)) == 0, F.get(F.transform(F.array(words), turn), F.lit(0))).otherwise(text)
