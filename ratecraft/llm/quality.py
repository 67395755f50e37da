"""Quality rules: suffix-array repetition.

The text of a document is a sequence of words (runs of bytes other than
white space).  For each document a suffix array over its words is built by
prefix doubling; the longest common prefixes of neighbouring suffixes give
the repeated substrings, the union of their spans gives the covered share of
the document.  Rules limit that share and the longest repeat.

Everything about a document is decided from its own row, so the job is one
narrow pass over the input: no shuffle, no hot key.  Inside a task the
documents of a piece of the Arrow batch share one vectorised suffix sort
(ranks are per document, so no repeat crosses documents).

Defined cases: a null or empty text has no words and fails the base rules;
repeated rows are judged one by one; a document shorter than two repeats has
covered share 0; other columns of the input pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx
from .storage import free_name, ship

SYMBOLS = tx.byte_set(*[(ord(c), ord(c)) for c in "#*$%&|<>"])

SIGNALS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("covered_words", T.LongType()),
        T.StructField("longest_repeat", T.LongType()),
        T.StructField("n_maximal_repeats", T.LongType()),
        T.StructField("span_starts", T.ArrayType(T.LongType())),
        T.StructField("span_ends", T.ArrayType(T.LongType())),
    ]
)


@dataclass(frozen=True)
class Rules:
    """Limits. ``min_words``/``max_repeat_pct`` are the base rules, the rest is the suffix-array verdict."""

    min_words: int = 50
    max_repeat_pct: int = 50
    #: shortest repeat (words) that counts as covered
    min_repeat: int = 8
    #: largest share (percent) of the words inside repeats; such words count in the base rule too, so it has to be lower than there
    max_covered_pct: int = 30
    #: that many covered words are no reason alone: a line of 20 words at the head and the foot of a short text
    min_covered: int = 40
    #: longest repeat allowed, in words, and as a share of the document
    max_longest: int = 100
    max_longest_pct: int = 10
    #: longest repeat allowed in words, however long the document
    max_longest_words: int = 200


def suffix_order(word_ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix array of each document's words, by prefix doubling.

    Returns the order of all word positions (documents one after the other,
    their suffixes sorted) and the ranks after each round as (h, rank):
    equal ranks at h mean equal h-word prefixes.  Only positions whose class
    still has several members are sorted again.
    """
    n = len(word_ids)
    row = tx.row_of(offsets)
    end = offsets[1:][row]
    order = np.lexsort((word_ids, row))
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (row[order][1:] != row[order][:-1]) | (word_ids[order][1:] != word_ids[order][:-1])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels = [(1, rank.astype(np.int32))]
    h = 1
    slots = np.arange(n)  # places in `order` whose class is not settled
    while True:
        r = rank[order[slots]]
        many = np.zeros(len(slots), dtype=bool)
        same = r[1:] == r[:-1]
        many[1:] |= same
        many[:-1] |= same
        slots = slots[many]
        if not len(slots):
            return order, levels
        pos = order[slots]
        nxt = pos + h
        after = np.where(nxt < end[pos], rank[np.minimum(nxt, n - 1)], -1)
        by = np.argsort((rank[pos] << 32) | (after + 1), kind="stable")
        pos, after = pos[by], after[by]
        old = rank[pos]
        order[slots] = pos
        fresh = np.ones(len(pos), dtype=bool)
        fresh[1:] = (old[1:] != old[:-1]) | (after[1:] != after[:-1])
        # a class keeps the places from its first one on, and `slots` are those places
        rank[pos] = np.maximum.accumulate(np.where(fresh, slots, 0))
        h *= 2
        levels.append((h, rank.astype(np.int32)))


def neighbour_lcp(order: np.ndarray, levels: list, offsets: np.ndarray, least: int) -> np.ndarray:
    """Longest common prefix (words) of each suffix and the one before it; values under ``least`` may read 0."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    # suffixes in one class of the last round with h <= least share at least h words; the others can't reach `least`
    start = max((lv for lv in levels if lv[0] <= max(least, 1)), key=lambda lv: lv[0])[1]
    at = np.flatnonzero(start[order[1:]] == start[order[:-1]]) + 1
    a, b = order[at - 1].copy(), order[at].copy()
    end = offsets[1:][tx.row_of(offsets)]
    end_a = end[a] if len(a) else a
    common = np.zeros(len(at), dtype=np.int64)
    for h, rank in reversed(levels):
        ok = (a + h <= end_a) & (b + h <= end_a)
        ok &= rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)]
        step = np.where(ok, h, 0)
        common += step
        a += step
        b += step
    lcp[at] = common
    return lcp


def repeats(word_ids: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(covered, longest from each position, start of a maximal repeat), one value per word."""
    n = len(word_ids)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z.astype(bool), z, z.astype(bool)
    order, levels = suffix_order(word_ids, offsets)
    lcp = neighbour_lcp(order, levels, offsets, least)
    both = np.maximum(lcp, np.append(lcp[1:], 0))
    longest = np.zeros(n, dtype=np.int64)
    longest[order] = np.where(both >= least, both, 0)
    edge = np.zeros(n + 1, dtype=np.int64)
    hit = np.flatnonzero(longest)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + longest[hit], -1)
    covered = np.cumsum(edge[:-1]) > 0
    # a repeat that is the tail of the one starting a word earlier can be extended to the left
    maximal = longest > 0
    maximal[1:] &= longest[:-1] != longest[1:] + 1
    return covered, longest, maximal


def _signals_of(data: np.ndarray, offsets: np.ndarray, least: int) -> dict[str, list | np.ndarray]:
    starts, lens, w_off = tx.words(data, offsets, tx.SPACED_WORD)
    ids = tx.hash_spans(data, starts, lens)
    rows = len(offsets) - 1
    lead = ((data & 0xC0) != 0x80) & tx.SPACED_WORD[data]

    l_start, l_len, l_off = tx.lines(data, offsets)
    wordy = np.searchsorted(starts, l_start + l_len) > np.searchsorted(starts, l_start)
    l_row = tx.row_of(l_off)[wordy]
    l_key = tx.combine(tx.mix(l_row.astype(np.uint64) + np.uint64(1)), tx.hash_spans(data, l_start[wordy], l_len[wordy]))
    dup = np.ones(len(l_key), dtype=bool)
    if len(l_key):
        dup[np.unique(l_key, return_index=True)[1]] = False

    row = tx.row_of(w_off)
    in_window = np.zeros(len(ids) + 2, dtype=bool)
    if len(ids) >= 3:
        inside = row[2:] == row[:-2]
        at = np.flatnonzero(inside)
        key = tx.combine(tx.combine(ids[at], ids[at + 1]), tx.combine(ids[at + 2], row[at].astype(np.uint64)))
        hit = at[tx.repeated(key)]
        for k in range(3):
            in_window[hit + k] = True
    covered, longest, maximal = repeats(ids, w_off, least)

    top = np.zeros(rows, dtype=np.int64)
    np.maximum.at(top, row, longest)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
    # spans don't run on into the next document
    begin = np.union1d(edge[::2], [o for o in w_off[1:-1].tolist() if 0 < o < len(covered) and covered[o]]).astype(np.int64)
    stop = np.union1d(edge[1::2], [o for o in w_off[1:-1].tolist() if 0 < o <= len(covered) and covered[o - 1]]).astype(np.int64)
    s_off = np.searchsorted(begin, w_off)
    return {
        "n_words": np.diff(w_off),
        "word_chars": tx.sum_by(lead, offsets),
        "n_symbols": tx.sum_by(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(l_row[dup], minlength=rows),
        "n_repeat_words": tx.sum_by(in_window[: len(ids)], w_off),
        "covered_words": tx.sum_by(covered, w_off),
        "longest_repeat": top,
        "n_maximal_repeats": tx.sum_by(maximal, w_off),
        "span_starts": [(begin[s:e] - w).tolist() for s, e, w in zip(s_off[:-1], s_off[1:], w_off[:-1], strict=True)],
        "span_ends": [(stop[s:e] - w).tolist() for s, e, w in zip(s_off[:-1], s_off[1:], w_off[:-1], strict=True)],
    }


def signals(text: Column, min_repeat: int = Rules.min_repeat) -> Column:
    """A struct of ``SIGNALS`` for a text column (Arrow batches, one row in, one row out)."""

    @F.arrow_udf(SIGNALS)
    def measure(texts: pa.Array) -> pa.Array:
        parts = [_signals_of(data, offsets, min_repeat) for _, _, data, offsets in tx.pieces(texts)]
        out = []
        for f in SIGNALS:
            if isinstance(f.dataType, T.ArrayType):
                out.append(pa.array([x for p in parts for x in p[f.name]], type=pa.list_(pa.int64())))
            else:
                out.append(pa.array(np.concatenate([p[f.name] for p in parts]) if parts else [], type=pa.int64()))
        return pa.StructArray.from_arrays(out, names=[f.name for f in SIGNALS])

    return measure.asNondeterministic()(text)  # keeps the optimiser from evaluating it twice


def base_failed(q: str, rules: Rules) -> Column:
    n = F.col(f"{q}.n_words")
    return (n < rules.min_words) | (100 * F.col(f"{q}.n_repeat_words") > rules.max_repeat_pct * n)


def repetition_failed(q: str, rules: Rules) -> Column:
    n, top = F.col(f"{q}.n_words"), F.col(f"{q}.longest_repeat")
    too_long = (top > rules.max_longest_words) | ((top > rules.max_longest) & (100 * top > rules.max_longest_pct * n))
    covered = F.col(f"{q}.covered_words")
    return ((covered > rules.min_covered) & (100 * covered > rules.max_covered_pct * n)) | too_long


def judge(docs: DataFrame, text_col: str = "text", rules: Rules = Rules(), into: str = "_quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the signals, ``base_failed`` and ``kept``."""
    ship(docs.sparkSession)
    tmp = f"{into}_signals"
    df = docs.withColumn(tmp, signals(F.col(text_col), rules.min_repeat))
    bad = base_failed(tmp, rules)
    fields = [F.col(f"{tmp}.{f.name}").alias(f.name) for f in SIGNALS]
    return df.withColumn(
        into, F.struct(*fields, bad.alias("base_failed"), (~bad & ~repetition_failed(tmp, rules)).alias("kept"))
    ).drop(tmp)


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that pass all rules, with their own columns."""
    into = free_name(docs, "_quality")
    return judge(docs, text_col, rules, into).filter(F.col(f"{into}.kept")).drop(into)
