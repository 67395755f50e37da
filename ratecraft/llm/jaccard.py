"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Two documents link when the Jaccard similarity of their sets of word n-grams
is at least the threshold.  The join is exact.

1. Each document becomes a sketch: the size of its set, a 128-bit digest of
   the set, a bitmap (each n-gram flips one bit), and its smallest n-gram
   hashes: as many that two sets which link must share one of them.
   Documents with equal sets form a class; only one sketch of a class goes on.
2. Sketches meet in tiles: classes that share one of those hashes and, where
   a hash is frequent, lie in the same or neighbouring size bands.  A band that
   exceeds a block is dealt to blocks of bounded size, which meet in pairs.  With
   ``pairs_later`` bands of nearly the same classes are made one, each block meets itself
   first, and pairs of blocks are opened once these are settled, only between classes of different components.  Inside a tile, the number of bits in
   which two bitmaps differ is at most the size of the symmetric difference, which
   bounds the overlap from above; pairs over the bound are dropped.
3. The rest is checked exactly: the sorted hash arrays of both sets are
   intersected.
4. Components come from contraction over the links (``components``).

A class in a tile first proposes its nearest few candidates only, besides a
spanning forest of the nearest candidates, and a tile with more names the classes
that its candidates connect.  Once the proposals
are checked and joined, groups of such classes that are still apart are visited
again, with sixteen times as many candidates, until there is none.  So a large
group of near copies needs few pairs a class in place of all pairs, and no link
between components is missed.

Defined cases: a document of fewer words than n has its whole sequence as one
n-gram; without words (or null) its set is empty and it links with nothing; a
null id takes part, but isn't anybody's smallest id; documents of one id and
other texts are told apart by their sets; equal rows are in one component, and
``keep_one`` keeps one of them; an empty table gives no rows; texts are read
whole, of any length; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .components import stars, unite
from .storage import free_name, ship, stored


@dataclass(frozen=True)
class Join:
    n: int = 3
    #: least similarity in percent
    percent: int = 90
    #: classes that a tile holds at most (per block)
    block: int = 1024
    #: candidates that a class proposes per tile in the first round
    nearest: int = 2
    #: bits of a bitmap at most
    most_bits: int = 8192
    #: n-grams for each bit of a bitmap, up to most_bits; a lower percent needs fewer, or unrelated sets pass its bound
    load: int = 2
    #: open the pairs of a large band's blocks only once its blocks are settled: fewer rows, and more rounds
    pairs_later: bool = False


#: Lists of ids up to this many rows are sent to all executors; larger ones are joined by a shuffle.
SMALL_ROWS = 1 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending, and the texts' offsets in them."""
    low = tx.LOWER[data]
    starts, lens, w_off = tx.words(low, offsets, tx.SPACED_WORD)
    h = tx.hash_spans(low, starts, lens)
    count = np.diff(w_off)
    # n-grams by their first word; a shorter text has one, of all its words
    grams = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), grams)
    first = w_off[row] + np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    key = tx.mix(h[first] + np.uint64(n)) if len(row) else np.empty(0, np.uint64)
    for k in range(1, n):
        more = np.flatnonzero(count[row] > k)
        key[more] = tx.combine(key[more], h[first[more] + k])
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(row[order].astype(np.uint16) if len(count) < 65536 else row[order], kind="stable")]
    key, row = key[order], row[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[new], row[new]
    return key, np.searchsorted(row, np.arange(len(count) + 1))


def width_of(sizes: np.ndarray, most_bits: int, load: int = 2) -> np.ndarray:
    """Bits of the bitmaps: the power of two that is at least the size over ``load``, between 64 and the most."""
    return np.clip(1 << np.ceil(np.log2(np.maximum(sizes / load, 1))).astype(np.int64), 64, most_bits)


SKETCH = "doc_id {kind}, text_key long, n_shingles long, set_id binary, prefix binary, bits binary"


def sketches(docs: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document (``SKETCH``); prefix and bits are little-endian 64-bit words."""
    ship(docs.sparkSession)
    src = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_key")
    )
    kind = src.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in tx.pieces(b.column("text")):
                key, off = shingle_sets(data, offsets, cfg.n)
                size = np.diff(off)
                row = tx.row_of(off)
                with_sums = np.zeros((2, len(key) + 1), dtype=np.uint64)
                np.cumsum(tx.mix(key), out=with_sums[0, 1:])
                np.cumsum(tx.mix(key ^ np.uint64(0x5BD1E995)), out=with_sums[1, 1:])
                ids = (with_sums[:, off[1:]] - with_sums[:, off[:-1]]).T + size[:, None].astype(np.uint64)
                width = width_of(size, cfg.most_bits, cfg.load)
                w_off = np.concatenate([[0], np.cumsum(width)])
                bit = (tx.mix(key + np.uint64(7)) % width[row].astype(np.uint64)).astype(np.int64)
                flips = np.bincount(w_off[row] + bit, minlength=int(w_off[-1])) & 1
                bits = np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()
                need = size - -(-cfg.percent * size // 100) + (size > 0)
                ends = off[:-1] + need
                raw, id_raw = key.tobytes(), np.ascontiguousarray(ids).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id").slice(lo, hi - lo), b.column("text_key").slice(lo, hi - lo), pa.array(size),
                        pa.array([id_raw[16 * i : 16 * i + 16] for i in range(hi - lo)], pa.binary()),
                        pa.array([raw[8 * s : 8 * e] for s, e in zip(off.tolist(), ends.tolist(), strict=False)], pa.binary()),
                        pa.array([bits[s // 8 : e // 8] for s, e in zip(w_off[:-1].tolist(), w_off[1:].tolist(), strict=True)], pa.binary()),
                    ],
                    names=[c.strip().split(" ")[0] for c in SKETCH.split(",")],
                )

    return src.mapInArrow(sketch, SKETCH.format(kind=kind))


def classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct set: cid (a long that numbers it), set_id, n_shingles, rep_id (smallest id), prefix, bits."""
    one = (
        sketched.filter("n_shingles > 0")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("rep_id"), F.first(F.struct("n_shingles", "prefix", "bits")).alias("s"))
    )
    return one.select(F.monotonically_increasing_id().alias("cid"), "set_id", "rep_id", "s.*")


def band_edges(percent: int, top: int = 1 << 40) -> np.ndarray:
    """First sizes of the bands; sizes that can link lie in one band or in neighbours."""
    edges = [1]
    while edges[-1] < top:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, dtype=np.int64)


def tiles(cls: DataFrame, cfg: Join = Join()) -> tuple[DataFrame, DataFrame]:
    """(rows of the first tiles, the classes of bands that exceed a block).

    A tile's rows have the tile columns (hash, band, bi, bj), cid, n_shingles,
    home, left, bits.  A hash that fits one block is one tile of all sizes (band
    -1).  For others a class goes to its own size band and, as a visitor, to the
    next one; a band that exceeds a block is dealt to blocks, and a tile is a pair
    of them.  With ``pairs_later`` each block is a tile of its own, and such bands'
    rows (hash, band, cid, home) are returned for ``block_pairs``.
    """
    ship(cls.sparkSession)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("prefix").to_pylist()
            n = np.fromiter((len(x) // 8 for x in raw), dtype=np.int64, count=len(raw))
            at = pa.array(np.repeat(np.arange(len(raw)), n))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(raw), np.int64)), b.column("cid").take(at), b.column("n_shingles").take(at)],
                names=["hash", "cid", "size"],
            )

    rows = cls.select("cid", "n_shingles", "prefix").mapInArrow(spell, "hash long, cid long, size long")
    # hashes that the same classes share (as copies share most of theirs) give the same tile: one of them is enough
    members = [F.bit_xor(F.xxhash64("cid", F.lit(k))).alias(f"m{k}") for k in (1, 2)]
    near = lambda small, large: 100 * small >= cfg.percent * large  # noqa: E731  sizes of sets that can link
    counts = (
        rows.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("lo"), F.max("size").alias("hi"), *members)
        .filter((F.col("n") > 2) | ((F.col("n") == 2) & near(F.col("lo"), F.col("hi"))))
    )
    one = counts.groupBy("n", "m1", "m2").agg(F.min("hash").alias("hash")).select("hash", "n")
    met = stored(rows.join(one, "hash"), "met")
    # in order of size, a class that can link with any other of its tile can do so with a neighbour
    by_size = Window.partitionBy("hash").orderBy("size")
    few = (
        met.filter(F.col("n") <= cfg.block)
        .withColumns({"before": F.lag("size").over(by_size), "after": F.lead("size").over(by_size)})
        .filter(F.coalesce(near(F.col("before"), F.col("size")), F.lit(False)) | F.coalesce(near(F.col("size"), F.col("after")), F.lit(False)))
        .select("hash", F.lit(-1).alias("band"), F.lit(0).alias("bi"), F.lit(0).alias("bj"), "cid", F.lit(True).alias("home"), F.lit(True).alias("left"))
    )
    bands = F.array(*[F.lit(int(e)) for e in band_edges(cfg.percent)])
    band = F.size(F.filter(bands, lambda e: e <= F.col("size")))
    own = met.filter(F.col("n") > cfg.block).select("hash", "cid", band.alias("own"))
    many = alike(own) if cfg.pairs_later else _homes_and_visits(own, "hash", "hash", "cid")
    sizes = many.groupBy("hash", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(cfg.block)).cast("int").alias("k"), F.max("home").alias("any_home"))
    dealt = stored(many.join(sizes.filter("any_home"), ["hash", "band"]).select("hash", "band", "cid", "home", "k"), "large-bands")
    block = F.pmod(F.xxhash64("cid"), F.col("k")).cast("int")
    if not cfg.pairs_later:
        met_by = dealt.withColumn("x", block).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        every = met_by.select(
            "hash", "band", F.least("x", "y").alias("bi"), F.greatest("x", "y").alias("bj"), "cid", "home", (F.col("x") <= F.col("y")).alias("left")
        )
        return _with_bits(few.unionByName(every), cls), dealt.filter("false").drop("k")
    own = dealt.select("hash", "band", block.alias("bi"), block.alias("bj"), "cid", "home", F.lit(True).alias("left"))
    return _with_bits(few.unionByName(own), cls), dealt.filter("k > 1").drop("k")


def _homes_and_visits(own: DataFrame, lead: str, visited: str, *keep: str) -> DataFrame:
    """Each row of a band ``own`` at home there, under the hash ``lead``, and as a visitor in the next band, under ``visited`` (NULL: nowhere)."""
    at = lambda hash, band, home: F.struct(F.col(hash).alias("hash"), band.alias("band"), F.lit(home).alias("home"))
    both = F.array(at(lead, F.col("own"), True), at(visited, F.col("own") + 1, False))
    return own.select(*keep, F.explode(both).alias("b")).select("b.hash", *keep, "b.band", "b.home").filter("hash is not null")


def alike(own: DataFrame) -> DataFrame:
    """The large bands' rows (hash, cid, band, home), of classes (hash, cid, own) in their size bands, with bands
    of nearly the same classes made one, under their least hash.

    The hashes of a passage that many texts share have nearly the same classes each.
    Bands of one size range become one if they agree in two of the three least hashes of
    their classes, as those do that have nearly all in common.  A pair of classes
    that shares a band shares the band made of it, so none is lost; a band without a class at home goes.
    A class finds both its bands by one join, so it is shuffled once a hash.
    """
    own = stored(own, "frequent")
    least = [F.min(F.xxhash64("cid", F.lit(k))).alias(f"m{k}") for k in (1, 2, 3)]
    bands = _homes_and_visits(own.groupBy("hash", "own").agg(*least), "hash", "hash", "m1", "m2", "m3")
    bands = bands.groupBy("hash", "band").agg(F.max("home").alias("any_home"), *[F.min(m).alias(m) for m in ("m1", "m2", "m3")])
    bands = bands.filter("any_home").withColumn("lead", F.col("hash"))
    for two in (("m1", "m2"), ("m1", "m3"), ("m2", "m3")):
        # the bands made one so far stay together
        bands = bands.withColumn("least", F.min("lead").over(Window.partitionBy("band", *two)))
        bands = bands.withColumn("lead", F.min("least").over(Window.partitionBy("band", "lead")))
    named = stored(bands.select("hash", "band", "lead"), "alike-bands")
    visited = named.select("hash", (F.col("band") - 1).alias("own"), F.col("lead").alias("visited"))
    named = named.withColumnRenamed("band", "own").join(visited, ["hash", "own"], "left")
    return _homes_and_visits(own.join(named, ["hash", "own"]), "lead", "visited", "cid").distinct()


def _with_bits(placed: DataFrame, cls: DataFrame) -> DataFrame:
    return placed.join(cls.select("cid", "n_shingles", "bits"), "cid")


def block_pairs(large: DataFrame, cls: DataFrame, roots: DataFrame, cfg: Join) -> DataFrame:
    """Tiles in which the classes of a large band meet those of other components (``roots``: u, root).

    The classes of components of at most half a block share blocks, which meet in
    pairs within the band; in a band without a larger component these blocks are those that
    have met themselves already.  A larger component meets the classes of all its
    bands at once, in tiles of its own (hash: its root, band -2), not band by band:
    near copies share most of their frequent hashes.  So a band that is one component
    has no tile, and a large component and a few other classes give about as many
    rows as classes, however many hashes they share.
    """
    known = roots.select(F.col("u").alias("cid"), "root")
    placed = large.join(known, "cid", "left").withColumn("of", F.coalesce("root", "cid")).drop("root")
    parts = placed.groupBy("hash", "band", "of").agg(F.count(F.lit(1)).alias("n")).withColumn("alone", 2 * F.col("n") > cfg.block)
    several = parts.groupBy("hash", "band").agg(
        F.count(F.lit(1)).alias("components"), F.max("alone").alias("mixed"),
        F.ceil(F.sum(F.when(~F.col("alone"), F.col("n")).otherwise(0)) / F.lit(cfg.block)).alias("shared"),
    ).filter("components > 1")
    parts = stored(parts.join(several, ["hash", "band"]).select("hash", "band", "of", "alone", "mixed", "shared"), "open-components")
    rows = stored(placed.join(parts, ["hash", "band", "of"]), "open-classes")
    blocks = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    x = F.pmod(F.xxhash64("cid"), F.col("shared"))
    y = F.explode(F.filter(blocks("shared"), lambda y: F.col("mixed") | (y != F.col("x"))))
    shared = rows.filter("not alone").withColumn("x", x).withColumn("y", y).select(
        "hash", "band", F.least("x", "y").cast("int").alias("bi"), F.greatest("x", "y").cast("int").alias("bj"), "cid", "home",
        (F.col("x") <= F.col("y")).alias("left"),
    )
    hosts = parts.filter("alone").select("hash", "band", F.col("of").alias("owner"))
    # two larger components of a band meet at the one of the smaller number
    meets = (F.col("of") != F.col("owner")) & (~F.col("alone") | (F.col("of") > F.col("owner")))
    side = lambda df, of, left: df.select(F.col(of).alias("owner"), "cid", F.lit(left).alias("left")).distinct()
    both = stored(side(rows.filter("alone"), "of", True).unionByName(side(rows.join(hosts, ["hash", "band"]).filter(meets), "owner", False)), "large-components")
    number = lambda left: F.ceil(F.count(F.when(F.col("left") == F.lit(left), 1)) / F.lit(cfg.block))
    split = stored(both.groupBy("owner").agg(number(True).alias("own"), number(False).alias("others")).filter("others > 0"), "large-split")
    nth = F.pmod(F.xxhash64("cid"), F.when(F.col("left"), F.col("own")).otherwise(F.col("others")))
    met = both.join(split, "owner").withColumn("nth", nth).withColumn("met", F.explode(F.when(F.col("left"), blocks("others")).otherwise(blocks("own"))))
    by_owner = met.select(
        F.col("owner").alias("hash"), F.lit(-2).alias("band"), F.when(F.col("left"), F.col("nth")).otherwise(F.col("met")).cast("int").alias("bi"),
        (F.col("own") + F.when(F.col("left"), F.col("met")).otherwise(F.col("nth"))).cast("int").alias("bj"), "cid", F.lit(True).alias("home"), "left",
    )
    return _with_bits(shared.unionByName(by_owner), cls)


def _bit_rows(bits: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)


def candidates(size: np.ndarray, bits: list[bytes], home: np.ndarray, left: np.ndarray, cross: bool, percent: int):
    """Pairs of a tile whose bitmaps allow a link: (index, index, differing bits); ``cross`` pairs left rows with right ones."""
    width = np.fromiter(map(len, bits), dtype=np.int64, count=len(bits))
    out = []

    def against(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray, same: bool) -> None:
        step = max(1, (1 << 21) // max(1, len(b) * wa.shape[1]))
        for s in range(0, len(a), step):
            x = a[s : s + step]
            sx, sy = size[x][:, None], size[b][None, :]
            ok = (100 * np.minimum(sx, sy) >= percent * np.maximum(sx, sy)) & (home[x][:, None] | home[b][None, :])
            if same:
                ok &= np.arange(s, s + len(x))[:, None] < np.arange(len(b))[None, :]
            elif cross:
                ok &= left[x][:, None] != left[b][None, :]
            i, j = np.nonzero(ok)
            for lo in range(0, len(i), max(1, (1 << 21) // wa.shape[1])):
                u, v = i[lo : lo + max(1, (1 << 21) // wa.shape[1])], j[lo : lo + max(1, (1 << 21) // wa.shape[1])]
                differ = np.bitwise_count(wa[s + u] ^ wb[v]).sum(axis=1, dtype=np.int64)
                total = size[x[u]] + size[b[v]]
                # overlap <= (total - differ) / 2, and a link needs (100 + percent) * overlap >= percent * total
                fits = (100 + percent) * (total - differ) >= 2 * percent * total
                out.append((x[u[fits]], b[v[fits]], differ[fits]))

    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        words = _bit_rows([bits[i] for i in rows])
        if cross:
            l, r = np.flatnonzero(left[rows]), np.flatnonzero(~left[rows])
            against(rows[l], words[l], rows[r], words[r], False)
        else:
            against(rows, words, rows, words, True)
        wide = np.flatnonzero(width == 2 * w)
        if len(wide):
            # the lower half's bits and the upper half's bits are the same bits of the narrower bitmap
            big = _bit_rows([bits[i] for i in wide])
            against(rows, words, wide, big[:, : big.shape[1] // 2] ^ big[:, big.shape[1] // 2 :], False)
    if not out:
        e = np.empty(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


TILE = ["hash", "band", "bi", "bj"]


def forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the edges of a least spanning forest: each component takes its least edge until none is left."""
    if not len(a):
        return np.empty(0, np.int64)
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    by = np.argsort(weight, kind="stable")
    a, b = a[by], b[by]
    part = np.arange(len(ids))
    left, taken = np.arange(len(a)), []
    while len(left):
        x, y = part[a[left]], part[b[left]]
        least = np.full(len(ids), len(by))
        np.minimum.at(least, x, left)
        np.minimum.at(least, y, left)
        least = np.unique(least[least < len(by)])
        taken.append(least)
        vertices, head = unite(part[a[least]], part[b[least]])
        part = np.where(np.isin(part, vertices), head[np.minimum(np.searchsorted(vertices, part), len(vertices) - 1)], part)
        left = left[part[a[left]] != part[b[left]]]
    return by[np.concatenate(taken)]


def propose(tiled: DataFrame, first: int, last: int, cfg: Join) -> DataFrame:
    """Candidates ranked ``first`` to ``last`` (exclusive) by nearness for one of their classes, and of those ranked further
    a least spanning forest, unless both classes are in one component already (column root): rows (u, v) with u > v.
    Where a tile has more, rows (cid, head, hash, band, bi, bj) for the groups that its candidates connect: the classes
    of each group, and one of them that names it."""
    percent = cfg.percent

    def pairs_of(t: dict[str, np.ndarray], bits: list[bytes]):
        cross = bool(t["bi"][0] != t["bj"][0])
        i, j, d = candidates(t["n_shingles"], bits, t["home"], t["left"], cross, percent)
        if not len(i):
            return np.empty((0, 2), np.int64), np.empty((0, 2), np.int64)
        cid, root = t["cid"], t["root"]
        # rank of each candidate among those of either class, nearest first; the better one of its two ranks counts
        who, other, near = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([d, d])
        order = np.lexsort((cid[other], near, who))
        w = who[order]
        rank = np.empty(len(w), dtype=np.int64)
        rank[order] = np.arange(len(w)) - np.searchsorted(w, w)
        rank = np.minimum(rank[: len(i)], rank[len(i) :])
        open_ = (root[i] != root[j]) & (rank >= first)
        take = open_ & (rank < last)
        at = np.flatnonzero(open_)
        take[at[forest(root[i[at]], root[j[at]], d[at])]] = True
        rest = open_ & ~take
        more = np.empty((0, 2), np.int64)
        if rest.any():
            # the classes connected to a candidate left over, by the tile's whole candidate graph
            ids, group = unite(i, j)
            open_ = np.isin(group, group[np.searchsorted(ids, i[rest])])
            more = np.stack([cid[ids[open_]], cid[group[open_]]], axis=1)
        a, b = cid[i[take]], cid[j[take]]
        pair = np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1)
        return pair[pair[:, 0] != pair[:, 1]], more

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("u", "v", "cid", "head", "hash")] + [(c, pa.int32()) for c in ("band", "bi", "bj")])
        found: list[np.ndarray] = []
        open_: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
            more = np.concatenate(open_) if open_ else np.empty((0, 6), np.int64)
            n, m = len(pairs), len(more)
            is_pair = np.arange(n + m) < n
            cols = [pa.array(np.concatenate([pairs[:, k], np.zeros(m, np.int64)]), mask=~is_pair) for k in (0, 1)]
            for k, t in enumerate(schema.types[2:]):
                cols.append(pa.array(np.concatenate([np.zeros(n, np.int64), more[:, k]]), mask=is_pair).cast(t))
            found.clear()
            open_.clear()
            return pa.RecordBatch.from_arrays(cols, schema=schema)

        rest: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            edges = _starts(t)
            # the last tile may go on in the next batch
            rest = t.slice(edges[-1])
            _visit_tiles(t.slice(0, edges[-1]), edges[:-1], pairs_of, first, percent, found, open_)
            if sum(map(len, found)) + sum(map(len, open_)) > 500_000:
                yield flush()
        if rest is not None:
            _visit_tiles(rest, [0], pairs_of, first, percent, found, open_)
        yield flush()
        tx.release()

    return tiled.mapInArrow(visit, "u long, v long, cid long, head long, hash long, band int, bi int, bj int")


def _starts(t: pa.Table) -> list[int]:
    """Rows at which a tile begins."""
    keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in TILE])
    return [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]


def _pairs_alone(cols: dict[str, np.ndarray], bits: list[bytes], first: np.ndarray, percent: int) -> np.ndarray:
    """Candidates of the tiles of two classes each (rows ``first`` and the next), all at once."""
    cid, size, root = cols["cid"], cols["n_shingles"], cols["root"]
    a, b = first, first + 1
    ok = (root[a] != root[b]) & (cols["home"][a] | cols["home"][b])
    ok &= (cols["bi"][a] == cols["bj"][a]) | (cols["left"][a] != cols["left"][b])
    ok &= 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
    a, b = a[ok], b[ok]
    width = np.fromiter(map(len, bits), dtype=np.int64, count=len(bits))
    swap = width[a] > width[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    out = []
    for w in np.unique(width[a]).tolist():
        for fold in (False, True):
            at = np.flatnonzero((width[a] == w) & (width[b] == (2 * w if fold else w)))
            if len(at):
                x, y = _bit_rows([bits[i] for i in a[at]]), _bit_rows([bits[i] for i in b[at]])
                if fold:
                    y = y[:, : x.shape[1]] ^ y[:, x.shape[1] :]
                total = size[a[at]] + size[b[at]]
                differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                at = at[(100 + percent) * (total - differ) >= 2 * percent * total]
                out.append(np.stack([np.maximum(cid[a[at]], cid[b[at]]), np.minimum(cid[a[at]], cid[b[at]])], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _visit_tiles(t: pa.Table, edges: list[int], pairs_of, first: int, percent: int, found: list, open_: list) -> None:
    if not edges or not t.num_rows:
        return
    cols = {c: t.column(c).to_numpy() for c in (*TILE, "cid", "n_shingles", "home", "left", "root")}
    bits = t.column("bits").to_pylist()
    start = np.array(edges)
    two = start[np.diff(np.append(start, t.num_rows)) == 2]
    if len(two) and first == 0:
        found.append(_pairs_alone(cols, bits, two, percent))
    for s, e in zip(edges, [*edges[1:], t.num_rows], strict=True):
        if e - s > 2:
            pairs, more = pairs_of({c: v[s:e] for c, v in cols.items()}, bits[s:e])
            if len(pairs):
                found.append(pairs)
            if len(more):
                tile = np.array([[cols[c][s] for c in TILE]], dtype=np.int64)
                open_.append(np.concatenate([more, np.repeat(tile, len(more), axis=0)], axis=1))


def exact_links(pairs: DataFrame, sets: DataFrame, cfg: Join) -> DataFrame:
    """The pairs (u, v) that link, by intersecting their sorted hash arrays; ``sets`` has cid, hashes."""
    percent = cfg.percent

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(b.column("a"), b.column("b"), strict=True)):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.searchsorted(q, p)
                common = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                keep[i] = 100 * common >= percent * (len(p) + len(q) - common)
            yield b.select(["u", "v"]).filter(pa.array(keep))
        tx.release()

    both = pairs.join(sets.select(F.col("cid").alias("u"), F.col("hashes").alias("a")), "u").join(
        sets.select(F.col("cid").alias("v"), F.col("hashes").alias("b")), "v"
    )
    return both.select("u", "v", "a", "b").mapInArrow(verify, "u long, v long")


def sets_of(docs: DataFrame, wanted: DataFrame, cfg: Join, id_col: str, text_col: str) -> DataFrame:
    """Whole hash arrays (cid, hashes) of the wanted classes (cid, set_id, rep_id), made again from a text of each."""
    wanted = stored(wanted, "wanted")
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    ids = wanted.select("rep_id").distinct()
    side = F.broadcast(ids) if wanted.count() <= SMALL_ROWS else ids  # beyond, the texts are joined by a shuffle
    src = src.join(side, F.col("doc_id").eqNullSafe(F.col("rep_id")), "left_semi").select("text")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offsets in tx.pieces(b.column("text")):
                key, off = shingle_sets(data, offsets, cfg.n)
                size = np.diff(off).astype(np.uint64)
                total = np.zeros((2, len(key) + 1), dtype=np.uint64)
                np.cumsum(tx.mix(key), out=total[0, 1:])
                np.cumsum(tx.mix(key ^ np.uint64(0x5BD1E995)), out=total[1, 1:])
                ids = np.ascontiguousarray((total[:, off[1:]] - total[:, off[:-1]]).T + size[:, None])
                raw, id_raw = key.tobytes(), ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([id_raw[16 * i : 16 * i + 16] for i in range(len(size))], pa.binary()),
                        pa.array([raw[8 * s : 8 * e] for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.binary()),
                    ],
                    names=["set_id", "hashes"],
                )

    made = src.mapInArrow(again, "set_id binary, hashes binary").dropDuplicates(["set_id"])
    return stored(made.join(wanted.select("cid", "set_id"), "set_id").select("cid", "hashes"), "sets")


def link_roots(docs: DataFrame, cls: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links between classes (u, v), roots (u, root) of the classes that aren't their component's smallest).

    The links found connect every component; links inside a component may be left unchecked.
    """
    spark = docs.sparkSession
    links = spark.createDataFrame([], "u long, v long")
    roots = spark.createDataFrame([], "u long, root long")
    tiled, large = tiles(cls, cfg)
    links, roots = _settled(docs, cls, tiled.withColumn("root", F.col("cid")), links, roots, cfg, id_col, text_col)
    if cfg.pairs_later and large.first() is not None:
        known = roots.select(F.col("u").alias("cid"), F.col("root").alias("now"))
        more = block_pairs(large, cls, roots, cfg).join(known, "cid", "left").withColumn("root", F.coalesce("now", "cid")).drop("now")
        links, roots = _settled(docs, cls, more, links, roots, cfg, id_col, text_col)
    return links, roots


def _settled(
    docs: DataFrame, cls: DataFrame, tiled: DataFrame, links: DataFrame, roots: DataFrame, cfg: Join, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """Links and roots once no tile has an unchecked candidate between two components."""
    tiled = stored(tiled, "tiles")
    first, last = 0, cfg.nearest
    while True:
        seen = tiled.repartition(*TILE).sortWithinPartitions(*TILE)
        proposed = stored(propose(seen, first, last, cfg), "proposed")
        pairs = stored(proposed.filter("u is not null").select("u", "v").distinct(), "pairs")
        if pairs.first() is not None:
            members = pairs.select(F.col("u").alias("cid")).union(pairs.select("v")).distinct()
            wanted = cls.select("cid", "set_id", "rep_id").join(members, "cid", "left_semi")
            more = stored(exact_links(pairs, sets_of(docs, wanted, cfg, id_col, text_col), cfg), "links")
            if more.first() is not None:
                links = links.unionByName(more)
                # what is known already is a star, so only the new links have work to do
                roots = stars(roots.select("u", F.col("root").alias("v")).unionByName(more))
        known = roots.select(F.col("u").alias("cid"), F.col("root").alias("now"))
        # a group is settled if all its classes lie in one component; the others' classes are visited again
        groups = proposed.filter("hash is not null").select(*TILE, "head", "cid").join(known, "cid", "left")
        groups = stored(groups.select(*TILE, "head", "cid", F.coalesce("now", "cid").alias("root")), "groups")
        apart = groups.groupBy(*TILE, "head").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select(*TILE, "head")
        left = stored(groups.join(apart, [*TILE, "head"], "left_semi").select(*TILE, "cid", "root"), "groups-open")
        if left.first() is None:
            return links, roots
        tiled = stored(tiled.drop("root").join(left, [*TILE, "cid"]), "tiles-left")
        first, last = last, 16 * last + 2


def join(docs: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, set_id, n_shingles, component_id, first_of_component."""
    sk = stored(sketches(docs, cfg, id_col, text_col), "sketches")
    cls = stored(classes(sk), "classes")
    _, roots = link_roots(docs, cls, cfg, id_col, text_col)
    # only classes with a link can have a root besides themselves
    member = cls.select("cid", "set_id", "rep_id").join(roots, F.col("cid") == F.col("u"), "left").select(
        "set_id", "cid", "rep_id", F.coalesce("root", "cid").alias("root")
    )
    best = member.groupBy("root").agg(F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "cid")).alias("m"))
    named = member.join(best, "root").select(
        "set_id", F.col("m.rep_id").alias("component"), (F.col("m.cid") == F.col("cid")).alias("leads"), "rep_id"
    )
    rows = sk.select("doc_id", "text_key", "n_shingles", "set_id")
    some = rows.filter("n_shingles > 0").join(named, "set_id").select(
        "doc_id", "text_key", "set_id", "n_shingles", F.col("component").alias("component_id"),
        (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("rep_id"))).alias("first_of_component"),
    )
    none = rows.filter("n_shingles = 0").select(
        "doc_id", "text_key", "set_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first_of_component")
    )
    return some.unionByName(none)


def keep_one(docs: DataFrame, cfg: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component (that of the smallest id), with its own columns; documents without words stay."""
    judged = stored(join(docs, cfg, id_col, text_col), "judged")
    kept = judged.filter("first_of_component and n_shingles > 0")
    # several rows can have the leading id and set: other texts of that id go, and one of equal rows stays
    several = kept.groupBy("set_id").agg(F.min("text_key").alias("lead_key"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    others = kept.join(several, "set_id").filter("text_key <> lead_key")
    name = free_name(docs, "_drop")
    drop = stored(
        judged.filter("not first_of_component").select("doc_id", "text_key").union(others.select("doc_id", "text_key"))
        .select(F.col("doc_id").alias(f"{name}_id"), F.col("text_key").alias(f"{name}_key")).distinct(),
        "dropped",
    )
    side = F.broadcast(drop) if drop.count() <= SMALL_ROWS else drop
    key = F.xxhash64(F.coalesce(text_col, F.lit("")))
    out = docs.join(side, F.col(id_col).eqNullSafe(F.col(f"{name}_id")) & (key == F.col(f"{name}_key")), "left_anti")
    equal = stored(
        kept.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select(F.col("doc_id").alias(f"{name}_id"), F.col("text_key").alias(f"{name}_key")),
        "equal-rows",
    )
    if equal.first() is None:
        return out
    is_equal = F.col(id_col).eqNullSafe(F.col(f"{name}_id")) & (key == F.col(f"{name}_key"))
    return out.join(equal, is_equal, "left_anti").unionByName(
        out.join(equal, is_equal, "left_semi").dropDuplicates([id_col, text_col])
    )
