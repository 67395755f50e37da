import random
import re

import numpy as np
from pyspark.sql import functions as F

from ratecraft.llm import components, jaccard
from tests.llm.fixtures import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(t, n=3):
    w = WORD.findall((t or "").translate(UPPER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, percent=90):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=str), len({find(i) for i in range(len(rows))})


def collected(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def near_copies(seed=2, groups=6, copies=14):
    """Chains and clouds of near copies around the threshold, and unrelated texts that share a long passage."""
    rng = random.Random(seed)
    rows = []
    passage = " ".join(f"p{k}" for k in range(40))
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range(rng.choice([30, 70, 150, 400]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                w = w[rng.randint(0, 3) :]
            rows.append(" ".join(w))
            if rng.random() < 0.3:
                base = w
        rows.append(passage + " " + " ".join(f"u{rng.randint(0, 10**6)}" for _ in range(20)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_fixture(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert collected(jaccard.join(df)) == brute(rows)[0]


def test_near_copies_at_every_block_size(spark):
    rows = near_copies()
    want, n = brute(rows)
    assert n < len(rows) - 20
    df = documents(spark, rows)
    for cfg in (jaccard.Join(block=4, nearest=1), jaccard.Join(block=4, nearest=1, pairs_later=True)):
        assert collected(jaccard.join(df, cfg)) == want


def test_bound_never_drops_a_link():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = a.copy()
        b[: rng.integers(0, max(1, n // 8) + 1)] = rng.integers(0, 2**63)
        b = np.unique(np.concatenate([b, rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1)), dtype=np.uint64)]))
        a = np.unique(a)
        common = len(np.intersect1d(a, b))
        size, bits = np.array([len(a), len(b)]), []
        for x in (a, b):
            width = int(jaccard.width_of(np.array([len(x)]), 8192)[0])
            flips = np.bincount((jaccard.tx.mix(x + np.uint64(7)) % np.uint64(width)).astype(np.int64), minlength=width) & 1
            bits.append(np.packbits(flips.astype(np.uint8), bitorder="little").tobytes())
        yes = np.ones(2, bool)
        i, _, differ = jaccard.candidates(size, bits, yes, yes, False, 90)
        if 100 * common >= 90 * (len(a) + len(b) - common):
            assert len(i) == 1
        if len(i):
            assert differ[0] <= len(a) + len(b) - 2 * common


def test_keep_one(spark):
    rows = near_copies(seed=4, groups=3)
    rows += [(500, rows[0][1]), (500, rows[0][1]), (0, rows[0][1]), (0, "quite another text under a used id"), (900, None), (901, "")]
    df = documents(spark, rows)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    empty = [r for r in rows if not grams(r[1])]
    assert len(got) == brute([r for r in rows if grams(r[1])])[1] + len(empty)
    assert set(empty) <= set(got) <= set(rows)


def test_empty_table(spark):
    assert jaccard.join(no_documents(spark)).count() == 0 and jaccard.keep_one(no_documents(spark)).count() == 0


def classes_on_one_hash(spark, n):
    """Classes of one size that share a hash and nothing else."""
    rows = [(k, 100, np.array([7, 1000 + k], np.int64).tobytes(), np.random.default_rng(k).bytes(16)) for k in range(n)]
    return spark.createDataFrame([(c, s, bytearray(p), bytearray(b)) for c, s, p, b in rows], "cid long, n_shingles long, prefix binary, bits binary").repartition(4)


def test_frequent_hash_is_visited_in_rows_of_its_size(spark):
    cls, cfg = classes_on_one_hash(spark, 2000), jaccard.Join(block=64, pairs_later=True)
    first, large = jaccard.tiles(cls, cfg)
    assert first.count() == 2000 and large.filter("home").count() == 2000
    assert first.groupBy(*jaccard.TILE).count().agg({"count": "max"}).first()[0] < 2 * 64
    # one component: no pair of blocks is opened
    one = spark.range(1, 2000).selectExpr("id AS u", "0L AS root")
    assert jaccard.block_pairs(large, cls, one, cfg).count() == 0
    # a large component and 40 other classes: each of the others' block meets all
    most = spark.range(1, 1960).selectExpr("id AS u", "0L AS root")
    opened = jaccard.block_pairs(large, cls, most, cfg).collect()
    met = {(r["bi"], r["bj"]) for r in opened}
    assert 2000 <= len(opened) < 2 * 2000 + 40 * 40 and len({r["cid"] for r in opened}) == 2000
    sides = {t: [{r["cid"] for r in opened if (r["bi"], r["bj"]) == t and r["left"] == s} for s in (True, False)] for t in met}
    others = set(range(1960, 2000))
    for o in others:
        seen = set().union(*[(r or l) if o in l else l for l, r in sides.values() if o in l or o in r])
        assert len(seen | {o}) == 2000
    # all apart: every pair of blocks once
    none = spark.createDataFrame([], "u long, root long")
    k = -(-2000 // 64)
    assert jaccard.block_pairs(large, cls, none, cfg).select(*jaccard.TILE).distinct().count() == k * (k - 1) // 2


def classes_on_many_hashes(spark, n, hashes):
    """Classes of one size, all on all hashes but one each."""
    rows = [(k, 100, np.array([h for h in range(hashes) if h != k % (hashes + 9)], np.int64).tobytes(), np.random.default_rng(k).bytes(16)) for k in range(n)]
    return spark.createDataFrame([(c, s, bytearray(p), bytearray(b)) for c, s, p, b in rows], "cid long, n_shingles long, prefix binary, bits binary").repartition(4)


def test_bands_of_nearly_the_same_classes_are_one(spark):
    n, hashes = 900, 30
    cls, cfg = classes_on_many_hashes(spark, n, hashes), jaccard.Join(block=64, pairs_later=True)
    first, large = jaccard.tiles(cls, cfg)
    # 26,900 rows band by band
    assert first.count() == large.filter("home").count() < n * hashes / 2
    none = spark.createDataFrame([], "u long, root long")
    met = set()
    for opened in (first, jaccard.block_pairs(large, cls, none, cfg)):
        tile: dict[tuple, tuple[list, list]] = {}
        for r in opened.select(*jaccard.TILE, "cid", "left").collect():
            tile.setdefault(tuple(r[:4]), ([], []))[0 if r["left"] else 1].append(r["cid"])
        for (_, _, bi, bj), (left, right) in tile.items():
            met |= {frozenset((a, b)) for a in left for b in (left if bi == bj else right)}
    # every two classes share a hash
    assert len({m for m in met if len(m) == 2}) == n * (n - 1) // 2


def test_bands_that_share_most_classes_are_one(spark):
    n, hashes = 600, 30
    on = np.random.default_rng(5).random((n, hashes)) < 0.85
    rows = [(k, 100, np.flatnonzero(on[k]).astype(np.int64).tobytes(), np.random.default_rng(k).bytes(16)) for k in range(n)]
    cls = spark.createDataFrame([(c, s, bytearray(p), bytearray(b)) for c, s, p, b in rows], "cid long, n_shingles long, prefix binary, bits binary")
    first, large = jaccard.tiles(cls, jaccard.Join(block=64, pairs_later=True))
    # every class stays, in few bands: 15,300 rows band by band
    assert first.count() == large.filter("home").count() < 3 * n
    assert large.select("cid").distinct().count() == n and large.filter("not home").count() == 0


def test_large_component_meets_others_once_for_all_hashes(spark):
    n, hashes = 900, 30
    cls, cfg = classes_on_many_hashes(spark, n, hashes), jaccard.Join(block=64, pairs_later=True)
    rows = cls.select("cid", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(hashes - 1).cast("long"))).alias("hash"))
    large = rows.filter(f"hash <> cid % {hashes + 9}").select("hash", F.lit(3).alias("band"), "cid", F.lit(True).alias("home"))
    most = spark.range(1, 880).selectExpr("id AS u", "0L AS root")
    opened = jaccard.block_pairs(large, cls, most, cfg).collect()
    assert len({r["cid"] for r in opened}) == n and len([r for r in opened if r["cid"] < 880]) == 880
    assert {r["cid"] for r in opened if r["band"] == -2 and not r["left"]} == set(range(880, n))


def test_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 80, 300), rng.integers(0, 80, 300)
    a, b = a[a != b], b[a != b]
    w = rng.integers(0, 9, len(a))
    got = jaccard.forest(a, b, w)
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    want = 0
    for e in np.argsort(w, kind="stable").tolist():
        x, y = find(a[e]), find(b[e])
        if x != y:
            root[x] = y
            want += w[e]
    assert w[got].sum() == want and len(got) == len(set(got.tolist())) == 80 - len({find(x) for x in range(80)})
    assert len(jaccard.forest(a[:0], b[:0], w[:0])) == 0


def test_keep_one_with_clashing_names(spark):
    rows = near_copies(seed=4, groups=2)
    df = documents(spark, rows).withColumns({"_drop_id": F.lit("x"), "_DROP_key": F.lit(3), "__drop": F.lit(None).cast("string")})
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in jaccard.keep_one(documents(spark, rows)).collect())


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000 + k, 2000) for k in range(1, 60)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["u"]: r["root"] for r in components.stars(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_sentences(spark):
    rng = random.Random(12)
    base = sentence(rng, 200)
    rows = [(k, base[: len(base) - 9 * k]) for k in range(25)]
    df = documents(spark, rows)
    assert collected(jaccard.join(df, jaccard.Join(block=5))) == brute(rows)[0]
