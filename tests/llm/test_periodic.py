import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import periodic, queries
from ratecraft.llm.storage import ship
from tests.llm.fixtures import documents, no_documents, sentence
from tests.llm.test_quality import WORD


def brute_runs(w):
    n, best = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i + q - a >= max(24, 3 * q):
                best.setdefault((a, i + q), q)
    return sorted((a, e - a, q) for (a, e), q in best.items())


def brute(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return (
        doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest(),
    )


def words(rng, n, vocabulary):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def texts(seed=1):
    """Runs of all periods around the scales' ends, nested and neighbouring runs, nearly periodic texts."""
    rng = random.Random(seed)
    out = []
    for q in [*range(1, 20), 24, 25, 31, 32, 33, 63, 64, 65, 127, 128, 129]:
        base = words(rng, q, 3 if q > 4 else 50)
        for copies in (2.9, 3, 3.4, 6):
            k = max(int(q * copies), 23 if copies < 3 else 24)
            out.append([*words(rng, rng.randrange(40), 30), *(base[i % q] for i in range(k)), *words(rng, rng.randrange(9), 30)])
    for _ in range(60):
        out.append(words(rng, rng.randrange(300), rng.choice([1, 2, 2, 3])))
    a = ["a"] * 40
    out += [a, a[:23], a[:24], [*a, "b", *a], [*a, *["b"] * 30], ([*a[:9], "b"] * 12 + ["c"]) * 5, (["x", "y"] * 20 + ["z"]) * 4]
    out += [["a"] * 8 + ["c"] + ["a"] * 16 + ["c"] + ["a"] * 30, words(rng, 30, 99) * 3 + words(rng, 40, 99) * 3]
    fib = ["0"], ["0", "1"]
    for _ in range(10):
        fib = fib[1], fib[1] + fib[0]
    out.append(fib[1])
    return [" ".join(w) for w in out]


def test_transform_and_mismatch():
    rng = np.random.default_rng(3)
    for size in (2, 8, 64):
        x = rng.integers(0, periodic.PRIME, (3, size), dtype=np.uint64)
        assert (periodic.restore(periodic.transform(x)) == x).all()
        block = max(1, size // 2)
        b = rng.integers(1, periodic.PRIME, (3, block), dtype=np.uint64)
        got = periodic.mismatch(b, x)
        for r in range(3):
            for d in range(size - block + 1):
                want = sum((int(u) - int(v)) ** 2 for u, v in zip(b[r], x[r, d : d + block], strict=True)) % periodic.PRIME
                assert got[r, d] == want


def test_runs_match_brute_force():
    for seed in (1, 2):
        docs = [t.split() for t in texts(seed)]
        keys = np.concatenate([np.array([zlib.crc32(x.encode()) for x in d], dtype=np.uint64) for d in docs])
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        found = periodic.runs_of(keys, offsets)
        for i, d in enumerate(docs):
            mine = found[(found[:, 0] >= offsets[i]) & (found[:, 0] < offsets[i + 1])]
            assert [(s - offsets[i], e - s, p) for s, e, p in mine.tolist()] == sorted(brute_runs(d), key=lambda r: (r[0], r[2])), d
    with pytest.raises(ValueError):
        periodic.runs_of(keys, offsets, copies=2)


def write(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(5)
    ts = [*texts(4), *[sentence(rng, rng.choice([0, 1, 2, 30, 200, 700])) for _ in range(150)]]
    rows = [(i, t) for i, t in enumerate(ts)] + [(None, ts[8]), (None, None), (3, ts[3]), (3, ts[3]), (10**12, "")]
    rows += [(-7, "é  ñ\x0b\x85 " * 30), (77, "w " * 3000), (78, None)]
    got = queries.op12_periodic_runs(spark, write(spark, tmp_path, documents(spark, rows))).collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in got), key=str) == sorted((brute(*r) for r in rows), key=str)
    assert sum(r["n_runs"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 10) > 100


def test_operator_on_odd_tables(spark):
    ship(spark)
    docs = documents(spark)
    out = docs.withColumn("length", periodic.find_runs(F.col("text"))).collect()
    assert len(out) == docs.count()
    for r in out:
        w = WORD.findall(r["text"] or "")
        runs = [(x["start"], x["length"], x["period"]) for x in r["length"]["runs"]]
        if len(w) < 4000:
            assert runs == brute_runs(w)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        assert r["length"]["collapsed"] == " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r["length"]["n_words"] == len(w) and r["shard"] == "y"
    assert no_documents(spark).withColumn("runs", periodic.find_runs(F.col("text"))).count() == 0


def test_long_text():
    rng = random.Random(8)
    w = words(rng, 30000, 10**6)
    w[5000:25000] = (w[5000:9000] * 5)[:20000]
    keys = np.array([zlib.crc32(x.encode()) for x in w], dtype=np.uint64)
    assert periodic.runs_of(keys, np.array([0, len(w)])).tolist() == [[5000, 25000, 4000]]
    same = np.full(200_000, 7, dtype=np.uint64)
    assert periodic.runs_of(same, np.array([0, len(same)])).tolist() == [[0, len(same), 1]]
