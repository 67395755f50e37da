import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from ratecraft.llm import trie_lm
from ratecraft.llm.eliasfano import EliasFano, pack_bits, read_bits
from tests.llm.fixtures import documents, no_documents, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
END = object()


def tokens(t):
    return [*WORD.findall((t or "").translate(UPPER)), END]


def is_held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0


def brute(rows, strength):
    c, cc = Counter(), Counter()
    for d, t in rows:
        if not is_held(d):
            w = tokens(t)
            c.update(w)
            cc.update(zip([END, *w], w, strict=False))
    n, v = sum(c.values()), len(c)
    mass = n + 0.1 * (v + 1)
    out = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + 0.1) / mass) for x in w)
        s = 0.0
        for u, x in zip([END, *w], w, strict=False):
            s += math.log10((cc[u, x] + strength * (c[x] + 0.1) / mass) / (c[u] + strength))
        out.append((d, is_held(d), len(w), sum(c[x] > 0 for x in w), n, base, s))
    return sorted(out, key=lambda r: (str(r[0]), r[2], r[5]))


def collected(df):
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: (str(r[0]), r[2], r[5]))


def same(got, want, loose=1e-6):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9), (g, w)
        assert abs(g[6] - w[6]) <= loose * (1 + abs(w[6])), (g, w)


def test_matches_brute_force(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = brute(rows, 20.0)
    for cfg in (
        trie_lm.Config(strength=20.0),
        trie_lm.Config(strength=20.0, shard_bytes=20_000, hot=60, chunk_tokens=500),  # many shards, hot words split
    ):
        scores, folder, t = trie_lm.fit_and_score(df, cfg)
        same(collected(scores), want, 0.01)  # quantised values
        again = trie_lm.score(df, folder, t, cfg)
        same(collected(again), collected(scores))
    assert len(t.hot_words) > 1 and max(t.hot_parts) > 1


def test_probabilities_add_up():
    """Over all known words and one unknown, p(. | u) sums to 1."""
    rng = random.Random(0)
    text = [rng.choice("abcdef") for _ in range(60)]
    c, cc = Counter(text), Counter(zip(text, text[1:], strict=False))
    ctx = Counter(text[:-1])
    mass = len(text) + 0.1 * (len(c) + 1)
    for u in c:
        p = [(cc[u, x] + 5 * (c[x] + 0.1) / mass) / (ctx[u] + 5) for x in [*c, "never"]]
        assert math.isclose(sum(p), 1.0)


def test_empty_tables(spark):
    scores, _, _ = trie_lm.fit_and_score(no_documents(spark))
    assert scores.count() == 0
    only_held = [k for k in range(200) if is_held(k)][:3]
    scores, _, t = trie_lm.fit_and_score(documents(spark, [(k, "a b a") for k in only_held]))
    rows = scores.collect()
    assert t.tokens == 0 and all(r["n_known"] == 0 and r["n_tokens"] == 4 for r in rows)


def test_held_out_texts_are_better_predicted_than_by_words_alone(spark):
    rng = random.Random(6)
    chain = {w: [rng.choice("abcdefghij") * 3 for _ in range(2)] for w in [c * 3 for c in "abcdefghij"]}
    rows = []
    for k in range(150):
        w = "aaa"
        out = []
        for _ in range(60):
            out.append(w)
            w = rng.choice(chain[w])
        rows.append((k, " ".join(out)))
    got = [r for r in trie_lm.fit_and_score(documents(spark, rows))[0].collect() if r["held_out"]]
    assert got and all(r["score"] > r["base_score"] for r in got)


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, bits in ((0, 10), (1, 64), (5, 4), (1000, 64), (1000, 12), (70_000, 57)):
        top = min(2**bits - 1, 2**63 - 1)
        v = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        if n:
            v[-1] = 2**bits - 1
        e = EliasFano.encode(v, bits)
        ef = EliasFano(e["n"], e["low_bits"], np.frombuffer(e["low"], np.uint8), np.frombuffer(e["high"], np.uint8))
        assert (ef.get(np.arange(n)) == v).all()
        q = np.concatenate([v, rng.integers(0, top, 500, dtype=np.uint64)])
        assert (ef.successor(q) == np.searchsorted(v, q)).all()
        if n > 10:
            b, s = n // 3, 2 * n // 3
            assert (ef.successor(q, b, s) == b + np.searchsorted(v[b:s], q)).all()
            # two bits a value besides the packed low bits
            assert 8 * len(e["high"]) <= 4 * n + 64


def test_packed_bits():
    rng = np.random.default_rng(1)
    for width in (1, 7, 8, 31, 56):
        v = rng.integers(0, 2**width, 70_001, dtype=np.uint64)
        raw = np.frombuffer(pack_bits(v, width), np.uint8)
        assert (read_bits(raw, np.arange(len(v)), width) == v).all()


def test_quantised_values():
    rng = np.random.default_rng(2)
    few = rng.integers(0, 50, 1000).astype(float)
    book, codes = trie_lm.quantise(few)
    assert (book[codes] == few).all()
    many = rng.normal(size=50_000)
    book, codes = trie_lm.quantise(many)
    assert np.abs(book[codes] - many).mean() < 0.02 and abs((book[codes] - many).sum()) < 1e-6
    assert texts()
