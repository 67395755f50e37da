import re
from collections import Counter

from ratecraft.llm import quality
from tests.llm.fixtures import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, least=8):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    win = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    rep = set()
    for i in range(n - 2):
        if win[tuple(w[i : i + 3])] > 1:
            rep |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    longest = [0] * n
    where = {}
    for i in range(n - least + 1):
        where.setdefault(tuple(w[i : i + least]), []).append(i)
    for places in where.values():
        for i in places:
            for j in places:
                if i != j:
                    k = 0
                    while i + k < n and j + k < n and w[i + k] == w[j + k]:
                        k += 1
                    longest[i] = max(longest[i], k)
    cover = [False] * n
    for i, k in enumerate(longest):
        cover[i : i + k] = [True] * k if k else cover[i : i + k]
    return {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup, "n_repeat_words": len(rep), "covered_words": sum(cover), "longest_repeat": max(longest, default=0),
        "base_failed": n < 50 or 100 * len(rep) > 50 * n, "cover": cover,
    }


def test_signals_match_brute_force(spark):
    short = [r for r in documents(spark).collect() if len(r["text"] or "") < 8000]
    docs = documents(spark, [(r["doc_id"], r["text"]) for r in short])
    got = quality.judge(docs).select("doc_id", "text", "n_words", "_quality").collect()
    assert len(got) == len(short)
    for r in got:
        want, q = brute(r["text"]), r["_quality"].asDict()
        assert r["n_words"] == "x"  # the caller's own column
        assert {k: q[k] for k in want if k != "cover"} == {k: v for k, v in want.items() if k != "cover"}, r["text"]
        spans = [False] * want["n_words"]
        for s, e in zip(q["span_starts"], q["span_ends"], strict=True):
            spans[s:e] = [True] * (e - s)
        assert spans == want["cover"]


def test_verdict(spark):
    import random

    rng = random.Random(3)
    clean = " ".join(f"word{rng.randint(0, 10**6)}" for _ in range(400))
    block = " ".join(f"b{i}" for i in range(150))
    looped = clean + " " + block + " " + " ".join(f"m{i}" for i in range(90)) + " " + block
    docs = documents(spark, [(1, clean), (2, looped), (3, "few words"), (4, None)])
    rows = {r["doc_id"]: r["_quality"] for r in quality.judge(docs).collect()}
    assert rows[1]["kept"] and not rows[1]["base_failed"]
    assert not rows[2]["base_failed"] and not rows[2]["kept"] and rows[2]["longest_repeat"] == 150
    assert rows[3]["base_failed"] and rows[4]["base_failed"] and rows[4]["n_words"] == 0
    assert [r["doc_id"] for r in quality.keep_good(docs).collect()] == [1]
    assert quality.keep_good(docs).columns == docs.columns


def test_each_limit_rejects_alone(spark):
    fresh = iter(range(10**6))
    new = lambda n: " ".join(f"v{next(fresh)}" for _ in range(n))

    def twice(repeats, n):
        """A text of n words in which passages of these lengths stand twice."""
        parts = [new(k) for k in repeats]
        rest = n - 2 * sum(repeats)
        return " ".join(x for p in parts for x in (p, new(rest // (2 * len(parts))), p, new(rest // (2 * len(parts)))))

    texts = {
        "share": twice([60, 60, 60], 960),  # 37.5 % covered, longest 60
        "passage": twice([150], 1400),  # 21 % covered, longest 150 words and 10.7 %
        "words": twice([250], 6000),  # 8 % covered, longest 250 words and 4 %
        "below share": twice([60, 60], 960),  # 25 %
        "line at both ends": twice([13], 60),  # 43 % of a short text, 26 words
        "below words": twice([190], 6000),
    }
    rows = {r["doc_id"]: r["_quality"] for r in quality.judge(documents(spark, list(enumerate(texts.values())))).collect()}
    got = {name: rows[i] for i, name in enumerate(texts)}
    assert not any(q["base_failed"] for q in got.values())
    limits = lambda q: (
        40 < q["covered_words"] > 0.3 * q["n_words"], 100 < q["longest_repeat"] > 0.1 * q["n_words"], q["longest_repeat"] > 200
    )
    assert [limits(q) for q in got.values()] == [
        (True, False, False), (False, True, False), (False, False, True), *[(False, False, False)] * 3
    ]
    assert [q["kept"] for q in got.values()] == [False, False, False, True, True, True]


def test_empty_table_and_pieces(spark):
    assert quality.judge(no_documents(spark)).count() == 0
    import random

    rng = random.Random(5)
    t = sentence(rng, 300)
    import numpy as np
    import pyarrow as pa

    from ratecraft.llm import text as tx

    arr = pa.array([t, None, "", t, t + " x"])
    one = [quality._signals_of(d, o, 8) for _, _, d, o in tx.pieces(arr)]
    many = [quality._signals_of(d, o, 8) for _, _, d, o in tx.pieces(arr, 10)]
    assert np.concatenate([p["covered_words"] for p in many]).tolist() == one[0]["covered_words"].tolist()
    assert [x for p in many for x in p["span_starts"]] == one[0]["span_starts"]
