import random
import re

import numpy as np
import pyarrow as pa

from ratecraft.llm import linededup
from ratecraft.llm import text as tx
from tests.llm.fixtures import documents, no_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lines_of(text):
    return [(i, line, len(WORD.findall(line))) for i, line in enumerate((text or "").split("\n")) if WORD.search(line)]


def brute(docs, least):
    """Delete the lines of every occurrence of a qualifying run that an earlier place has too (all run lengths tried)."""
    order = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, d[2]))
    seqs = {d: lines_of(d[1]) for d in order}
    first = {}
    for d in order:
        seq = seqs[d]
        for i in range(len(seq)):
            words = 0
            for j in range(i, len(seq)):
                words += seq[j][2]
                if words >= least:
                    first.setdefault(tuple(x[1] for x in seq[i : j + 1]), (d, i))
    out = {}
    for d in order:
        seq, gone = seqs[d], set()
        for i in range(len(seq)):
            words = 0
            for j in range(i, len(seq)):
                words += seq[j][2]
                if words >= least and first[tuple(x[1] for x in seq[i : j + 1])] != (d, i):
                    a, b = seq[i][0], (seq[j + 1][0] - 1 if j + 1 < len(seq) else d[1].count("\n"))
                    gone |= set(range(a, b + 1))
        t = d[1]
        out[d[:2]] = t if not gone else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
    return out


def check(spark, docs, least):
    keyed = docs.withColumn("key", linededup.text_key(docs["text"])).select("doc_id", "text", "key").collect()
    want = brute([(r["doc_id"], r["text"], r["key"]) for r in keyed], least)
    got = linededup.deduplicate(docs, min_words=least).collect()
    assert len(got) == len(keyed)
    for r in got:
        assert r["_lines"]["text"] == want[(r["doc_id"], r["text"])]
        if r["text"] is not None:
            assert r["_lines"]["n_lines"] == r["text"].count("\n") + 1
    return got


def test_fixture(spark):
    got = check(spark, documents(spark), 12)
    assert any(r["_lines"]["n_deleted"] for r in got) and got[0]["n_words"] == "x"


def test_random_lines(spark):
    rng = random.Random(9)
    lines = [" ".join(f"w{rng.randint(0, 5)}" for _ in range(rng.randint(0, 6))) for _ in range(6)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    for least in (1, 7, 15):
        check(spark, documents(spark, rows), least)


def test_passage_across_documents(spark):
    rng = random.Random(1)
    line = lambda n: " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(n))
    passage = "\n".join(line(20) for _ in range(3))
    rows = [(k, f"{line(30)}\n{line(9)}\n{passage}\n{line(25)}") for k in range(8)]
    got = {r["doc_id"]: r["_lines"]["text"] for r in linededup.deduplicate(documents(spark, rows)).collect()}
    assert got[0] == rows[0][1]
    assert all(got[k] == rows[k][1].replace(passage + "\n", "") for k in range(1, 8))


def test_empty_table(spark):
    assert linededup.deduplicate(no_documents(spark)).count() == 0


def test_names_tell_runs_apart():
    t = pa.array(["a\nb\na\nb\na\nc\na\nb\na\nb\na\nd"])
    _, _, data, off = next(tx.pieces(t))
    starts, lens, l_off = tx.lines(data, off)
    ids = tx.hash_spans(data, starts, lens)
    levels = linededup.doubled_names(ids, l_off, len(ids))
    text = t[0].as_py().split("\n")
    runs = [(i, j) for i in range(len(text)) for j in range(i, len(text))]
    names = linededup.run_names(levels, np.array([r[0] for r in runs]), np.array([r[1] for r in runs]))
    by = {}
    for (i, j), n in zip(runs, names.tolist(), strict=True):
        by.setdefault(n, set()).add(tuple(text[i : j + 1]))
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({tuple(text[i : j + 1]) for i, j in runs})
