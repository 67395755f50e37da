"""The pipeline against a brute-force version of its stages, and its stages on odd tables."""

import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from ratecraft.llm import linededup, quality
from tests.llm import test_linededup, test_postings, test_quality
from tests.llm.fixtures import documents
from tests.llm.test_jaccard import grams
from tests.llm.test_tokens import check_pieces

WORDY = re.compile(r"[^\x20\x09-\x0D]")
BENCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(17)
    line = lambda n: " ".join(f"w{rng.randint(0, 4000)}" for _ in range(n))
    text = lambda: "\n".join(line(rng.randint(5, 15)) for _ in range(rng.randint(6, 14)))
    bench = [(k, line(rng.choice([8, 20, 30]))) for k in range(12)] + [(90, None), (91, "")]
    shared = "\n".join(line(12) for _ in range(6))
    rows = [text() for _ in range(40)]
    rows += [f"{text()}\n{shared}\n{line(9)}" for _ in range(6)]  # a passage of 72 words
    rows += [f"{line(60)}\n{bench[k][1]}\n{line(30)}" for k in range(12)]
    for k in range(8):  # near copies, too short a run to lose lines
        w = rows[k].replace("\n", " ").split()
        w[rng.randrange(len(w))] = "changed"
        rows.append(" ".join(w))
        rows.append(rows[-1] + " more")
    rows += [rows[3], rows[3]]  # exact copies
    rows += [None, "", "too short", (line(7) + " ") * 30, "\n".join([line(10)] * 12)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)], bench


def near_components(rows):
    """(id, smallest id of its component) by five words and 80 %; documents without words are alone."""
    sets = [grams(t, 5) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, least[find(i)]) for i, (d, _) in enumerate(rows)]


def brute(spark, rows, bench):
    rules = quality.Rules()
    good = []
    for d, t in rows:
        q = test_quality.brute(t)
        n, top = q["n_words"], q["longest_repeat"]
        covered = q["covered_words"] > rules.min_covered and 100 * q["covered_words"] > rules.max_covered_pct * n
        bad = covered or top > rules.max_longest_words or (top > rules.max_longest and 100 * top > rules.max_longest_pct * n)
        if not q["base_failed"] and not bad:
            good.append((d, t))
    keyed = documents(spark, good).select("doc_id", linededup.text_key(F.col("text")).alias("k"))
    keys = {r["doc_id"]: r["k"] for r in keyed.collect()}
    left = test_linededup.brute([(d, t, keys[d]) for d, t in good], linededup.MIN_WORDS)
    deduped = [(d, left[(d, t)]) for d, t in good]
    deduped = [(d, t) for (d, t), (_, before) in zip(deduped, good, strict=True) if t == before or WORDY.search(t)]
    leads = {(c, d) for d, c in near_components(deduped)}
    unique = [(d, t) for d, t in deduped if (d, d) in leads]
    hits = {r[0]: r[-1] for r in test_postings.brute(unique, bench)}
    return good, deduped, unique, [(d, t) for d, t in unique if not hits[d]]


def write(spark, tmp_path, rows, bench):
    documents(spark, rows).select(*DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, BENCH).write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_match_brute_force(spark, tmp_path):
    rows, bench = corpus()
    sf = write(spark, tmp_path, rows, bench)
    want = brute(spark, rows, bench)
    assert len(rows) > len(want[0]) > len(want[2]) > len(want[3]) > 20
    assert any(dict(want[1])[d] != t for d, t in want[0] if d in dict(want[1]))  # some lines went
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want, strict=False):
        out = stage(spark, docs, sf)
        assert out.columns == DOCS and out.dtypes == docs.dtypes, name
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted(expected), name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    pieces = corpus_pipeline.run(spark, sf).collect()
    check_pieces(pieces, docs, 0, 1024, "sequence_id")
    assert {r["doc_id"] for r in pieces} == {d for d, _ in want[3]}


def test_odd_tables(spark, tmp_path):
    """Nulls, repeated rows and ids, clashing columns; then an empty table: nothing crashes, clean texts stay."""
    rows, bench = corpus()
    odd = [*rows[:30], rows[0], rows[1], (None, rows[2][1]), (None, None), (rows[4][0], "another text " + rows[5][1])]
    sf = write(spark, tmp_path, rows, bench)
    for table in (odd, []):
        docs = documents(spark, table).withColumns({c: F.lit(c) for c in ("_quality", "_lines", "_lines_id", "_drop_id", "_drop_key", "_bad_text")})
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            assert out.filter("_quality <> '_quality' or _lines <> '_lines' or _bad_text <> '_bad_text'").count() == 0
            path = str(tmp_path / f"{name}-{len(table)}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 0) == bool(table)
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() > 0) == bool(table)


def test_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(e.oracle_sql()) <= set(names)


def test_near_duplicates_by_five_words(spark):
    """Pairs between the stage's rule (5 words, 80 %) and op6's (3 words, 90 %) lose a document; pairs under 80 % don't."""
    rng = random.Random(29)
    rows = []
    for k, changes in enumerate([1, 4, 4, 5, 30]):
        w = [f"t{k}x{i}" for i in range(200)]
        at = range(6, 200, 6)[:changes] if changes == 30 else [20 + 40 * i for i in range(changes)]
        copy = [f"other{k}x{i}" if i in at else x for i, x in enumerate(w)]
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(copy))]
    sets = {n: [grams(t, n) for _, t in rows] for n in (3, 5)}
    alike = lambda n, i, j: len(sets[n][i] & sets[n][j]) / len(sets[n][i] | sets[n][j])
    assert all(0.8 <= alike(5, i, i + 1) < 0.84 and alike(3, i, i + 1) < 0.9 for i in (2, 4))
    gone = {j for i in range(len(rows)) for j in range(i + 1, len(rows)) if alike(5, i, j) >= 0.8}
    assert gone == {1, 3, 5}
    rng.shuffle(rows)
    out = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in out.collect()) == sorted({d for d, _ in rows} - gone)
