import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm import postings, storage
from tests.llm.fixtures import VOCAB, documents, no_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return WORD.findall((t or "").translate(UPPER))


def brute(docs, items, size=13):
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, it in items:
            iw = words(it)
            n = min(size, len(iw))
            wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(item)
        ids = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(ids), ",".join(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def items_table(spark, items):
    schema = T.StructType([T.StructField(c, k) for c, k in (("item_id", T.LongType()), ("text", T.StringType()), ("n_words", T.StringType()))])
    return spark.createDataFrame([(*i, "x") for i in items], schema)


def collected(df):
    return sorted(
        (
            (r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"])
            for r in df.collect()
        ),
        key=str,
    )


def cases(seed=11):
    rng = random.Random(seed)
    pick = lambda n: " ".join(rng.choice(VOCAB) for _ in range(n))
    items = [(k, pick(rng.choice([1, 3, 12, 13, 14, 30]))) for k in range(20)]
    items += [(3, pick(15)), (None, pick(16)), (50, None), (51, ""), (52, "!!"), (53, items[5][1])]
    docs = [(k, pick(rng.choice([0, 1, 5, 40, 300]))) for k in range(40)]
    for k, (_, t) in enumerate(items):
        docs.append((100 + k, f"{pick(rng.choice([0, 3, 200]))} {(t or '').upper()}, {pick(4)}"))
        docs.append((200 + k, " ".join((t or "").split()[:12])))
    docs += [(None, items[0][1]), (None, None), (7, items[1][1]), (7, items[1][1]), (8, "z" * 3000)]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = cases()
    want = brute(docs, items)
    assert sum(r[-1] for r in want) > 5
    df = documents(spark, docs)
    got = postings.decontaminate(df, items_table(spark, items))
    assert collected(got) == want
    # blocks of the test set don't change the report
    assert collected(postings.decontaminate(df, items_table(spark, items), block_items=3)) == want
    clean = {r[0] for r in want if not r[-1]}
    kept = postings.keep_clean(df, items_table(spark, items))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} <= clean
    assert kept.count() == sum(not r[-1] for r in want)


def test_hit_spans_and_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    docs = [(1, "x x " + item + " y"), (2, " ".join(reversed(item.split()))), (3, item.replace(" ", " pad pad pad pad "))]
    rows = {r["doc_id"]: r for r in postings.decontaminate(documents(spark, docs), items_table(spark, [(9, item)])).collect()}
    assert (rows[1]["hit_starts"], rows[1]["hit_ends"], rows[1]["n_near"]) == ([2], [15], 1)
    assert (rows[2]["n_hit"], rows[2]["n_near"]) == (0, 1)
    assert (rows[3]["n_hit"], rows[3]["n_near"]) == (0, 0)


def test_proximity_matches_brute_force(spark):
    docs, items = cases(5)
    index = storage.stored(postings.build(documents(spark, docs)), "near-index")
    got = {}
    rep = postings.report(index, storage.stored(postings.search(index, items_table(spark, items), slop=20), "near"))
    for r in rep.collect():
        got.setdefault((r["doc_id"], r["n_words"]), []).append(r["n_near"])
    for d, t in docs:
        w, near = words(t), set()
        for item, it in items:
            iw = words(it)
            n = min(13, len(iw))
            wins = [set(iw[i : i + n]) for i in range(len(iw) - n + 1)] if n else []
            if item is not None and any(x <= set(w[a : a + 20]) for x in wins for a in range(len(w))):
                near.add(item)
        assert len(near) in got[(d, len(w))]


def test_empty_tables(spark):
    docs, items = cases()
    assert postings.decontaminate(no_documents(spark), items_table(spark, items)).count() == 0
    got = postings.decontaminate(documents(spark, docs), items_table(spark, []))
    assert got.count() == len(docs) and got.filter("contaminated or n_hit > 0").count() == 0


def test_index_holds_every_position(spark):
    docs, _ = cases()
    index = storage.stored(postings.build(documents(spark, docs)), "test-index")
    seen = []
    for r in index.collect():
        seg = postings.Segment(__import__("numpy").array(r["n_words"]), r["terms"], r["term_first"], r["deltas"])
        every = sorted(int(p) for t in range(len(seg.terms)) for p in seg.positions(t))
        assert every == list(range(sum(r["n_words"])))
        seen += list(zip(r["doc_ids"], r["n_words"], strict=True))
    assert sorted(seen, key=str) == sorted(((d, len(words(t))) for d, t in docs), key=str)
    assert index.select(F.sum(F.size("doc_ids"))).first()[0] == len(docs)
