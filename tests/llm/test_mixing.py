import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm import mixing
from tests.llm.fixtures import documents, no_documents, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that the operator uses for its own columns
        *[T.StructField(c, T.StringType()) for c in ("size", "of", "v", "key", "more", "rows", "gap", "target", "nth")],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *"abcdefghi") for r in rows], ROWS).repartition(3)


def fill(sizes, weights, total, most):
    """Shares by weight, none above ``most`` times its size, by handing on the excess until there is none."""
    share, open_, left = {}, set(sizes), total
    while True:
        w = sum(weights[s] for s in open_)
        full = [s for s in open_ if left * weights[s] > most * sizes[s] * w + 1e-9]
        if not full:
            return share | {s: left * weights[s] / w for s in open_}
        for s in full:
            share[s] = most * sizes[s]
            left -= share[s]
            open_.remove(s)
        if not open_:
            return share


def brute(rows, passes=mixing.PASSES, most=mixing.MOST):
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = Counter()
    for n, (_, _, s) in zip(size, rows, strict=True):
        total[s] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    target = fill(total, {s: 1 + k % 3 for k, s in enumerate(names)}, sum(size), most)
    out = []
    for s in names:
        mine = [i for i in range(len(rows)) if rows[i][2] == s]
        like = defaultdict(int)
        for i in mine:
            if size[i]:
                like[size[i].bit_length()] += size[i]
        copies, rest = {}, target[s]
        if like:
            level = fill(like, {k: k * w for k, w in like.items()}, target[s], most)
            copies = {k: level[k] / w for k, w in like.items()}
        more, ranks = dict.fromkeys(mine, 0), []
        for i in mine:
            if size[i]:
                c = copies[size[i].bit_length()]
                sure = math.floor(c + 1e-9)
                more[i], p = sure, c - sure
                rest -= sure * size[i]
                if p > 1e-9:
                    key = hashlib.md5("|".join(str(x) for x in (rows[i][0], size[i]) if x is not None).encode()).hexdigest()
                    u = (int(key[:13], 16) + 0.5) / 2**52
                    odds = (u / (1 - u)) / (p / (1 - p))
                    ranks.append((odds / (1 + odds), key, i))
        ranks.sort()
        for n in range(passes):
            gap, cum, done = rest, 0, []
            for r in [r for r in ranks if size[r[2]] <= gap]:
                cum += size[r[2]]
                if cum - (size[r[2]] / 2 if n == passes - 1 else 0) > gap:
                    break
                done.append(r)
            for r in done:
                more[r[2]] += 1
                rest -= size[r[2]]
                ranks.remove(r)
        out += [(rows[i][0], s, size[i], total[s], round(target[s], 6), more[i] * size[i]) for i in mine]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=str)


def corpus(seed=3, n=420):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "B", "é", "zz", None, "small"][: 1 + i % 6])
        rows.append((i, sentence(rng, rng.choice([1, 3, 8, 20, 50, 90, 400])), source))
    rows += [(1000, None, "hot"), (1001, "", "only empty"), (None, "one two", "hot"), (None, "one two", "hot"), (None, None, None)]
    rows += [(7, "a b c d", "hot")] * 40  # repeated rows
    rows += [(k, "x " * 9000, "a") for k in (2000, 2001)]  # long texts
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    assert got(mixing.mix(table(spark, rows))) == brute(rows)


def test_targets_and_caps(spark):
    rows = corpus(seed=9)
    out = mixing.mix(table(spark, rows)).collect()
    assert len(out) == len(rows)
    per = defaultdict(list)
    for r in out:
        assert 0 <= r["copies"] <= mixing.MOST and r["taken"] == r["copies"] * r["size"]
        per[r["source"]].append(r)
    for rs in per.values():
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(0.02 * rs[0]["target"], max(r["size"] for r in rs) / 2)
        assert rs[0]["target"] <= 3 * rs[0]["source_size"] + 1e-9
    assert math.isclose(sum(rs[0]["target"] for rs in per.values()), sum(r["size"] for r in out))
    assert len({r["copies"] for r in out}) == 4


def test_reruns_agree(spark):
    rows = corpus(seed=5)
    once = got(mixing.mix(table(spark, rows)))
    random.Random(1).shuffle(rows)
    assert got(mixing.mix(table(spark, rows).repartition(7))) == once


def test_one_source_and_equal_rows(spark):
    """A target equal to the size takes every document of one preference class once."""
    rows = [(k, "five words are in this", "s") for k in range(30)]
    assert {r["taken"] for r in mixing.mix(table(spark, rows)).collect()} == {5}
    rows = [(1, "five words are in this", "s")] * 50 + [(2, "w " * 200, "s"), (3, None, "t"), (4, "one", "t")]
    out = mixing.mix(table(spark, rows)).collect()
    assert len(out) == 53 and got(mixing.mix(table(spark, rows))) == brute(rows)


def test_fixture_and_empty_tables(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    assert got(mixing.mix(df)) == brute(rows)
    assert mixing.mix(no_documents(spark)).count() == 0
    nothing = mixing.mix(table(spark, [(1, None, None), (2, "", "s")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


def test_inclusion_follows_preference(spark):
    """Expected copies are in proportion to the preference: over many draws the two classes' shares tell them apart."""
    rows = [(k, "w " * (4 if k % 2 else 64), "s" if k < 4000 else "t") for k in range(8000)]
    out = mixing.mix(table(spark, rows)).filter("source = 's'").groupBy("size").agg(F.avg("copies").alias("c")).collect()
    c = {r["size"]: r["c"] for r in out}
    assert abs(c[64] / c[4] - 7 / 3) < 0.25


def test_plan_is_native(spark):
    plan = mixing.mix(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|MapPartitions|ExternalRDD", plan)
