import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.llm import hardneg

ROWS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        # names that the operator uses for its own columns
        *[T.StructField(c, T.StringType()) for c in ("uid", "id", "anchor", "vector", "means", "devs", "rb", "ab", "nth", "rank")],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *"abcdefghij") for r in rows], ROWS).repartition(3)


def whole(x):
    return [math.floor(256 * float(np.float32(c))) for c in x]


def brute(rows):
    rows = [
        (i, d, whole(v), y)
        for i, (d, v, y) in enumerate(rows)
        if d is not None and y is not None and v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, d, v, y in rows:
        if d % 50:
            continue
        others = sorted((-dot(v, w), e, z == y) for j, e, w, z in rows if j != i)
        for s, e, _ in [o for o in others if o[2]][:5]:
            band = [o for o in others if not o[2] and -50 * s <= -100 * o[0] <= -95 * s][:3]
            out += [(d, e, k + 1, o[1], -s, -o[0]) for k, o in enumerate(band)]
    return sorted(out)


def mined(df, **cfg):
    found = hardneg.mine(df, F.pmod("vec_id", F.lit(50)) == 0, **cfg)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(n=500, dims=24, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [
        (k, [float(c) for c in (centres[k % 6] + rng.normal(size=dims) * 0.8) / 6], int(rng.integers(0, 4)) if k % 5 else None if k % 3 else 2)
        for k in range(n)
    ]


def odd():
    rows = clustered(300, seed=6)
    rows += [(50, rows[50][1], 2), (100, rows[100][1], 2), (100, rows[100][1], 2)]  # repeated rows
    rows += [(None, rows[1][1], 2), (1000, None, 1), (1050, [None] * 24, 1), (1100, [float("nan")] * 24, 1), (1150, [float("inf")] + [0.0] * 23, 1)]
    rows += [(1200, [], 1), (1250, [0.5, 0.25], 3), (1300, [0.0] * 24, 3), (1350, [1e5] * 24, 3), (-50, [-0.1] * 24, 1), (1351, [-1e5] * 24, 3)]
    rows += [(2000 + k, [0.125] * 24, k % 3) for k in range(60)]  # ties
    rows += [(3000 + k, [0.1171875] * 24, k % 3) for k in range(60)]
    return rows


def test_matches_brute_force(spark):
    for rows in (clustered(), odd()):
        want = brute(rows)
        assert len(want) > 30 and {r[2] for r in want} == {1, 2, 3}
        assert mined(table(spark, rows)) == want


def test_blocks_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ROWS", 40)
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    monkeypatch.setattr(hardneg, "CHUNK", 100)
    rows = odd()
    assert mined(table(spark, rows)) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(50 * k, [1e5 * (10 + k), 1.0, 3e5], k % 2) for k in range(12)] + [(7, [3e6, 3e6, 1.0], 1)]
    assert mined(table(spark, rows)) == brute(rows) != []
    assert mined(table(spark, [*rows, (9, [3e38, 1.0, 1.0], 1), (11, [-3e38, 1.0, 1.0], 0)]))


def test_bounds_hold_and_prune():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    base = np.repeat(rng.integers(-200, 200, (40, 16)), 4, axis=1)  # nearly constant in segments
    v = np.concatenate([base + rng.integers(-3, 4, base.shape), rng.integers(-200, 200, (40, 64))]).astype(float)
    means, devs = hardneg.summaries(v)
    t = pa.table(
        {"uid": np.arange(80), "id": np.arange(80), "label": ["a"] * 80, "vector": [x.astype("<i4").tobytes() for x in v],
         "means": [x.tobytes() for x in means], "devs": [x.tobytes() for x in devs]}
    )
    b, every = hardneg.Block(t, 64), np.arange(80)
    exact = v @ v.T
    width = []
    for level in range(len(hardneg.LEVELS)):
        lo, hi = hardneg.bounds(b, every, b, every, level)
        assert (lo <= exact).all() and (exact <= hi).all()
        width.append((hi - lo)[:40, :40].mean())
    assert width[0] > width[1] > 10 * width[2]
    i, band, j, s = hardneg.best_rows(b, b, True, 3)
    for a in range(80):
        want = sorted((-exact[a, x], x) for x in range(80) if x != a)[:3]
        assert sorted(zip(-s[i == a], j[i == a], strict=True)) == want


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1), (2, [0.5], 2)], [(50, [], 1), (100, [], 1), (3, [], 2)], [(50, [0.5], 1)]])
def test_small_tables(spark, rows):
    assert mined(table(spark, rows)) == brute(rows)
