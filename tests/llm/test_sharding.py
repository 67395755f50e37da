import zlib
from collections import Counter, defaultdict

import numpy as np

from ratecraft.llm import sharding
from tests.llm.fixtures import documents, no_documents


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_is_the_published_function():
    keys = np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64) * np.uint64(2)
    for n in (1, 2, 40, 41, 1000):
        assert sharding.jump(keys, n).tolist() == [jump_one(int(k), n) for k in keys]


def test_growth_moves_only_into_the_new_shard():
    keys = np.random.default_rng(2).integers(0, 2**63, 20000, dtype=np.uint64)
    a, b = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert set(b[a != b]) == {40} and 0.01 < (a != b).mean() < 0.04


def test_assignment(spark):
    docs = documents(spark)
    got = sharding.assign(docs, 5).collect()
    assert len(got) == docs.count()
    slots, place = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        place[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert r["grown_shard"] in (r["shard"], 5) and r["law"] == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in place.values())
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    again = {(r["doc_id"], r["shard"]) for r in sharding.assign(docs.repartition(7), 5).collect()}
    assert again == {(r["doc_id"], r["shard"]) for r in got}
    assert sharding.assign(no_documents(spark), 5).count() == 0


def test_written_shards(spark, tmp_path):
    docs = documents(spark).drop("shard")
    sharding.write_shards(docs, 5, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    want = {(r["doc_id"], r["shard"]) for r in sharding.assign(documents(spark), 5).collect()}
    assert {(r["doc_id"], r["shard"]) for r in back.collect()} == want and back.count() == docs.count()
