import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratecraft.llm import matrices, packing, separators, tokens
from tests.llm.fixtures import documents, no_documents, texts

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PLAIN.encode_special_tokens = True


OWN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # the library's own reading of special tokens


def ids_of(text, end, reader=PLAIN):
    return [*reader.encode(text or "", add_special_tokens=False).ids, end]


def vector(ts, end=0, special=False):
    out = []
    for _, _, ids, off in tokens.encoded(pa.array(ts, pa.string()), end, special=special):
        out += [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:], strict=True)]
    return out


def test_ids_of_the_fixture():
    ts = texts()
    assert vector(ts) == [ids_of(t, 0) for t in ts]


def test_forgotten_units_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "KEEP_UNITS", 40)
    monkeypatch.setattr(tokens, "_UNITS", {})
    ts = texts()
    assert [x for k in range(0, len(ts), 3) for x in vector(ts[k : k + 3])] == [ids_of(t, 0) for t in ts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r  　\x85\x1cabé'sñ日1.,Ω", max_size=25), max_size=6))
def test_ids_of_any_white_space(ts):
    assert vector(ts) == [ids_of(t, 0) for t in ts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "a", "bé", "<", "|>"]), max_size=9), max_size=5))
def test_special_tokens_as_the_library_reads_them(parts):
    ts = ["".join(p) for p in parts]
    assert vector(ts, special=True) == [ids_of(t, 0, OWN) for t in ts]
    assert vector(ts) == [ids_of(t, 0) for t in ts]


def test_special_tokens_of_the_fixture():
    ts = ["a b <|endoftext|> c", *texts()]
    assert vector(ts, special=True) == [ids_of(t, 0, OWN) for t in ts]
    assert vector(ts[:1], special=True) == [[64, 275, 220, 50256, 269, 0]]


def test_a_vocabulary_beyond_two_bytes_raises(spark, tmp_path):
    from tokenizers import Tokenizer as T
    from tokenizers.models import WordLevel

    wide = str(tmp_path / "wide.json")
    T(WordLevel({"a": 0, "b": 65536}, unk_token="a")).save(wide)
    tokens.require_width("<u4", 0, wide)
    docs = documents(spark)
    for write in (
        lambda: separators.write_flat(docs, str(tmp_path / "flat"), tokenizer=wide, end_id=0),
        lambda: matrices.pack_rows(docs, tokenizer=wide, end_id=0),
        lambda: matrices.pack_rows(docs, end_id=1 << 16),
        lambda: matrices.pack_rows(docs, end_id=-1),
    ):
        with pytest.raises(ValueError):
            write()
    assert not (tmp_path / "flat").exists()


def test_matrices_keep_the_type_of_ids(spark):
    for kind in ("smallint", "date", "string"):
        docs = spark.sql(f"SELECT CAST('2' AS {kind}) AS doc_id, 'a b' AS text" if kind != "date" else "SELECT DATE'2024-01-02' AS doc_id, 'a b' AS text")
        m = matrices.write_matrices(docs)
        got = matrices.segments(m)
        assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        assert [r["doc_id"] for r in got.collect()] == [r["doc_id"] for r in docs.collect()]


def check_pieces(rows, docs, end, window, seq, reader=PLAIN):
    want = {}
    for d in docs.collect():
        want.setdefault(d["doc_id"], []).append(ids_of(d["text"], end, reader))
    filled, covered = {}, {}
    for r in rows:
        filled.setdefault(r[seq], []).append((r["offset"], r["length"]))
        covered.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"]))
    for spans in filled.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at and n > 0
            at += n
        assert at <= window
    for key, spans in covered.items():
        docs_ = [x for x in want[key[0]] if len(x) == key[1]]
        assert sum(n for _, n in spans) == sum(map(len, docs_))
    assert sum(r["length"] for r in rows) == sum(len(x) for v in want.values() for x in v)
    import zlib

    for r in rows:
        ok = [zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for x in want[r["doc_id"]]]
        assert r["ids_crc32"] in ok


def test_nnls_packing(spark):
    docs = documents(spark)
    cfg = packing.Packing(window=256, bin_tokens=4, group=16)
    rows = packing.pack(docs, cfg).collect()
    check_pieces(rows, docs, 0, 256, "sequence_id", OWN)
    assert packing.pack(no_documents(spark), cfg).count() == 0
    with_ids = packing.pack(docs, cfg, with_ids=True).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in with_ids)


def test_plan_serves_each_piece_once():
    rng = np.random.default_rng(4)
    for cfg in (packing.Packing(), packing.Packing(window=64, bin_tokens=4, depth=4)):
        h = np.zeros(cfg.bins + 1, dtype=np.int64)
        h[1:] = rng.integers(0, 500, cfg.bins)
        p = packing.plan(h, cfg)
        assert (p.used <= h).all() and p.spare == (h - p.used).sum()
        fill = np.zeros(p.sequences, dtype=np.int64)
        for b in p.begins:
            stops = np.append(p.begins[b][1:], p.used[b])
            for i, (s, e) in enumerate(zip(p.begins[b], stops, strict=True)):
                t = np.arange(e - s)
                np.add.at(fill, p.base[b][i] + t // p.per[b][i], b)
        assert (fill == cfg.bins).all()


def test_nnls_against_projected_gradient():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((8, 15)), rng.normal(size=8)
        x = packing.nnls(a, b)
        g = a.T @ (a @ x - b)
        assert (x >= 0).all() and (g > -1e-6).all() and abs(float(x @ g)) < 1e-6  # Karush-Kuhn-Tucker


def test_padding_is_small():
    rng = np.random.default_rng(1)
    for lengths in (np.minimum(1 + rng.exponential(300, 20000).astype(int), 1024), rng.integers(1, 1025, 20000)):
        h = np.bincount(-(-lengths // 8), minlength=129)
        p = packing.plan(h)
        left = [8 * b for b in range(1, 129) for _ in range(int(h[b] - p.used[b]))]
        sequences = p.sequences + packing.best_fit(left, 1024)[2]
        assert lengths.sum() > 0.97 * 1024 * sequences
        assert p.spare < 0.3 * len(lengths)


def test_capacity_tree_is_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = rng.integers(1, 65, 60)
        row, offset, n = matrices.best_fit_decreasing(lengths, 64)
        rooms: list[int] = []
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms[rooms.index(min(fits))] -= int(lengths[i])
            else:
                rooms.append(64 - int(lengths[i]))
        assert n == len(rooms)
        assert sorted(64 - np.bincount(row, lengths, minlength=n).astype(int)) == sorted(rooms)


def test_matrices(spark, tmp_path):
    docs = documents(spark)
    m = matrices.write_matrices(docs, str(tmp_path / "m"), window=128, block_tokens=3000)
    rows = m.collect()
    for r in rows:
        assert len(r["ids"]) == 256 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["position_resets"] == r["cu_seqlens"][:-1]
        assert set(np.frombuffer(r["ids"], "<u2")[r["n_tokens"] :]) <= {tokens.END_OF_TEXT}
    assert len({r["row_id"] for r in rows}) == len(rows)
    check_pieces(matrices.segments(m).collect(), docs, tokens.END_OF_TEXT, 128, "row_id")
    assert matrices.segments(matrices.write_matrices(no_documents(spark))).count() == 0


def test_separator_scan(spark, tmp_path):
    docs = documents(spark)
    got = separators.token_counts(docs).collect()
    want = sorted((str(d["doc_id"]), len(ids_of(d["text"], 0))) for d in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    assert separators.token_counts(no_documents(spark)).count() == 0


def test_scan_stitches_blocks(spark, tmp_path):
    rng = np.random.default_rng(3)
    files = [rng.choice([9, 1, 2, 3], 257, p=[0.05, 0.35, 0.3, 0.3]), np.full(40, 1), np.full(5, 9), np.empty(0), np.array([1] * 90 + [9])]
    want = set()
    for k, ids in enumerate(files):
        (tmp_path / f"part-{k:05d}.tok").write_bytes(ids.astype("<u2").tobytes())
        begin, nth = 0, 0
        for i, x in enumerate(ids):
            if x == 9:
                want.add((k, nth, begin, i + 1 - begin, True))
                begin, nth = i + 1, nth + 1
        if begin < len(ids):
            want.add((k, nth, begin, len(ids) - begin, False))
    for block in (7, 16, 1000):
        got = separators.scan(spark, str(tmp_path), end_id=9, block_tokens=block).collect()
        assert {(r["part"], r["nth"], r["first_token"], r["n_tokens"], r["closed"]) for r in got} == want and len(got) == len(want)
