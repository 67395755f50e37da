"""Language-model scoring with an Elias-Fano n-gram trie.

Tokens are lower-cased words and one end token a document.  The trie is kept
by predicted word: its first level holds the words, its second, for each
word, the contexts it was seen after.  A level is a monotone sequence in
Elias-Fano code (contexts relative to their word: the word's number above the
context's 40-bit hash), pointers to the words' ranges are another, counts are
bit-packed, and the bigrams' smoothed values are quantised to a byte.  A
look-up is a successor search among the words, then one inside the word's range.

Smoothing (Dirichlet): p(w | u) = (c(u, w) + m p(w)) / (c(u) + m), with p(w) =
(c(w) + 0.1) / (N + 0.1 (V + 1)).  The sum of log10 p over a text splits into
a term of each bigram, which the shard of w knows alone, and a term of each
context's count; the contexts of a text are its own tokens (the first word's
context is the end token), so the shard of w knows that too.  Hence one
shuffle of the corpus' bigrams, by predicted word, both trains and scores.

Shards: words are dealt by hash.  A first job counts all words exactly; a
word with more occurrences than a shard should hold (there are at most
N / ``hot`` of them) is split by context, its count being known.  The number
of shards follows the size of the texts.  Tasks count and sort a bounded
number of tokens at a time and send packed arrays, so a frequent word costs a
row per task and shard, not a row per occurrence.

Levels are written to files in the shared folder and memory-mapped for the
look-ups; a file depends only on its shard, so another attempt writes it anew.

Defined cases: a null or empty text is the end token alone; a null id hashes
like an empty one (held out); repeated rows count as often as they come; an
empty table gives no rows; without any training text all counts are 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .eliasfano import EliasFano, pack_bits, read_bits
from .storage import make_folder, mapped, publishing, ship, stored, table_path

#: Hash that stands for the end of a document.
END = np.uint64(0x1F83D9ABFB41BD6B)
CONTEXT_BITS = 40
_CTX = np.uint64((1 << CONTEXT_BITS) - 1)


@dataclass(frozen=True)
class Config:
    #: weight of the unigram distribution, in counts
    strength: float = 200.0
    #: bytes of text per shard
    shard_bytes: int = 20 << 20
    #: occurrences from which a word's contexts are dealt to several shards
    hot: int = 1 << 20
    #: tokens that a task sorts at a time
    chunk_tokens: int = 3 << 19


def held_out(doc_id: Column) -> Column:
    """True for the documents that the model doesn't learn from: crc32 of the id's text is divisible by 10."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _source(docs: DataFrame, id_col: str, text_col: str, train: Column | None) -> DataFrame:
    train = ~held_out(F.col(id_col)) if train is None else train
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), train.alias("train"))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, an end after each text, and the texts' offsets in them."""
    low = tx.LOWER[data]
    starts, lens, w_off = tx.words(low, offsets, tx.SPACED_WORD)
    h = tx.hash_spans(low, starts, lens)
    return np.insert(h, w_off[1:], END), w_off + np.arange(len(w_off))


def _chunks(batches: Iterator[pa.RecordBatch], most: int):
    """(tokens, documents, training flags, ids) of a bounded number of tokens, documents numbered from 0."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
    n = 0

    def joined():
        size = np.concatenate([h[1] for h in held])
        ids = pa.concat_arrays([h[3] for h in held])
        out = np.concatenate([h[0] for h in held]), np.repeat(np.arange(len(size)), size), np.concatenate([h[2] for h in held]), ids
        held.clear()
        return out

    for b in batches:
        train = b.column("train").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, data, offsets in tx.pieces(b.column("text")):
            t, off = tokens(data, offsets)
            held.append((t, np.diff(off), train[lo:hi], b.column("doc_id").slice(lo, hi - lo)))
            n += len(t)
            if n >= most:
                yield joined()
                n = 0
    if held:
        yield joined()


def shard_of(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of the hashes."""
    return (((words >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def shard_count(docs: DataFrame, text_col: str, cfg: Config) -> int:
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(1, -(-size // cfg.shard_bytes))


def vocabulary(src: DataFrame, shards: int, cfg: Config) -> DataFrame:
    """Exact counts of all words, a row per shard: shard, words, n_train, n_all (packed), tokens, types (of training), hot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, doc, train, _ in _chunks(batches, cfg.chunk_tokens):
            words, which = np.unique(t, return_inverse=True)
            n_all = np.bincount(which).astype("<u4")
            n_train = np.bincount(which[train[doc]], minlength=len(words)).astype("<u4")
            cut = np.searchsorted(shard_of(words, shards), np.arange(shards + 1)).tolist()
            some = [(s, a, b) for s, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s for s, _, _ in some], pa.int32()),
                    *(pa.array([v[a:b].tobytes() for _, a, b in some], pa.binary()) for v in (words, n_train, n_all)),
                ],
                names=["shard", "words", "n_train", "n_all"],
            )

    def merge(t: pa.Table) -> pa.Table:
        words = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("words")])
        u, which = np.unique(words, return_inverse=True)
        n = [
            np.bincount(which, np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in t.column(c)]), len(u)).astype("<i8")
            for c in ("n_train", "n_all")
        ]
        top = np.flatnonzero(n[1] >= cfg.hot)
        hot = [{"word": int(tx.signed(u[i : i + 1])[0]), "n_train": int(n[0][i]), "n_all": int(n[1][i])} for i in top]
        return pa.table(
            {
                "shard": t.column("shard").slice(0, 1), "words": [u.tobytes()], "n_train": [n[0].tobytes()], "n_all": [n[1].tobytes()],
                "tokens": [int(n[0].sum())], "types": [int((n[0] > 0).sum())],
                "hot": pa.array([hot], pa.list_(pa.struct([("word", pa.int64()), ("n_train", pa.int64()), ("n_all", pa.int64())]))),
            }
        )

    partial = src.mapInArrow(count, "shard int, words binary, n_train binary, n_all binary")
    return partial.groupBy("shard").applyInArrow(
        merge,
        "shard int, words binary, n_train binary, n_all binary, tokens long, types long, "
        "hot array<struct<word:long,n_train:long,n_all:long>>",
    )


@dataclass(frozen=True)
class Totals:
    """What all shards share: training tokens and types, shards, and the hot words' counts and places."""

    tokens: int
    types: int
    shards: int
    strength: float
    hot_words: tuple[int, ...]
    hot_train: tuple[int, ...]
    hot_parts: tuple[int, ...]

    @property
    def mass(self) -> float:
        return self.tokens + 0.1 * (self.types + 1)

    def route(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        shard = shard_of(words, self.shards)
        first = self.shards
        for w, parts in zip(self.hot_words, self.hot_parts, strict=True):
            at = np.flatnonzero(words == np.uint64(w))
            shard[at] = first + (contexts[at] % np.uint64(parts)).astype(np.int64)
            first += parts
        return shard


def totals(vocab: DataFrame, shards: int, cfg: Config) -> Totals:
    n = vocab.agg(F.sum("tokens"), F.sum("types")).first()
    # at most one hot word for each cfg.hot tokens of the corpus
    hot = sorted((r["h"] for r in vocab.select(F.explode("hot").alias("h")).toLocalIterator()), key=lambda h: h["word"])
    return Totals(
        n[0] or 0, n[1] or 0, shards, cfg.strength,
        tuple(h["word"] % 2**64 for h in hot), tuple(h["n_train"] for h in hot), tuple(-(-h["n_all"] // cfg.hot) for h in hot),
    )


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of all values, then the next ones, ...: high bytes are mostly 0 and compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplane(raw, width: int) -> np.ndarray:
    parts = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros(parts.shape[1], dtype=np.uint64)
    for k in range(width):
        out |= parts[k].astype(np.uint64) << np.uint64(8 * k)
    return out


PACKS = (
    "piece long, shard int, words binary, word_n binary, contexts binary, n_train binary, n_occ binary, docs binary, doc_ids array<{kind}>"
)


def packs(src: DataFrame, t: Totals, cfg: Config) -> DataFrame:
    """The corpus' bigrams, a row per task's chunk and shard (``PACKS``): sorted by (word, context), with the documents
    of each occurrence.  The row that holds a chunk's end tokens also names its documents."""
    kind = src.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId() << 32
        for w, doc, train, ids in _chunks(batches, cfg.chunk_tokens):
            ctx = tx.mix(np.concatenate([[END], w[:-1]])) & _CTX
            shard = t.route(w, ctx)
            order = np.lexsort((ctx, w, shard))
            w, ctx, shard, doc = w[order], ctx[order], shard[order], doc[order]
            new_w = np.ones(len(w), dtype=bool)
            new_w[1:] = (w[1:] != w[:-1]) | (shard[1:] != shard[:-1])
            new = new_w.copy()
            new[1:] |= ctx[1:] != ctx[:-1]
            gram, word = np.flatnonzero(new), np.flatnonzero(new_w)
            n_occ = np.diff(np.append(gram, len(w)))
            n_train = np.add.reduceat(train[doc].astype(np.int64), gram)
            g_of_w = np.searchsorted(gram, word)
            word_n = np.diff(np.append(g_of_w, len(gram)))
            here = np.unique(shard)
            o = np.searchsorted(shard, np.append(here, here[-1] + 1))
            g, k = np.searchsorted(gram, o), np.searchsorted(word, o)
            end_shard = int(shard[np.flatnonzero(w == END)[0]])
            for i, s in enumerate(here.tolist()):
                a, b, c, d = int(g[i]), int(g[i + 1]), int(k[i]), int(k[i + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece]), pa.array([s], pa.int32()), pa.array([w[word[c:d]].tobytes()], pa.binary()),
                        pa.array([_planes(word_n[c:d], 4)], pa.binary()), pa.array([_planes(ctx[gram[a:b]], 5)], pa.binary()),
                        pa.array([_planes(n_train[a:b], 4)], pa.binary()), pa.array([_planes(n_occ[a:b], 4)], pa.binary()),
                        pa.array([_planes(doc[o[i] : o[i + 1]], 4)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array([0, len(ids) if s == end_shard else 0], pa.int32()), ids),
                    ],
                    names=[c.strip().split(" ")[0] for c in PACKS.split(",")],
                )
            piece += 1

    return src.mapInArrow(pack, PACKS.format(kind=kind))


class Levels:
    """The two levels of a shard, over the bytes of its file."""

    def __init__(self, raw: pa.Buffer):
        size = int.from_bytes(raw[:8].to_pybytes(), "little")
        self.meta = json.loads(raw[8 : 8 + size].to_pybytes())
        at, part = 8 + size, {}
        for name, n in self.meta["parts"]:
            part[name] = np.frombuffer(raw, np.uint8, n, at)
            at += n
        sequence = lambda k: EliasFano(self.meta[k]["n"], self.meta[k]["low_bits"], part[f"{k}_low"], part[f"{k}_high"])
        self.words, self.pointers, self.grams = sequence("words"), sequence("pointers"), sequence("grams")
        self.count_raw, self.codes = part["counts"], part["codes"]
        self.book = np.frombuffer(part["book"].tobytes(), "<f8")

    @staticmethod
    def encode(words: np.ndarray, counts: np.ndarray, first: np.ndarray, contexts: np.ndarray, values: np.ndarray) -> bytes:
        """``first[i]`` to ``first[i + 1]`` are word i's bigrams, whose contexts ascend."""
        row = np.repeat(np.arange(len(words), dtype=np.uint64), np.diff(first))
        word_bits = max(1, len(words).bit_length())
        coded = {
            "words": EliasFano.encode(words, 64),
            "pointers": EliasFano.encode(first, max(1, len(contexts).bit_length())),
            "grams": EliasFano.encode((row << np.uint64(CONTEXT_BITS)) | contexts, CONTEXT_BITS + word_bits),
        }
        book, codes = quantise(values)
        width = max(1, int(counts.max(initial=0)).bit_length())
        parts = [(f"{k}_{p}", v[p]) for k, v in coded.items() for p in ("low", "high")]
        parts += [("counts", pack_bits(counts, width)), ("codes", codes.tobytes()), ("book", book.astype("<f8").tobytes())]
        meta = {k: {"n": v["n"], "low_bits": v["low_bits"]} for k, v in coded.items()}
        head = json.dumps(meta | {"count_bits": width, "parts": [(k, len(v)) for k, v in parts]}).encode()
        return len(head).to_bytes(8, "little") + head + b"".join(v for _, v in parts)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, counts); an unknown word gets -1 and 0."""
        at = self.words.successor(words)
        ok = at < self.words.n
        ok[ok] = self.words.get(at[ok]) == words[ok]
        counts = np.zeros(len(words), dtype=np.int64)
        counts[ok] = read_bits(self.count_raw, at[ok], self.meta["count_bits"]).astype(np.int64)
        return np.where(ok, at, -1), counts

    def values(self, numbers: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        """Smoothed values of (word number, context); nan where the bigram isn't in the trie."""
        out = np.full(len(numbers), np.nan)
        q = np.flatnonzero(numbers >= 0)
        if len(q):
            begin, end = self.pointers.get(numbers[q]).astype(np.int64), self.pointers.get(numbers[q] + 1).astype(np.int64)
            key = (numbers[q].astype(np.uint64) << np.uint64(CONTEXT_BITS)) | contexts[q]
            at = self.grams.successor(key, begin, end)
            ok = at < end
            ok[ok] = self.grams.get(at[ok]) == key[ok]
            out[q[ok]] = self.book[self.codes[at[ok]]]
        return out


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code book of at most 256 values, a byte per value): exact if there are that few, else the means of equal shares."""
    if not len(values):
        return np.zeros(1), np.empty(0, np.uint8)
    u, which = np.unique(values, return_inverse=True)
    if len(u) <= 256:
        return u, which.astype(np.uint8)
    n = np.bincount(which)
    share = np.minimum((np.cumsum(n) - n) * 256 // len(values), 255)
    book = np.bincount(share, u * n, 256) / np.maximum(np.bincount(share, n, 256), 1)
    return book, share[which].astype(np.uint8)


class _Shard:
    """A shard's packs, opened: distinct words and bigrams over all rows, and each row's references to them."""

    def __init__(self, t: pa.Table):
        rows = t.num_rows
        col = lambda name: [x.as_buffer() for x in t.column(name)]
        row_words = [np.frombuffer(x, np.uint64) for x in col("words")]
        self.words, which = np.unique(np.concatenate(row_words), return_inverse=True)
        cut = np.concatenate([[0], np.cumsum([len(w) for w in row_words])])
        per = [np.repeat(which[cut[i] : cut[i + 1]], _unplane(x, 4).astype(np.int64)) for i, x in enumerate(col("word_n"))]
        keys = [(p.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | _unplane(x, 5) for p, x in zip(per, col("contexts"), strict=True)]
        sizes = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        self.grams, gram_of = np.unique(np.concatenate(keys), return_inverse=True)
        self.gram_of = [gram_of[sizes[i] : sizes[i + 1]] for i in range(rows)]
        train = np.concatenate([_unplane(x, 4) for x in col("n_train")]).astype(np.float64)
        self.gram_n = np.bincount(gram_of, train, len(self.grams)).astype(np.int64)
        self.word_of = (self.grams >> np.uint64(CONTEXT_BITS)).astype(np.int64)
        self.contexts = self.grams & _CTX
        self.n_occ, self.docs = col("n_occ"), col("docs")


def _counts(s: _Shard, t: Totals) -> np.ndarray:
    """Training counts of the shard's words; a hot word's contexts are in several shards, so its count is given."""
    n = np.bincount(s.word_of, s.gram_n, len(s.words)).astype(np.int64)
    for w, c in zip(t.hot_words, t.hot_train, strict=True):
        n[s.words == np.uint64(w)] = c
    return n


def _build(s: _Shard, t: Totals) -> bytes:
    n = _counts(s, t)
    known, seen = np.flatnonzero(n > 0), s.gram_n > 0
    p = (n + 0.1) / t.mass
    values = np.log10(s.gram_n[seen] + t.strength * p[s.word_of[seen]])
    first = np.searchsorted(s.word_of[seen], np.append(known, len(n)))
    return Levels.encode(s.words[known], n[known], first, s.contexts[seen], values)


PARTIAL = "piece long, docs binary, n_tokens binary, n_known binary, base binary, score binary, doc_ids array<{kind}>"


def _score(s: _Shard, levels: Levels, t: Totals, table: pa.Table) -> pa.Table:
    number, count = levels.find(s.words)
    value = levels.values(number[s.word_of], s.contexts)
    p = (count + 0.1) / t.mass
    value = np.where(np.isnan(value), np.log10(t.strength * p)[s.word_of], value) - np.log10(count + t.strength)[s.word_of]
    base, known = np.log10(count + 0.1)[s.word_of], (count > 0).astype(np.float64)[s.word_of]
    out: dict[str, list] = {c: [] for c in ("docs", "n_tokens", "n_known", "base", "score")}
    for gram, n_occ, docs in zip(s.gram_of, s.n_occ, s.docs, strict=True):
        doc = _unplane(docs, 4).astype(np.int64)
        gram = np.repeat(gram, _unplane(n_occ, 4).astype(np.int64))
        n = np.bincount(doc)
        some = np.flatnonzero(n)
        out["docs"].append(some.astype("<u4").tobytes())
        out["n_tokens"].append(n[some].astype("<u4").tobytes())
        out["n_known"].append(np.bincount(doc, known[gram])[some].astype("<u4").tobytes())
        out["base"].append(np.bincount(doc, base[gram])[some].astype("<f8").tobytes())
        out["score"].append(np.bincount(doc, value[gram])[some].astype("<f8").tobytes())
    return pa.table(
        [t_ for t_ in (table.column("piece"), *(pa.array(v, pa.binary()) for v in out.values()), table.column("doc_ids"))],
        names=["piece", *out, "doc_ids"],
    )


def _sum(kind: str):
    names = [("docs", "<u4"), ("n_tokens", "<u4"), ("n_known", "<u4"), ("base", "<f8"), ("score", "<f8")]

    def add(t: pa.Table) -> pa.Table:
        cols = {c: np.concatenate([np.frombuffer(x.as_buffer(), d) for x in t.column(c)]) for c, d in names}
        ids = next(x.values for x in t.column("doc_ids") if len(x))
        doc, n = cols["docs"].astype(np.int64), len(ids)
        total = lambda c: np.bincount(doc, cols[c], n)
        return pa.table(
            {
                "doc_id": ids, "n_tokens": total("n_tokens").astype(np.int64), "n_known": total("n_known").astype(np.int64),
                "base": total("base"), "score": total("score"),
            }
        )

    return add, f"doc_id {kind}, n_tokens long, n_known long, base double, score double"


def _file(folder: str, shard: int) -> str:
    return f"{folder}/levels-{shard:06d}.lm"


def _finish(partial: DataFrame, t: Totals, kind: str) -> DataFrame:
    add, schema = _sum(kind)
    return partial.groupBy("piece").applyInArrow(add, schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(t.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(t.mass))).alias("base_score"), "score",
    )


def fit_and_score(
    docs: DataFrame, cfg: Config = Config(), id_col: str = "doc_id", text_col: str = "text", train: Column | None = None,
    folder: str | None = None,
) -> tuple[DataFrame, str, Totals]:
    """Train on the documents for which ``train`` holds (by default those not held out) and score all of them.

    Returns the scores (a row per document), the folder with the level files, and the totals; with the latter two
    ``score`` rates other documents.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or table_path(spark, "levels")
    make_folder(folder)
    src = _source(docs, id_col, text_col, train)
    shards = shard_count(docs, text_col, cfg)
    t = totals(stored(vocabulary(src, shards, cfg), "vocabulary"), shards, cfg)
    kind = src.schema["doc_id"].dataType.simpleString()

    def learn(table: pa.Table) -> pa.Table:
        s, path = _Shard(table), _file(folder, table.column("shard")[0].as_py())
        with publishing(path) as out:
            out.write(_build(s, t))
        return _score(s, Levels(mapped(path)), t, table)

    partial = packs(src, t, cfg).groupBy("shard").applyInArrow(learn, PARTIAL.format(kind=kind))
    return _finish(partial, t, kind), folder, t


def score(docs: DataFrame, folder: str, t: Totals, cfg: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of documents under levels written before."""
    ship(docs.sparkSession)
    src = _source(docs, id_col, text_col, F.lit(False))
    kind = src.schema["doc_id"].dataType.simpleString()
    empty = Levels.encode(np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.uint64), np.empty(0))

    def rate(table: pa.Table) -> pa.Table:
        try:
            levels = Levels(mapped(_file(folder, table.column("shard")[0].as_py())))
        except FileNotFoundError:  # no training word is in this shard
            levels = Levels(pa.py_buffer(empty))
        return _score(_Shard(table), levels, t, table)

    partial = packs(src, t, cfg).groupBy("shard").applyInArrow(rate, PARTIAL.format(kind=kind))
    return _finish(partial, t, kind)
