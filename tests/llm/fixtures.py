"""Small tables with the odd cases: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

VOCAB = ["the", "of", "and", "Zug", "über", "été", "naïve", "data,", "x1", "end.", "AbC", "straße", "ñandú", "ok", "a", "日本"]

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use for their own columns
        T.StructField("n_words", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("length", T.StringType()),
    ]
)


def sentence(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        out.append(rng.choice(VOCAB) + (str(rng.randint(0, 40)) if rng.random() < 0.5 else ""))
        out.append(rng.choice([" ", " ", " ", "  ", "\n", "\t", " \n"]))
    return "".join(out)


def texts(seed: int = 7) -> list[str | None]:
    rng = random.Random(seed)
    base = [sentence(rng, rng.choice([1, 2, 3, 5, 20, 60, 120])) for _ in range(40)]
    passage = sentence(rng, 70).replace("\n", " ").strip()
    out: list[str | None] = [None, "", " \n\t ", "one", "two words", "\n", "\x1c \x85  x", "<|endoftext|> <|endoftext|>"]
    out += base
    out += [base[9], base[9], base[10] + " tail"]  # copies
    out += [f"{base[k]}\n{passage}\n{base[k + 1]}" for k in range(5)]
    out += [passage, passage + "\n" + passage, ("again and again " * 60).strip()]
    out += ["\n".join(["same line here"] * 30), "w" * 5000, "long " * 9000 + "end"]
    big = base[12] * 3 + sentence(rng, 400)
    words = big.split(" ")
    for k in range(6):  # near copies
        w = list(words)
        w[10 + 7 * k] = f"changed{k}"
        out.append(" ".join(w))
    out += ["#*$ %% && || <> " * 20]
    return out


def documents(spark, rows: list[tuple[int | None, str | None]] | None = None):
    if rows is None:
        ts = texts()
        rows = [(i, t) for i, t in enumerate(ts)]
        rows += [(None, ts[10]), (None, None), (3, "one"), (5, "other text under a used id")]
    full = [(i, t, "en", "src0", len(t or ""), "x", "y", "z", "w") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)
