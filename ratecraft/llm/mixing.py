"""Mixing sources to target weights by Pareto order sampling.

The mix takes as many words as the corpus has.  Sources share them by weight;
a source's target stops at ``most`` times its own size and the excess goes to
the others by weight.  The documents of a source then get expected copies in
proportion to their preference, ``most`` at most, such that the expected words
are the target.

1. The whole part of a document's expected copies is certain.
2. The fraction left is an inclusion probability p, and documents of one source
   differ in it.  Each draws a uniform u from a hash of its id and size and is
   ranked by the Pareto order variable (u / (1 - u)) / (p / (1 - p)).
3. Of fixed size is the sample in words: documents get one more copy in rank
   order as long as the words taken stay within what the target leaves.  The
   document that would go beyond is passed over, and the gap is filled by later
   documents that fit into it, in rank order too; ``PASSES`` such passes, the
   last of which takes the document that crosses the end if it leaves less of a
   difference.

Everything is DataFrame expressions.  The place where a source's ranked words
reach the target is found by sums over ranges of the order variable, each range
split by ``BINS`` twice, so a source of any size is read in parallel; only the
documents of one range of ranges are sorted.

Defined cases: a null text has size 0 and a document of size 0 is taken as 0
words; a null source is a source of its own, ordered last; a null id draws like any
other value; equal rows (id, source, size) rank together, and where the end
falls among them so many of them are taken as fit; a row of the result for each
row of the input; an empty table gives no rows.  Texts are read whole, of any
length.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.session import scratch_path

from .storage import stored

#: Largest multiple of a source, and of a document, that the mix takes.
MOST = 3
#: Weights of the sources, repeating in the order of their names.
WEIGHTS = (1, 2, 3)
#: Ranges that a range of the order variable is split into.
BINS = 4096
#: Fillings of what is left to the target.
PASSES = 3
#: Expected copies so near to a whole number are that number.
_SNAP = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def longer_first(size: Column) -> Column:
    """A preference of documents: the number of binary digits of the size."""
    return F.length(F.bin(size))


def _landed(df: DataFrame, name: str) -> DataFrame:
    return stored(df, name, scratch_path(df.sparkSession, f"llm-{name}"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row (source, source_size) per source.

    A source stops at ``most`` times its size; sorted by size over weight, those
    that stop are the first ones, and the level of the others is the largest
    that any such split gives.  One row per source, so one task sorts them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    wide = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sources.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    split = ranked.withColumn(
        "level",
        (F.sum("source_size").over(wide) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest),
    )
    level = F.max("level").over(wide)
    return split.select(
        "source", "source_size", F.least((most * F.col("source_size")).cast("double"), level * F.col("weight")).alias("target")
    )


def _expected(groups: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """Per source and preference: expected copies as whole copies ``sure`` and a probability ``p``; per source ``rest``, the words left."""
    by = Window.partitionBy("source").orderBy(F.col("preference").desc())
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    wide = Window.partitionBy("source")
    classes = groups.filter("size > 0").groupBy("source", "preference").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
    split = classes.join(aims.withColumnRenamed("source", "aim_source"), F.col("source").eqNullSafe(F.col("aim_source"))).withColumn(
        "level",
        (F.col("target") - most * F.coalesce(F.sum("words").over(before), F.lit(0))) / F.sum(F.col("words") * F.col("preference")).over(rest),
    )
    copies = F.least(F.lit(float(most)), F.max("level").over(wide) * F.col("preference"))
    sure = F.floor(F.col("copies") + _SNAP)
    out = split.withColumn("copies", copies).withColumn("sure", sure).withColumn("p", F.col("copies") - F.col("sure"))
    return out.select(
        F.col("source").alias("of"), F.col("preference").alias("liked"), "sure", F.when(F.col("p") > _SNAP, F.col("p")).otherwise(0.0).alias("p"),
        (F.col("target") - F.sum(F.col("sure") * F.col("words")).over(wide)).alias("rest"),
    )


def _crossing(sums: DataFrame, bin_: str) -> DataFrame:
    """Per source the range in which the words go beyond ``gap``, and the words before it; sources that stay within have none."""
    before = Window.partitionBy("of").orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("start") + F.coalesce(F.sum("words").over(before), F.lit(0))
    hit = sums.withColumn("start", start).filter((F.col("start") <= F.col("gap")) & (F.col("start") + F.col("words") > F.col("gap")))
    return hit.select(F.col("of").alias("at_of"), F.col(bin_).alias(f"at_{bin_}"), F.col("start").alias("at_start"))


def _within(df: DataFrame, at: DataFrame, bin_: str) -> DataFrame:
    inside = F.col("of").eqNullSafe(F.col("at_of")) & (F.col(bin_) == F.col(f"at_{bin_}"))
    return df.drop("start").join(at.withColumnRenamed("at_start", "start"), inside).drop("at_of", f"at_{bin_}")


def _cut(open_: DataFrame, last: bool) -> DataFrame:
    """Per source the rank (``cut_v``, ``cut_key``) up to which documents are taken, and of those at that rank how many rows.

    A source without a row is taken whole.
    """
    first = F.least(F.floor(F.col("v") * BINS), F.lit(BINS - 1))
    ranged = open_.withColumn("b1", first).withColumn("b2", F.floor((F.col("v") * BINS - F.col("b1")) * BINS)).withColumn("start", F.lit(0))
    for b in ("b1", "b2"):
        sums = ranged.groupBy("of", b, "gap", "start").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
        ranged = _within(ranged, _crossing(sums, b), b)
    before = Window.partitionBy("of").orderBy("v", "key").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size") * F.col("rows")
    placed = ranged.withColumn("start", F.col("start") + F.coalesce(F.sum(words).over(before), F.lit(0)))
    crossing = placed.filter((F.col("start") <= F.col("gap")) & (F.col("start") + words > F.col("gap")))
    room = (F.col("gap") - F.col("start")) / F.col("size")
    fit = (F.floor(room + 0.5) if last else F.floor(room)).cast("long")
    return crossing.select(
        F.col("of").alias("cut_of"), F.col("v").alias("cut_v"), F.col("key").alias("cut_key"), F.least(fit, F.col("rows")).alias("cut_rows")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    preference=longer_first,
    passes: int = PASSES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``preference`` maps the size to a whole number from 1 on, of few values;
    expected copies are in proportion to it within a source.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    groups = _landed(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("preference", preference(F.col("size")).cast("long")),
        "mix-sizes",
    )
    aims = _landed(
        targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, most), "mix-targets"
    )
    chances = _landed(_expected(groups, aims, most), "mix-chances")

    key = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.col("size").cast("string")).cast("binary"))
    u = (F.conv(F.substring("key", 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    odds = (u / (1.0 - u)) / (F.col("p") / (1.0 - F.col("p")))
    liked = F.col("source").eqNullSafe(F.col("of")) & (F.col("preference") == F.col("liked")) & (F.col("size") > 0)
    ranked = _landed(
        groups.withColumn("key", key).join(chances, liked, "left")
        .withColumn("odds", F.when(F.col("p") > 0, odds))
        .withColumn("v", F.col("odds") / (1.0 + F.col("odds")))
        .select("doc_id", "source", "size", "rows", F.coalesce("sure", F.lit(0)).alias("sure"), "key", "v"),
        "mix-ranks",
    )
    own = ranked.columns
    rests = chances.groupBy("of").agg(F.max("rest").alias("rest"))
    state = ranked.withColumn("more", F.lit(0).cast("long"))
    for n in range(passes):
        spent = state.groupBy("source").agg(F.sum(F.col("size") * F.col("more")).alias("spent"))
        gaps = _landed(
            rests.join(spent, F.col("of").eqNullSafe(F.col("source"))).select("of", (F.col("rest") - F.col("spent")).alias("gap")),
            f"mix-gap-{n}",
        )
        # larger ones don't fit; those taken before don't either, or all of their rows are taken
        fits = F.col("v").isNotNull() & (F.col("more") == 0) & (F.col("size") <= F.col("gap"))
        of = F.col("source").eqNullSafe(F.col("of"))
        cut = _cut(state.join(gaps, of).filter(fits), last=n == passes - 1)
        ends = _landed(gaps.join(cut, F.col("of").eqNullSafe(F.col("cut_of")), "left").drop("cut_of"), f"mix-end-{n}")
        ahead = (F.col("v") < F.col("cut_v")) | ((F.col("v") == F.col("cut_v")) & (F.col("key") < F.col("cut_key")))
        at_end = (F.col("v") == F.col("cut_v")) & (F.col("key") == F.col("cut_key"))
        got = F.when(F.col("cut_v").isNull() | ahead, F.col("rows")).when(at_end, F.col("cut_rows")).otherwise(0)
        state = state.join(ends, of, "left").select(*own, F.when(fits, got).otherwise(F.col("more")).alias("more"))

    aims = aims.withColumnRenamed("source", "of")
    out = state.join(aims, F.col("source").eqNullSafe(F.col("of"))).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("nth"))
    copies = (F.col("sure") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
