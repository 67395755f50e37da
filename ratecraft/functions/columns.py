"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INSTANT_PATTERN  # noqa: F401  (re-exported)
from ..schema import NAME_KEYS


def inf() -> Column:
    return F.lit(float("inf"))


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(s: str | Column) -> Column:
    """Parse a ``...Z`` string as a UTC wall-clock timestamp; bad text -> NULL.

    The result is ``timestamp_ntz`` so year/month do not depend on the
    session time zone.
    """
    return F.try_to_timestamp(col_of(s), F.lit(INSTANT_PATTERN)).cast("timestamp_ntz")


def first_date(raw_json: str | Column) -> Column:
    """First element of a ``{"$date": ...}`` value (scalar, list, [] or missing)."""
    raw = col_of(raw_json)
    text = F.coalesce(
        F.get_json_object(raw, "$['$date'][0]"),
        F.get_json_object(raw, "$['$date']"),
    )
    return parse_instant(text)


#: Spellings of a point in time that a revision date may have, besides epoch milliseconds.
ANY_INSTANT_PATTERNS = [
    INSTANT_PATTERN,
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][.SS][.S]'Z'",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][.SS][.S]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][.SS][.S]",
    "yyyy-MM-dd'T'HH:mm'Z'",
    "yyyy-MM-dd",
]


def any_instant(raw: str | Column) -> Column:
    """UTC wall-clock timestamp of a date in any orderable spelling; unreadable text -> NULL.

    The value may be plain text or the JSON text of ``{"$date": ...}`` with a
    scalar, a list (its first element) or ``{"$numberLong": "<epoch ms>"}``.
    """
    raw = F.trim(col_of(raw))
    inner = F.coalesce(
        F.get_json_object(raw, "$['$date']['$numberLong']"),
        F.get_json_object(raw, "$['$date'][0]"),
        F.get_json_object(raw, "$['$date']"),
    )
    text = F.when(raw.startswith("{"), inner).otherwise(raw)
    stamps = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in ANY_INSTANT_PATTERNS]
    epoch = F.when(text.rlike(r"^-?[0-9]{9,}$"), text.try_cast("long"))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.coalesce(*stamps, start + F.make_dt_interval(secs=(epoch / 1000).cast("decimal(18,6)")))


def uncapped_to_inf(cap: str | Column) -> Column:
    """NULL or non-positive cap means 'no upper bound'."""
    c = col_of(cap).cast("double")
    return F.when(c.isNull() | (c <= 0), inf()).otherwise(c)


def non_empty(arr: str | Column) -> Column:
    """Zero-length array -> NULL (NULL stays NULL)."""
    a = col_of(arr)
    return F.when(F.size(a) > 0, a)


def zero_matrix(rows: int = 12, cols: int = 24, fill: int = 0) -> Column:
    return F.array_repeat(F.array_repeat(F.lit(fill).cast("int"), cols), rows)


#: A non-NULL hash of a plan's name.  A table that carries it has been dealt by it
#: (``plans.relational.co_located``), and joins, windows and aggregates per plan need no further shuffle.
#: A number is sorted without comparisons; names that share it are told apart by the keys beside it.
NAME_KEY = "name_key"


def name_key() -> Column:
    return F.xxhash64(*NAME_KEYS)


def carried(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys, and the name key if the table carries it."""
    return [*keys, NAME_KEY] if NAME_KEY in df.columns else list(keys)


def null_safe_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    hashed: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``).

    The right-hand key columns are renamed away and dropped so the result
    carries each key once, like a ``USING`` join.  Spark keeps ``<=>`` as
    hash/sort-merge keys, so this is an ordinary shuffle or broadcast join.

    If both tables carry the name key, it is the only hash key, so tables
    dealt by it meet without a shuffle; the other keys are compared inside a
    plan, as a pair of inequalities that Spark doesn't take for hash keys: first
    a hash of them, then they themselves.  That suits keys with few values a plan;
    those with many are named in ``hashed`` and are hash keys beside the name key,
    on which the tables still meet where they lie.
    """
    suffix = "__r"
    by_name = set(NAME_KEYS) <= set(keys) and NAME_KEY in left.columns and NAME_KEY in right.columns
    dropped = {*keys, NAME_KEY} if NAME_KEY in left.columns else set(keys)
    if by_name:
        compared = [k for k in keys if k not in hashed]
        left, right = (t.withColumn("_keys_hash", F.xxhash64(*compared)) for t in (left, right))
        dropped.add("_keys_hash")
    renamed = right.select(
        *[F.col(c).alias(c + suffix) if c in dropped else F.col(c) for c in right.columns]
    )
    if by_name:
        h, g = left["_keys_hash"], renamed["_keys_hash" + suffix]
        a = F.struct(*[left[k] for k in compared])
        b = F.struct(*[renamed[k + suffix] for k in compared])
        many = [left[k].eqNullSafe(renamed[k + suffix]) for k in hashed]
        cond = [left[NAME_KEY] == renamed[NAME_KEY + suffix], *many, (h <= g) & (h >= g) & (a <= b) & (a >= b)]
        # merged in the buckets: by the size of compressed files it would be broadcast, many times as large in the driver
        renamed = renamed.hint("merge")
    else:
        cond = [left[k].eqNullSafe(renamed[k + suffix]) for k in keys]
    joined = left.join(renamed, on=cond, how=how)
    return joined.drop("_keys_hash", *[c + suffix for c in dropped])


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def not_true(cond: Column) -> Column:
    """Row fails a check unless the condition is definitely true (NULL fails)."""
    return ~F.coalesce(cond, F.lit(False))


def distinct_count_with_null(c: str | Column) -> Column:
    """``n_distinct`` that counts NULL as one more value."""
    x = col_of(c)
    return F.count_distinct(x) + F.max(F.when(x.isNull(), 1).otherwise(0))


def choose_divisor(denominator: str, target: Column, billed: Column) -> Column:
    """What a levelized rate divides by: the target load (``peak``) or the billed quantity (``billed``)."""
    if denominator not in ("peak", "billed"):
        raise ValueError("denominator is 'peak' or 'billed'")
    return billed if denominator == "billed" else target


def as_number(c: str | Column) -> Column:
    """A double; text that is no number gives NULL."""
    return col_of(c).try_cast("double")
