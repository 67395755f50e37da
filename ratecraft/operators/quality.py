"""Plan filters, plan counts and the filter funnel.

Group-wise filters (W4, W5) keep or drop a whole (utilityName, rateName)
group.  They are written as "aggregate the failing groups, then join back
and drop": the aggregate is combined map-side and the join is broadcast
or skew-split by AQE, so no group is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ENERGY_RATE_LIMIT, FIXED_CHARGE_LIMIT, IRRELEVANT_PATTERN, IRRIGATION_PATTERN
from ..functions.columns import null_safe_left_join
from ..schema import COUNT_KEYS, NAME_KEYS


# --- P12 ------------------------------------------------------------------
def drop_high_fixed(df: DataFrame, limit: float = FIXED_CHARGE_LIMIT) -> DataFrame:
    """Keep fixedChargeFirstMeter < limit (NULL dropped)."""
    return df.where(F.col("fixedChargeFirstMeter") < F.lit(limit))


# --- P13 / P7 -------------------------------------------------------------
def drop_irrelevant(df: DataFrame, pattern: str = IRRELEVANT_PATTERN) -> DataFrame:
    """Drop plan names matching the pattern, case-insensitive (NULL dropped)."""
    return df.where(~F.col("rateName").rlike("(?i)" + pattern))


def drop_irrigation(df: DataFrame) -> DataFrame:
    return drop_irrelevant(df, IRRIGATION_PATTERN)


# --- P14 / P15 ------------------------------------------------------------
def drop_multi_unit(df: DataFrame) -> DataFrame:
    return df.where(F.col("multi_unit") == F.lit(False))


def keep_multi_unit(df: DataFrame) -> DataFrame:
    return df.where(F.col("multi_unit") == F.lit(True))


# --- W4 / W5 --------------------------------------------------------------
def drop_failing_groups(
    df: DataFrame, fails: Column, group: Sequence[str] = tuple(NAME_KEYS)
) -> DataFrame:
    """Drop every group holding a row where ``fails`` is true (NULL ignored)."""
    bad = df.where(F.coalesce(fails, F.lit(False))).select(*group).distinct()
    flagged = bad.withColumn("_bad", F.lit(True))
    return (
        null_safe_left_join(df, flagged, list(group))
        .where(F.col("_bad").isNull())
        .drop("_bad")
    )


def drop_high_energy(df: DataFrame, limit: float = ENERGY_RATE_LIMIT) -> DataFrame:
    return drop_failing_groups(df, F.col("total_energy_rate") > F.lit(limit))


def drop_negative(df: DataFrame) -> DataFrame:
    return drop_failing_groups(
        df, (F.col("total_energy_rate") < 0) | (F.col("total_demand_rate") < 0)
    )


# --- A4 -------------------------------------------------------------------
def count_plans(df: DataFrame, keys: Sequence[str] = tuple(COUNT_KEYS)) -> DataFrame:
    """Number of distinct key tuples (a NULL tuple counts) as a one-row table."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("n_plans"))


# --- A5 -------------------------------------------------------------------
FUNNEL_STEPS = ["high_fixed_charge", "high_energy_rate", "irrelevant_plans", "multi_unit_plans", "remove_negative_plans"]


def filter_funnel(
    df: DataFrame,
    fixed_limit: float = FIXED_CHARGE_LIMIT,
    energy_limit: float = ENERGY_RATE_LIMIT,
    pattern: str = IRRELEVANT_PATTERN,
    keys: Sequence[str] = tuple(COUNT_KEYS),
) -> DataFrame:
    """Removed / remaining plans after each of the five filters, in order
    (fixed, energy, irrelevant, multi-unit, negative).

    Rows are first reduced (map-side combined) to at most eight rows per
    plan holding per-step flags; every step is then a prefix conjunction of
    those flags, so the hourly rows are read once.  Group-wise steps
    (W4, W5) are evaluated on the rows that survive the earlier steps,
    exactly as a sequential application would.
    """
    row_keep_1 = F.coalesce(F.col("fixedChargeFirstMeter") < F.lit(fixed_limit), F.lit(False))
    row_keep_3 = F.coalesce(~F.col("rateName").rlike("(?i)" + pattern), F.lit(False))
    row_keep_4 = F.coalesce(F.col("multi_unit") == F.lit(False), F.lit(False))
    energy_bad = F.coalesce(F.col("total_energy_rate") > F.lit(energy_limit), F.lit(False))
    neg_bad = F.coalesce(
        (F.col("total_energy_rate") < 0) | (F.col("total_demand_rate") < 0), F.lit(False)
    )
    ids = list(dict.fromkeys([*keys, *NAME_KEYS]))
    flagged = (
        df.select(
            *ids,
            row_keep_1.alias("k1"),
            row_keep_3.alias("k3"),
            row_keep_4.alias("k4"),
            energy_bad.alias("eb"),
            neg_bad.alias("nb"),
        )
        .groupBy(*ids, "k1", "k3", "k4")
        .agg(F.max("eb").alias("eb"), F.max("nb").alias("nb"))
    )
    return _funnel_from_flags(flagged, keys)


def filter_funnel_cells(
    plan_cells: DataFrame,
    fixed_limit: float = FIXED_CHARGE_LIMIT,
    energy_limit: float = ENERGY_RATE_LIMIT,
    pattern: str = IRRELEVANT_PATTERN,
    keys: Sequence[str] = tuple(COUNT_KEYS),
) -> DataFrame:
    """The funnel from plan rows holding hourly ``cells`` (nested path).

    Plan-level flags (fixed charge, name pattern) are evaluated once per
    plan row instead of once per hour; the cell-level flags are reduced
    inside the row to at most two flag rows (unit flag false / not false).
    """
    ids = list(dict.fromkeys([*keys, *NAME_KEYS]))
    e_bad = f"coalesce(c.total_energy_rate > {float(energy_limit)}D, false)"
    n_bad = "coalesce(c.total_energy_rate < 0 OR c.total_demand_rate < 0, false)"

    def part(k4: bool) -> str:
        sel = "coalesce(c.multi_unit = false, false)" if k4 else "NOT coalesce(c.multi_unit = false, false)"
        return (
            f"named_struct('k4', {str(k4).lower()}, "
            f"'present', exists(cells, c -> {sel}), "
            f"'eb', exists(cells, c -> {sel} AND {e_bad}), "
            f"'nb', exists(cells, c -> {sel} AND {n_bad}))"
        )

    parts = plan_cells.select(
        *ids,
        F.coalesce(F.col("fixedChargeFirstMeter") < F.lit(fixed_limit), F.lit(False)).alias("k1"),
        F.coalesce(~F.col("rateName").rlike("(?i)" + pattern), F.lit(False)).alias("k3"),
        F.inline_outer(F.expr(f"array({part(True)}, {part(False)})")),
    )
    flagged = parts.where(F.col("present")).drop("present")
    return _funnel_from_flags(flagged, keys)


def _funnel_from_flags(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Funnel counts from rows (ids, k1, k3, k4, eb, nb); duplicates allowed.

    The input is consumed once: one aggregate per plan keeps, for each
    step, whether some row reaches it and whether a reaching row fails a
    group-wise check.  The group-wide verdicts (W4, W5) only decide whether
    a name's counts go on, so a second aggregate, per name, adds up the
    counts and the verdicts; a name that very many plans share is combined
    before the shuffle like any other.  A group failing W4 reaches no later
    step, so W5's verdict only needs rows passing the row-level steps.
    """
    ids = list(dict.fromkeys([*keys, *NAME_KEYS]))
    k1, k3, k4 = F.col("k1"), F.col("k3"), F.col("k4")
    per_plan = flagged.groupBy(*ids).agg(
        F.max(k1).alias("a1"),
        F.max(k1 & k3).alias("a3"),
        F.max(k1 & k3 & k4).alias("a4"),
        F.max(F.when(k1, F.col("eb"))).alias("e2"),
        F.max(F.when(k1 & k3 & k4, F.col("nb"))).alias("e5"),
    )
    if set(keys) >= set(NAME_KEYS):
        per_name = per_plan.groupBy(*NAME_KEYS).agg(
            F.count(F.lit(1)).alias("c0"),
            *[F.count(F.when(F.col(f"a{i}"), 1)).alias(f"c{i}") for i in (1, 3, 4)],
            F.coalesce(F.max("e2"), F.lit(False)).alias("g2"),
            F.coalesce(F.max("e5"), F.lit(False)).alias("g5"),
        )
        g2, g5 = F.col("g2"), F.col("g5")
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        counts = per_name.agg(
            total("c0").alias("n0"),
            total("c1").alias("n1"),
            total(F.when(~g2, F.col("c1"))).alias("n2"),
            total(F.when(~g2, F.col("c3"))).alias("n3"),
            total(F.when(~g2, F.col("c4"))).alias("n4"),
            total(F.when(~g2 & ~g5, F.col("c4"))).alias("n5"),
        )
    else:
        # plans are counted by keys that span names: the verdicts go back to the plans first
        verdict = per_plan.groupBy(*NAME_KEYS).agg(
            F.coalesce(F.max("e2"), F.lit(False)).alias("g2"), F.coalesce(F.max("e5"), F.lit(False)).alias("g5")
        )
        g2, g5 = F.col("g2"), F.col("g5")
        staged = null_safe_left_join(per_plan, verdict, list(NAME_KEYS)).groupBy(*keys).agg(
            F.max("a1").alias("s1"),
            F.max(F.col("a1") & ~g2).alias("s2"),
            F.max(F.col("a3") & ~g2).alias("s3"),
            F.max(F.col("a4") & ~g2).alias("s4"),
            F.max(F.col("a4") & ~g2 & ~g5).alias("s5"),
        )
        counts = staged.agg(
            F.count(F.lit(1)).alias("n0"),
            *[F.count(F.when(F.col(f"s{i}"), 1)).alias(f"n{i}") for i in range(1, 6)],
        )
    steps = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("name"),
                (F.col(f"n{i - 1}") - F.col(f"n{i}")).alias("removed"),
                F.col(f"n{i}").alias("remaining"),
            )
            for i, name in enumerate(FUNNEL_STEPS, start=1)
        ]
    )
    return counts.select(F.inline(steps))
