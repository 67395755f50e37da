"""Dataset-level validation of the published hourly table (V1-V8).

``validation_report`` (long table): one grouped pass over the plans counts the
row checks (V1, V2, V4-V6) and the copies (V3) together, with a shuffle of one
row a plan and task (``validation_report_slots``); V7 compares two distinct plan counts.
``validation_report_cells`` computes the same from plan rows without
shuffling the hourly table.  The result is a small table ``(step,
check_name, severity, n, n_failed, passed)``; V8 (``enforce``) raises after
the table has been computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ENERGY_RATE_CHECK, EXCLUDED_NAMES, FIXED_CHARGE_CHECK, WEEKDAY, WEEKEND
from ..functions.columns import count_if, not_true
from ..schema import COUNT_KEYS
from ..session import scratch_path

UNIQUE_KEYS = ["eiaId", "utilityName", "rateName", "month", "week_part", "hour"]
CRITICAL_STEPS = 4


class ValidationError(RuntimeError):
    pass


def validation_report(
    input_plans: DataFrame,
    output: DataFrame,
    fixed_limit: float = FIXED_CHARGE_CHECK,
    energy_limit: float = ENERGY_RATE_CHECK,
    pattern: str = EXCLUDED_NAMES,
) -> DataFrame:
    """The seven checks as rows; NULL fails a comparison check.

    The hourly rows are combined to one row a plan and task before they are
    shuffled (``validation_report_slots``), so no hour is a group of its own.
    """
    return validation_report_slots(input_plans, output, fixed_limit, energy_limit, pattern)


def _one_row(*parts: DataFrame) -> DataFrame:
    """Merge single-row aggregates with disjoint columns into one row
    (union, then a global max; no join)."""
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def _steps(one: DataFrame) -> DataFrame:
    def step(i, name, severity, failed):
        return F.struct(
            F.lit(i).alias("step"),
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.col("n").alias("n"),
            failed.cast("long").alias("n_failed"),
        )

    plan_mismatch = F.when(F.col("n_in") == F.col("n_out"), F.lit(0)).otherwise(F.lit(1))
    steps = F.array(
        step(1, "fixed_charge_lte_limit", "critical", F.col("f1")),
        step(2, "energy_rate_lte_limit", "critical", F.col("f2")),
        step(3, "rows_distinct", "critical", F.col("f3")),
        step(4, "no_excluded_plan_names", "critical", F.col("f4")),
        step(5, "demand_rate_gte_0", "report", F.col("f5")),
        step(6, "energy_rate_gte_0", "report", F.col("f6")),
        step(7, "plan_count_matches_input", "warning", plan_mismatch),
    )
    return one.select(F.inline(steps)).withColumn("passed", F.col("n_failed") == 0)


def enforce(report: DataFrame) -> list:
    """V8: raise if any critical step failed (the report is tiny)."""
    rows = report.orderBy("step").collect()
    failed = [r for r in rows if r["step"] <= CRITICAL_STEPS and r["n_failed"] > 0]
    if failed:
        names = ", ".join(f"{r['check_name']} ({r['n_failed']})" for r in failed)
        raise ValidationError("Data validation failed on a critical check: " + names)
    return rows


def validation_report_cells(
    input_plans: DataFrame,
    plan_cells: DataFrame,
    fixed_limit: float = FIXED_CHARGE_CHECK,
    energy_limit: float = ENERGY_RATE_CHECK,
    pattern: str = EXCLUDED_NAMES,
) -> DataFrame:
    """Same report, computed from plan rows holding their hourly ``cells``.

    The row checks are counted inside each plan row and summed (a global
    aggregate of one small row per partition).  Uniqueness (V3) needs the
    hourly keys only where two plan rows share (eiaId, utilityName,
    rateName): within one row the cells have distinct (week part, month,
    hour) by construction.  So plan rows are counted per key first, and only
    rows of duplicated keys are exploded and grouped; the hourly table is
    never shuffled as a whole.
    """
    rows = plan_cells.where(F.size("cells") > 0)  # pass materialized cells: read three times
    fixed_bad = not_true(F.col("fixedChargeFirstMeter") <= F.lit(fixed_limit))
    name_bad = not_true(~F.col("rateName").rlike("(?i)" + pattern))

    def cells_failing(cond: str):
        return F.expr(f"size(filter(cells, c -> NOT coalesce({cond}, false)))").cast("long")

    n_cells = F.size("cells").cast("long")
    totals = rows.agg(
        F.coalesce(F.sum(n_cells), F.lit(0)).cast("long").alias("n"),
        F.coalesce(F.sum(F.when(fixed_bad, n_cells).otherwise(0)), F.lit(0)).cast("long").alias("f1"),
        F.coalesce(F.sum(cells_failing(f"c.total_energy_rate <= {float(energy_limit)}D")), F.lit(0))
        .cast("long")
        .alias("f2"),
        F.coalesce(F.sum(F.when(name_bad, n_cells).otherwise(0)), F.lit(0)).cast("long").alias("f4"),
        F.coalesce(F.sum(cells_failing("c.total_demand_rate >= 0")), F.lit(0)).cast("long").alias("f5"),
        F.coalesce(F.sum(cells_failing("c.total_energy_rate >= 0")), F.lit(0)).cast("long").alias("f6"),
        F.count_distinct(F.struct(*COUNT_KEYS)).alias("n_out"),
    )
    per_key = rows.groupBy(*COUNT_KEYS).agg(F.count(F.lit(1)).alias("copies"))
    dup_keys = per_key.where(F.col("copies") > 1).select(*COUNT_KEYS)
    dup_rows = rows.join(
        dup_keys, on=[rows[k].eqNullSafe(dup_keys[k]) for k in COUNT_KEYS], how="left_semi"
    )
    dup = (
        dup_rows.select(*COUNT_KEYS, F.inline_outer("cells"))
        .where(F.col("week_part").isNotNull())
        .groupBy(*UNIQUE_KEYS)
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).cast("long").alias("f3"))
    )
    n_in = input_plans.select(*COUNT_KEYS).distinct().agg(F.count(F.lit(1)).alias("n_in"))
    return _steps(_one_row(totals, dup, n_in))


#: 576 slots (week part, month, hour) in words of 64 bits.
SLOT_BITS = 64
SLOT_WORDS = 576 // SLOT_BITS


def _slot() -> Column:
    """Number 0..575 of a row's (week part, month, hour); NULL off the grid."""
    part = F.when(F.col("week_part") == WEEKDAY, 0).when(F.col("week_part") == WEEKEND, 288)
    on_grid = F.col("month").between(1, 12) & F.col("hour").between(1, 24)
    return F.when(on_grid, part + (F.col("month") - 1) * 24 + F.col("hour") - 1).cast("int")


def plan_slots(
    output: DataFrame,
    fixed_limit: float = FIXED_CHARGE_CHECK,
    energy_limit: float = ENERGY_RATE_CHECK,
    pattern: str = EXCLUDED_NAMES,
) -> DataFrame:
    """Per plan of the long table: rows, failures of each check, slots that occur (``slots``)
    and that occur an odd number of times (``odd``), rows off the grid.

    A plan's slots are bitmaps of nine words under ``bit_or`` and ``bit_xor``, fixed-width
    buffers that the scan's tasks combine before the shuffle: one row a plan and
    task, not one an hour.
    """
    slotted = output.select(
        *COUNT_KEYS, "fixedChargeFirstMeter", "total_energy_rate", "total_demand_rate", _slot().alias("_slot")
    )

    def word(k: int, merge: Callable[[Column], Column]) -> Column:
        bit = F.expr(f"IF(_slot DIV {SLOT_BITS} = {k}, shiftleft(1L, _slot % {SLOT_BITS}), 0L)")
        return F.coalesce(merge(bit), F.lit(0).cast("long"))

    def bits(name: str) -> Column:
        return sum((F.bit_count(f"{name}{k}") for k in range(1, SLOT_WORDS)), F.bit_count(f"{name}0")).cast("long")

    return (
        slotted.groupBy(*COUNT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            count_if(not_true(F.col("fixedChargeFirstMeter") <= F.lit(fixed_limit))).alias("f1"),
            count_if(not_true(F.col("total_energy_rate") <= F.lit(energy_limit))).alias("f2"),
            count_if(not_true(F.col("total_demand_rate") >= 0)).alias("f5"),
            count_if(not_true(F.col("total_energy_rate") >= 0)).alias("f6"),
            count_if(F.col("_slot").isNull()).alias("off_grid"),
            *[word(k, F.bit_or).alias(f"_w{k}") for k in range(SLOT_WORDS)],
            *[word(k, F.bit_xor).alias(f"_x{k}") for k in range(SLOT_WORDS)],
        )
        .select(
            *COUNT_KEYS, "n", "f1", "f2",
            # the name is a key, so this check is one decision a plan
            F.when(not_true(~F.col("rateName").rlike("(?i)" + pattern)), F.col("n")).otherwise(0).alias("f4"),
            "f5", "f6", "off_grid", bits("_w").alias("slots"), bits("_x").alias("odd"),
        )
    )


def validation_report_slots(
    input_plans: DataFrame,
    output: DataFrame,
    fixed_limit: float = FIXED_CHARGE_CHECK,
    energy_limit: float = ENERGY_RATE_CHECK,
    pattern: str = EXCLUDED_NAMES,
) -> DataFrame:
    """Same report of the long table, shuffled at plan grain.

    Slots that occur an odd number of times have at least one row each, the
    others at least two.  A plan with just as many rows has none more, so its
    copies (V3) are the rows of the others.  Plans with more rows (a slot three
    times), or rows off the grid, are the only ones whose rows are grouped
    by all six keys.  The plans' counts are written to the shared folder first,
    so the size of that list is known when the join is planned: a short list
    (the normal case is none) is sent to the hourly rows, a long one is joined
    by shuffle.  ``output`` is read again only if the list has a plan.
    """
    spark = output.sparkSession
    path = scratch_path(spark, "plan-slots")
    plan_slots(output, fixed_limit, energy_limit, pattern).write.parquet(f"{path}/counts")
    per_plan = spark.read.parquet(f"{path}/counts")
    even = F.col("slots") - F.col("odd")
    told = (F.col("off_grid") == 0) & (F.col("n") == F.col("odd") + 2 * even)
    per_plan.where(~told).select(*COUNT_KEYS).write.parquet(f"{path}/suspects")
    suspects = spark.read.parquet(f"{path}/suspects")
    totals = per_plan.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"),
        *[F.coalesce(F.sum(f), F.lit(0)).cast("long").alias(f) for f in ("f1", "f2", "f4", "f5", "f6")],
        F.coalesce(F.sum(F.when(told, 2 * even)), F.lit(0)).cast("long").alias("f3_told"),
        F.count(F.lit(1)).alias("n_out"),
    )
    n_in = input_plans.select(*COUNT_KEYS).distinct().agg(F.count(F.lit(1)).alias("n_in"))
    rows = output.select(*UNIQUE_KEYS)
    copies = (
        rows.join(suspects, on=[rows[k].eqNullSafe(suspects[k]) for k in COUNT_KEYS], how="left_semi")
        .groupBy(*UNIQUE_KEYS)
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).cast("long").alias("f3_grouped"))
    )
    one = _one_row(totals, copies, n_in)
    return _steps(one.withColumn("f3", F.col("f3_told") + F.col("f3_grouped")))
