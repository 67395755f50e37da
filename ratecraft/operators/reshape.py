"""Schedules and rate structures from nested to long form.

Every explode here is a narrow operator: rows of one plan never leave the
partition that holds the plan.  Matrices are flattened with higher-order
functions and a single ``inline``, so one generator produces all 576 rows
of a plan in one pass, with no shuffle.  ``fill_units_ranges`` alone moves
rows: it is for input where very many plans share a name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_number, carried, col_of
from ..constants import DEFAULT_ENERGY_UNIT, WEEKDAY, WEEKEND
from ..schema import PLAN_KEYS_SECTOR
from ..session import scratch_path


def matrix_cells(matrix: str | Column, offset: int = 1, label: str | None = None) -> Column:
    """array<struct<[week_part,] month, hour, period>> of a 12x24 matrix.

    month and hour are 1-based; period = value + ``offset``.
    """
    m = col_of(matrix)

    def cell(p, i, j):
        fields = [] if label is None else [F.lit(label).alias("week_part")]
        return F.struct(
            *fields,
            (i + 1).alias("month"),
            (j + 1).alias("hour"),
            (p + F.lit(offset)).cast("int").alias("period"),
        )

    return F.flatten(F.transform(m, lambda row, i: F.transform(row, lambda p, j: cell(p, i, j))))


# --- U1 -------------------------------------------------------------------
def schedule_long(
    df: DataFrame, matrix: str, keys: Sequence[str] = tuple(PLAN_KEYS_SECTOR), offset: int = 1
) -> DataFrame:
    """12x24 matrix -> rows (month, hour, period); NULL matrix -> no rows."""
    return df.select(*carried(df, keys), F.inline(matrix_cells(matrix, offset)))


# --- U2 / U3 / U11 --------------------------------------------------------
def week_schedule(
    df: DataFrame,
    weekday: str,
    weekend: str,
    keys: Sequence[str] = tuple(PLAN_KEYS_SECTOR),
    offset: int = 1,
) -> DataFrame:
    """Both week parts unpivoted into ``week_part`` and exploded in one generator."""
    return df.select(*carried(df, keys), F.inline(week_cells(weekday, weekend, offset)))


def week_cells(weekday: str, weekend: str, offset: int = 1) -> Column:
    """The cells of both week parts in one array; a NULL matrix has none."""
    empty = F.array().cast("array<struct<week_part:string,month:int,hour:int,period:int>>")
    return F.flatten(
        F.array(
            F.coalesce(matrix_cells(weekday, offset, WEEKDAY), empty),
            F.coalesce(matrix_cells(weekend, offset, WEEKEND), empty),
        )
    )


def demand_schedule(df: DataFrame) -> DataFrame:
    return week_schedule(df, "demandWeekdaySched", "demandWeekendSched")


def energy_schedule(df: DataFrame) -> DataFrame:
    return week_schedule(df, "energyWeekdaySched", "energyWeekendSched")


def week_periods(
    df: DataFrame,
    weekday: str,
    weekend: str,
    keys: Sequence[str] = tuple(PLAN_KEYS_SECTOR),
    offset: int = 1,
) -> DataFrame:
    """Distinct (plan, period) of ``week_schedule``, found inside the plan's row: its cells are never exploded."""
    none = F.array().cast("array<int>")
    values = [F.coalesce(F.flatten(m).cast("array<int>"), none) for m in (weekday, weekend)]
    periods = df.select(*carried(df, keys), F.explode(F.array_distinct(F.concat(*values))).alias("_p"))
    # rows of one plan key can still repeat a period
    return periods.select(*carried(df, keys), (F.col("_p") + F.lit(offset)).cast("int").alias("period")).distinct()


def demand_periods(df: DataFrame) -> DataFrame:
    return week_periods(df, "demandWeekdaySched", "demandWeekendSched")


def energy_periods(df: DataFrame) -> DataFrame:
    return week_periods(df, "energyWeekdaySched", "energyWeekendSched")


# --- U4 -------------------------------------------------------------------
def flat_schedule(df: DataFrame, keys: Sequence[str] = tuple(PLAN_KEYS_SECTOR)) -> DataFrame:
    """12-vector -> (period 0-based, month = position + 1); NULL -> no rows.

    The month is the position inside each plan's own vector (not a
    table-wide recycling counter), so a plan without months cannot shift
    the months of other plans.
    """
    keys = carried(df, keys)
    return df.select(*keys, F.posexplode("flatDemandMonths").alias("_pos", "period")).select(
        *keys, F.col("period").cast("int").alias("period"), (F.col("_pos") + 1).alias("month")
    )


# --- U5 / U6 / U7 ---------------------------------------------------------
def rate_structure(
    df: DataFrame,
    strux: str,
    tiers_field: str,
    keep: Sequence[str],
    period_base: int = 1,
    keep_empty: bool = True,
) -> DataFrame:
    """Explode periods then tiers; period = position + ``period_base``, tier 1-based.

    Plans and periods without tiers stay as a row of NULLs, or go
    (``keep_empty=False``, the legacy form).
    """
    keep = carried(df, keep)
    explode = F.posexplode_outer if keep_empty else F.posexplode
    periods = df.select(*keep, explode(strux).alias("_p", "_period"))
    tiers = periods.select(
        *keep,
        (F.col("_p") + F.lit(period_base)).cast("int").alias("period"),
        explode(F.col("_period")[tiers_field]).alias("_t", "_tier"),
    )
    tier_fields = [
        f.name
        for f in df.schema[strux].dataType.elementType[tiers_field].dataType.elementType.fields
    ]
    return tiers.select(
        *keep,
        "period",
        (F.col("_t") + 1).cast("int").alias("tier"),
        *[F.col("_tier")[f].alias(f) for f in tier_fields],
    )


# --- U8 -------------------------------------------------------------------
def reformat_zero_filled(df: DataFrame) -> DataFrame:
    """period, tier, rate, adj, max: NULL -> 0 (numbers may be text); total_rate = rate + adj."""
    out = df.withColumns(
        {
            "period": F.coalesce("period", F.lit(0)),
            "tier": F.coalesce("tier", F.lit(0)),
            "rate": F.coalesce(as_number("rate"), F.lit(0.0)),
            "adj": F.coalesce(as_number("adj"), F.lit(0.0)),
            "max": F.coalesce(as_number("max"), F.lit(0.0)),
        }
    )
    return out.withColumn("total_rate", F.col("rate") + F.col("adj"))


# --- U9 -------------------------------------------------------------------
def reformat_energy(df: DataFrame) -> DataFrame:
    """rate, adj: NULL -> 0; max: NULL -> -1; period and tier stay NULL."""
    out = df.withColumns(
        {
            "rate": F.coalesce(as_number("rate"), F.lit(0.0)),
            "adj": F.coalesce(as_number("adj"), F.lit(0.0)),
            "max": F.coalesce(as_number("max"), F.lit(-1.0)),
        }
    )
    return out.withColumn("total_rate", F.col("rate") + F.col("adj"))


# --- W3 -------------------------------------------------------------------
def fill_units(
    df: DataFrame,
    default: str = DEFAULT_ENERGY_UNIT,
    group: Sequence[str] = ("rateName", "utilityName"),
    order: Sequence[str] = ("eiaId", "sector", "period", "tier"),
) -> DataFrame:
    """Fill ``unit`` down in structure order within a plan name, then default.

    The window is one plan's tier rows (plan names are unique after K1).
    """
    if "unit" not in df.columns:
        df = df.withColumn("unit", F.lit(None).cast("string"))
    w = (
        Window.partitionBy(*carried(df, group))
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(
        "unit", F.coalesce(F.last("unit", ignorenulls=True).over(w), F.lit(default))
    )


def _in_ranges(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The table written in ranges of ``keys`` and read back; ``_part`` numbers the ranges in order."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    dealt = df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in keys])
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def fill_units_ranges(
    df: DataFrame,
    default: str = DEFAULT_ENERGY_UNIT,
    group: Sequence[str] = ("rateName", "utilityName"),
    order: Sequence[str] = ("eiaId", "sector", "period", "tier"),
) -> DataFrame:
    """``fill_units`` for input where many plans share a name (K1 skipped).

    A segmented scan in two phases.  The rows are written in ranges of (name,
    order), so that a name with very many rows lies in many ranges; each range
    fills its own part of a name.  What a part carries in is the last unit of
    the name's earlier parts.  Only the name that a range begins with can
    continue from an earlier one, so at most one row a range is carried, and
    that list is sent to all rows.  Rows that tie in ``order`` are taken by
    unit, NULL first.
    """
    if "unit" not in df.columns:
        df = df.withColumn("unit", F.lit(None).cast("string"))
    rows = _in_ranges(df, [*group, *order, "unit"], "units-by-range")
    in_part = (
        Window.partitionBy("_part", *group)
        .orderBy(*[F.col(c).asc_nulls_first() for c in (*order, "unit")])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # one row for each name of a range, combined before the shuffle
    ends = rows.groupBy("_part", *group).agg(
        F.max_by("unit", F.when(F.col("unit").isNotNull(), F.struct(*order, "unit"))).alias("_unit")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ends.select(
            F.col("_part").alias("_to"),
            *[F.col(c).alias(f"_c{i}") for i, c in enumerate(group)],
            F.last("_unit", ignorenulls=True).over(before).alias("_carried"),
        )
        .where(F.col("_carried").isNotNull())
    )
    same = F.col("_part") == F.col("_to")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_c{i}"))
    filled = rows.withColumn("_unit", F.last("unit", ignorenulls=True).over(in_part))
    return (
        filled.join(F.broadcast(carry), same, "left")
        .withColumn("unit", F.coalesce("_unit", "_carried", F.lit(default)))
        .select(*df.columns)
    )


# --- U10 ------------------------------------------------------------------
def demand_structure(df: DataFrame, keep_empty: bool = True) -> DataFrame:
    keep = [*PLAN_KEYS_SECTOR, "demandMin", "demandMax", "demandRateUnits"]
    return (
        rate_structure(df, "demandRateStrux", "demandRateTiers", keep, period_base=1, keep_empty=keep_empty)
        .transform(reformat_zero_filled)
        .transform(fill_units)
    )


def energy_structure(df: DataFrame, keep_empty: bool = True) -> DataFrame:
    keep = [*PLAN_KEYS_SECTOR, "energyMin", "energyMax"]
    return (
        rate_structure(df, "energyRateStrux", "energyRateTiers", keep, period_base=1, keep_empty=keep_empty)
        .transform(reformat_energy)
        .transform(fill_units)
        .drop("sell")
    )


def flat_structure(df: DataFrame, keep_empty: bool = True) -> DataFrame:
    keep = [*PLAN_KEYS_SECTOR, "flatDemandUnits"]
    return rate_structure(df, "flatDemandStrux", "flatDemandTiers", keep, period_base=0, keep_empty=keep_empty).transform(
        reformat_zero_filled
    )


# --- K4 -------------------------------------------------------------------
def distinct_tiers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Unique tier rows (collapses the hourly fan-out of a combo)."""
    return df.select(*carried(df, cols)).distinct()
