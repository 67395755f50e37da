"""Nested-first rates pipeline: one plan row in, its 576 hourly rates out.

After revision selection (K1/K2, the only wide steps) each plan is a
single row holding its tiers and schedules.  Everything downstream of
that is evaluated *inside the row* with higher-order functions:

* tiers are flattened in structure order, units filled down (W3);
* the schedule's distinct periods are matched to structure periods (J1-J3
  restricted to the plan, so no join) and the waterfall (W1) is an
  ``aggregate`` over each period's tiers (A1-A3);
* the unit flag (W2) is a distinct count over the matched tiers;
* hourly rates are a ``transform`` over the 12x24 matrices (J4-J6);
* plan filters (P12-P14, W4, W5) are ``forall`` predicates on the row.

The physical plan has no Exchange after K2, whatever the data size, and a
skewed utility or plan name cannot concentrate work: the unit of work is a
row.  The relational operators in ``operators`` compute the same result
step by step (tested equal in ``tests/test_pipeline.py`` and ``tests/test_properties.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    DEFAULT_DEMAND_UNIT,
    DEFAULT_ENERGY_UNIT,
    ENERGY_RATE_LIMIT,
    FIXED_CHARGE_LIMIT,
    HP_PER_KW_DIVISOR,
    IRRELEVANT_PATTERN,
    KVA_PER_KW_DIVISOR,
    MONTHLY_USAGE_KWH,
    PEAK_DEMAND_KW,
    WEEKDAY,
    WEEKEND,
)
from ..schema import NAME_KEYS, PLAN_KEYS
from ..sources.publish import grid_matrix_sql

INF = "CAST('Infinity' AS DOUBLE)"
ENTRY = "struct<period:int,tier:int,rate:double,cap:double,unit:string>"


def _entries(strux: str, tiers: str, period_base: int, null_period: str, null_tier: str, unit: bool) -> str:
    """Flat tier list of a structure column as SQL (U5-U9 inside the row)."""
    unit_of = "t.unit" if unit else "CAST(NULL AS STRING)"

    def entry(period: str, tier: str, rate: str, mx: str, u: str) -> str:
        cap = f"IF({mx} IS NULL OR {mx} <= 0, {INF}, CAST({mx} AS DOUBLE))"
        return (
            f"named_struct('period', CAST({period} AS INT), 'tier', CAST({tier} AS INT), "
            f"'rate', CAST({rate} AS DOUBLE), 'cap', {cap}, 'unit', {u})"
        )

    missing = entry(null_period, null_tier, "0D", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)")
    empty_period = entry(f"i + {period_base}", null_tier, "0D", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)")
    tier = entry(
        f"i + {period_base}", "j + 1", "coalesce(t.rate, 0D) + coalesce(t.adj, 0D)", "t.max", unit_of
    )
    return (
        f"IF(coalesce(size({strux}), 0) <= 0, array({missing}), "
        f"flatten(transform({strux}, (p, i) -> IF(coalesce(size(p.{tiers}), 0) <= 0, "
        f"array({empty_period}), transform(p.{tiers}, (t, j) -> {tier})))))"
    )


def _fill_units(entries: str, default: str = DEFAULT_ENERGY_UNIT) -> str:
    """Fill ``unit`` down the flat tier list, then default."""
    rebuilt = (
        "named_struct('period', x.period, 'tier', x.tier, 'rate', x.rate, 'cap', x.cap, "
        "'unit', coalesce(x.unit, acc.last))"
    )
    return (
        f"aggregate({entries}, named_struct('out', CAST(array() AS array<{ENTRY}>), "
        f"'last', CAST(NULL AS STRING)), "
        f"(acc, x) -> named_struct('out', concat(acc.out, array({rebuilt})), "
        f"'last', coalesce(x.unit, acc.last)), "
        f"acc -> transform(acc.out, x -> named_struct('period', x.period, 'tier', x.tier, "
        f"'rate', x.rate, 'cap', x.cap, 'unit', coalesce(x.unit, '{default}'))))"
    )


def _waterfall(tiers: str, target: str, scale: str) -> str:
    """struct(billed, cost) of a tier list (W1 + sum); ``scale`` uses ``t``."""
    prev = "acc.prev"
    cap = f"(t.cap * {scale})"
    qty = (
        f"least(IF({prev} = {INF}, 0D, greatest({target} - {prev}, 0D)), "
        f"IF({prev} = {INF}, 0D, greatest({cap} - {prev}, 0D)))"
    )
    return (
        f"aggregate({tiers}, named_struct('prev', 0D, 'billed', 0D, 'cost', 0D), "
        f"(acc, t) -> named_struct('prev', {cap}, 'billed', acc.billed + {qty}, "
        f"'cost', acc.cost + {qty} * coalesce(t.rate, 0D)), "
        f"acc -> named_struct('billed', acc.billed, 'cost', acc.cost))"
    )


def _matched(entries: str, period: str) -> str:
    """Tiers of one scheduled period; an unmatched period acts as one
    uncapped zero-rate tier with a NULL unit (what the left join yields)."""
    none = (
        f"array(named_struct('period', CAST(NULL AS INT), 'tier', CAST(NULL AS INT), "
        f"'rate', CAST(NULL AS DOUBLE), 'cap', {INF}, 'unit', CAST(NULL AS STRING)))"
    )
    return f"IF(exists({entries}, x -> x.period = {period}), filter({entries}, x -> x.period = {period}), {none})"


def _periods_of(weekday: str, weekend: str) -> str:
    return (
        f"filter(array_distinct(transform(flatten(flatten(array(coalesce({weekday}, array()), "
        f"coalesce({weekend}, array())))), v -> v + 1)), v -> v IS NOT NULL)"
    )


def rate_cells(
    plans: DataFrame, monthly_kwh: float = MONTHLY_USAGE_KWH, peak_kw: float = PEAK_DEMAND_KW
) -> DataFrame:
    """Plan rows with ``cells``: the hourly rate records of the plan.

    ``cells`` = array<struct<week_part, month, hour, demand_period,
    total_demand_rate, multi_unit, energy_period, total_energy_rate>>,
    one element per demand-schedule cell (576 for full matrices).
    """
    peak = float(peak_kw)
    kwh = float(monthly_kwh)
    e_scale = (
        f"CASE WHEN t.unit = 'kWh' THEN 1D WHEN t.unit = 'kWh/kW' THEN {peak}D "
        f"WHEN t.unit = 'kWh/hp' THEN {peak / HP_PER_KW_DIVISOR}D "
        f"WHEN t.unit = 'kWh/kVA' THEN {peak / KVA_PER_KW_DIVISOR}D ELSE 1D END"
    )

    def d_target(units: str) -> str:
        return (
            f"CASE WHEN coalesce({units}, '{DEFAULT_DEMAND_UNIT}') = 'kW' THEN {peak}D "
            f"WHEN coalesce({units}, '{DEFAULT_DEMAND_UNIT}') = 'hp' THEN {peak / HP_PER_KW_DIVISOR}D "
            f"WHEN coalesce({units}, '{DEFAULT_DEMAND_UNIT}') = 'kVA' THEN {peak / KVA_PER_KW_DIVISOR}D "
            f"ELSE {peak}D END"
        )

    staged = plans.select(
        *PLAN_KEYS,
        "sector",
        "fixedChargeFirstMeter",
        "demandWeekdaySched",
        "demandWeekendSched",
        "energyWeekdaySched",
        "energyWeekendSched",
        "flatDemandMonths",
        F.expr(_fill_units(_entries("energyRateStrux", "energyRateTiers", 1, "NULL", "NULL", True))).alias("_e"),
        F.expr(_entries("demandRateStrux", "demandRateTiers", 1, "0", "0", False)).alias("_d"),
        F.expr(_entries("flatDemandStrux", "flatDemandTiers", 0, "0", "0", False)).alias("_f"),
        F.expr(_periods_of("energyWeekdaySched", "energyWeekendSched")).alias("_se"),
        F.expr(_periods_of("demandWeekdaySched", "demandWeekendSched")).alias("_sd"),
        F.expr(d_target("demandRateUnits")).alias("_dt"),
        F.expr(d_target("flatDemandUnits")).alias("_ft"),
    )
    energy_wf = _waterfall(_matched("_e", "s"), f"{kwh}D", e_scale)
    demand_wf = _waterfall(_matched("_d", "s"), "_dt", "1D")
    flat_wf = _waterfall(_matched("_f", "m"), "_ft", "1D")
    allocated = staged.select(
        "*",
        F.expr(f"transform(_se, s -> {energy_wf})").alias("_ewf"),
        F.expr(f"transform(_sd, s -> {demand_wf}.cost)").alias("_dwf"),
    )
    costed = allocated.select(
        "*",
        F.expr("map_from_arrays(_se, transform(_ewf, w -> try_divide(w.cost, w.billed)))").alias("_erate"),
        F.expr(
            "size(array_distinct(flatten(transform(_se, s -> transform(filter(_e, x -> x.period = s), "
            "x -> x.unit))))) + IF(exists(_se, s -> NOT exists(_e, x -> x.period = s)), 1, 0) > 1"
        ).alias("_multi"),
        F.expr("map_from_arrays(_sd, _dwf)").alias("_dcost"),
        F.expr(f"transform(coalesce(flatDemandMonths, array()), m -> {flat_wf}.cost)").alias("_fcost"),
    )

    def cells(label: str, demand: str, energy: str) -> str:
        # ``ctx`` carries the per-plan lookups into the per-cell lambdas, so
        # whatever Catalyst inlines for them is evaluated once per plan.
        return (
            f"flatten(transform({demand}, (row, i) -> transform(row, (v, j) -> named_struct("
            f"'week_part', '{label}', 'month', i + 1, 'hour', j + 1, "
            f"'demand_period', CAST(v + 1 AS INT), "
            f"'total_demand_rate', try_divide(try_element_at(ctx.dcost, v + 1) + "
            f"coalesce(get(ctx.fcost, i), 0D), {peak}D), "
            f"'multi_unit', IF(get(get({energy}, i), j) IS NULL, CAST(NULL AS BOOLEAN), ctx.multi), "
            f"'energy_period', CAST(get(get({energy}, i), j) + 1 AS INT), "
            f"'total_energy_rate', try_element_at(ctx.erate, get(get({energy}, i), j) + 1)))))"
        )

    let = (
        "transform(array(named_struct('erate', _erate, 'dcost', _dcost, 'fcost', _fcost, 'multi', _multi)), "
        "ctx -> concat({}, {}))[0]"
    ).format(
        cells(WEEKDAY, "demandWeekdaySched", "energyWeekdaySched"),
        cells(WEEKEND, "demandWeekendSched", "energyWeekendSched"),
    )
    return costed.select(
        *PLAN_KEYS,
        F.coalesce("fixedChargeFirstMeter", F.lit(0.0)).alias("fixedChargeFirstMeter"),
        F.expr(let).alias("cells"),
    )


RATE_COLUMNS = [
    "eiaId",
    "rateName",
    "utilityName",
    "fixedChargeFirstMeter",
    "week_part",
    "month",
    "hour",
    "demand_period",
    "total_demand_rate",
    "multi_unit",
    "energy_period",
    "total_energy_rate",
]


def explode_cells(df: DataFrame) -> DataFrame:
    """Hourly long table (``utility_rates`` layout) from plan rows.

    ``inline_outer`` + a filter on the generated column instead of
    ``inline``: the filter Catalyst infers for ``inline`` would be pushed
    below the projection and evaluate the whole ``cells`` expression twice.
    A filter on generator output stays above the Generate.
    """
    return (
        df.select(*PLAN_KEYS, "fixedChargeFirstMeter", F.inline_outer("cells"))
        .where(F.col("week_part").isNotNull())
        .select(*RATE_COLUMNS)
    )


def filter_plans(
    df: DataFrame,
    fixed_limit: float = FIXED_CHARGE_LIMIT,
    energy_limit: float = ENERGY_RATE_LIMIT,
    pattern: str = IRRELEVANT_PATTERN,
    drop_negative: bool = False,
) -> DataFrame:
    """P13, P12, W4, P14 and (optionally) W5 as predicates on the plan row.

    Exact for tables where (utilityName, rateName) names one plan, which
    revision selection (K1) guarantees.  The outcome is a ``keep`` flag and
    the surviving ``cells`` (empty when dropped), computed in the same
    projection as the cells themselves; nothing is filtered here, so no
    predicate is pushed below the cell computation.
    """
    keep = (
        F.coalesce(~F.col("rateName").rlike("(?i)" + pattern), F.lit(False))
        & F.coalesce(F.col("fixedChargeFirstMeter") < F.lit(fixed_limit), F.lit(False))
        & F.expr(f"forall(cells, c -> coalesce(c.total_energy_rate <= {float(energy_limit)}D, true))")
    )
    unit_ok = F.expr("filter(cells, c -> c.multi_unit = false)")
    staged = df.withColumn("keep", keep).withColumn("cells", unit_ok)
    if drop_negative:
        staged = staged.withColumn(
            "keep",
            F.col("keep")
            & F.expr(
                "forall(cells, c -> coalesce(c.total_energy_rate >= 0, true) "
                "AND coalesce(c.total_demand_rate >= 0, true))"
            ),
        )
    return staged.withColumn(
        "cells", F.when(F.col("keep"), F.col("cells")).otherwise(F.expr("slice(cells, 1, 0)"))
    ).withColumn("keep", F.col("keep") & (F.size("cells") > 0))


def drop_failing_names(plan_cells: DataFrame, fails: str) -> DataFrame:
    """W4/W5 at plan grain: drop the plan rows of every (utilityName, rateName)
    with a cell ``c`` for which the SQL condition ``fails`` is true.

    The verdict is one narrow row per failing name; the hourly rows are
    exploded afterwards, from the plan rows that stay.  Exact for any input,
    also where several plans share a name.  Pass materialized plan rows:
    they are read twice.
    """
    failing = plan_cells.where(F.expr(f"exists(cells, c -> coalesce({fails}, false))")).select(*NAME_KEYS).distinct()
    bad = failing.select(*[F.col(k).alias(f"_bad_{k}") for k in NAME_KEYS])
    return plan_cells.join(bad, [F.col(k).eqNullSafe(F.col(f"_bad_{k}")) for k in NAME_KEYS], "left_anti")


def names_are_unique(plans: DataFrame) -> bool:
    """Whether every (utilityName, rateName) is one plan, as after K1; an aggregate over two narrow columns."""
    return plans.groupBy(*NAME_KEYS).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first() is None


def kept_plans(df: DataFrame) -> DataFrame:
    """Plan rows whose ``keep`` flag is set.

    The flag is read after a one-row-per-plan Generate, which predicates
    are not pushed through, so the cells are not computed a second time
    inside a pushed-down filter.
    """
    cols = df.columns
    return (
        df.select(F.inline_outer(F.array(F.struct(*cols))))
        .where(F.col("keep"))
        .drop("keep")
    )


def rate_matrices(df: DataFrame) -> DataFrame:
    """R1/R2 from plan rows: four 12x24 matrices per plan, missing cell -> 0."""

    def matrix(label: str, field: str) -> str:
        return grid_matrix_sql(f"_cells_{label}", field)

    keyed = df.select(
        *PLAN_KEYS,
        "fixedChargeFirstMeter",
        *[
            F.expr(
                f"array_sort(transform(filter(cells, c -> c.week_part = '{wp}'), "
                f"c -> named_struct('k', c.month * 100 + c.hour, 'v', c)))"
            ).alias(f"_cells_{wp}")
            for wp in (WEEKDAY, WEEKEND)
        ],
    )
    return keyed.select(
        F.col("eiaId").alias("eiaid"),
        F.col("rateName").alias("name"),
        F.col("utilityName").alias("utility"),
        F.col("fixedChargeFirstMeter").alias("fixedchargefirstmeter"),
        F.expr(matrix(WEEKDAY, "total_demand_rate")).alias("totaldemandweekdayschedule"),
        F.expr(matrix(WEEKEND, "total_demand_rate")).alias("totaldemandweekendschedule"),
        F.expr(matrix(WEEKDAY, "total_energy_rate")).alias("energyweekdayschedule"),
        F.expr(matrix(WEEKEND, "total_energy_rate")).alias("energyweekendschedule"),
    )
