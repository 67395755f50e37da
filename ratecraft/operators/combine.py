"""Schedule x structure joins, unit flag and the hourly compile.

All joins are left outer on NULL-safe (``<=>``) keys.  Join strategy is
left to AQE: the per-plan cost tables are small relative to the hourly
schedule and get broadcast when their measured size allows, otherwise a
sort-merge join with skew splitting runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import PEAK_DEMAND_KW, WEEKDAY
from ..functions.columns import choose_divisor as _divisor
from ..functions.columns import NAME_KEY, carried, distinct_count_with_null, null_safe_left_join
from ..schema import PLAN_KEYS, PLAN_KEYS_SECTOR
from .reshape import week_cells

COMBO_KEYS = [*PLAN_KEYS_SECTOR, "period"]


# --- J1 -------------------------------------------------------------------
def demand_combo(sched: DataFrame, strux: DataFrame) -> DataFrame:
    right = strux.select(*carried(strux, COMBO_KEYS), "tier", "demandRateUnits", "total_rate", "max")
    return null_safe_left_join(sched, right, COMBO_KEYS)


# --- J2 -------------------------------------------------------------------
def flat_combo(sched: DataFrame, strux: DataFrame) -> DataFrame:
    right = strux.select(*carried(strux, COMBO_KEYS), "tier", "flatDemandUnits", "total_rate", "max")
    return null_safe_left_join(sched, right, COMBO_KEYS)


# --- J3 -------------------------------------------------------------------
def energy_combo(sched: DataFrame, strux: DataFrame) -> DataFrame:
    right = strux.select(*carried(strux, COMBO_KEYS), "tier", "unit", "total_rate", "max")
    return null_safe_left_join(sched, right, COMBO_KEYS)


# --- W2 -------------------------------------------------------------------
def multi_unit_flags(combo: DataFrame, keys=tuple(PLAN_KEYS_SECTOR)) -> DataFrame:
    """Per plan: more than one distinct unit, NULL counted as a unit.

    A grouped aggregate (partial distinct per partition, then merge), so a
    plan with a huge combo is reduced map-side.
    """
    return combo.groupBy(*carried(combo, keys)).agg(
        (distinct_count_with_null("unit") > 1).alias("multi_unit")
    )


def with_multi_unit(combo: DataFrame, keys=tuple(PLAN_KEYS_SECTOR)) -> DataFrame:
    """The combo with its plan's flag.

    A combo dealt by name takes it from a window in the same buckets, so that
    the combo is built once; any other from the aggregate, joined back.
    """
    if NAME_KEY in combo.columns:
        plan = Window.partitionBy(*carried(combo, keys))
        units, rows = F.count("unit").over(plan), F.count(F.lit(1)).over(plan)
        two = F.coalesce(F.min("unit").over(plan) < F.max("unit").over(plan), F.lit(False))
        return combo.withColumn("multi_unit", two | ((units > 0) & (units < rows)))
    return null_safe_left_join(combo, multi_unit_flags(combo, keys), list(keys))


def energy_combo_with_flag(sched: DataFrame, strux: DataFrame, keys=tuple(PLAN_KEYS_SECTOR)) -> DataFrame:
    """J3 with the W2 flag.

    The flag depends on a plan's distinct scheduled periods only, so it is
    taken from those (a few rows per plan) and stands beside their tiers; the
    hourly rows are joined once, with both.
    """
    periods = sched.select(*carried(sched, COMBO_KEYS)).distinct()
    tiers = with_multi_unit(energy_combo(periods, strux), keys)
    return null_safe_left_join(sched, tiers, COMBO_KEYS)


# --- J4 -------------------------------------------------------------------
def demand_total(
    sched: DataFrame,
    demand_cost: DataFrame,
    flat_cost: DataFrame,
    peak_kw: float = PEAK_DEMAND_KW,
    denominator: str = "peak",
) -> DataFrame:
    """Demand and flat demand per hour; the total is divided by the peak, or by
    the billed demand (``denominator="billed"``, the legacy rate)."""
    divisor = _divisor(denominator, F.lit(float(peak_kw)), F.col("total_demand_billed"))
    out = null_safe_left_join(sched, demand_cost, [*PLAN_KEYS, "period"])
    out = null_safe_left_join(out, flat_cost, [*PLAN_KEYS, "month"])
    return out.withColumns(
        {
            "total_flat_demand_cost": F.coalesce("total_flat_demand_cost", F.lit(0.0)),
            "levelized_flat_demand_rate": F.coalesce("levelized_flat_demand_rate", F.lit(0.0)),
        }
    ).withColumn(
        "levelized_total_demand_cost",
        F.try_divide(F.col("total_demand_cost") + F.col("total_flat_demand_cost"), divisor),
    )


# --- J5 -------------------------------------------------------------------
def energy_total(sched: DataFrame, energy_cost: DataFrame) -> DataFrame:
    return null_safe_left_join(sched, energy_cost, [*PLAN_KEYS, "period"])


# --- J6 -------------------------------------------------------------------
UTILITY_RATE_COLUMNS = [
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


def utility_rates(plans: DataFrame, demand_tot: DataFrame, energy_tot: DataFrame) -> DataFrame:
    """Hourly table: demand part left join fixed charges, left join energy part."""
    fixed = plans.select(
        *carried(plans, PLAN_KEYS), F.coalesce("fixedChargeFirstMeter", F.lit(0.0)).alias("fixedChargeFirstMeter")
    )
    demand = demand_tot.select(
        *carried(demand_tot, PLAN_KEYS),
        "week_part",
        "month",
        "hour",
        F.col("period").alias("demand_period"),
        F.col("levelized_total_demand_cost").alias("total_demand_rate"),
    )
    energy = energy_tot.select(
        *carried(energy_tot, PLAN_KEYS),
        "week_part",
        "multi_unit",
        "month",
        "hour",
        F.col("period").alias("energy_period"),
        F.col("levelized_rate").alias("total_energy_rate"),
    )
    charged = null_safe_left_join(demand, fixed, PLAN_KEYS)
    # the hours are hash keys beside the name, in whose buckets they lie: no hourly row is shuffled
    hours = ["week_part", "month", "hour"]
    return null_safe_left_join(charged, energy, [*PLAN_KEYS, *hours], hashed=hours).select(*UTILITY_RATE_COLUMNS)


def _per_plan(costs: DataFrame, into: str, **fields: str) -> DataFrame:
    """A plan's costs as one array: as many entries as it has distinct periods or months."""
    entry = F.struct(*[F.col(c).alias(f) for f, c in fields.items()])
    return costs.groupBy(*carried(costs, PLAN_KEYS)).agg(F.collect_list(entry).alias(into))


#: What an hour looks up, made once a plan: the periods that have a cost (``*_periods``), their costs
#: in that order, the flat cost of each month, and the longest row of each energy month
#: (``longest``) in any schedule of the plan keys.
LOOKUPS = {
    "demand_periods": "transform(demand_costs, x -> x.period)",
    "demand_by_period": "transform(demand_costs, x -> x.cost)",
    "demand_no_period": "get(filter(demand_costs, x -> x.period IS NULL), 0).cost",
    "flat_by_month": """transform(sequence(1, greatest(array_max(transform(flat_costs, x -> x.month)), 1)), m ->
        get(filter(flat_costs, x -> x.month = m), 0).cost)""",
    "energy_periods": "filter(array_distinct(transform(energy_costs, x -> x.period)), p -> p IS NOT NULL)",
    "energy_by_period": """transform(filter(array_distinct(transform(energy_costs, x -> x.period)), p -> p IS NOT NULL), p ->
        transform(filter(energy_costs, x -> x.period = p), x -> named_struct('p', x.period, 'm', x.multi_unit, 'r', x.rate, 'is', true)))""",
    "energy_no_period": """transform(filter(energy_costs, x -> x.period IS NULL), x ->
        named_struct('p', x.period, 'm', x.multi_unit, 'r', x.rate, 'is', true))""",
    "longest": """transform(array(0, 1), part -> transform(
        sequence(0, coalesce(array_max(transform(flatten(shapes), r -> size(r))), 0)), m ->
          array_max(transform(shapes, s -> get(get(s, part), m)))))""",
}

#: The energy side of an hour: an entry for each energy cost at the same place of this
#: row's schedule, else one without a cost.  A place that no schedule of the plan keys
#: has gives one empty entry, with the first of their rows.
ENERGY_ENTRIES = """
CASE WHEN coalesce(size(get(get(weeks, part), month - 1)) >= hour, false) THEN
  coalesce(
    CASE WHEN energy_period IS NULL THEN IF(size(energy_no_period) > 0, energy_no_period, NULL)
      ELSE get(energy_by_period, CAST(array_position(energy_periods, energy_period) - 1 AS INT)) END,
    array(named_struct('p', energy_period, 'm', CAST(NULL AS BOOLEAN), 'r', CAST(NULL AS DOUBLE), 'is', true)))
WHEN first_row AND NOT coalesce(get(get(longest, part), month - 1) >= hour, false) THEN
  array(named_struct('p', CAST(NULL AS INT), 'm', CAST(NULL AS BOOLEAN), 'r', CAST(NULL AS DOUBLE), 'is', true)) END
"""

TOTAL_DEMAND = """
try_divide(
  IF(demand_period IS NULL, demand_no_period,
     get(demand_by_period, CAST(array_position(demand_periods, demand_period) - 1 AS INT)))
    + coalesce(get(flat_by_month, month - 1), 0D), {peak}D)
"""


def utility_rates_by_position(
    plans: DataFrame,
    demand_cost: DataFrame,
    flat_cost: DataFrame,
    energy_cost: DataFrame,
    peak_kw: float = PEAK_DEMAND_KW,
) -> DataFrame:
    """J4, J5 and J6 in the plan's row: the rows of ``utility_rates``, exploded last.

    The costs of a plan meet its schedules as short arrays, and the energy
    schedule is read at each demand cell's position, so the joins are at plan
    grain.  On plans dealt by name they need no shuffle.  Plan rows with equal
    keys meet as the joins would have them: demand rows x fixed charges x energy rows.
    """
    keys = carried(plans, PLAN_KEYS)
    demand = plans.select(*keys, week_cells("demandWeekdaySched", "demandWeekendSched").alias("demand_cells"))
    fixed = plans.select(*keys, F.coalesce("fixedChargeFirstMeter", F.lit(0.0)).alias("fixedChargeFirstMeter"))
    # a matrix with a NULL row has no cells, as in the exploded schedule
    whole = [F.when(~F.exists(c, lambda r: r.isNull()), F.col(c)) for c in ("energyWeekdaySched", "energyWeekendSched")]
    weeks = plans.select(*keys, F.array(*whole).alias("weeks"))
    shape = F.transform("weeks", lambda m: F.transform(m, lambda r: F.size(r)))
    plan = Window.partitionBy(*keys)
    energy = weeks.withColumns(
        {
            "shapes": F.collect_set(shape).over(plan),
            "first_row": F.row_number().over(plan.orderBy(F.lit(1))) == 1,
        }
    )
    out = null_safe_left_join(demand, _per_plan(demand_cost, "demand_costs", period="period", cost="total_demand_cost"), PLAN_KEYS)
    out = null_safe_left_join(out, _per_plan(flat_cost, "flat_costs", month="month", cost="total_flat_demand_cost"), PLAN_KEYS)
    out = null_safe_left_join(out, fixed, PLAN_KEYS)
    per_energy = _per_plan(energy_cost, "energy_costs", period="period", multi_unit="multi_unit", rate="levelized_rate")
    energy = null_safe_left_join(energy, per_energy, PLAN_KEYS)
    none = F.expr("slice(array(named_struct('period', 0, 'multi_unit', false, 'rate', 0D)), 1, 0)")
    out = null_safe_left_join(out, energy.withColumn("energy_costs", F.coalesce("energy_costs", none)), PLAN_KEYS)
    carry = [*PLAN_KEYS, "fixedChargeFirstMeter", "weeks", "first_row", *LOOKUPS]
    looked_up = out.withColumns({name: F.expr(sql) for name, sql in LOOKUPS.items()})
    # inline_outer: no filter on the size of the cells is inferred, which would compute them twice
    cells = looked_up.select(*carry, F.inline_outer("demand_cells")).where(F.col("month").isNotNull())
    cells = cells.withColumnRenamed("period", "demand_period").withColumn("part", F.expr(f"IF(week_part = '{WEEKDAY}', 0, 1)"))
    placed = cells.withColumn("energy_period", F.expr("get(get(get(weeks, part), month - 1), hour - 1) + 1"))
    hours = [*PLAN_KEYS, "fixedChargeFirstMeter", "week_part", "month", "hour", "demand_period"]
    entries = placed.select(
        *hours, F.expr(TOTAL_DEMAND.format(peak=float(peak_kw))).alias("total_demand_rate"), F.expr(ENERGY_ENTRIES).alias("entries")
    )
    hourly = entries.select(*hours, "total_demand_rate", F.inline_outer("entries")).where(F.col("is"))
    renamed = hourly.withColumnsRenamed({"m": "multi_unit", "p": "energy_period", "r": "total_energy_rate"})
    return renamed.select(*UTILITY_RATE_COLUMNS)
