"""Step-by-step (relational) rates pipeline built from the public operators.

Mirrors the reference's target graph, with one deliberate re-ordering:
the levelizers only need the *distinct* (plan, period) pairs of a
schedule, so the tier joins run on those (at most a few rows per plan)
instead of on the 576-row hourly schedule ("late fan-out"), and the
periods are found inside the plan's row.  The per-period costs meet the
schedules by position in that row, and the hours are exploded last.  The plans
are landed and dealt by name once, and the chain keeps that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..constants import MONTHLY_USAGE_KWH, PEAK_DEMAND_KW
from ..functions.columns import NAME_KEY, name_key
from ..operators import combine, quality, reshape, waterfall
from ..session import co_partitioned, dealt_by, landed


@dataclass(frozen=True)
class Load:
    """Customer load used by every levelizer (one object, so the peak used
    for allocation and for the final division can never disagree)."""

    monthly_kwh: float = MONTHLY_USAGE_KWH
    peak_kw: float = PEAK_DEMAND_KW


def co_located(plans: DataFrame) -> DataFrame:
    """The plans landed once, in buckets of the plan name.

    Every table of the chain comes from this one and carries the name key, so
    its windows, aggregates and joins keep the partitioning, the hourly compile
    by position (J6) too.  After K1 a name is one plan, so no task
    gets more than its share.
    """
    if NAME_KEY in plans.columns:
        return plans
    return dealt_by(plans.withColumn(NAME_KEY, name_key()), NAME_KEY, "plans_by_name")


def schedules(plans: DataFrame) -> dict[str, DataFrame]:
    return {
        "demand": reshape.demand_schedule(plans),
        "energy": reshape.energy_schedule(plans),
        "flat": reshape.flat_schedule(plans),
    }


def structures(plans: DataFrame) -> dict[str, DataFrame]:
    return {
        "demand": reshape.demand_structure(plans),
        "energy": reshape.energy_structure(plans),
        "flat": reshape.flat_structure(plans),
    }


def costs(plans: DataFrame, load: Load = Load()) -> dict[str, DataFrame]:
    plans = co_located(plans)
    sch = schedules(plans)
    st = structures(plans)
    d_combo = combine.demand_combo(reshape.demand_periods(plans), st["demand"])
    f_combo = combine.flat_combo(sch["flat"], st["flat"])
    e_combo = combine.with_multi_unit(combine.energy_combo(reshape.energy_periods(plans), st["energy"]))
    return {
        "schedules": sch,
        "demand": waterfall.levelized_demand(d_combo, load.peak_kw),
        "flat": waterfall.levelized_flat_demand(f_combo, load.peak_kw),
        "energy": waterfall.levelized_energy(e_combo, load.monthly_kwh, load.peak_kw),
    }


def utility_rates(plans: DataFrame, load: Load = Load()) -> DataFrame:
    """The hourly table compiled at plan grain, without a shuffle once the plans are dealt."""
    plans = co_located(plans)
    c = costs(plans, load)
    return combine.utility_rates_by_position(plans, c["demand"], c["flat"], c["energy"], load.peak_kw)


def utility_rates_joined(plans: DataFrame, load: Load = Load()) -> DataFrame:
    """The same rows by the reference's joins, hour by hour (J4, J5, J6), which run here, in the buckets of the name."""
    plans = co_located(plans)
    c = costs(plans, load)
    d_total = combine.demand_total(c["schedules"]["demand"], c["demand"], c["flat"], load.peak_kw)
    e_total = combine.energy_total(c["schedules"]["energy"], c["energy"])
    with co_partitioned(plans.sparkSession):
        return landed(combine.utility_rates(plans, d_total, e_total))


def published(rates: DataFrame, drop_negative: bool = False) -> DataFrame:
    """P13 -> P12 -> W4 -> P14 (-> W5), the reference's filter order."""
    out = (
        rates.transform(quality.drop_irrelevant)
        .transform(quality.drop_high_fixed)
        .transform(quality.drop_high_energy)
        .transform(quality.drop_multi_unit)
    )
    return out.transform(quality.drop_negative) if drop_negative else out
