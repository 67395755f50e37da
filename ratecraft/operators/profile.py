"""Summary profile and hourly trends of the published table.

All are single hash aggregates with partial (map-side) combining; their
output is bounded by the number of (month, hour, week_part) cells.
``profiles`` gives all of them from one pass over the table, and one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import count_if


def _stats() -> list:
    out = [F.count(F.lit(1)).alias("total_rows")]
    for col, tag in (("total_energy_rate", "energy"), ("total_demand_rate", "demand"), ("fixedChargeFirstMeter", "fixed")):
        c = F.col(col)
        out += [
            F.avg(c).alias(f"avg_{tag}"),
            F.min(c).alias(f"min_{tag}"),
            F.max(c).alias(f"max_{tag}"),
            count_if(c.isNull()).alias(f"na_{tag}"),
        ]
    return out


def rates_profile(df: DataFrame) -> DataFrame:
    """Rows; mean/min/max/missing of energy, demand and fixed charge.

    Demand statistics use ``total_demand_rate`` (the published report
    computed them from the energy column by mistake).
    """
    return df.agg(*_stats())


#: Names of the levels of ``profiles``: the whole table, its hours, the hours of its months.
LEVELS = ("all", "hour", "month_hour")


def profiles(df: DataFrame) -> DataFrame:
    """A6-A10 at once: ``level``, the level's keys (else NULL) and all statistics of ``rates_profile``.

    Grouping sets over (), (hour, week_part) and (month, hour, week_part): each task
    combines its rows to at most 576 + 48 + 1 groups before the one shuffle.
    """
    keys = ["month", "hour", "week_part"]
    sets = [[], [F.col("hour"), F.col("week_part")], [F.col(k) for k in keys]]
    grouped = df.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.grouping_id().alias("gid"), *_stats())
    level = F.when(F.col("gid") == 0, LEVELS[2]).when(F.col("gid") == 4, LEVELS[1]).otherwise(LEVELS[0])
    return grouped.withColumn("level", level).drop("gid")


def level_of(found: DataFrame, level: str, keys: list[str], names: dict[str, str]) -> DataFrame:
    """One level of landed ``profiles``: its keys and the statistics in ``names`` under the names given there."""
    return found.filter(F.col("level") == level).select(*keys, *[F.col(c).alias(n) for c, n in names.items()])


def _trend(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(col).alias(name))


def hourly_energy(df: DataFrame) -> DataFrame:
    return _trend(df, ["hour", "week_part"], "total_energy_rate", "avg_energy_rate")


def monthly_hourly_energy(df: DataFrame) -> DataFrame:
    return _trend(df, ["month", "hour", "week_part"], "total_energy_rate", "avg_energy_rate")


def hourly_demand(df: DataFrame) -> DataFrame:
    return _trend(df, ["hour", "week_part"], "total_demand_rate", "avg_demand_rate")


def monthly_hourly_demand(df: DataFrame) -> DataFrame:
    return _trend(df, ["month", "hour", "week_part"], "total_demand_rate", "avg_demand_rate")
