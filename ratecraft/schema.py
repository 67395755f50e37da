"""Explicit read schema of a rate-plan record.

Only the consumed fields are declared; JSON fields that are absent read as
NULL, which replaces every "add the column if it is missing" guard of a
schema-inferring reader.  Dates are kept as raw JSON text because their
shape varies (scalar, list, empty list, missing); see
``functions.columns.first_date``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TIER = StructType(
    [
        StructField("rate", DoubleType()),
        StructField("adj", DoubleType()),
        StructField("max", DoubleType()),
    ]
)

ENERGY_TIER = StructType(
    TIER.fields
    + [
        StructField("unit", StringType()),
        StructField("sell", DoubleType()),
    ]
)


def _periods(tier_field: str, tier_type: StructType) -> ArrayType:
    return ArrayType(StructType([StructField(tier_field, ArrayType(tier_type))]))


SCHEDULE = ArrayType(ArrayType(IntegerType()))

PLAN_SCHEMA = StructType(
    [
        StructField("label", StringType()),
        StructField("eiaId", LongType()),
        StructField("utilityName", StringType()),
        StructField("rateName", StringType()),
        StructField("sector", StringType()),
        StructField("revisions", ArrayType(StructType([StructField("date", StringType())]))),
        StructField("effectiveDate", StringType()),
        StructField("endDate", StringType()),
        StructField("demandMin", DoubleType()),
        StructField("demandMax", DoubleType()),
        StructField("energyMin", DoubleType()),
        StructField("energyMax", DoubleType()),
        StructField("fixedChargeFirstMeter", DoubleType()),
        StructField("fixedChargeUnits", StringType()),
        StructField("flatDemandUnits", StringType()),
        StructField("demandRateUnits", StringType()),
        StructField("demandUnits", StringType()),
        StructField("flatDemandMonths", ArrayType(IntegerType())),
        StructField("flatDemandStrux", _periods("flatDemandTiers", TIER)),
        StructField("demandRateStrux", _periods("demandRateTiers", TIER)),
        StructField("energyRateStrux", _periods("energyRateTiers", ENERGY_TIER)),
        StructField("demandWeekdaySched", SCHEDULE),
        StructField("demandWeekendSched", SCHEDULE),
        StructField("energyWeekdaySched", SCHEDULE),
        StructField("energyWeekendSched", SCHEDULE),
    ]
)

# Plan identity used by joins, group-wise filters and counts.
PLAN_KEYS = ["eiaId", "rateName", "utilityName"]
PLAN_KEYS_SECTOR = ["eiaId", "rateName", "utilityName", "sector"]
COUNT_KEYS = ["eiaId", "utilityName", "rateName"]
NAME_KEYS = ["utilityName", "rateName"]

SCHEDULE_COLUMNS = [
    "demandWeekdaySched",
    "demandWeekendSched",
    "energyWeekdaySched",
    "energyWeekendSched",
]

# Columns of the cleaned plan table, in output order.
CLEAN_COLUMNS = [
    "eiaId",
    "revision_date",
    "revision_year",
    "effectiveDate",
    "effectiveDate_year",
    "effectiveDate_month",
    "endDate",
    "endDate_year",
    "endDate_month",
    "utilityName",
    "rateName",
    "sector",
    "demandMin",
    "demandMax",
    "fixedChargeFirstMeter",
    "fixedChargeUnits",
    "flatDemandMonths",
    "flatDemandStrux",
    "flatDemandUnits",
    "demandRateStrux",
    "demandRateUnits",
    "demandWeekdaySched",
    "demandWeekendSched",
    "demandUnits",
    "energyMin",
    "energyMax",
    "energyRateStrux",
    "energyWeekdaySched",
    "energyWeekendSched",
]
