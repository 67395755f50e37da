"""Invariants of the plan records derived from the driver tables."""

from pyspark.sql import functions as F

from ratecraft.schema import PLAN_SCHEMA
from ratecraft.sources import tpch

SF = "/root/testdata/sf0.001"


def test_one_record_per_order_with_plan_schema(spark):
    recs = tpch.plan_records(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert [f.name for f in recs.schema.fields] == [f.name for f in PLAN_SCHEMA.fields]
    assert recs.count() == orders.count()
    assert recs.select("label").distinct().count() == orders.count()


def test_schedule_and_structure_shapes(spark):
    recs = tpch.plan_records(spark, SF)
    shapes = recs.agg(
        F.max(F.size("energyWeekendSched")).alias("rows"),
        F.max(F.expr("aggregate(energyWeekendSched, 0, (a, r) -> greatest(a, size(r)))")).alias("cols"),
        F.max(F.size("energyRateStrux")).alias("max_periods"),
        F.count(F.when(F.col("energyRateStrux").isNull(), 1)).alias("no_structure"),
        F.count(F.when(F.size("flatDemandMonths") == 12, 1)).alias("full_months"),
        F.count(F.when(F.col("sector") == "Commercial", 1)).alias("commercial"),
    ).collect()[0]
    assert shapes["rows"] == 12 and shapes["cols"] == 24
    assert shapes["max_periods"] == 2
    assert shapes["full_months"] > 0 and shapes["commercial"] > 0
