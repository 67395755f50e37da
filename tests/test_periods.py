"""Periods found inside the plan's row (A3), and the unit flag by a window in the name buckets."""

from pyspark.sql import functions as F

from ratecraft.functions.columns import NAME_KEY
from ratecraft.operators import combine, reshape

KEYS = "eiaId long, utilityName string, rateName string, sector string"


def test_periods_of_a_row_equal_the_schedule(spark):
    whole, mixed = [[0, 1], [1, 1]], [[0, None], [3]]
    rows = [
        (1, "u", "a", "r", whole, mixed), (1, "u", "a", "r", [[5]], None), (2, None, "b", None, None, None),
        (3, "u", "c", "r", [[1], None], [[2]]), (4, "u", "d", "r", [], [[]]), (5, "u", "e", "r", [[None]], whole),
    ]
    names = ("energyWeekdaySched", "energyWeekendSched", "demandWeekdaySched", "demandWeekendSched")
    df = spark.createDataFrame([(*r, *r[4:]) for r in rows], KEYS + "".join(f", {c} array<array<int>>" for c in names))
    for periods, schedule in ((reshape.energy_periods, reshape.energy_schedule), (reshape.demand_periods, reshape.demand_schedule)):
        got, want = periods(df), schedule(df).select("eiaId", "utilityName", "rateName", "sector", "period").distinct()
        assert got.schema == want.select(got.columns).schema
        assert got.exceptAll(want.select(got.columns)).count() == 0 and want.select(got.columns).exceptAll(got).count() == 0


def test_unit_flag_in_buckets_equals_the_aggregate(spark):
    units = {"a": ["kWh"], "b": ["kWh", "kW"], "c": [None, "kWh"], "d": [None, None], "e": ["kWh", "kWh"], "f": [None, "x", "y"]}
    rows = [(None if n == "e" else 1, "u", n, "r", 1, u) for n, us in units.items() for u in us]
    combo = spark.createDataFrame(rows, KEYS + ", period int, unit string")
    dealt = combine.with_multi_unit(combo.withColumn(NAME_KEY, F.col("rateName")))
    plan = dealt._jdf.queryExecution().sparkPlan().toString()
    assert "Window" in plan and "Join" not in plan
    want = combine.with_multi_unit(combo)
    dealt = dealt.drop(NAME_KEY).select(want.columns)
    assert dealt.exceptAll(want).count() == 0 and want.exceptAll(dealt).count() == 0
    assert {r["rateName"] for r in want.where("multi_unit").collect()} == {"b", "c", "f"}
