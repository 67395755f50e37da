"""Units filled down in ranges (W3 where plans share a name) against the window over the name."""

import random
import re

from pyspark.sql import functions as F

from ratecraft.operators import reshape

ROWS = "rateName string, utilityName string, eiaId long, sector string, period int, tier int, unit string, extra long"


def structure(spark, n, names, units, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        name, utility = rng.choice(names)
        rows.append((name, utility, i // 7 if i % 5 else None, rng.choice(["r", None]), i % 7, i, rng.choice(units), i))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, ROWS)


def same(df, **kw):
    got = sorted(map(tuple, reshape.fill_units_ranges(df, **kw).collect()), key=str)
    want = sorted(map(tuple, reshape.fill_units(df, **kw).collect()), key=str)
    assert got == want and len(got) == df.count()


def test_a_name_in_many_ranges(spark):
    for units in (["kWh"] + [None] * 400, ["kWh", "kWh daily", None, None], [None]):
        same(structure(spark, 3000, [("hot", "u")], units, 1))


def test_hot_and_small_names_and_null_names(spark):
    names = [("hot", "u")] * 20 + [(f"n{i}", "u") for i in range(30)] + [(None, "u"), ("hot", None), (None, None)]
    same(structure(spark, 2000, names, ["kWh", "kW"] + [None] * 30, 2))
    same(structure(spark, 2000, names, ["a", None], 3), default="none")


def test_ties_empty_tables_and_no_unit(spark):
    tied = spark.createDataFrame([("a", "u", 1, "r", 0, 0, u, 0) for u in (None, "kW", "kWh", None) * 50], ROWS)
    got = reshape.fill_units_ranges(tied, default="-").groupBy("unit").count().collect()
    assert {r["unit"]: r["count"] for r in got} == {"-": 100, "kW": 50, "kWh": 50}
    assert reshape.fill_units_ranges(tied.limit(0)).count() == 0
    assert {r["unit"] for r in reshape.fill_units_ranges(tied.drop("unit"), default="-").collect()} == {"-"}


def test_a_hot_name_is_no_single_task(spark):
    df = structure(spark, 4000, [("hot", "u")], ["kWh"] + [None] * 50, 4)
    parts = reshape._in_ranges(df, ["rateName", "utilityName", "eiaId", "sector", "period", "tier", "unit"], "t")
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2000
    plan = reshape.fill_units_ranges(df)._jdf.queryExecution().optimizedPlan().toString()
    # the rows' window is by range and name; the one by name alone reads a row a range
    windows = [x for x in plan.splitlines() if "Window" in x]
    assert len(windows) == 2 and sum(bool(re.search(r"\], \[_part#\d+, rateName", x)) for x in windows) == 1
    carried = reshape.fill_units_ranges(df.withColumn("x", F.lit(1)))
    assert carried.columns == [*df.columns, "x"]
