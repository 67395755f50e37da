"""The report of the long table at plan grain (V3 by bitmaps), and the published plans as one JSON array."""

import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import validate
from ratecraft.plans import end_to_end
from ratecraft.schema import COUNT_KEYS
from ratecraft.sources import publish, tpch

SF = "/root/testdata/sf0.001"
HOURLY = (
    "eiaId long, utilityName string, rateName string, week_part string, month int, hour int, "
    "fixedChargeFirstMeter double, total_energy_rate double, total_demand_rate double"
)


def report(df):
    return sorted(tuple(r) for r in df.collect())


def grid(eia, utility, name, part="Weekday"):
    return [(eia, utility, name, part, m, h, 5.0, 0.1, 1.0) for m in range(1, 13) for h in range(1, 25)]


def both_ways(spark, rows, **limits):
    out = spark.createDataFrame(rows, HOURLY)
    plans = out.select(*COUNT_KEYS).distinct()
    slots = report(validate.validation_report_slots(plans, out, **limits))
    assert slots == report(validate.validation_report(plans, out, **limits))
    return {r[1]: r[4] for r in slots}


def test_slots_on_copies_nulls_and_rows_off_the_grid(spark):
    rows = grid(1, "u", "a") + grid(1, "u", "a", "Weekend") + grid(None, None, None) + grid(2, "u", "Irrigation pump")
    assert both_ways(spark, rows)["rows_distinct"] == 0
    odd = [(1, "u", "b", "Holiday", 1, 1), (1, "u", "b", None, None, 1), (1, "u", "b", "Weekday", 13, 0), (1, "u", "b", "Weekday", 1, 25)]
    rows += [(*o, None, None, None) for o in odd]
    assert both_ways(spark, rows)["rows_distinct"] == 0  # off the grid, but each once
    rows += [(*odd[0], 1.0, 1.0, 1.0), *grid(None, None, None)[:7], *2 * grid(1, "u", "a")[:1]]
    failed = both_ways(spark, rows, fixed_limit=4.0, energy_limit=0.05)
    assert failed["rows_distinct"] == 2 + 14 + 3 and failed["no_excluded_plan_names"] == 288 + 288 + 7
    assert both_ways(spark, [])["rows_distinct"] == 0


def test_slots_on_random_rows(spark):
    rng = random.Random(5)
    pick = lambda *v: rng.choice(v)
    rows = [
        (pick(1, 2, None), pick("u", None), pick("a", "b", "Heating", None), pick("Weekday", "Weekend", None), rng.randint(0, 13),
         pick(1, 24, 25, None), pick(1.0, 2e4, None), pick(-1.0, 0.1, 200.0, None), pick(-1.0, 2.0, None))
        for _ in range(1500)
    ]
    both_ways(spark, rows)
    both_ways(spark, list(dict((r[:6], r) for r in rows).values()))


def test_copies_are_counted_as_a_loop_counts_them(spark):
    rng = random.Random(8)
    rows = []
    for name, times in (("once", (1,)), ("twice", (1, 2)), ("thrice", (1, 2, 3)), ("four", (1, 4)), (None, (1, 2))):
        for g in grid(1, "u", name):
            rows += [g] * rng.choice(times)
    rows += [(1, "u", "twice", "Holiday", 1, 1, 5.0, 0.1, 1.0)] * 2
    seen = Counter(r[:6] for r in rows)
    assert both_ways(spark, rows)["rows_distinct"] == sum(n for n in seen.values() if n > 1)
    out = spark.createDataFrame([r for r in rows if r[2] in ("once", None)], HOURLY)
    # copies of two rows are counted by the bitmaps, so no plan is left to be grouped hour by hour
    per_plan = validate.plan_slots(out)
    assert per_plan.where("off_grid > 0 OR n <> odd + 2 * (slots - odd)").count() == 0
    plan = validate.validation_report(out.select(*COUNT_KEYS).distinct(), out)._jdf.queryExecution().sparkPlan().toString()
    assert "bit_count" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_slots_shuffle_plans_not_hours(spark, tmp_path):
    plans = spark.read.parquet(publish.land_plans(end_to_end.clean_plans(tpch.plan_records(spark, SF)), str(tmp_path / "plans")))
    rates = spark.read.parquet(publish.land_plans(end_to_end.published_rates(plans), str(tmp_path / "rates")))
    per_plan = validate.plan_slots(rates)._jdf.queryExecution().sparkPlan().toString()
    exchanges = [x for x in per_plan.splitlines() if "HashAggregate" in x]
    assert len(exchanges) == 2 and "partial_bit_or" in exchanges[1] and "ObjectHashAggregate" not in per_plan
    assert all(f"month#{i}" not in x.split("functions=")[0] for x in exchanges for i in range(10))
    # no plan is suspect, so the list is sent to the hourly rows and these are not shuffled to be joined
    plan = validate.validation_report_slots(plans, rates)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert report(validate.validation_report_slots(plans, rates)) == report(validate.validation_report(plans, rates))


def test_one_document(spark, tmp_path):
    rows = end_to_end.rate_json_rows(end_to_end.clean_plans(tpch.plan_records(spark, SF)))
    odd = rows.limit(2).withColumn("name", F.lit('a "}],\n[{\\   é')).withColumn("eiaid", F.lit(None).cast("long"))
    rows = rows.unionByName(odd).checkpoint()
    path = str(tmp_path / "document")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish.write_rates_document(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-") and os.path.getsize(f"{path}/{f}"))
    assert len(parts) > 3  # written by several tasks, and the closing part
    array = json.loads("".join(open(f"{path}/{p}", encoding="utf-8").read() for p in parts))
    assert len(array) == rows.count()
    keys = [tuple((r.get(c) is not None, r.get(c)) for c in ("utility", "name")) for r in array]
    assert keys == sorted(keys)
    back = publish.read_rates_document(spark, path)
    lines = publish.read_rates_json(spark, publish.write_rates_json(rows, str(tmp_path / "lines")))
    assert back.schema == lines.schema
    assert back.exceptAll(lines).count() == 0 and lines.exceptAll(back).count() == 0


def test_document_of_one_plan_of_none_and_unfinished(spark, tmp_path):
    rows = end_to_end.rate_json_rows(end_to_end.clean_plans(tpch.plan_records(spark, SF))).limit(1).checkpoint()
    path = str(tmp_path / "document")
    for df, n in ((rows, 1), (rows.limit(0), 0), (rows.unionByName(rows), 2)):  # each replaces the one before
        publish.write_rates_document(df, path)
        parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
        assert len(json.loads("".join(open(f"{path}/{p}").read() for p in parts))) == n
        assert publish.read_rates_document(spark, path).count() == n
    os.remove(f"{path}/_DOCUMENT")
    with pytest.raises(FileNotFoundError):
        publish.read_rates_document(spark, path)
