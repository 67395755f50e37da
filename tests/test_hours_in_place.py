"""Hourly rows are joined, nested and written where they lie: none is shuffled, sorted by text or computed twice."""

from pyspark.sql import functions as F

from ratecraft.functions.columns import NAME_KEY, null_safe_left_join
from ratecraft.operators import combine, reshape
from ratecraft.plans import catalog, end_to_end, relational
from ratecraft.session import co_partitioned
from ratecraft.sources import publish
from tests.test_label_join import executed
from tests.test_customer_join import write_tables
from tests.test_pipeline import F1, _variant
from tests.test_shared_names import _all_versions, _same

KW = [{"energyRateTiers": [{"rate": 0.1, "unit": "kWh"}, {"rate": 0.2, "unit": "kWh/kW"}]}]
SHARED = [
    F1,
    _variant(label="a", rateName="A", eiaId=None),
    _variant(label="b", rateName="A", eiaId=None, energyRateStrux=KW),
    _variant(label="c", rateName="A", eiaId=2, energyWeekdaySched=[[7] * 24] * 12),
    _variant(label="n", rateName=None),
]


def test_a_document_computes_its_plans_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(name):
        seen.add(1)
        return name

    plans = _all_versions(spark, [_variant(label=f"r{k}", rateName=f"R{k}") for k in range(6)])
    rows = end_to_end.rate_json_rows(plans).checkpoint().repartition(3)
    n = rows.count()
    assert n
    marked = rows.withColumn("name", F.udf(counted, "string").asNondeterministic()("name"))
    publish.write_rates_document(marked, str(tmp_path / "document"))
    assert seen.value == n


def test_the_flag_is_joined_with_the_tiers(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    assert executed(catalog.q_multi_unit(spark, str(tmp_path))).count("SortMergeJoin [name_key") == 2
    plans = relational.co_located(_all_versions(spark, SHARED))
    for p in (plans, plans.drop(NAME_KEY)):
        sched, strux = reshape.energy_schedule(p), reshape.energy_structure(p)
        combo = combine.energy_combo(sched, strux)
        want = null_safe_left_join(combo, combine.multi_unit_flags(combo), combine.PLAN_KEYS_SECTOR)
        got = combine.energy_combo_with_flag(sched, strux)
        assert got.columns == want.columns and _same(got, want)


def test_names_of_one_hash_are_told_apart(spark):
    plans = relational.co_located(_all_versions(spark, SHARED))
    assert dict(plans.dtypes)[NAME_KEY] == "bigint"
    one = plans.withColumn(NAME_KEY, F.lit(1).cast("long"))
    assert _same(relational.utility_rates(one), relational.utility_rates(plans))
    assert _same(relational.utility_rates_joined(one), relational.utility_rates_joined(plans))


def test_hours_nest_by_bitmaps(spark):
    row = "eiaId long, rateName string, utilityName string, fixedChargeFirstMeter double, week_part string, month int, hour int, "
    row += "total_demand_rate double, total_energy_rate double"
    rows = [(1, "A", "U", 5.0, w, m, h, m / 8, h / 8) for w in ("Weekday", "Weekend") for m in range(1, 13) for h in range(1, 25)]
    rows += rows[:30]  # copies
    rows += [(1, "A", "U", 5.0, "Weekend", 12, 24, 0.5, 9.0), (1, "A", "U", 5.0, "Weekend", 12, 23, 9.0, 0.5)]
    rows += [(1, "A", "U", 5.0, "Weekday", 1, 1, None, 4.0), (1, "A", "U", 5.0, "Weekday", 13, 1, 7.0, 7.0)]
    rows += [(None, None, "U", None, "Weekday", 3, 4, -1.0, None)]
    nested = publish.nested_rates(spark.createDataFrame(rows, row).repartition(3))
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("partial_bit_or") == 9
    back = {r["name"]: r for r in nested.collect()}
    assert len(back) == 2
    want = {}
    for r in rows:
        if r[5] <= 12:
            nulls_first = [(v is not None, v or 0.0) for v in r[7:]]
            slot = (r[1], r[4], r[5], r[6])
            want[slot] = min(want.get(slot, nulls_first), nulls_first)
    for name, r in back.items():
        for w, d, e in (("Weekday", r[4], r[6]), ("Weekend", r[5], r[7])):
            assert [len(x) for x in (*d, *e)] == [24] * 24
            for m in range(12):
                for h in range(24):
                    pair = want.get((name, w, m + 1, h + 1), [(False, 0.0)] * 2)
                    assert [d[m][h], e[m][h]] == [v for _, v in pair]


def test_hours_are_joined_in_the_buckets_of_the_name(spark):
    plans = relational.co_located(_all_versions(spark, SHARED))
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    c = relational.costs(plans)
    demand = combine.demand_total(c["schedules"]["demand"], c["demand"], c["flat"])
    energy = combine.energy_total(c["schedules"]["energy"], c["energy"])
    with co_partitioned(spark):
        assert "Exchange" not in executed(combine.utility_rates(plans, demand, energy))
    relational.utility_rates_joined(plans)
    assert spark.conf.get(name) == before


def test_an_hour_by_position_runs_no_lambda(spark):
    plans = relational.co_located(_all_versions(spark, SHARED))
    hours = executed(relational.utility_rates(plans)).split("Generate inline(demand_cells")
    assert len(hours) == 2 and "lambda" not in hours[0]
