"""Physical-plan properties that matter at scale."""

from ratecraft.operators import clean, profile, quality, validate
from ratecraft.plans import end_to_end, nested
from ratecraft.sources import tpch

SF = "/root/testdata/sf0.001"


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_revision_limits_rows_before_the_shuffle(spark):
    recs = tpch.plan_records(spark, SF).transform(clean.sector_filter)
    plan = clean.latest_revision(recs)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_cartesian_products(spark):
    recs = tpch.plan_records(spark, SF)
    plans = end_to_end.clean_plans(recs)
    rates = end_to_end.hourly_rates(plans)
    cells = nested.kept_plans(end_to_end.published_cells(plans, drop_negative=True))
    for df in (
        plans,
        quality.filter_funnel(rates),
        quality.filter_funnel_cells(nested.rate_cells(plans)),
        validate.validation_report(plans, rates),
        validate.validation_report_cells(plans, cells),
        quality.drop_negative(rates),
    ):
        text = df._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scan_prunes_columns_and_pushes_filters(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _physical(clean.sector_filter(tpch.plan_records(spark, SF)).select("label"))
    assert "ReadSchema: struct<o_orderkey:bigint" in plan
    assert "l_shipdate" not in plan  # unused lineitem column never read
    assert orders.count() > 0


def test_results_do_not_depend_on_session_settings(spark):
    """Same hourly table with ANSI off, another session time zone and
    another shuffle width (the caller's session may differ from ours)."""
    from ratecraft.plans import catalog

    base = catalog.q_published_rates(spark, SF).collect()
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        other = catalog.q_published_rates(spark, SF).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(map(repr, base)) == sorted(map(repr, other))


def test_relational_chain_shuffles_twice_after_landing(spark):
    """The plans are landed and dealt by name; only the hourly joins (J6) shuffle again, and by position nothing does."""
    from ratecraft.plans import relational

    plans = relational.co_located(end_to_end.clean_table_plans(spark, SF))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        costs = relational.costs(plans)
        for name in ("demand", "flat", "energy"):
            assert _physical(costs[name]).count("Exchange hashpartitioning") <= 2, name
        assert _physical(relational.utility_rates_joined(plans)).count("Exchange hashpartitioning") <= 10
        text = _physical(relational.utility_rates(plans))
        assert "Exchange" not in text and text.count("Generate inline") <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_clean_plans_selects_revisions_on_narrow_rows(spark):
    """K1 has run on flat columns when the plan rows are built: the plan holds no window over nested columns."""
    plans = end_to_end.clean_table_plans(spark, SF)
    text = _physical(plans)
    assert "WindowGroupLimit" not in text and "Window " not in text
    assert text.count("lineitem.parquet") == 1
    records = tpch.plan_records(spark, SF)
    winners = clean.current_plans(records.drop(*[c for c in records.columns if c.endswith(("Strux", "Sched", "Months"))]))
    assert winners.count() == plans.count()


def test_group_filters_judge_names_before_hours(spark):
    """W4 at plan grain: the hourly rows are generated once, above the join that drops names."""
    from ratecraft.session import cut_lineage

    cells = cut_lineage(nested.rate_cells(end_to_end.clean_table_plans(spark, SF)))
    kept = nested.explode_cells(nested.drop_failing_names(cells, "c.total_energy_rate > 0.1"))
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate ") == 1 and text.index("Generate ") < text.index("Join LeftAnti")


def test_profiles_are_one_pass(spark):
    """A6-A10 from one scan and one shuffle, each level equal to its own aggregate."""
    rows = [
        (1 + k % 3, 1 + k % 4, ("Weekday", "Weekend")[k % 2], None if k % 7 == 0 else k / 10, k / 5 if k % 5 else None, float(k % 9))
        for k in range(400)
    ]
    cols = ["month", "hour", "week_part", "total_energy_rate", "total_demand_rate", "fixedChargeFirstMeter"]
    df = spark.createDataFrame(rows, cols)
    found = profile.profiles(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Scan ") == 1
    found = spark.createDataFrame(found.collect(), found.schema)

    def same(got, want):
        near = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
        assert sorted(map(str, map(near, got.collect()))) == sorted(map(str, map(near, want.select(got.columns).collect())))

    stats = [c for c in found.columns if c not in ("level", "month", "hour", "week_part")]
    same(profile.level_of(found, "all", [], {c: c for c in stats}), profile.rates_profile(df))
    energy, demand = {"avg_energy": "avg_energy_rate"}, {"avg_demand": "avg_demand_rate"}
    same(profile.level_of(found, "hour", ["hour", "week_part"], energy), profile.hourly_energy(df))
    same(profile.level_of(found, "hour", ["hour", "week_part"], demand), profile.hourly_demand(df))
    same(profile.level_of(found, "month_hour", ["month", "hour", "week_part"], energy), profile.monthly_hourly_energy(df))
    same(profile.level_of(found, "month_hour", ["month", "hour", "week_part"], demand), profile.monthly_hourly_demand(df))
