"""End-to-end behaviour on hand-written plan records and on the driver tables."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import clean, validate
from ratecraft.plans import end_to_end, nested, relational
from ratecraft.sources import publish, tpch

SF = "/root/testdata/sf0.001"


def _matrix(fn):
    return [[fn(m, h) for h in range(24)] for m in range(12)]


F1 = {
    "label": "f1",
    "eiaId": 101,
    "utilityName": "North Power",
    "rateName": "GS-1",
    "sector": "Commercial",
    "revisions": [{"date": "2023-05-01T00:00:00Z"}, {"date": "2024-02-01T00:00:00Z"}],
    "effectiveDate": {"$date": "2024-01-01T00:00:00Z"},
    "endDate": None,
    "fixedChargeFirstMeter": 10.0,
    "fixedChargeUnits": "$/day",
    "demandRateUnits": "kW",
    "flatDemandUnits": "kW",
    "flatDemandMonths": [0, 0, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0],
    "flatDemandStrux": [{"flatDemandTiers": [{"rate": 2.0}]}, {"flatDemandTiers": [{"rate": 3.0, "adj": 0.5}]}],
    "demandRateStrux": [{"demandRateTiers": [{"rate": 10.0, "max": 100.0}, {"rate": 20.0}]}],
    "energyRateStrux": [
        {"energyRateTiers": [{"rate": 0.10, "max": 100, "unit": "kWh"}, {"rate": 0.20}]},
        {"energyRateTiers": [{"rate": 0.30, "adj": 0.05, "unit": "kWh"}]},
    ],
    "demandWeekdaySched": _matrix(lambda m, h: 0),
    "demandWeekendSched": _matrix(lambda m, h: 0),
    "energyWeekdaySched": _matrix(lambda m, h: 1 if 12 <= h < 18 else 0),
    "energyWeekendSched": _matrix(lambda m, h: 0),
}


def _variant(**kw):
    rec = json.loads(json.dumps(F1))
    rec.update(kw)
    return rec


def _read(spark, recs):
    d = tempfile.mkdtemp(prefix="ratecraft-test-")
    with open(os.path.join(d, "plans.json"), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    return publish.read_plans(spark, d)


def test_f1_golden(spark):
    plans = end_to_end.clean_plans(_read(spark, [F1]))
    p = plans.collect()[0]
    assert p["fixedChargeFirstMeter"] == pytest.approx(304.375)
    assert p["fixedChargeUnits"] == "$/month"
    rows = end_to_end.hourly_rates(plans).collect()
    assert len(rows) == 576
    by = {(r["week_part"], r["month"], r["hour"]): r for r in rows}
    assert by[("Weekday", 1, 1)]["total_energy_rate"] == pytest.approx(0.195)
    assert by[("Weekday", 1, 13)]["total_energy_rate"] == pytest.approx(0.35)
    assert by[("Weekday", 1, 1)]["total_demand_rate"] == pytest.approx(20.0)
    assert by[("Weekend", 6, 5)]["total_demand_rate"] == pytest.approx(21.5)
    assert all(r["multi_unit"] is False for r in rows)
    mats = end_to_end.rate_json_rows(plans).collect()[0]
    assert mats["energyweekdayschedule"][0][12] == pytest.approx(0.35)
    assert len(mats["totaldemandweekendschedule"]) == 12


def test_edge_variants_nested_equals_relational(spark):
    recs = [
        F1,
        _variant(label="f2", rateName="Res", sector="Residential"),
        _variant(label="f3", rateName="NoRev", revisions=[]),
        _variant(label="f4a", rateName="Dup", eiaId=7, revisions=[{"date": "2020-01-01T00:00:00Z"}]),
        _variant(label="f4b", rateName="Dup", eiaId=8, revisions=[{"date": "2021-01-01T00:00:00Z"}]),
        _variant(label="f7", rateName="NullId", eiaId=None),
        _variant(label="f9", rateName="NoSched", demandWeekdaySched=None, demandWeekendSched=None,
                 energyWeekdaySched=None, energyWeekendSched=None),
        _variant(label="f10", rateName="NoEnergy", energyRateStrux=None),
        _variant(label="f11", rateName="NoDemand", demandRateStrux=None, flatDemandStrux=None),
        _variant(label="f12", rateName="NoMonths", flatDemandMonths=None),
        _variant(label="f13", rateName="Unmatched",
                 energyWeekdaySched=_matrix(lambda m, h: 2 if h == 0 else 0)),
        _variant(label="f14", rateName="Mixed", energyRateStrux=[
            {"energyRateTiers": [{"rate": 0.1, "unit": "kWh"}]},
            {"energyRateTiers": [{"rate": 0.2, "unit": "kWh/kW", "max": 2}]}]),
        _variant(label="f15", rateName="Pricey", fixedChargeFirstMeter=10000.0, fixedChargeUnits="$/month"),
        _variant(label="f16", rateName="Space Heating"),
        _variant(label="f18", rateName="Negative", energyWeekdaySched=_matrix(lambda m, h: 0), energyRateStrux=[
            {"energyRateTiers": [{"rate": -0.1, "unit": "kWh"}]}]),
    ]
    plans = end_to_end.clean_plans(_read(spark, recs)).cache()
    names = {r["rateName"] for r in plans.collect()}
    assert "Res" not in names and "NoRev" not in names
    dup = plans.where("rateName = 'Dup'").collect()
    assert len(dup) == 1 and dup[0]["eiaId"] == 8

    a = end_to_end.hourly_rates(plans)
    b = relational.utility_rates(plans)
    r6 = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith("total") else F.col(c) for c in df.columns])
    assert r6(a).exceptAll(r6(b)).count() == 0
    assert r6(b).exceptAll(r6(a)).count() == 0

    flags = {r["rateName"]: r["multi_unit"] for r in a.select("rateName", "multi_unit").distinct().collect()}
    assert flags["Unmatched"] is True and flags["Mixed"] is True and flags["NoEnergy"] is False

    pub = {r["rateName"] for r in end_to_end.published_rates(plans).select("rateName").distinct().collect()}
    pub_rel = {r["rateName"] for r in relational.published(b).select("rateName").distinct().collect()}
    assert pub == pub_rel
    assert {"Unmatched", "Mixed", "Pricey", "Space Heating"}.isdisjoint(pub)
    assert "Negative" in pub
    validated = end_to_end.published_rates(plans, drop_negative=True)
    assert "Negative" not in {r["rateName"] for r in validated.select("rateName").distinct().collect()}


def test_dates_tolerant(spark):
    df = spark.createDataFrame(
        [('{"$date": "2024-01-01T00:00:00Z"}',), ('{"$date": ["2024-01-01T00:00:00Z"]}',), ('{"$date": []}',),
         (None,), ('{"$date": "2024-01-01T00:00:00.000Z"}',)],
        "effectiveDate string",
    ).withColumn("endDate", F.lit(None).cast("string"))
    got = [r["effectiveDate"] for r in clean.parse_dates(df).collect()]
    assert [g is not None for g in got] == [True, True, False, False, False]


def test_required_columns_guard(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError, match="which the input lacks"):
        clean.plans_in_effect(df)


def test_latest_revision_is_order_independent(spark):
    recs = tpch.plan_records(spark, SF)
    a = clean.latest_revision(recs.transform(clean.sector_filter)).select("label")
    b = clean.latest_revision(recs.transform(clean.sector_filter).repartition(7).orderBy(F.rand(3))).select("label")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_validation_gate_raises_on_duplicates(spark):
    plans = end_to_end.clean_plans(_read(spark, [F1]))
    out = end_to_end.published_rates(plans)
    report = validate.validation_report(plans, out.unionByName(out.limit(1)))
    with pytest.raises(validate.ValidationError):
        validate.enforce(report)
    ok = validate.enforce(validate.validation_report(plans, out))
    assert [r["n_failed"] for r in ok] == [0] * 7


def test_driver_tables_nested_equals_relational(spark):
    plans = end_to_end.clean_plans(tpch.plan_records(spark, SF)).cache()
    a = end_to_end.hourly_rates(plans)
    b = relational.utility_rates(plans)
    r6 = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith("total") else F.col(c) for c in df.columns])
    assert a.count() == b.count() == 576 * plans.count()
    assert r6(a).exceptAll(r6(b)).count() == 0


def test_nested_path_has_no_shuffle(spark, tmp_path):
    """After the plans are landed, hourly rates, filters and matrices are narrow."""
    path = str(tmp_path / "plans")
    end_to_end.clean_plans(tpch.plan_records(spark, SF)).write.parquet(path)
    plans = spark.read.parquet(path)
    for df in (end_to_end.hourly_rates(plans), end_to_end.published_rates(plans), end_to_end.rate_json_rows(plans)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_matrices_round_trip(spark):
    plans = end_to_end.clean_plans(tpch.plan_records(spark, SF))
    pub = end_to_end.published_rates(plans)
    back = publish.matrices_to_long(publish.nested_rates(pub))
    cols = ["eiaid", "week_part", "month", "hour", "total_demand_rate", "total_energy_rate"]
    src = pub.select(
        F.col("eiaId").alias("eiaid"), "week_part", "month", "hour",
        F.coalesce("total_demand_rate", F.lit(0.0)).alias("total_demand_rate"),
        F.coalesce("total_energy_rate", F.lit(0.0)).alias("total_energy_rate"),
    )
    assert back.select(*cols).exceptAll(src).count() == 0
    nested_rows = publish.matrices_to_long(end_to_end.rate_json_rows(plans))
    assert nested_rows.exceptAll(back).count() == 0


def test_cell_validation_equals_long_validation(spark):
    plans = end_to_end.clean_plans(_read(spark, [F1, _variant(label="g", rateName="Second")]))
    cells = nested.kept_plans(end_to_end.published_cells(plans)).cache()
    dup_cells = cells.unionByName(cells.where("rateName = 'GS-1'"))
    long = nested.explode_cells(dup_cells)
    a = sorted(tuple(r) for r in validate.validation_report(plans, long).collect())
    b = sorted(tuple(r) for r in validate.validation_report_cells(plans, dup_cells).collect())
    assert a == b
    assert dict((r[0], r[4]) for r in a)[3] == 2 * 576


def test_json_array_document_scan(spark, tmp_path):
    """One JSON array document (the reference's input shape) with multiLine."""
    doc = tmp_path / "plans.json"
    doc.write_text(json.dumps([F1, _variant(label="b", rateName="Other")], indent=2))
    recs = publish.read_plans(spark, str(doc), multi_line=True)
    assert sorted(r["rateName"] for r in recs.collect()) == ["GS-1", "Other"]
    landed = publish.land_plans(recs, str(tmp_path / "landed"))
    assert spark.read.parquet(landed).count() == 2


def test_grid_matrix_positional_and_ragged(spark):
    full = [(m * 100 + h, float(m * 100 + h)) for m in range(1, 13) for h in range(1, 25)]
    ragged = [c for c in full if c[0] != 507] + [(1301, 9.0)]  # one cell missing, one off-grid
    df = spark.createDataFrame([(full,), (ragged,)], "cells array<struct<k:int, x:double>>").select(
        F.expr("transform(cells, c -> named_struct('k', c.k, 'v', named_struct('x', c.x)))").alias("cells")
    )
    got = df.select(F.expr(publish.grid_matrix_sql("cells", "x")).alias("m")).collect()
    a, b = got[0]["m"], got[1]["m"]
    assert a[4][6] == 507.0 and a[11][23] == 1224.0
    assert b[4][6] == 0.0 and b[0][0] == 101.0 and b[11][23] == 1224.0


def test_clean_plans_without_labels_matches_stepwise(spark):
    """K1/K2 in clean_plans (light pass for the group maximum) equal the
    step-by-step operators, also when record ids are missing."""
    recs = [
        _variant(label=None, rateName="Tie", eiaId=5),
        _variant(label=None, rateName="Tie", eiaId=6),
        _variant(label=None, rateName="Old", revisions=[{"date": "2019-01-01T00:00:00Z"}]),
        F1,
    ]
    df = _read(spark, recs)
    a = end_to_end.clean_plans(df).select("eiaId", "rateName", "revision_year")
    b = (
        df.transform(clean.sector_filter).transform(clean.parse_dates).transform(clean.latest_revision)
        .transform(clean.date_parts).transform(clean.plans_in_effect)
        .select("eiaId", "rateName", "revision_year")
    )
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.where("rateName = 'Tie'").count() == 1


def test_run_job_writes_all_outputs(spark, tmp_path):
    from ratecraft.plans.end_to_end import run_job

    recs = tpch.plan_records(spark, SF)
    paths = run_job(recs, str(tmp_path / "out"))  # the gate passes on this data
    rates = spark.read.parquet(paths["rates"])
    expected = end_to_end.published_rates(end_to_end.clean_plans(recs))
    assert rates.count() == expected.count() > 0
    assert spark.read.json(paths["json"]).count() == rates.select("eiaId", "rateName", "utilityName").distinct().count()
    report = {r["step"]: r["n_failed"] for r in spark.read.json(paths["report"]).collect()}
    assert set(report) == set(range(1, 8)) and report[3] == 0
