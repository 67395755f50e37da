"""Input that skips K1: several plans under one name (T17), and a name that very many plans share."""

import random

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import clean, quality, reshape, waterfall
from ratecraft.plans import end_to_end, nested, relational
from tests.test_pipeline import F1, _matrix, _read, _variant


def _all_versions(spark, records):
    """Cleaned plans of every record: all steps but K1 and K2."""
    dated = _read(spark, records).transform(clean.parse_dates).withColumn("revision_date", clean.newest_revision())
    out = dated.transform(clean.date_parts).transform(clean.fill_bounds).transform(clean.fill_fixed_charge)
    return out.transform(clean.daily_to_monthly).transform(clean.empty_to_null).transform(clean.default_schedule)


NEGATIVE = [{"energyRateTiers": [{"rate": -0.1, "unit": "kWh"}]}]
PRICEY = [{"energyRateTiers": [{"rate": 300.0, "unit": "kWh"}]}]
ZERO = _matrix(lambda m, h: 0)

RECORDS = [
    F1,
    _variant(label="twin", fixedChargeFirstMeter=2.0),
    _variant(label="other id", eiaId=7),
    _variant(label="neg", rateName="N", eiaId=1, energyRateStrux=NEGATIVE, energyWeekdaySched=ZERO),
    _variant(label="neg sibling", rateName="N", eiaId=2),
    _variant(label="pricey", rateName="P", eiaId=1, energyRateStrux=PRICEY, energyWeekdaySched=ZERO),
    _variant(label="pricey sibling", rateName="P", eiaId=2),
    _variant(label="alone", rateName="A"),
]


def _same(a, b):
    r = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith("total") else F.col(c) for c in df.columns])
    return r(a).exceptAll(r(b)).count() == 0 and r(b).exceptAll(r(a)).count() == 0


def test_published_rates_of_any_input(spark):
    plans = _all_versions(spark, RECORDS)
    assert not nested.names_are_unique(plans)
    for drop in (False, True):
        got = end_to_end.any_published_rates(plans, drop_negative=drop)
        assert _same(got, relational.published(relational.utility_rates(plans), drop))
    names = lambda df: {(r["rateName"], r["eiaId"]) for r in df.select("rateName", "eiaId").distinct().collect()}
    kept = names(end_to_end.any_published_rates(plans, drop_negative=True))
    assert kept == {("GS-1", 101), ("GS-1", 7), ("A", 101)}  # N and P go as whole names
    rows = end_to_end.any_published_rates(plans).where("rateName = 'GS-1' and eiaId = 101")
    assert rows.count() == 576 * 2 * 2 * 2  # the joins multiply equal plan keys: schedule x energy x fixed charge
    unique = _all_versions(spark, [F1, _variant(label="z", rateName="Z")])
    assert nested.names_are_unique(unique)
    assert _same(end_to_end.any_published_rates(unique), relational.published(relational.utility_rates(unique)))


def test_run_job_refuses_shared_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(end_to_end, "clean_plans", lambda records: _all_versions(spark, RECORDS))
    with pytest.raises(ValueError, match="share a name"):
        end_to_end.run_job(_read(spark, RECORDS), str(tmp_path / "out"))


def test_names_are_judged_as_a_whole_at_plan_grain(spark):
    cells = nested.rate_cells(_all_versions(spark, RECORDS)).cache()
    long = nested.explode_cells(cells)
    assert _same(nested.explode_cells(nested.drop_failing_names(cells, "c.total_energy_rate > 100")), quality.drop_high_energy(long))
    negative = "c.total_energy_rate < 0 OR c.total_demand_rate < 0"
    assert _same(nested.explode_cells(nested.drop_failing_names(cells, negative)), quality.drop_negative(long))


def _flags(spark, rows):
    return spark.createDataFrame(rows, "eiaId long, utilityName string, rateName string, k1 boolean, k3 boolean, k4 boolean, eb boolean, nb boolean")


def _brute(rows):
    plans = {}
    for *ids, k1, k3, k4, eb, nb in rows:
        p = plans.setdefault(tuple(ids), dict(a1=0, a3=0, a4=0, e=0, n=0))
        p["a1"] |= k1
        p["a3"] |= k1 and k3
        p["a4"] |= k1 and k3 and k4
        p["e"] |= k1 and eb
        p["n"] |= k1 and k3 and k4 and nb
    names = {}
    for (_, u, r), p in plans.items():
        g = names.setdefault((u, r), [0, 0])
        g[0] |= p["e"]
        g[1] |= p["n"]
    left = [len(plans), 0, 0, 0, 0, 0]
    for (_, u, r), p in plans.items():
        e, n = names[(u, r)]
        for i, ok in enumerate((p["a1"], p["a1"] and not e, p["a3"] and not e, p["a4"] and not e, p["a4"] and not e and not n), 1):
            left[i] += bool(ok)
    return [(i, left[i - 1] - left[i], left[i]) for i in range(1, 6)]


def test_funnel_with_one_name_shared_by_very_many_plans(spark):
    rng = random.Random(4)
    flip = lambda p: rng.random() < p
    rows = [(k, "U", "General", flip(0.9), flip(0.9), flip(0.8), False, False) for k in range(20000)]
    rows += [(k, "U", f"R{k % 40}", flip(0.9), flip(0.9), flip(0.8), flip(0.05), flip(0.05)) for k in range(3000)]
    rows += [(None, None, "x", True, True, True, False, False)]
    flagged = _flags(spark, rows)
    got = quality._funnel_from_flags(flagged, quality.COUNT_KEYS)
    assert [(r["step"], r["removed"], r["remaining"]) for r in got.orderBy("step").collect()] == _brute(rows)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    by_id = quality._funnel_from_flags(flagged.where("eiaId is not null"), ["eiaId"]).orderBy("step").collect()
    assert by_id[0]["remaining"] + by_id[0]["removed"] == 20000


def test_legacy_parameters(spark):
    plans = _all_versions(spark, [F1, _variant(label="e", rateName="E", energyRateStrux=None, demandRateStrux=None, flatDemandStrux=None)])
    for make in (reshape.energy_structure, reshape.demand_structure, reshape.flat_structure):
        assert {r["rateName"] for r in make(plans).collect()} == {"GS-1", "E"}
        assert {r["rateName"] for r in make(plans, keep_empty=False).collect()} == {"GS-1"}
    combo = spark.createDataFrame(
        [(1, "p", "u", 1, 1, "kW", 100.0, 10.0), (1, "p", "u", 1, 2, "kW", 300.0, 20.0)],
        "eiaId long, rateName string, utilityName string, period int, tier int, demandRateUnits string, max double, total_rate double",
    )
    peak = waterfall.levelized_demand(combo, 500.0).first()
    billed = waterfall.levelized_demand(combo, 500.0, denominator="billed").first()
    assert (peak["levelized_demand_rate"], billed["levelized_demand_rate"]) == (5000 / 500, 5000 / 300)
    with pytest.raises(ValueError, match="denominator"):
        waterfall.levelized_demand(combo, 500.0, denominator="target")


def test_text_numbers_in_structures(spark):
    df = spark.createDataFrame([("0.5", None, "x")], "rate string, adj string, max string").selectExpr(
        "rate", "adj", "max", "1 as period", "1 as tier"
    )
    row = reshape.reformat_zero_filled(df).first()
    assert (row["rate"], row["adj"], row["max"], row["total_rate"]) == (0.5, 0.0, 0.0, 0.5)


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from ratecraft import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Spark())


def test_scratch_is_released(spark, tmp_path):
    import os

    from ratecraft import session

    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    session.release_scratch(spark)
    assert not os.path.exists(path) and not session._HANDED_OUT
