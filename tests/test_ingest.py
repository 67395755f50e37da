"""S1 and K1 on input as users have it: number spellings, array documents, broken records, date shapes."""

import json

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import clean
from ratecraft.plans import end_to_end
from ratecraft.schema import PLAN_SCHEMA
from ratecraft.sources import plans as source
from ratecraft.sources import publish
from tests.test_pipeline import F1, _matrix, _variant


def _write(path, records, array=False):
    if array:
        path.write_text(json.dumps(records, indent=1))
    else:
        path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
    return str(path)


def test_number_spellings_are_kept(spark, tmp_path):
    odd = _variant(
        label="odd",
        rateName="Odd",
        eiaId="101",
        fixedChargeFirstMeter="10",
        energyWeekdaySched=_matrix(lambda m, h: 1.0 if 12 <= h < 18 else 0.0),
        flatDemandMonths=["0", 0.0, "0.0", 0, 0, 1, "1", 1.0, 1, 0, 0, 0],
        energyRateStrux=[
            {"energyRateTiers": [{"rate": "0.1", "max": "100", "unit": "kWh"}, {"rate": " 2e-1 "}]},
            {"energyRateTiers": [{"rate": "0.30", "adj": "0.05", "unit": "kWh"}]},
        ],
    )
    path = _write(tmp_path / "p.json", [F1, odd])
    a, b = (r.asDict(recursive=True) for r in publish.read_plans(spark, path).orderBy("label").collect())
    assert publish.read_plans(spark, path).schema.simpleString() == PLAN_SCHEMA.simpleString()
    for k in a:
        if k not in ("label", "rateName"):
            assert a[k] == b[k], k
    rates = end_to_end.hourly_rates(end_to_end.clean_plans(publish.read_plans(spark, path)))
    per = {r["rateName"]: (r["n"], r["s"]) for r in rates.groupBy("rateName").agg(
        F.count("total_energy_rate").alias("n"), F.round(F.sum("total_energy_rate"), 9).alias("s")).collect()}
    assert per["Odd"] == per["GS-1"]


def test_blank_and_missing_numbers_are_null(spark, tmp_path):
    path = _write(tmp_path / "p.json", [_variant(demandMin="", demandMax=None, energyMin="  ")])
    row = publish.read_plans(spark, path).first()
    assert (row["demandMin"], row["demandMax"], row["energyMin"]) == (None, None, None)


@pytest.mark.parametrize(
    ("bad", "column"),
    [
        ({"fixedChargeFirstMeter": "ten"}, "fixedChargeFirstMeter in 1"),
        ({"eiaId": 101.5}, "eiaId in 1"),
        ({"energyWeekdaySched": _matrix(lambda m, h: 0.5)}, "energyWeekdaySched in 1"),
        ({"energyRateStrux": [{"energyRateTiers": [{"rate": "n/a"}]}]}, "energyRateStrux in 1"),
    ],
)
def test_unreadable_numbers_raise_with_a_count(spark, tmp_path, bad, column):
    path = _write(tmp_path / "p.json", [F1, _variant(label="x", **bad)])
    with pytest.raises(source.InputError, match="of 2 records.*" + column):
        publish.read_plans(spark, path)
    assert publish.read_plans(spark, path, on_bad="null").count() == 2


def test_broken_records_raise_with_a_count(spark, tmp_path):
    path = _write(tmp_path / "p.json", [F1, '{"label": "cut", "sector": "Comm', "no json", _variant(label="b")])
    with pytest.raises(source.InputError, match="of 4 records, unreadable: malformed in 2"):
        publish.read_plans(spark, path)
    assert publish.read_plans(spark, path, on_bad="null").count() == 2


def test_array_document_is_recognised(spark, tmp_path):
    records = [F1, _variant(label="b", rateName="Other")]
    for name, text in (("pretty", json.dumps(records, indent=2)), ("flat", json.dumps(records)), ("led", "\n\n " + json.dumps(records, indent=1))):
        path = tmp_path / f"{name}.json"
        path.write_text(text)
        assert sorted(r["rateName"] for r in publish.read_plans(spark, str(path)).collect()) == ["GS-1", "Other"]
        assert end_to_end.clean_plans(publish.read_plans(spark, str(path))).count() == 2
    cut = tmp_path / "cut.json"
    cut.write_text(json.dumps(records, indent=2)[:-30])
    with pytest.raises(source.InputError, match="malformed"):
        publish.read_plans(spark, str(cut))
    with pytest.raises(source.InputError, match="malformed"):
        publish.read_plans(spark, str(tmp_path / "pretty.json"), multi_line=False)


def test_revision_dates_in_any_spelling(spark, tmp_path):
    shapes = [
        "2024-02-01T00:00:00Z", "2024-02-01T00:00:00.000Z", "2024-02-01", "2024-02-01 00:00:00", "2024-02-01T00:00:00",
        {"$date": "2024-02-01T00:00:00Z"}, {"$date": "2024-02-01T00:00:00.000Z"}, {"$date": ["2024-02-01T00:00:00Z"]},
        {"$date": 1706745600000}, {"$date": {"$numberLong": "1706745600000"}}, 1706745600000,
    ]
    recs = [_variant(label=f"s{k}", rateName=f"P{k}", revisions=[{"date": d}]) for k, d in enumerate(shapes)]
    recs.append(_variant(label="u", rateName="U", revisions=[{"date": "next spring"}]))
    recs += [_variant(label=f"n{k}", rateName=f"N{k}", revisions=r) for k, r in enumerate([[], None, [{"date": None}], [{"date": ""}]])]
    records = publish.read_plans(spark, _write(tmp_path / "p.json", recs))
    plans = end_to_end.clean_plans(records)
    rows = plans.select("rateName", F.col("revision_date").cast("string").alias("d")).collect()
    assert sorted(r["rateName"] for r in rows) == sorted(f"P{k}" for k in range(len(shapes)))
    assert {r["d"] for r in rows} == {"2024-02-01 00:00:00"}
    report = clean.revision_dates_report(records).first()
    assert (report["records"], report["without_date"], report["unreadable_date"]) == (len(recs), 4, 1)


def test_json_numbers_have_four_decimals(spark, tmp_path):
    plans = end_to_end.clean_plans(publish.read_plans(spark, _write(tmp_path / "p.json", [_variant(fixedChargeFirstMeter=1.11)])))
    out = publish.write_rates_json(end_to_end.rate_json_rows(plans), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert '"fixedchargefirstmeter":33.7856,' in text  # 1.11 * 30.4375 = 33.785625
    assert publish.read_rates_json(spark, out).first()["fixedchargefirstmeter"] == 33.7856


def test_plain_records_are_read_once_and_odd_ones_as_text(spark, tmp_path):
    odd = _variant(label="odd", eiaId="7", demandMin=" 1.5 ", demandMax="NaN", flatDemandMonths=["1", 0.0, 1] + [0] * 9)
    plain = _write(tmp_path / "plain.json", [F1, _variant(label="b", eiaId=None)])
    mixed = _write(tmp_path / "mixed.json", [F1, odd, _variant(label="b", eiaId=None)])
    lists = _write(tmp_path / "lists.json", [F1, [odd, _variant(label="b", eiaId=None)]])

    def was(path):
        """Every record by its text, as before."""
        text = source.scan_text(spark, path, False)
        return text.select(*[source.typed(F.col(f.name), f.dataType).alias(f.name) for f in PLAN_SCHEMA.fields])

    rows = lambda df: sorted(map(str, df.collect()))
    for path, n in ((plain, 2), (mixed, 3), (lists, 3)):
        got = publish.read_plans(spark, path)
        assert got.schema.simpleString() == PLAN_SCHEMA.simpleString()
        assert rows(got) == rows(was(path)) and got.count() == n
        assert got.select("label").distinct().count() == n
    plan = publish.read_plans(spark, plain)._jdf.queryExecution().executedPlan().toString()
    assert "cast" not in plan and "from_json" not in plan
