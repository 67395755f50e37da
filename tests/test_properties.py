"""Randomized property checks over many generated plans in one job."""

import json
import os
import random
import tempfile

from pyspark.sql import functions as F

from ratecraft.plans import end_to_end, relational
from ratecraft.sources import publish

UNITS = [None, "kWh", "kWh/kW", "kWh/hp", "kWh/kVA", "therms"]
CAPS = [None, -1, 0, 5, 50, 100, 400, 1000, 3000]


def _tiers(rng, energy):
    out = []
    for _ in range(rng.randint(0, 4)):
        t = {"rate": rng.choice([None, 0.0, round(rng.uniform(-0.05, 0.4), 4)])}
        if rng.random() < 0.5:
            t["adj"] = round(rng.uniform(-0.02, 0.05), 4)
        t["max"] = rng.choice(CAPS)
        if energy:
            t["unit"] = rng.choice(UNITS)
        out.append(t)
    return out


def _strux(rng, field, energy):
    if rng.random() < 0.1:
        return None
    return [{field: (_tiers(rng, energy) if rng.random() > 0.1 else None)} for _ in range(rng.randint(1, 3))]


def _plan(rng, i):
    n = rng.randint(1, 4)
    sched = lambda: [[rng.randrange(n) for _ in range(24)] for _ in range(12)]
    return {
        "label": f"p{i:04d}", "eiaId": rng.choice([None, 1, 2]), "utilityName": f"U{i % 7}",
        "rateName": f"Plan {i}", "sector": "Commercial", "revisions": [{"date": "2024-01-01T00:00:00Z"}],
        "fixedChargeFirstMeter": rng.choice([None, 5.0, 20000.0]), "fixedChargeUnits": rng.choice([None, "$/day"]),
        "demandRateUnits": rng.choice([None, "kW", "hp", "kVA"]), "flatDemandUnits": rng.choice([None, "kW", "hp"]),
        "flatDemandMonths": None if rng.random() < 0.1 else [rng.randrange(2) for _ in range(12)],
        "flatDemandStrux": _strux(rng, "flatDemandTiers", False),
        "demandRateStrux": _strux(rng, "demandRateTiers", False),
        "energyRateStrux": _strux(rng, "energyRateTiers", True),
        "demandWeekdaySched": sched(), "demandWeekendSched": sched(),
        "energyWeekdaySched": sched(), "energyWeekendSched": sched(),
    }


def test_random_plans_nested_equals_relational(spark):
    rng = random.Random(7)
    d = tempfile.mkdtemp(prefix="ratecraft-prop-")
    with open(os.path.join(d, "plans.json"), "w") as f:
        for i in range(60):
            f.write(json.dumps(_plan(rng, i)) + "\n")
    plans = end_to_end.clean_plans(publish.read_plans(spark, d)).cache()
    assert plans.count() == 60
    a = end_to_end.hourly_rates(plans)
    b = relational.utility_rates(plans)
    r = lambda df: df.select(*[F.round(c, 9).alias(c) if c.startswith("total") else F.col(c) for c in df.columns])
    assert a.count() == b.count() == 60 * 576
    assert r(a).exceptAll(r(b)).count() == 0
    pa = end_to_end.published_rates(plans, drop_negative=True)
    pb = relational.published(b, drop_negative=True)
    assert r(pa).exceptAll(r(pb)).count() == 0 and r(pb).exceptAll(r(pa)).count() == 0


def test_partitioning_does_not_change_results(spark):
    rng = random.Random(11)
    d = tempfile.mkdtemp(prefix="ratecraft-prop-")
    with open(os.path.join(d, "plans.json"), "w") as f:
        for i in range(30):
            f.write(json.dumps(_plan(rng, i)) + "\n")
    recs = publish.read_plans(spark, d)
    a = end_to_end.hourly_rates(end_to_end.clean_plans(recs))
    b = end_to_end.hourly_rates(end_to_end.clean_plans(recs.repartition(5).orderBy(F.rand(1))))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
