"""The hourly compile by position (J4-J6) gives the rows of the joins, multiplicity included."""

import random

import pytest

from ratecraft.plans import relational
from tests.test_pipeline import F1, _variant
from tests.test_shared_names import _all_versions, _same

GRID = [[(m + h) % 2 for h in range(24)] for m in range(12)]
KW = [{"energyRateTiers": [{"rate": 0.1, "unit": "kWh"}, {"rate": 0.2, "unit": "kWh/kW"}]}]


def check(spark, records):
    plans = relational.co_located(_all_versions(spark, records))
    got, want = relational.utility_rates(plans), relational.utility_rates_joined(plans)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert _same(got, want)
    return got


def test_unique_plans(spark):
    assert check(spark, [F1, _variant(label="z", rateName="Z"), _variant(label="n", rateName=None, eiaId=None)]).count() == 576 * 3


def test_places_that_one_schedule_lacks(spark):
    short, ragged = GRID[:3], [r[: 24 - i] for i, r in enumerate(GRID)]
    records = [
        _variant(label="a", rateName="A", energyWeekdaySched=short),
        _variant(label="b", rateName="B", demandWeekdaySched=ragged, energyWeekendSched=ragged),
        _variant(label="c", rateName="C", energyWeekdaySched=[[7] * 24] * 12),  # a period without a price
    ]
    rows = check(spark, records)
    assert rows.where("rateName = 'A' and week_part = 'Weekday' and energy_period is null").count() == 9 * 24


@pytest.mark.parametrize("seed", range(2))
def test_equal_keys_multiply_as_the_joins_do(spark, seed):
    rng = random.Random(seed)
    cut = lambda: [r[: rng.randint(0, 24)] for r in GRID[: rng.randint(0, 12)]]
    records = [
        _variant(
            label=f"r{k}", rateName=rng.choice("AB"), eiaId=rng.choice([1, 2, None]), fixedChargeFirstMeter=float(k),
            **({"energyWeekdaySched": cut(), "demandWeekdaySched": cut()} if k % 2 else {}),
            **({"energyRateStrux": KW, "sector": rng.choice(["Commercial", "Industrial"])} if k % 3 == 0 else {}),
        )
        for k in range(9)
    ]
    check(spark, records)
