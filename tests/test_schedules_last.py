"""The schedules of the cleaned plans are added after the label join: no shuffle or sort there carries them."""

import json

from ratecraft.plans import end_to_end
from ratecraft.operators import clean
from ratecraft.sources import tpch

from .test_customer_join import write_tables


def nodes(plan):
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        todo += [node.children().apply(i) for i in range(node.children().size())]


def test_no_schedule_enters_the_label_join(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    plans = end_to_end.clean_table_plans(spark, str(tmp_path))
    joins = [n for n in nodes(plans._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    joined = [f for n in joins for f in json.loads(n.schema().json())["fields"]]
    assert any(f["name"] == "energyRateStrux" for f in joined)
    assert not any(f["name"].endswith("Sched") or f["name"] == "flatDemandMonths" for f in joined)


def test_plans_are_those_of_the_whole_records(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    plans = end_to_end.clean_table_plans(spark, str(tmp_path))
    whole = clean.clean_plans(tpch.plan_records(spark, str(tmp_path)))
    assert plans.dtypes == whole.dtypes
    rows = sorted(map(str, plans.collect()))
    assert rows and rows == sorted(map(str, whole.collect()))
