"""Plans meet their payload by a merge: nothing that grows with the plans is built in the driver."""

from ratecraft.plans import catalog

from .test_customer_join import write_tables


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_plans_and_payload_are_merged_by_label(spark, tmp_path):
    write_tables(spark, str(tmp_path))
    joins = [line for line in executed(catalog.q_clean_plans(spark, str(tmp_path))).splitlines() if "Join [label" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
