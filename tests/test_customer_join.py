"""The schedules of the derived records are added after the customer join, and are those of the mapping."""

import json

from ratecraft.sources import tpch

KEYS = [-3, 0, 1, 2, 17, 19, 23, 29, 31, 37, 41, 58, 74, 82]


def write_tables(spark, sf):
    customer = [(k, f"C{k}", abs(k) % 3, 1.5, "BUILDING") for k in KEYS]
    spark.createDataFrame(customer, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        f"{sf}/customer.parquet"
    )
    orders = [(100 + i, k, "O", 10.0, "1-URGENT") for i, k in enumerate(KEYS)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").selectExpr(
        "*", "timestamp'1996-01-02 00:00:00' AS o_orderdate"
    ).write.parquet(f"{sf}/orders.parquet")
    spark.sql(
        "SELECT 100L AS l_orderkey, 1L AS l_partkey, 1L AS l_suppkey, 1 AS l_linenumber, 2D AS l_quantity, 3D AS l_extendedprice, "
        "0.05D AS l_discount, 0.01D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus"
    ).write.parquet(f"{sf}/lineitem.parquet")


def matrix(key, weight, block):
    return [[(key + m * weight + h // block) % 2 for h in range(24)] for m in range(12)]


def test_schedules_follow_the_mapping(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    rows = {r["label"]: r for r in tpch.plan_records(spark, sf).collect()}
    assert len(rows) == len(KEYS)
    for i, k in enumerate(KEYS):
        r = rows[f"{100 + i:012d}"]
        missing = k % 29 == 0
        assert r["demandWeekdaySched"] == (None if missing else matrix(k, 1, 1))
        assert r["demandWeekendSched"] == (None if missing or k % 31 == 0 else matrix(k, 2, 1))
        assert r["energyWeekdaySched"] == (None if missing else [] if k % 41 == 0 else matrix(k, 1, 6))
        assert r["energyWeekendSched"] == (None if missing else matrix(k, 2, 6))
        months = None if k % 19 == 0 else [] if k % 37 == 0 else [(k + m) % 2 for m in range(1, 13)]
        assert r["flatDemandMonths"] == months


def test_no_schedule_enters_the_customer_join(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    todo, seen = [tpch.plan_records(spark, sf)._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        inputs = [node.children().apply(i) for i in range(node.children().size())]
        todo += inputs
        if node.nodeName() == "Join":
            sides = [json.loads(x.schema().json())["fields"] for x in inputs]
            if any(f["name"] == "c_custkey" for f in sides[1]):
                seen += 1
                assert all(isinstance(f["type"], str) for side in sides for f in side)
    assert seen == 1
