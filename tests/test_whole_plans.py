"""Whole plans fetched after K1 and K2 are those of the operators' chain on whole records."""

from ratecraft.plans import catalog


def write_tables(spark, sf):
    """Orders that come twice, an order key with two unlike orders, a NULL key, customers with many orders."""
    customer = [(k, f"C{k}", k % 3, 1.5, "BUILDING" if k % 2 else "AUTOMOBILE") for k in range(1, 40)]
    spark.createDataFrame(customer, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(
        f"{sf}/customer.parquet"
    )
    orders = [(i, 1 + i % 39, 10.0 + i % 7, i % 50) for i in range(200)]
    orders += orders[:20] + [(30, 7, 1.0, 48), (30, 8, 2.0, 48), (None, 9, 3.0, 49), (None, 9, 3.0, 49)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, day int").selectExpr(
        "o_orderkey", "o_custkey", "'O' AS o_orderstatus", "o_totalprice", "'1-URGENT' AS o_orderpriority",
        "timestamp'1996-12-01 00:00:00' + make_dt_interval(day) AS o_orderdate",
    ).write.parquet(f"{sf}/orders.parquet")
    spark.range(400).selectExpr(
        "IF(id = 0, NULL, id div 2) AS l_orderkey", "id AS l_partkey", "1L AS l_suppkey", "CAST(id % 2 + 1 AS INT) AS l_linenumber",
        "CAST(id % 5 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount", "id / 1000D AS l_tax",
        "'N' AS l_returnflag", "IF(id % 3 = 0, 'F', 'O') AS l_linestatus",
    ).write.parquet(f"{sf}/lineitem.parquet")


def test_whole_plans_equal_the_chain(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    chain = catalog.in_effect(spark, sf)
    whole = catalog.in_effect_whole(spark, sf)
    assert whole.columns == chain.columns
    assert whole.count() == chain.count() > 20
    text = lambda df: sorted(repr(r) for r in df.collect())
    assert text(whole) == text(chain)


def test_nested_columns_are_built_for_staying_plans_only(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    for q in (catalog.q_default_structures, catalog.q_empty_to_null, catalog.q_default_schedule):
        plan = q(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftSemi") >= 2
