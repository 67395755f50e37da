"""The records of given labels are met by a merge: no list of labels goes through the driver, however small its rows look."""

from pyspark.sql import functions as F

from ratecraft.sources import tpch

from .test_customer_join import KEYS, write_tables


def test_no_list_of_labels_is_broadcast(spark, tmp_path):
    sf = str(tmp_path)
    write_tables(spark, sf)
    only = spark.range(100, 100 + len(KEYS), 3).select(F.format_string("%012d", "id").alias("label"))
    records = tpch.plan_records(spark, sf, only=only)
    planned = records._jdf.queryExecution().executedPlan().toString()
    semi = [line for line in planned.splitlines() if "LeftSemi" in line]
    assert len(semi) == 2
    assert all("SortMergeJoin" in line for line in semi)
    assert sorted(r["label"] for r in records.select("label").collect()) == sorted(r["label"] for r in only.collect())
