"""Wide tables are landed as Parquet, every row computed once."""

from ratecraft.session import landed


def test_landed_rows_are_computed_once_and_stored_as_parquet(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r

    rows = spark.createDataFrame(spark.sparkContext.parallelize([(i, [{"a": i}]) for i in range(100)], 4).mapPartitions(count), "i int, m array<map<string,int>>")
    got = landed(rows)
    assert seen.value == 100 and got.schema == rows.schema
    assert sorted(r["i"] for r in got.collect()) == list(range(100)) and seen.value == 100
