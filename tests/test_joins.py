"""Semi- and anti-join by a key that holds a large part of the rows."""

import pytest
from pyspark.sql import functions as F

from florafold.operators.joins import bounded_broadcast, exchanged, split_by_key
from florafold.session import written


@pytest.mark.parametrize("hot_rows", [0, 3, 50, 10 ** 6])
def test_split_by_key(spark, hot_rows):
    keys = [1] * 60 + [2] * 60 + [3, 3, 4, 4, 4, 4, 5] + [None] * 55 + list(range(10, 40))
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, v long")
    ids = spark.createDataFrame([(1,), (3,), (4,), (12,), (None,)], "k long")
    placed, others = split_by_key(rows, ids, "k", hot_rows)
    assert placed.columns == others.columns == ["k", "v"]
    want = {i for i, k in enumerate(keys) if k in (1, 3, 4, 12)}
    got, rest = [r["v"] for r in placed.collect()], [r["v"] for r in others.collect()]
    assert sorted(got) == sorted(want) and sorted(rest) == sorted(set(range(len(keys))) - want)


def test_rows_of_a_frequent_key_stay_where_they_are(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 4 < 2, 1).when(F.col("id") % 4 == 2, 2).otherwise(F.col("id")).alias("k"), "id")
    rows = rows.withColumn("k", F.when(F.col("id") % 10 != 0, F.col("k")))
    for df in split_by_key(rows, spark.createDataFrame([(1,)], "k long"), "k", 1000):
        assert df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 1000


def test_a_side_over_the_bound_is_never_broadcast(spark):
    """Its files may look small: here 20,000 rows of one text."""
    side = written(spark.range(20_000).select(F.col("id").alias("k"), F.lit("x" * 100).alias("v")), "side")
    joins = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    rows = spark.range(50).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in joins(rows.join(bounded_broadcast(side), "k"))
    for one in (bounded_broadcast(side, 1 << 20), exchanged(side)):
        out = rows.join(one.withColumn("w", F.explode(F.array("v", "v"))), "k")
        assert "SortMergeJoin" in joins(out) and "Broadcast" not in joins(out) and out.count() == 100
