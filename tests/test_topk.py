"""Two-phase top-k facets against the facet that counts every value."""

import random

import pytest
from pyspark.sql import functions as F

from florafold.operators import checks as CK
from florafold.operators import topk as TK


@pytest.mark.parametrize("k, buckets", [(0, 64), (1, 64), (5, 1), (5, 64), (40, 4096), (5000, 64)])
def test_equal_to_the_full_count(spark, k, buckets):
    rng = random.Random(k)
    # a hot value with a third of the rows, ties at every count, a long tail, nulls
    rows = [("hot",)] * 3000 + [(f"t{i % 20}",) for i in range(2000)] + [(f"r{rng.randrange(3000)}",) for _ in range(4000)] + [(None,)] * 50
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "v string").repartition(6)
    assert TK.facet_topk(df, "v", k, buckets=buckets).collect() == CK.facet_counts(df, "v", limit=k, sort="count").collect()


def test_types_arrays_and_filter(spark):
    df = spark.range(3000).select(
        (F.col("id") % 37).cast("double").alias("d"), F.to_date(F.lit("2024-01-01")).alias("day"),
        F.array((F.col("id") % 11).cast("string"), (F.col("id") % 5).cast("string")).alias("tags"),
        F.encode((F.col("id") % 9).cast("string"), "utf-8").alias("raw"), (F.col("id") % 2 == 0).alias("flag"), "id")
    for field in ("d", "day", "tags", "raw", "flag"):
        for q in (None, F.col("id") > 1000, F.col("id") < 0):
            assert TK.facet_topk(df, field, 4, q).collect() == CK.facet_counts(df, field, q, 4, "count").collect(), field


def test_second_phase_counts_only_values_that_can_reach(spark):
    df = spark.range(40000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 10).otherwise(F.col("id") + 100).alias("v"))
    left = TK.candidates(TK._values(df, "v", None), 5).select("value").distinct().count()
    assert left < 100  # of 20,005 values
    assert TK.facet_topk(df, "v", 5).collect() == CK.facet_counts(df, "v", limit=5, sort="count").collect()
