"""Ranks and running sums over more rows than Spark's range sample, with columns outside the order."""

import pytest
from pyspark.sql import functions as F

from florafold.operators import planning as PL
from florafold.operators.checks import sample_records
from florafold.operators.ranking import with_global_rank, with_running_sum

N = 20_000


@pytest.fixture(params=[2, 4, 32])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_and_running_sum_of_whole_rows(spark, partitions):
    df = spark.range(N).select((F.col("id") * 7919 % N).alias("k"), F.concat(F.lit("x"), F.col("id")).alias("extra"),
                               (F.col("id") % 13).alias("v"), (F.col("id") % 3).alias("g"))
    ranked = with_global_rank(df, ["k"], "rk")
    rows = ranked.collect()
    assert len(rows) == N and all(r["rk"] == r["k"] for r in rows)
    total, want = {}, {}
    for r in sorted(rows, key=lambda r: r["rk"]):
        total[r["g"]] = want[r["rk"]] = total.get(r["g"], 0) + r["v"]
    got = with_running_sum(ranked, "rk", "g", "v", "run").collect()
    assert len(got) == N and all(r["run"] == want[r["rk"]] for r in got)


def test_batches_of_many_datasets(spark, partitions):
    ids = spark.range(N).select(F.format_string("dr%06d", F.col("id")).alias("dataset_id"), (F.col("id") % 97).alias("size"))
    batches = PL.round_robin_batches(ids, 8, 6).collect()
    assert len({r["dataset_id"] for r in batches}) == N
    for r in batches:
        i = int(r["dataset_id"][2:])
        size = len(range(r["batch"], N, 6))
        assert r["batch"] == i % 6 and r["position"] == size - 1 - i // 6


def test_buckets_by_size_agree_with_the_loop(spark, partitions):
    sizes = spark.range(N).select(F.format_string("dr%06d", F.col("id")).alias("dataset_id"),
                                  (F.col("id") * 7919 % N).alias("size"), F.lit("extra").alias("extra"))
    got = {r["dataset_id"]: (r["batch"], r["position"]) for r in PL.partition_by_size(sizes, [("all", 4, None)]).collect()}
    order = sorted(range(N), key=lambda i: (i * 7919 % N, i))
    assert got == {f"dr{i:06d}": (k % 4 + 1, k) for k, i in enumerate(order)}


def test_samples_of_many_datasets(spark, partitions):
    df = spark.range(N).select(F.format_string("dr%06d", F.col("id")).alias("dataResourceUid"),
                               F.format_string("r%06d", F.col("id")).alias("id"), F.lit("x").alias("extra"))
    rows = sample_records(df, 500).collect()
    assert len(rows) == 500
    for r in rows:
        assert r["offset"] == 0 and r["id"][1:] == r["dataset_id"][2:]
