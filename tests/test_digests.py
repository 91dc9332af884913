"""Whole-version comparison by digests: random versions against the plain comparison of all records."""

import random

import pytest
from pyspark.sql import functions as F

from florafold.operators import checks as CK
from florafold.operators import digests as DG

SCHEMA = "id string, dataResourceUid string, a string, b double, tags array<string>, userAssertions string"


def version(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def records(rng, n):
    return [(str(i), f"dr{i % 7}", rng.choice(["x", "y", None]), rng.choice([1.0, 0.0, -0.0, float("nan"), None]),
             rng.choice([None, [], ["p"], ["p", "q"]]), rng.choice([None, "flag"])) for i in range(n)]


def edited(rng, rows):
    out = []
    for r in rows:
        k = rng.randrange(30)
        if k == 0:
            continue
        if k == 1:
            out.append(r)
        if k == 2:
            r = (r[0], "dr99", *r[2:])
        if k == 3:
            r = (*r[:2], r[2] and r[2] + "!", *r[3:])
        if k == 4:
            r = (*r[:4], ["q", "p"], r[5])
        if k == 5:
            r = (*r[:5], "other")
        out.append(r)
    return out + [(f"new{i}", "dr1", "x", None, None, None) for i in range(3)]


@pytest.mark.parametrize("bucket_rows", [1, 20, 100000])
def test_every_difference_is_found(spark, bucket_rows):
    rng = random.Random(bucket_rows)
    rows = records(rng, 400)
    old, new = version(spark, rows), version(spark, edited(rng, rows)).withColumn("extra", F.when(F.col("id") == "7", "z"))
    got = {r["id"]: r for r in DG.compare_versions(old, new, bucket_rows=bucket_rows).collect()}
    plain = CK.compare_records(old.drop("userAssertions"), new.drop("userAssertions")).where("status <> 'PASS'").collect()
    assert set(got) == {r["id"] for r in plain} and len(got) > 30
    for r in plain:
        assert got[r["id"]].asDict() == {**r.asDict(), "kind": got[r["id"]]["kind"]}
    assert {r["kind"] for r in got.values()} == {"added", "removed", "changed", "repeated"}


def test_values_that_swap_places_or_fields_differ(spark):
    row = lambda i, ds, a, b: (i, ds, a, b, None, None)
    old = version(spark, [row("1", "d", "x", None), row("2", "d", "y", None), row("3", "e", "x", 1.0), row(None, "d", "x", None)])
    new = version(spark, [row("1", "d", "y", None), row("2", "d", "x", None), row("3", "e", "x", 1.0), row(None, "d", "z", None)])
    assert {(r["id"], r["changed"]) for r in DG.compare_versions(old, new).collect()} == {("1", "a"), ("2", "a")}
    same = {r["dataset"]: r["same"] for r in DG.changed_datasets(DG.digest_tables(old, new)).collect()}
    assert same == {"d": False, "e": True}
    two = spark.createDataFrame([("1", "d", "v", None)], "id string, dataResourceUid string, a string, c string")
    moved = spark.createDataFrame([("1", "d", None, "v")], "id string, dataResourceUid string, a string, c string")
    assert [(r["missing"], r["added"]) for r in DG.compare_versions(two, moved).collect()] == [("a", "c")]


def test_repeats_order_types_and_empty_versions(spark):
    rows = [("1", "d", "x", 1.0, ["p"], None)] * 2 + [("2", "d", None, None, None, "flag")]
    old, new = version(spark, rows), version(spark, rows[::-1]).select("tags", "b", "id", "a", "dataResourceUid", "userAssertions")
    assert DG.compare_versions(old, new).count() == 0
    number = lambda t: spark.createDataFrame([("1", "d", 5)], f"id string, dataResourceUid string, n {t}")
    assert DG.compare_versions(number("int"), number("bigint")).count() == 0  # compared as text, as record by record
    none = version(spark, [])
    assert DG.compare_versions(none, none).count() == 0
    assert {(r["id"], r["kind"]) for r in DG.compare_versions(none, new).collect()} == {("1", "added"), ("2", "added")}
    with pytest.raises(ValueError, match="flatten maps"):
        DG.compare_versions(old.withColumn("m", F.create_map(F.lit("k"), F.lit("v"))), new)


def test_unchanged_buckets_are_not_joined(spark):
    rows = records(random.Random(0), 2000)
    old, new = version(spark, rows), version(spark, [(*rows[0][:2], "changed", *rows[0][3:])] + rows[1:])
    digests = DG.digest_tables(old, new)
    dealt = digests.withColumn("bucket", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(200)))
    assert DG._differences(dealt, "bucket").where("not same").count() == 1
    assert [r["id"] for r in DG.changed_ids(digests, bucket_rows=10).collect()] == [rows[0][0]]
