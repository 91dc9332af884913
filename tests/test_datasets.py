"""Datasets of a table replaced, emptied and deleted in one step."""

import pytest
from pyspark.sql import functions as F

from florafold.plans import commits as CM
from florafold.plans import datasets as DS


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, dataset_id string")


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


def held(spark, root):
    return sorted((r["k"], r["dataset_id"]) for r in DS.read_datasets(spark, root).collect())


def test_replace_empty_delete(spark, tmp_path):
    root = str(tmp_path)
    DS.replace_datasets(table(spark, [(1, "007"), (2, "b c/d"), (3, "x"), (3, "x"), (None, "x")]), root)
    assert sorted(map(str, DS.read_datasets(spark, root).collect())) == sorted(
        map(str, table(spark, [(1, "007"), (2, "b c/d"), (3, "x"), (3, "x"), (None, "x")]).collect()))
    DS.replace_datasets(table(spark, [(9, "x"), (8, "y")]), root, ids(spark, "x", "y", "007"))
    assert held(spark, root) == [(2, "b c/d"), (8, "y"), (9, "x")]
    DS.delete_datasets(spark, root, ids(spark, "y", "not there"))
    assert held(spark, root) == [(2, "b c/d"), (9, "x")]
    assert {(r["dataset_id"], r["n_rows"]) for r in DS.manifest(spark, root).collect()} == {("b c/d", 1), ("x", 1)}
    DS.replace_datasets(table(spark, []), root, ids(spark, "x", "b c/d"))
    with pytest.raises(ValueError, match="holds no dataset"):
        DS.read_datasets(spark, root)
    DS.replace_datasets(table(spark, [(5, "z")]), root)
    assert held(spark, root) == [(5, "z")]


def test_a_call_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    DS.replace_datasets(table(spark, [(1, "a"), (2, "b")]), root)
    broken = table(spark, [(3, "a"), (4, "b")]).select(
        F.when(F.col("k") == 4, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("k")).alias("k"), "dataset_id")
    with pytest.raises(Exception, match="broken row"):
        DS.replace_datasets(broken, root)
    with pytest.raises(ValueError, match="without a dataset"):
        DS.replace_datasets(table(spark, [(3, None), (3, "a")]), root)
    with pytest.raises(ValueError, match="not asked for"):
        DS.replace_datasets(table(spark, [(3, "a"), (3, "b")]), root, ids(spark, "a"))
    with pytest.raises(ValueError, match="columns differ"):
        DS.replace_datasets(table(spark, [(3, "a")]).withColumn("more", F.lit(1)), root)
    DS.replace_datasets(table(spark, [(7, "b")]), root)
    for late in (lambda: DS.replace_datasets(table(spark, [(3, "a")]), root, base=1),
                 lambda: DS.delete_datasets(spark, root, ids(spark, "a"), base=1)):
        with pytest.raises(CM.PublishConflict):
            late()
    assert held(spark, root) == [(1, "a"), (7, "b")]
    live = {r["batch"] for r in DS.manifest(spark, root).collect()}
    unused = [(r["dataset_id"], r["batch"] in live) for r in DS.unused_folders(spark, root).collect()]
    # the first "b" (its batch still holds "a"), and what was written before a call was refused
    assert ("b", True) in unused and ("a", False) in unused and ("a", True) not in unused


def test_the_table_can_be_its_own_input(spark, tmp_path):
    root = str(tmp_path)
    DS.replace_datasets(table(spark, [(1, "a"), (2, "b")]), root)
    now = DS.read_datasets(spark, root)
    DS.replace_datasets(now.withColumn("k", F.col("k") + 10), root)
    assert held(spark, root) == [(11, "a"), (12, "b")]
