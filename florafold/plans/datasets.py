"""Replacing, emptying and deleting datasets of a table in one step.

Under the table's root:

* ``data/batch=<token>/dataset_id=<id>/``: the rows one call wrote, never overwritten;
* ``manifests/<token>``: one row per dataset the table holds: dataset_id, batch, n_rows;
* ``commits/``: the numbered commits of :mod:`florafold.plans.commits`, each naming a manifest.

A call writes its rows, then a manifest, then a commit. Readers follow the last commit, so they see all of
a call or nothing of it; a call that fails leaves folders no manifest names, and of two calls from the same
state one raises ``PublishConflict``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.operators.joins import bounded_broadcast
from florafold.plans import commits as CM

ALIAS = "table"
MANIFEST_SCHEMA = "dataset_id string, batch string, n_rows bigint"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """dataset_id, batch and n_rows of each dataset the table holds; no rows before the first commit."""
    row = CM.current(spark, root, ALIAS)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(row["path"]) if row else spark.createDataFrame([], MANIFEST_SCHEMA)


def _schema(spark: SparkSession, root: str, batch: str) -> T.StructType:
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data/batch={batch}").schema


def read_datasets(spark: SparkSession, root: str, dataset_col: str = "dataset_id") -> DataFrame:
    """The table as of the last commit, its dataset last. Folders no manifest names are pruned, or left out by the join."""
    now = manifest(spark, root)
    some = now.first()
    if some is None:
        raise ValueError(f"{root!r} holds no dataset")
    parts = T.StructType([T.StructField("batch", T.StringType()), T.StructField("_dataset", T.StringType())])
    fields = T.StructType(_schema(spark, root, some["batch"]).fields + parts.fields)
    rows = spark.read.schema(fields).parquet(f"{root}/data")
    live = bounded_broadcast(now.select("batch", F.col("dataset_id").alias("_dataset")))
    return rows.join(live, ["batch", "_dataset"], "left_semi").select(
        *[F.col(f"`{f.name}`") for f in fields[:-2]], F.col("_dataset").alias(dataset_col))


def replace_datasets(df: DataFrame, root: str, ids: DataFrame | None = None, dataset_col: str = "dataset_id",
                     base: int | None = None) -> dict:
    """One step: the datasets in ``df`` get its rows, and every other dataset that ``ids`` (one column) asks for goes.

    So a dataset of ``ids`` without rows in ``df`` is emptied or deleted; without ``ids`` only the datasets in
    ``df`` are asked for. Raises, with nothing changed, on a null dataset, on rows of a dataset not asked for, on
    columns other than the table's, or if another call committed after ``base`` (the commit number now, if not given)."""
    spark = df.sparkSession
    root = root.rstrip("/")
    base = CM.last_number(spark, root, ALIAS) if base is None else base
    before = manifest(spark, root)
    some = before.first()
    named = df.withColumn("_dataset", F.col(f"`{dataset_col}`").cast("string")).drop(dataset_col)
    if some is not None:
        want = {(f.name, f.dataType.simpleString()) for f in _schema(spark, root, some["batch"]).fields}
        have = {(f.name, f.dataType.simpleString()) for f in named.schema.fields if f.name != "_dataset"}
        if want != have:
            raise ValueError(f"columns differ from the table's: {sorted(want ^ have)}")
    token = uuid.uuid4().hex[:12]
    folder = f"{root}/data/batch={token}"
    named.hint("rebalance", "_dataset").write.mode("errorifexists").partitionBy("_dataset").parquet(folder)
    fields = T.StructType([f for f in named.schema.fields if f.name != "_dataset"] + [T.StructField("_dataset", T.StringType())])
    # counted from what was written, so the manifest never promises rows that are not there
    written = spark.read.schema(fields).parquet(folder).groupBy(F.col("_dataset").alias("dataset_id")) \
        .agg(F.lit(token).alias("batch"), F.count(F.lit(1)).alias("n_rows"))
    if not written.where("dataset_id is null").isEmpty():
        raise ValueError("rows without a dataset")
    asked = written.select("dataset_id")
    if ids is not None:
        ids = ids.select(F.col(ids.columns[0]).cast("string").alias("dataset_id"))
        if not asked.join(ids, "dataset_id", "left_anti").isEmpty():
            raise ValueError("rows of a dataset that was not asked for")
        asked = ids
    after = before.join(asked, "dataset_id", "left_anti").unionByName(written)
    path = f"{root}/manifests/{token}"
    after.write.mode("errorifexists").parquet(path)
    return CM._commit(spark, root, ALIAS, base, token, "replace", path)


def delete_datasets(spark: SparkSession, root: str, ids: DataFrame, base: int | None = None) -> dict:
    """One step: every dataset of ``ids`` (one column) goes; ids the table does not hold are passed over."""
    root = root.rstrip("/")
    base = CM.last_number(spark, root, ALIAS) if base is None else base
    token = uuid.uuid4().hex[:12]
    path = f"{root}/manifests/{token}"
    gone = ids.select(F.col(ids.columns[0]).cast("string").alias("dataset_id"))
    manifest(spark, root).join(gone, "dataset_id", "left_anti").write.mode("errorifexists").parquet(path)
    return CM._commit(spark, root, ALIAS, base, token, "delete", path)


def unused_folders(spark: SparkSession, root: str, dataset_col: str = "dataset_id") -> DataFrame:
    """batch and dataset of each folder with files that the current manifest does not name: replaced or deleted
    datasets, and calls that failed after their write. Readers of an earlier commit may still need the former."""
    parts = T.StructType([T.StructField("batch", T.StringType()), T.StructField("_dataset", T.StringType())])
    folders = spark.read.schema(parts).parquet(f"{root.rstrip('/')}/data").distinct()
    live = manifest(spark, root.rstrip("/")).select("batch", F.col("dataset_id").alias("_dataset"))
    return folders.join(live, ["batch", "_dataset"], "left_anti").withColumnRenamed("_dataset", dataset_col)
