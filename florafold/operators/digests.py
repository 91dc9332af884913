"""Comparison of whole versions by a tree of digests (J3, U2): field, record, bucket, dataset.

A record's digest hashes the names and values of its fields in the order of their names (nothing for a null), a
bucket's and a dataset's is the sum of their records' digests with the ids. Sums do not depend on any order and
are combined map-side, so a level costs one row per bucket (dataset) and task. Each digest is a pair of
64-bit hashes of different seeds: two different records or sets have equal digests with odds of about 2^-128
(not against someone who builds collisions on purpose).

Each version is read once in full, for a narrow table (dataset, id, digests) that is written; datasets
and buckets are compared on that. Records are read again only for ids that differ. Unchanged buckets
are never joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.operators.checks import ASSERTION_FIELDS, compare_records
from florafold.operators.joins import bounded_broadcast
from florafold.session import ensure_checkpoint_dir, scratch_dir

SEEDS = (1, 2)
BUCKET_ROWS = 1000


def _without(df: DataFrame, ignore: list[str], id_col: str) -> DataFrame:
    drop = {x.lower() for x in ignore} - {id_col.lower()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in drop])


def _record_digest(fields: list[tuple[str, Column]], seed: int) -> Column:
    # xxhash64 passes over nulls, so each value goes with its name; fields are taken by name, not by place
    return F.xxhash64(F.lit(seed), *[F.when(value.isNotNull(), F.struct(F.lit(name), value)) for name, value in sorted(fields, key=lambda x: x[0])])


def record_digests(df: DataFrame, other: DataFrame | None = None, id_col: str = "id",
                   dataset_col: str = "dataResourceUid", ignore: list[str] = ASSERTION_FIELDS) -> DataFrame:
    """dataset, id, d1, d2 of each record with an id. Fields whose type differs in ``other`` are hashed as text, as the
    record comparison compares them. Null counts as absent; ignored fields are left out; map columns raise."""
    df = _without(df, ignore, id_col)
    fields = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.MapType):
            raise ValueError(f"{f.name}: flatten maps before comparing versions")
        if f.name == id_col:
            continue
        value = F.col(f"`{f.name}`")
        if other is not None and f.name in other.columns and other.schema[f.name].dataType != f.dataType:
            value = value.cast("string")
        fields.append((f.name, value))
    rid = F.col(f"`{id_col}`").cast("string")
    return df.where(rid.isNotNull()).select(
        F.col(f"`{dataset_col}`").cast("string").alias("dataset"), rid.alias("id"),
        *[_record_digest(fields, s).alias(f"d{s}") for s in SEEDS])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sides(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))


def _differences(both: DataFrame, key: str) -> DataFrame:
    """key, n_old, n_new, same: digests of both sides added up per key, in one aggregation."""
    aggs = [F.sum(1 - F.col("is_new")).alias("n_old"), F.sum("is_new").alias("n_new")]
    for s in SEEDS:
        # a record counts with its id, so two records that swap their values differ
        h = F.xxhash64(F.lit(s), "id", f"d{s}").cast("decimal(20,0)")
        aggs.append(F.sum(F.when(F.col("is_new") == 1, h).otherwise(-h)).alias(f"_x{s}"))
    same = (F.col("n_old") == F.col("n_new")) & (F.col("_x1") == 0) & (F.col("_x2") == 0)
    return both.groupBy(key).agg(*aggs).select(key, "n_old", "n_new", same.alias("same"))


def digest_tables(old: DataFrame, new: DataFrame, id_col: str = "id", dataset_col: str = "dataResourceUid",
                  ignore: list[str] = ASSERTION_FIELDS) -> DataFrame:
    """The narrow written table of both versions: dataset, id, d1, d2, is_new."""
    return _written(_sides(record_digests(old, new, id_col, dataset_col, ignore),
                           record_digests(new, old, id_col, dataset_col, ignore)), "digests")


def changed_datasets(digests: DataFrame) -> DataFrame:
    """dataset, n_old, n_new, same: whether a dataset (null is one) holds the same records in both versions."""
    return _differences(digests, "dataset")


def changed_ids(digests: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """id, n_old, n_new of each id whose records differ, found through buckets of about ``bucket_rows`` records.

    Buckets are dealt by a hash of the id alone, so a record that moved to another dataset meets its old self.
    ``bucket_rows`` does not change the result. An id repeated alike in both versions does not differ."""
    buckets = max(1, -(-digests.count() // (2 * bucket_rows)))  # one number
    dealt = digests.withColumn("bucket", F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(buckets)))
    open_ = _written(_differences(dealt, "bucket").where("not same").select("bucket"), "buckets")
    rows = dealt.join(bounded_broadcast(open_), "bucket", "left_semi")
    return _differences(rows, "id").where("not same").drop("same")


def compare_versions(old: DataFrame, new: DataFrame, id_col: str = "id", dataset_col: str = "dataResourceUid",
                     ignore: list[str] = ASSERTION_FIELDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every record that differs between two versions, with the columns of :func:`compare_records` and ``kind``:
    added, removed, changed (one record on each side) or repeated (several on a side, not the same ones).

    Null ids are left out, as there; ignored fields are not compared at all. Empty versions are fine."""
    ensure_checkpoint_dir(new.sparkSession)
    old, new = _without(old, ignore, id_col), _without(new, ignore, id_col)
    ids = _written(changed_ids(digest_tables(old, new, id_col, dataset_col, []), bucket_rows), "changed")
    kind = (F.when(F.col("n_old") == 0, "added").when(F.col("n_new") == 0, "removed")
            .when((F.col("n_old") == 1) & (F.col("n_new") == 1), "changed").otherwise("repeated"))
    return compare_records(old, new, ids.select("id"), [], id_col).withColumn("kind", kind)
