"""Exact top-k facets in two phases (T2, J2), for fields with far more values than the few asked for.

1. One pass: rows per hash bucket of the value, an upper bound for each value of the bucket, and a
   frequent-items sketch whose k best values are then counted exactly. The k-th of these counts is a lower bound
   of the k-th count.
2. Only values of buckets that reach the lower bound are grouped and counted.

The result is exact, ties included, whatever the sketch found: a poor lower bound only leaves more values to
count. The first phase shuffles at most ``buckets`` rows and one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.operators.checks import facet_counts
from florafold.operators.joins import bounded_broadcast
from florafold.session import ensure_checkpoint_dir

BUCKETS = 1 << 16
# types the sketch takes; values of others are all counted
SKETCHED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def _values(df: DataFrame, field: str, q: Column | None) -> DataFrame:
    src = df.where(q) if q is not None else df
    col = F.col(f"`{field}`")
    col = F.explode(F.array_distinct(col)) if isinstance(df.schema[field].dataType, T.ArrayType) else col
    return src.select(col.alias("value")).where("value is not null")


def candidates(values: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``values`` that phase 2 counts."""
    if not isinstance(values.schema["value"].dataType, SKETCHED):
        return values
    ensure_checkpoint_dir(values.sparkSession)
    bucket = F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int").alias("bucket")
    # the sketch tracks a few values more than asked for, so that near ties are among them
    items = f"approx_top_k(value, {min(k, 10_000)}, {min(4 * k + 1000, 50_000)})"
    found = values.agg(F.expr(items).alias("found")).select(F.explode("found.item").alias("value"))
    exact = values.join(F.broadcast(found), "value", "left_semi").groupBy("value").count()
    kth = exact.orderBy(F.col("count").desc()).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("c")).first()
    if kth["n"] < k:  # one row; fewer values than asked for: there is no bound
        return values
    totals = values.groupBy(bucket).agg(F.count(F.lit(1)).alias("total"))
    reach = totals.where(F.col("total") >= kth["c"]).select("bucket").checkpoint()
    return values.select("value", bucket).join(bounded_broadcast(reach), "bucket", "left_semi").select("value")


def facet_topk(df: DataFrame, field: str, k: int, q: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(value, count) of the k most frequent non-null values, count descending, then value; the same rows as
    ``facet_counts(limit=k, sort="count")``. ``k`` of 0 gives none."""
    values = _values(df, field, q)
    return facet_counts(candidates(values, k, buckets) if k > 0 else values, "value", limit=k, sort="count")
