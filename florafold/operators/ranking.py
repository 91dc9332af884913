"""Exact global positions and running sums without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.
Here the rows are range-partitioned on the order (one balanced shuffle; a hot
key is split because the order ends in a unique column), each partition
numbers its own rows, and a per-partition count table — one row per
partition, so its size is bounded by the partition count — gives the offsets.
The same trick gives running sums per group.

The partitioned rows are checkpointed, with the partition number as a column,
before both uses: range bounds are sampled, so rows and offsets may only come
from one and the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florafold.session import ensure_checkpoint_dir


def _parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_rank(df: DataFrame, order: list[Column | str], rank_col: str = "rank",
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col``: 0-based position of each row in ``order``.

    ``order`` should be a total order (end it with a unique column) so that
    the numbering is repeatable when a lost partition is recomputed.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = _parts(df, num_partitions)
    # an explicit partition count keeps AQE from coalescing the range partitions
    ensure_checkpoint_dir(df.sparkSession)
    srt = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("_rk_p", F.spark_partition_id())
           .withColumn("_rk_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_rk_p").cast("bigint"), 33))
           .checkpoint())
    counts = srt.groupBy("_rk_p").agg(F.count(F.lit(1)).alias("_rk_n"))
    # one row per partition: this window is over the partition table, not the data
    offsets = counts.select(
        "_rk_p",
        (F.sum("_rk_n").over(Window.orderBy("_rk_p").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_rk_off"))
    return (srt.join(F.broadcast(offsets), "_rk_p")
            .withColumn(rank_col, F.coalesce(F.col("_rk_off"), F.lit(0)) + F.col("_rk_i"))
            .drop("_rk_p", "_rk_i", "_rk_off"))


def with_running_sum(df: DataFrame, rank_col: str, group_col: Column | str, value_col: str,
                     out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col``: sum of ``value_col`` over rows of the same group with
    rank <= this row's rank (inclusive running sum per group).

    Rows are range-partitioned on the rank; every partition sums its own
    slice per group, and a (partitions × groups) table of slice totals gives
    the carry-in. No group is ever gathered into one task.
    """
    g = F.col(group_col) if isinstance(group_col, str) else group_col
    n = _parts(df, num_partitions)
    ensure_checkpoint_dir(df.sparkSession)
    d = (df.withColumn("_rs_g", g)
         .repartitionByRange(n, F.col(rank_col)).sortWithinPartitions(rank_col)
         .withColumn("_rs_p", F.spark_partition_id()).checkpoint())
    # the window groups are (partition slice, group): bounded by the slice size
    local = Window.partitionBy("_rs_p", "_rs_g").orderBy(rank_col).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_rs_local", F.sum(value_col).over(local))
    slice_tot = d.groupBy("_rs_p", "_rs_g").agg(F.sum(value_col).alias("_rs_t"))
    carry = slice_tot.select(
        "_rs_p", "_rs_g",
        F.sum("_rs_t").over(Window.partitionBy("_rs_g").orderBy("_rs_p")
                            .rowsBetween(Window.unboundedPreceding, -1)).alias("_rs_carry"))
    return (d.join(carry, ["_rs_p", "_rs_g"], "left")
            .withColumn(out_col, F.col("_rs_local") + F.coalesce(F.col("_rs_carry"), F.lit(0)))
            .drop("_rs_p", "_rs_g", "_rs_local", "_rs_carry"))


def smallest_per_group(df: DataFrame, group_col: str, order_col: str, k: int, fan_in: int = 64,
                       rank_col: str = "pos") -> DataFrame:
    """The ``k`` smallest ``order_col`` values per group (nulls first), with
    their 0-based position in the group — exact, with bounded work per task.

    1. Inside every input partition keep the ``k`` smallest per group
       (``mapInPandas``; no shuffle, memory ≤ groups × k + one batch).
    2. Merge partition results in a tree: partitions are bucketed
       ``fan_in`` at a time and each (group, bucket) keeps its ``k`` smallest,
       so no window group ever holds more than ``fan_in × k`` rows, however
       large the group is.
    """
    import pandas as pd

    sub = df.select(group_col, order_col)
    schema = sub.schema

    def keep_smallest(batches):
        acc = None
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            # merge when as many new rows have come as are kept already, so the sorts stay linear in all
            if acc is None or size >= max(100_000, len(acc)):
                acc, held, size = smallest([acc, *held] if acc is not None else held), [], 0
        if acc is not None:
            acc = smallest([acc, *held])
            if len(acc):
                yield acc

    def smallest(frames):
        return (pd.concat(frames, ignore_index=True)
                .sort_values([group_col, order_col], na_position="first", kind="mergesort")
                .groupby(group_col, sort=False, dropna=False).head(k))

    x = sub.mapInPandas(keep_smallest, schema).withColumn("_b", F.spark_partition_id())
    n = max(1, sub.rdd.getNumPartitions())
    order = F.col(order_col).asc_nulls_first()
    while n > 1:
        x = x.withColumn("_b", F.floor(F.col("_b") / fan_in))
        w = Window.partitionBy(group_col, "_b").orderBy(order)
        x = x.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")
        n = -(-n // fan_in)
    w = Window.partitionBy(group_col).orderBy(order)
    return (x.withColumn(rank_col, F.row_number().over(w) - 1).filter(F.col(rank_col) < k)
            .drop("_b"))
