"""Facts about groups of rows, dealt so that no group lands in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def salt(df: DataFrame, id_col: str, name: str = "_salt") -> DataFrame:
    """With a salt of the id: as many values as there are shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(name, F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(n)).cast("int"))


def group_facts(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """keys, least_id, group_size and salts of each group (rows have a column _salt).

    Combined for each (group, salt) first, so a group with a third of all rows is
    no larger than its number of salts when its parts meet.
    """
    part = rows.groupBy(*keys, "_salt").agg(F.min(id_col).alias("_id"), F.count(F.lit(1)).alias("_n"))
    return part.groupBy(*keys).agg(F.min("_id").alias("least_id"), F.sum("_n").alias("group_size"),
                                   F.collect_list("_salt").alias("salts"))


def per_salt(facts: DataFrame) -> DataFrame:
    """One row for each salt of a group, to be joined to its rows by (keys, _salt)."""
    return facts.select("*", F.explode("salts").alias("_salt")).drop("salts")
