"""Read many globbed paths as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_records(spark: SparkSession, paths: list[str] | str, fmt: str = "parquet",
                 merge_schema: bool = True) -> DataFrame:
    """One DataFrame over all paths (globs allowed). Parquet files whose
    schemas differ are merged by name; a column missing in some files reads
    as null there. Avro needs the spark-avro package on the classpath."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(fmt)
    if fmt == "parquet" and merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(paths)
