"""Object inventory and dataset catalogue.

An inventory is a DataFrame ``(key, size, modified)``. :func:`object_inventory`
reads one from files with the ``binaryFile`` source selecting only path,
length and modification time (the content column is pruned, so files are
listed, not read). Everything after that is DataFrame work: regex filters,
one aggregate per dataset, a sort.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's ----------------------------
DATASET_PATTERN = r"^dr[0-9]+$"
# profile: (prefix, key regex, sub folder inside the dataset folder)
PROFILES = {
    "dwca": ("dwca-imports/", r"^.*/(dr[0-9]+)\.zip$", ""),
    "index_avro": ("pipelines-all-datasets/index-record/", r"^.*/dr[0-9]+/dr[0-9]+[\-0-9of]*\.avro$", ""),
    "verbatim_avro": ("pipelines-data/", r"^.*/dr[0-9]+/1/verbatim/verbatim+[\-0-9of]*\.avro$", ""),
    "ingested_since": ("pipelines-data/", r".*", "1/interpretation-metrics.yml"),
}
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
ISO_UTC_SUFFIX = "+00:00"
# ------------------------------------------------------------------------------


def object_inventory(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True,
                     modified_after: str | None = None, modified_before: str | None = None) -> DataFrame:
    """``(key, size, modified)`` for files under ``root`` matching ``glob``.

    ``key`` is the path relative to ``root``. Only file metadata is read;
    ``modified_after/before`` prune files during listing.
    """
    root_uri = root.rstrip("/")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if modified_before:
        reader = reader.option("modifiedBefore", modified_before)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(root_uri).select("path", "length", "modificationTime")
    rel = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root_uri.split("://")[-1]) + "/", "")
    return df.select(rel.alias("key"), F.col("length").alias("size"),
                     F.col("modificationTime").alias("modified"))


def iso_text(ts) -> Column:
    """A timestamp as the ISO text the listing compares (UTC offset included)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(c, ISO_FORMAT), F.lit(ISO_UTC_SUFFIX))


def in_time_range(df: DataFrame, col: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Inclusive on both ends, either end open, compared as ISO text, so a
    date-only upper end ('2024-01-05') excludes that day's objects."""
    t = iso_text(col)
    ts = F.col(col)
    # pushable superset bounds first (whole days around the text bounds), then
    # the exact text comparison
    if lo:
        df = df.filter(ts >= F.lit(lo[:10]).cast("date").cast(df.schema[col].dataType))
        df = df.filter(t >= F.lit(lo))
    if hi:
        df = df.filter(ts < F.date_add(F.lit(hi[:10]).cast("date"), 1).cast(df.schema[col].dataType))
        df = df.filter(t <= F.lit(hi))
    return df


def valid_datasets(df: DataFrame, col: str = "dataset_id", excluded=()) -> DataFrame:
    """P5: keep ids matching ``^dr[0-9]+$`` that are not excluded."""
    out = df.filter(F.col(col).rlike(DATASET_PATTERN))
    ex = [e for e in excluded if e]
    return out.filter(~F.col(col).isin(ex)) if ex else out


def dataset_folder(key: Column, prefix: str) -> Column:
    """First folder under ``prefix`` ('' when the key is not inside a folder there)."""
    rest = F.substring(key, len(prefix) + 1, 1 << 30)
    return F.when(key.startswith(prefix), F.regexp_extract(rest, r"^([^/]+)/", 1)).otherwise(F.lit(""))


def dataset_sizes(inv: DataFrame, key_regex: str, prefix: str, sub: str = "",
                  time_range: tuple[str | None, str | None] | None = None, excluded=()) -> DataFrame:
    """Bytes per dataset folder of objects whose key matches the regex
    (inside ``<prefix><dataset>/<sub>``), sorted by size desc then id.

    The reference keeps the last matching object's size; we sum (documented).
    """
    key = F.col("key")
    d = inv.filter(key.startswith(prefix)).withColumn("dataset_id", dataset_folder(key, prefix))
    d = valid_datasets(d, "dataset_id", excluded)
    d = d.filter(key.startswith(F.concat(F.lit(prefix), F.col("dataset_id"), F.lit("/" + sub))))
    d = d.filter(key.rlike(key_regex))
    if time_range:
        d = in_time_range(d, "modified", time_range[0], time_range[1])
    return (d.groupBy("dataset_id").agg(F.sum("size").cast("bigint").alias("size"))
            .orderBy(F.col("size").desc(), F.col("dataset_id").asc()))


def catalog(inv: DataFrame, profile: str, time_range=None, excluded=()) -> DataFrame:
    """Dataset sizes for one of the fixed listing profiles."""
    prefix, regex, sub = PROFILES[profile]
    return dataset_sizes(inv, regex, prefix, sub, time_range, excluded)


def named_dataset_sizes(inv: DataFrame, ids: DataFrame, id_col: str = "dataset_id") -> DataFrame:
    """Archive size for requested ids only (keys starting with
    ``dwca-imports/<id>/<id>.zip``), sorted desc. ``ids`` is a (small) request
    frame; joined with a semi-join, so the inventory is never collected."""
    want = ids.select(F.col(id_col).alias("dataset_id")).distinct()
    d = inv.withColumn("dataset_id", dataset_folder(F.col("key"), "dwca-imports/")) \
        .join(want, "dataset_id", "left_semi")
    d = d.filter(F.col("key").startswith(
        F.concat(F.lit("dwca-imports/"), F.col("dataset_id"), F.lit("/"), F.col("dataset_id"), F.lit(".zip"))))
    return (d.groupBy("dataset_id").agg(F.sum("size").cast("bigint").alias("size"))
            .orderBy(F.col("size").desc(), F.col("dataset_id").asc()))
