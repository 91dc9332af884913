"""Load planning: size classes, batches and image-sync candidates
(P9-P12, W2, W3, A6, J5-J7).

Outputs are long tables — one row per (batch, dataset) — never id lists
collected into one row. Global orders use the distributed rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florafold.functions.scalar import id_kind
from florafold.operators.ranking import with_global_rank, with_running_sum
from florafold.session import ensure_checkpoint_dir

# ---- fixed values that must equal the reference's ----------------------------
SMALL_MAX_BYTES = 5000000         # small: size <= this
XLARGE_MIN_BYTES = 5000000000     # xlarge: size >= this (reference: no class at exactly this)
CLASS_ORDER = ["small", "large", "xlarge"]
EXCLUDED_IMAGE_DATASET = "no_dataresource"
IMAGE_LOOKBACK_DAYS = 7
# ------------------------------------------------------------------------------


def size_class(size: Column | str) -> Column:
    """P9: 'small' / 'large' / 'xlarge' from bytes."""
    s = F.col(size) if isinstance(size, str) else size
    return (F.when(s <= SMALL_MAX_BYTES, F.lit("small"))
            .when(s < XLARGE_MIN_BYTES, F.lit("large"))
            .otherwise(F.lit("xlarge")))


def size_class_as_batches(sizes: DataFrame) -> DataFrame:
    """P10: the classes as id lists, in long form: one row per dataset with its
    class and position (size desc, then id) inside the class. Empty classes
    have no rows."""
    d = sizes.withColumn("size_class", size_class("size")).withColumn(
        "_co", F.when(F.col("size_class") == "small", 0).when(F.col("size_class") == "large", 1).otherwise(2))
    ensure_checkpoint_dir(sizes.sparkSession)
    ranked = with_global_rank(d, [F.col("_co").asc(), F.col("size").desc(), F.col("dataset_id").asc()], "_r") \
        .checkpoint()  # one row per dataset, read twice below
    starts = ranked.groupBy("_co").agg(F.min("_r").alias("_s"))  # at most 3 rows
    return (ranked.join(F.broadcast(starts), "_co")
            .select("size_class", (F.col("_r") - F.col("_s")).alias("position"), "dataset_id", "size"))


def dispatch_mode(n: Column, min_per_batch: int) -> Column:
    """0 → 'skip', more than ``min_per_batch`` → 'batch', else 'direct'."""
    return (F.when(n == 0, F.lit("skip")).when(n > min_per_batch, F.lit("batch"))
            .otherwise(F.lit("direct")))


def workload_class(counts: DataFrame, threshold: int, count_col: str = "count",
                   small: str = "small", large: str = "xlarge") -> DataFrame:
    """The larger tier when the largest dataset exceeds ``threshold`` rows."""
    m = counts.agg(F.max(count_col).alias("max_count"))
    return m.select(F.col("max_count").cast("bigint").alias("max_count"),
                    F.when(F.col("max_count") > threshold, F.lit(large)).otherwise(F.lit(small))
                    .alias("workload"))


def round_robin_batches(ids: DataFrame, min_per_batch: int, max_batches: int,
                        order: list | None = None, id_col: str = "dataset_id") -> DataFrame:
    """``n = min(ceil(c / min_per_batch), max_batches)`` batches; the i-th
    id goes to batch ``i % n``; inside a batch later ids come first.
    Output: batch, position, dataset_id (plus n_batches)."""
    order = order or [F.col(id_col).asc()]
    ensure_checkpoint_dir(ids.sparkSession)
    # one row per dataset, ranked once and written: the count and the batches read it
    r = with_global_rank(ids, order, "_i").checkpoint()
    c = r.count()  # one scalar
    if c == 0:
        return ids.sparkSession.createDataFrame([], "batch int, position bigint, dataset_id string, n_batches int")
    n = min(-(-c // min_per_batch), max_batches)
    batch = F.pmod(F.col("_i"), F.lit(n))
    in_batch = F.floor((F.lit(c - 1) - batch) / F.lit(n)) + 1
    pos = in_batch - 1 - F.floor(F.col("_i") / F.lit(n))
    return r.select(batch.cast("int").alias("batch"), pos.cast("bigint").alias("position"),
                    F.col(id_col).alias("dataset_id"), F.lit(n).alias("n_batches"))


def partition_by_size(sizes: DataFrame, specs: list[tuple[str, int, int | None]],
                      id_col: str = "dataset_id", size_col: str = "size") -> DataFrame:
    """Layered round-robin of ascending sizes into capped buckets per tier.

    In each tier (name, buckets, cap) the datasets still unassigned, by size
    then id, go round-robin to the tier's buckets; the tier stops at the first
    dataset that no longer fits its bucket (loads stay ordered, so no later
    bucket could take it either), and the rest escalate to the next tier.
    A tier with no cap takes all. Output: dataset_id, size, category, batch
    (1-based), position (0-based rank in the tier).

    Per tier: one distributed rank, one distributed running sum per bucket
    and one scalar (the cut).
    """
    d = sizes.select(F.col(id_col).alias("dataset_id"), F.col(size_col).cast("bigint").alias("size"))
    ensure_checkpoint_dir(d.sparkSession)
    # one row per dataset, written once: every tier's cut reads it instead of
    # recomputing the listing and the rank
    ranked = with_global_rank(d, [F.col("size").asc(), F.col("dataset_id").asc()], "_r").checkpoint()
    out = []
    start = 0
    for name, buckets, cap in specs:
        tier = ranked.filter(F.col("_r") >= start).withColumn("_t", F.col("_r") - F.lit(start))
        tier = tier.withColumn("_b", F.pmod(F.col("_t"), F.lit(buckets)))
        if cap is None:
            cut = None
        else:
            run = with_running_sum(tier, "_t", "_b", "size", "_load")
            cut = run.filter(F.col("_load") > cap).agg(F.min("_t")).first()[0]
        taken = tier if cut is None else tier.filter(F.col("_t") < cut)
        out.append(taken.select("dataset_id", "size", F.lit(name).alias("category"),
                                (F.col("_b") + 1).cast("int").alias("batch"),
                                F.col("_t").alias("position")))
        if cut is None:
            break
        start += cut
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def recent_image_counts(images: DataFrame, lo: str, hi: str | None = None,
                        date_col: str = "uploaded", count_col: str = "images") -> DataFrame:
    """Images per dataset uploaded on days lo..hi inclusive (hi = today
    when None); 'no_dataresource' dropped. Sums (the reference keeps the last
    day's count; documented)."""
    hi_c = F.lit(hi).cast("date") if hi else F.current_date()
    d = images.filter((F.col(date_col).cast("date") >= F.lit(lo).cast("date"))
                      & (F.col(date_col).cast("date") <= hi_c))
    d = d.filter(F.col("dataset_id") != EXCLUDED_IMAGE_DATASET)
    return d.groupBy("dataset_id").agg(F.sum(count_col).cast("bigint").alias("images"))


def image_sync_candidates(recent: DataFrame, reindexed: DataFrame) -> DataFrame:
    """Datasets with new images that were also re-indexed since the cutoff."""
    return recent.select("dataset_id").intersect(reindexed.select("dataset_id"))


def image_sync_cutoff(version_date: Column) -> Column:
    """Version date − 7 days. See :func:`version_cutoff` for a version's name."""
    return F.date_sub(version_date.cast("date"), IMAGE_LOOKBACK_DAYS)


def version_cutoff(spark, version: str) -> str:
    """The cutoff day of a version named ``<alias>-YYYY-MM-DD-HH-MM`` (one scalar row)."""
    day = F.to_date(F.nullif(F.regexp_extract(F.lit(version), r"-(\d{4}-\d{2}-\d{2})-\d{2}-\d{2}$", 1), F.lit("")))
    cutoff = spark.range(1).select(image_sync_cutoff(day).cast("string").alias("c")).first()["c"]
    if cutoff is None:
        raise ValueError(f"{version!r} does not end in a date and time")
    return cutoff


def expand_providers(ids: DataFrame, registry: DataFrame, id_col: str = "uid", mixed: str = "empty") -> DataFrame:
    """A provider uid ('dp…') becomes its member datasets; dataset uids
    pass through. A provider must be requested alone: otherwise there are no
    datasets (the reference skips the run), or with ``mixed="raise"`` a ValueError.
    Output: dataset_id, via (provider uid or null), valid (true)."""
    req = ids.select(F.col(id_col).alias("uid")).withColumn("kind", id_kind(F.col("uid"), strict=False))
    st = req.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("kind") == "dp", 1)).alias("ndp")).first()
    valid = st["ndp"] == 0 or st["n"] == 1  # one scalar row
    if not valid and mixed == "raise":
        raise ValueError("a provider must be requested alone")
    members = registry.select(F.col("uid").alias("p_uid"), F.explode_outer("dataResources").alias("dr"))
    dp = req.filter(F.col("kind") == "dp").join(members, F.col("uid") == F.col("p_uid"), "left") \
        .select(F.col("dr.uid").alias("dataset_id"), F.col("uid").alias("via"))
    bad = req.filter(F.coalesce(~F.col("kind").isin("dp", "dr"), F.lit(True))).select("uid").limit(5).collect()
    if bad:
        raise ValueError(f"neither dataset nor provider ids: {[r['uid'] for r in bad]}")
    dr = req.filter(F.col("kind") == "dr").select(F.col("uid").alias("dataset_id"),
                                                  F.lit(None).cast("string").alias("via"))
    out = dp.unionByName(dr).filter(F.col("dataset_id").isNotNull())
    return out.withColumn("valid", F.lit(valid)).filter(F.col("valid"))


def touch_registry(registry: DataFrame, ids: DataFrame, ts: str, id_col: str = "dataset_id",
                   providers: DataFrame | None = None) -> DataFrame:
    """Set ``lastChecked`` to ``ts`` on the named datasets, and with
    ``providers(uid, dataResources)`` on the members of named providers."""
    hit = ids.select(F.col(id_col).alias("_uid")).distinct()
    if providers is not None:
        members = providers.select(F.col("uid").alias("_uid"), F.explode("dataResources").alias("_dr"))
        hit = hit.unionByName(members.join(hit, "_uid", "left_semi").select(F.col("_dr.uid").alias("_uid"))).distinct()
    hit = hit.withColumn("_hit", F.lit(True))
    j = registry.join(hit, registry["uid"] == hit["_uid"], "left")
    return j.withColumn("lastChecked", F.when(F.col("_hit"), F.lit(ts)).otherwise(F.col("lastChecked"))) \
        .drop("_uid", "_hit")
