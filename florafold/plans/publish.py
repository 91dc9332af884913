"""C2 validate_and_publish and S9 publish_version.

Thirteen checks compare the old and the new version; each yields one
``(check, status)`` row. The rollup (A7) decides: the alias moves to the new
version only when no check FAILs (WARN passes) and the run is not
checks-only (then SKIP). Old versions are marked with W5 after a switch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florafold.operators import checks as CK
from florafold.operators import retention as RT
from florafold.operators.joins import bounded_broadcast
from florafold.plans import commits
from florafold.session import ensure_checkpoint_dir

# ---- fixed values that must equal the reference's ----------------------------
# (check name, field, old facet size, new facet size, sort)
FACET_CHECKS = [
    ("check_data_resources", "dataResourceUid", -1, -1, "index"),
    ("check_sensitivity", "sensitive", -1, -1, "index"),
    ("check_conservation_status", "stateConservation", -1, -1, "index"),
    ("check_species_list_uid", "speciesListUid", 100, 100, "count"),
    ("check_spatial_layer_country", "country", 10, 100, "count"),
    ("check_spatial_layer_state", "stateProvince", 10, 100, "count"),
    ("check_spatial_layer_cl959", "cl959", 10, 100, "count"),
    ("check_spatial_layer_cl1048", "cl1048", 10, 100, "count"),
    ("check_spatial_layer_cl966", "cl966", 10, 100, "count"),
    ("check_spatial_layer_cl21", "cl21", 10, 100, "count"),
]
ALL_CHECKS = sorted([c[0] for c in FACET_CHECKS] + [
    "check_total_count", "check_min_fields_for_random_records", "check_compare_random_records"])
# ------------------------------------------------------------------------------


def _row(check: str, status_df: DataFrame) -> DataFrame:
    return status_df.select(F.lit(check).alias("check"), F.col("status"))


def _worst(df: DataFrame, check: str, empty_status: str = CK.PASS) -> DataFrame:
    agg = df.agg(F.max(CK.severity(F.col("status"))).alias("_s"))
    empty_sev = CK.SEVERITY[empty_status]
    return agg.select(F.lit(check).alias("check"),
                      CK.status_of(F.coalesce(F.col("_s"), F.lit(empty_sev))).alias("status"))


def run_checks(old: DataFrame, new: DataFrame, checks: list[str] | None = None,
               sample_size: int = CK.DEFAULT_SAMPLE_SIZE, min_fields: int = CK.DEFAULT_MIN_FIELDS,
               seed: int = 42) -> DataFrame:
    """All (or the named) checks as one ``(check, status)`` frame."""
    wanted = set(checks or ALL_CHECKS)
    parts = []
    spark = old.sparkSession
    ensure_checkpoint_dir(spark)
    facet = [(n, f, cs, fs, srt) for n, f, cs, fs, srt in FACET_CHECKS
             if n in wanted and f in old.columns and f in new.columns]
    # a facet that one side lacks can't pass
    lacking = [c[0] for c in FACET_CHECKS if c[0] in wanted and c not in facet]
    if lacking:
        parts.append(spark.createDataFrame([(n, CK.FAIL) for n in lacking], "check string, status string"))
    fields = [f for _, f, *_ in facet]
    # one narrow pass per version: every facet field plus the row count;
    # the result is one row per distinct value, written once and reused
    fc_old = CK.facet_counts_many(old, fields, include_rows=True).checkpoint()
    fc_new = CK.facet_counts_many(new, fields, include_rows=True).checkpoint()
    if facet:
        per_value = CK.facet_compare_counts(fc_old, fc_new, [(f, cs, fs, srt) for _, f, cs, fs, srt in facet],
                                            materialized=True)
        worst = per_value.groupBy("field").agg(F.max(CK.severity(F.col("status"))).alias("_s"))
        names = spark.createDataFrame([(n, f) for n, f, *_ in facet], "check string, field string")
        parts.append(names.join(worst, "field", "left").select(
            "check", CK.status_of(F.coalesce(F.col("_s"), F.lit(1))).alias("status")))
    if "check_total_count" in wanted:
        parts.append(_row("check_total_count", CK.total_count_from_facets(fc_old, fc_new)))
    want_min = "check_min_fields_for_random_records" in wanted
    want_cmp = "check_compare_random_records" in wanted
    if want_min or want_cmp:
        # two independent samples (as the two checks draw their own), one pass
        s_min, s_cmp = CK.sample_records_many(old, [(sample_size, seed), (sample_size, seed + 1)])
        s_min = s_min if want_min else None
        s_cmp = s_cmp if want_cmp else None
        ids = reduce(lambda a, b: a.unionByName(b),
                     [s.select(F.col("id").cast("string").alias("id")) for s in (s_min, s_cmp) if s is not None])
        keep = bounded_broadcast(ids.filter(F.col("id").isNotNull()).distinct())
        # one wide pass per version: only the sampled records, written once
        old_s = old.join(keep, old["id"].cast("string") == keep["id"], "left_semi").checkpoint()
        new_s = new.join(keep, new["id"].cast("string") == keep["id"], "left_semi").checkpoint()
        if want_min:
            parts.append(_worst(CK.check_min_fields(s_min, new_s, min_fields),
                                "check_min_fields_for_random_records", CK.FAIL))
        if want_cmp:
            per = CK.compare_records(old_s, new_s, ids=s_cmp)
            # a null / 'null' sampled id fails without a lookup
            nulls = s_cmp.filter(CK.is_null_id(F.col("id"))).select(F.lit(CK.FAIL).alias("status"))
            parts.append(_worst(per.select("status").unionByName(nulls), "check_compare_random_records",
                                CK.FAIL))
    return reduce(lambda a, b: a.unionByName(b), parts)


def publish_decision(rollup: DataFrame, alias: str, new_version: str, checks_only: bool = False) -> DataFrame:
    """The pointer row: switch to the new version only without a FAIL.
    action: 'switch' | 'skip' (checks only) | 'blocked' (a check failed)."""
    action = (F.when(F.lit(checks_only), F.lit("skip"))
              .when(F.col("publish"), F.lit("switch")).otherwise(F.lit("blocked")))
    status = (F.when(F.lit(checks_only), F.lit(CK.SKIP))
              .when(F.col("publish"), F.lit(CK.PASS)).otherwise(F.lit(CK.FAIL)))
    return rollup.select(F.lit(alias).alias("alias"), F.lit(new_version).alias("version"),
                         F.col("status").alias("checks_status"), action.alias("action"), status.alias("status"))


def publish_version(spark, decision: DataFrame, root: str, new_df: DataFrame | None = None, base: int | None = None,
                    staged: str | None = None) -> dict:
    """S9 side effect: when the decision is 'switch', write the new version and
    commit it (``plans.commits``: data first, commit last and only if no other
    publisher came first; ``base`` is the commit number the decision rests on). Without
    ``new_df`` the version must have been published before, and becomes current again. A
    temp view named after the alias reads the current version. Returns the decision row as a dict."""
    row = decision.first().asDict()
    if row["action"] == "switch":
        if new_df is not None:
            commits.publish(new_df, root, row["alias"], row["version"], base, staged)
        else:
            commits.roll_back(spark, root, row["alias"], row["version"])
        commits.read_current(spark, root, row["alias"]).createOrReplaceTempView(row["alias"])
    return row


def current_version(spark, root: str, alias: str) -> str | None:
    """The version readers follow, None before the first."""
    row = commits.current(spark, root, alias)
    return row["version"] if row else None


def validate_and_publish(old: DataFrame, new: DataFrame, alias: str, new_version: str,
                         checks_only: bool = False, root: str | None = None, versions: DataFrame | None = None,
                         keep: int = RT.DEFAULT_KEEP, protected: tuple[str, ...] = (), staged: str | None = None, **kw):
    """(check table, rollup row, decision row, old versions) as DataFrames.

    With ``root`` the decision is carried out (data, then commit; a publisher that committed since the
    checks began makes it raise). Old versions (W5: name, rank, action) are marked only after a switch: those of
    ``versions``, or with ``root`` the committed ones; without either that result is None. ``staged`` names
    the folder that holds ``new`` already (``commits.stage``)."""
    spark = old.sparkSession
    base = commits.last_number(spark, root, alias) if root else None
    checks = run_checks(old, new, **kw).checkpoint()
    roll = CK.rollup_status(checks)
    decision = publish_decision(roll, alias, new_version, checks_only)
    switched = (publish_version(spark, decision, root, new, base, staged) if root else decision.first().asDict())["action"] == "switch"
    stale = None
    if switched and versions is not None:
        stale = RT.retain_versions(versions, alias, keep, protected, new_version)
    elif switched and root:
        stale = commits.stale_versions(spark, root, alias, keep, protected)
    return checks, roll, decision, stale
