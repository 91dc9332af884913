"""Facets and the old-version/new-version checks.

A facet is ``groupBy(field).count()``: partial aggregation runs map-side, so
only one row per distinct value and map task is shuffled, however skewed the
field. Every check reduces both versions to small per-value or per-id tables
before comparing, and returns DataFrames (one row per value / record / check)
with a ``status`` column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.functions.scalar import is_null_id
from florafold.operators.joins import bounded_broadcast
from florafold.operators.ranking import smallest_per_group, with_global_rank
from florafold.session import ensure_checkpoint_dir

# ---- fixed values that must equal the reference's ----------------------------
PASS, WARN, FAIL, SKIP = "PASS", "WARN", "FAIL", "SKIP"
# fields a record comparison ignores when they are missing from the new version
ASSERTION_FIELDS = ["userAssertions", "userVerified", "hasUserAssertions", "assertionUserId",
                    "lastAssertionDate"]
MIN_FACET_RECORD_COUNT = 1000    # below this, a drop with new > 0 is not severe
MAX_DROP_PCT = 2                 # a rounded drop above this many percent fails
SAMPLE_OFFSET_CAP = 20000        # a sampled record sits below this offset of its dataset
DEFAULT_SAMPLE_SIZE = 50
DEFAULT_MIN_FIELDS = 10
# ------------------------------------------------------------------------------

SEVERITY = {SKIP: 0, PASS: 1, WARN: 2, FAIL: 3}


def severity(status: Column) -> Column:
    return (F.when(status == FAIL, 3).when(status == WARN, 2).when(status == PASS, 1)
            .when(status == SKIP, 0))


def status_of(sev: Column) -> Column:
    return (F.when(sev == 3, F.lit(FAIL)).when(sev == 2, F.lit(WARN)).when(sev == 1, F.lit(PASS))
            .otherwise(F.lit(SKIP)))


# ---------------------------------------------------------------- A3 / A4 / P8

def facet_counts(df: DataFrame, field: str, q: Column | None = None, limit: int = -1,
                 sort: str = "index", ordered: bool = True) -> DataFrame:
    """``(value, count)`` of non-null values of ``field``.

    A multi-valued (array) field counts each distinct value once per row.
    ``sort='index'``: by value; ``'count'``: count desc then value. ``limit``
    -1 = all values; a top-k limit plans as TakeOrderedAndProject (no full sort).
    """
    src = df.filter(q) if q is not None else df
    col = F.col(f"`{field}`")
    if isinstance(df.schema[field].dataType, T.ArrayType):
        vals = src.select(F.explode(F.array_distinct(col)).alias("value"))
    else:
        vals = src.select(col.alias("value"))
    out = (vals.filter(F.col("value").isNotNull())
           .groupBy("value").agg(F.count(F.lit(1)).alias("count")))
    order = [F.col("value").asc()] if sort == "index" else [F.col("count").desc(), F.col("value").asc()]
    if limit is not None and limit >= 0:
        return out.orderBy(*order).limit(limit)  # TakeOrderedAndProject: no full sort
    return out.orderBy(*order) if ordered else out


def dataset_counts(df: DataFrame, dataset_col: str = "dataResourceUid") -> DataFrame:
    """A4: rows per dataset."""
    return (df.filter(F.col(dataset_col).isNotNull())
            .groupBy(F.col(dataset_col).alias("dataset_id")).agg(F.count(F.lit(1)).alias("count")))


def search(df: DataFrame, q: Column | None = None, fq: list[Column] | None = None,
           facet: str | None = None, page_size: int = 0, order: list[Column] | None = None):
    """Field:value search. Returns (count frame, page frame, facet frame or
    None). The page is the first ``page_size`` rows in ``order``; give one that
    ends in a unique column, without it any rows may make the page."""
    src = df.filter(q) if q is not None else df
    for f in fq or []:
        src = src.filter(f)
    count = src.agg(F.count(F.lit(1)).alias("count"))
    page = (src.orderBy(*order) if order else src).limit(page_size)
    fac = facet_counts(src, facet) if facet else None
    return count, page, fac


# ---------------------------------------------------------------- A2 / A5

def _two_counts(old: DataFrame, new: DataFrame, cond: Column | None = None) -> DataFrame:
    # one scan of each side and one global aggregate; no join
    o = (old.filter(cond) if cond is not None else old).select(F.lit(1).alias("_o"), F.lit(0).alias("_n"))
    n = (new.filter(cond) if cond is not None else new).select(F.lit(0).alias("_o"), F.lit(1).alias("_n"))
    return o.unionByName(n).agg(F.coalesce(F.sum("_o"), F.lit(0)).cast("bigint").alias("old_count"),
                                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("new_count"))


def check_total_count(old: DataFrame, new: DataFrame) -> DataFrame:
    """A2: FAIL when the new version has fewer rows, else PASS."""
    c = _two_counts(old, new)
    return c.select(F.lit("check_total_count").alias("check"), "old_count", "new_count",
                    (F.col("new_count") - F.col("old_count")).alias("diff"),
                    F.when(F.col("new_count") < F.col("old_count"), F.lit(FAIL)).otherwise(F.lit(PASS))
                    .alias("status"))


def asserted_count(df: DataFrame, field: str = "userAssertions") -> DataFrame:
    """A5: rows with assertions."""
    return df.agg(F.count(F.col(f"`{field}`")).cast("bigint").alias("asserted"))


def check_asserted(pre: DataFrame, post: DataFrame, field: str = "userAssertions") -> DataFrame:
    """A5: FAIL when fewer asserted rows than before (only when before > 0)."""
    c = _two_counts(pre, post, F.col(f"`{field}`").isNotNull())
    return c.select(F.lit("check_asserted").alias("check"), F.col("old_count").alias("pre_count"),
                    F.col("new_count").alias("post_count"),
                    F.when((F.col("old_count") > 0) & (F.col("new_count") < F.col("old_count")), F.lit(FAIL))
                    .otherwise(F.lit(PASS)).alias("status"))


# ---------------------------------------------------------------- J2

def facet_compare(old: DataFrame, new: DataFrame, field: str, check_size: int = -1,
                  fetch_size: int = -1, sort: str = "index") -> DataFrame:
    """Per old facet value: old/new counts, rounded drop percent, status.

    Old facet (top ``check_size``) left-joined to the new facet (top
    ``fetch_size``). Drop percent rounds half to even. Status: value absent in
    new → FAIL; drop > 2 % and not (old < 1000 and new > 0) → FAIL; new < old →
    WARN; else PASS. Both sides are aggregates, so the join is small.
    """
    o = facet_counts(old, field, limit=check_size, sort=sort, ordered=False).filter(F.col("count") > 0) \
        .select(F.col("value"), F.col("count").alias("old_count"))
    n = facet_counts(new, field, limit=fetch_size, sort=sort, ordered=False) \
        .select(F.col("value"), F.col("count").alias("new_count"))
    j = o.join(n, "value", "left")
    pct = F.bround((F.col("old_count") - F.col("new_count")).cast("double") / F.col("old_count") * 100.0, 0)
    severe = ~((F.col("old_count") < MIN_FACET_RECORD_COUNT) & (F.col("new_count") > 0))
    status = (F.when(F.col("new_count").isNull(), F.lit(FAIL))
              .when((pct > MAX_DROP_PCT) & severe, F.lit(FAIL))
              .when(F.col("new_count") < F.col("old_count"), F.lit(WARN))
              .otherwise(F.lit(PASS)))
    return j.select(F.lit(field).alias("field"), F.col("value").cast("string").alias("value"),
                    "old_count", "new_count", pct.cast("bigint").alias("drop_pct"), status.alias("status"))


ROWS_FIELD = "__rows__"


def facet_counts_many(df: DataFrame, fields: list[str], include_rows: bool = False) -> DataFrame:
    """A3 for several fields in one pass: ``(field, value, count)``.

    One scan of the fields and one shuffle for all of them (partial counts
    per map task), instead of one job per field. Values become text. With
    ``include_rows`` the row count rides along as field ``__rows__``."""
    parts = []
    for f in fields:
        c = F.col(f"`{f}`")
        if isinstance(df.schema[f].dataType, T.ArrayType):
            vals = F.array_distinct(c.cast("array<string>"))
        else:
            vals = F.array(c.cast("string"))
        parts.append(F.struct(F.lit(f).alias("field"), vals.alias("vals")))
    if include_rows:
        parts.append(F.struct(F.lit(ROWS_FIELD).alias("field"), F.array(F.lit("*")).alias("vals")))
    e = df.select(F.explode(F.array(*parts)).alias("p")).select(
        F.col("p.field").alias("field"), F.explode("p.vals").alias("value"))
    return (e.filter(F.col("value").isNotNull()).groupBy("field", "value")
            .agg(F.count(F.lit(1)).alias("count")))


def _limit_per_field(fc: DataFrame, specs: dict[str, tuple[int, str]], materialize: bool = True) -> DataFrame:
    """Top-k values per limited field: each is its own ``orderBy().limit(k)``
    (per-partition top-k, then a k-row merge); unlimited fields pass through."""
    limited = [f for f, (k, _) in specs.items() if k is not None and k >= 0]
    if not limited:
        return fc
    # one row per distinct value: written once, so the per-field top-k reads
    # it instead of re-running the facet scan and shuffle per field
    if materialize:
        ensure_checkpoint_dir(fc.sparkSession)
        fc = fc.checkpoint()
    out = fc.filter(~F.col("field").isin(limited))
    for f in limited:
        k, srt = specs[f]
        order = [F.col("value").asc()] if srt == "index" else [F.col("count").desc(), F.col("value").asc()]
        out = out.unionByName(fc.filter(F.col("field") == f).orderBy(*order).limit(k))
    return out


def facet_compare_many(old: DataFrame, new: DataFrame,
                       specs: list[tuple[str, int, int, str]]) -> DataFrame:
    """J2 for several fields at once: ``specs`` = (field, check_size,
    fetch_size, sort). One facet pass per side; same rule and output as
    :func:`facet_compare` (values compared as text)."""
    fields = [s[0] for s in specs]
    return facet_compare_counts(facet_counts_many(old, fields), facet_counts_many(new, fields), specs)


def facet_compare_counts(fc_old: DataFrame, fc_new: DataFrame,
                         specs: list[tuple[str, int, int, str]], materialized: bool = False) -> DataFrame:
    """J2 over precomputed ``(field, value, count)`` tables of both versions
    (``materialized``: they are already written, e.g. checkpointed)."""
    fields = [s[0] for s in specs]
    fc_old = fc_old.filter(F.col("field").isin(fields))
    fc_new = fc_new.filter(F.col("field").isin(fields))
    o = _limit_per_field(fc_old, {f: (cs, srt) for f, cs, _, srt in specs}, not materialized) \
        .select("field", "value", F.col("count").alias("old_count")).filter(F.col("old_count") > 0)
    n = _limit_per_field(fc_new, {f: (fs, srt) for f, _, fs, srt in specs}, not materialized) \
        .select("field", "value", F.col("count").alias("new_count"))
    j = o.join(n, ["field", "value"], "left")
    pct = F.bround((F.col("old_count") - F.col("new_count")).cast("double") / F.col("old_count") * 100.0, 0)
    severe = ~((F.col("old_count") < MIN_FACET_RECORD_COUNT) & (F.col("new_count") > 0))
    status = (F.when(F.col("new_count").isNull(), F.lit(FAIL))
              .when((pct > MAX_DROP_PCT) & severe, F.lit(FAIL))
              .when(F.col("new_count") < F.col("old_count"), F.lit(WARN))
              .otherwise(F.lit(PASS)))
    return j.select("field", "value", "old_count", "new_count", pct.cast("bigint").alias("drop_pct"),
                    status.alias("status"))


def total_count_from_facets(fc_old: DataFrame, fc_new: DataFrame) -> DataFrame:
    """A2 from the row counts carried by :func:`facet_counts_many` (``include_rows``)."""
    r = (fc_old.filter(F.col("field") == ROWS_FIELD).select(F.col("count").alias("_o"), F.lit(0).alias("_n"))
         .unionByName(fc_new.filter(F.col("field") == ROWS_FIELD).select(F.lit(0).alias("_o"),
                                                                          F.col("count").alias("_n"))))
    c = r.agg(F.coalesce(F.sum("_o"), F.lit(0)).cast("bigint").alias("old_count"),
              F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("new_count"))
    return c.select(F.lit("check_total_count").alias("check"), "old_count", "new_count",
                    (F.col("new_count") - F.col("old_count")).alias("diff"),
                    F.when(F.col("new_count") < F.col("old_count"), F.lit(FAIL)).otherwise(F.lit(PASS))
                    .alias("status"))


def facet_status(per_value: DataFrame, check: str | None = None) -> DataFrame:
    """Worst status of a J2 result; no old values → PASS."""
    agg = per_value.agg(F.max(severity(F.col("status"))).alias("_s"))
    return agg.select(F.lit(check).cast("string").alias("check") if check else F.lit("check_facet").alias("check"),
                      status_of(F.coalesce(F.col("_s"), F.lit(1))).alias("status"))


# ---------------------------------------------------------------- A7

def rollup_status(checks: DataFrame) -> DataFrame:
    """Worst status over checks; publish only without FAIL (WARN passes)."""
    agg = checks.agg(F.max(severity(F.col("status"))).alias("_s"),
                     F.count(F.lit(1)).alias("n_checks"),
                     F.count(F.when(F.col("status") == FAIL, 1)).alias("n_fail"),
                     F.count(F.when(F.col("status") == WARN, 1)).alias("n_warn"))
    return agg.select(status_of(F.coalesce(F.col("_s"), F.lit(1))).alias("status"),
                      F.col("n_checks").cast("bigint").alias("n_checks"),
                      F.col("n_fail").cast("bigint").alias("n_fail"),
                      F.col("n_warn").cast("bigint").alias("n_warn"),
                      (F.col("n_fail") == 0).alias("publish"))


# ---------------------------------------------------------------- A9

def field_fill(df: DataFrame, fields: list[str] | None = None) -> Column:
    """Number of non-null fields in a row (all columns by default)."""
    fields = fields if fields is not None else df.columns
    if not fields:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [F.col(f"`{f}`").isNotNull().cast("int") for f in fields])


# ---------------------------------------------------------------- W4

def _draw(i: Column, seed: int, a: int, b: int) -> Column:
    # integer hash of the draw number; reproducible in any SQL engine
    return F.pmod(i * F.lit(a) + F.lit(seed * b + 12345), F.lit(2147483647))


def sample_records(df: DataFrame, n: int = DEFAULT_SAMPLE_SIZE, seed: int = 42,
                   dataset_col: str = "dataResourceUid", id_col: str = "id",
                   max_offset: int = SAMPLE_OFFSET_CAP) -> DataFrame:
    """``n`` draws with replacement: a dataset uniformly among those with
    records (ordered by name), then an offset below ``min(count, max_offset)``
    into its records ordered by id (nulls first). Returns draw, dataset, offset, id.

    Only the drawn datasets' ``(dataset, id)`` columns are read, and only their
    first ``max_offset`` ids per dataset are kept (tree top-k with bounded
    groups), so a dataset holding a third of all rows is never sorted whole."""
    return sample_records_many(df, [(n, seed)], dataset_col, id_col, max_offset)[0]


def sample_records_many(df: DataFrame, specs: list[tuple[int, int]], dataset_col: str = "dataResourceUid",
                        id_col: str = "id", max_offset: int = SAMPLE_OFFSET_CAP) -> list[DataFrame]:
    """Several independent W4 samples ``(n, seed)`` from one dataset ranking
    and one top-k pass; the draws are materialised once (Σn rows)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    empty = "draw bigint, dataset_id string, offset bigint, id string"
    ds = dataset_counts(df, dataset_col)
    # one row per dataset; written to the checkpoint folder so the count and
    # the draws below read it instead of re-running the facet
    ds_ranked = with_global_rank(ds, [F.col("dataset_id").asc()], "ds_idx").checkpoint()
    n_ds = ds_ranked.count()  # one scalar
    if n_ds == 0:
        return [spark.createDataFrame([], empty) for _ in specs]
    draws = None
    for i, (n, seed) in enumerate(specs):
        d = spark.range(n).withColumnRenamed("id", "draw").withColumn("sample", F.lit(i)) \
            .withColumn("ds_idx", F.pmod(_draw(F.col("draw"), seed, 2654435761, 40503), F.lit(n_ds))) \
            .withColumn("_h2", _draw(F.col("draw"), seed, 1597334677, 69069))
        draws = d if draws is None else draws.unionByName(d)
    # the draws are Σn rows (bounded by the parameters); the dataset table is not
    draws = ds_ranked.join(F.broadcast(draws), "ds_idx") \
        .withColumn("offset", F.pmod(F.col("_h2"), F.least(F.col("count"), F.lit(max_offset))))
    drawn = draws.select("dataset_id").distinct()
    recs = df.select(F.col(dataset_col).alias("dataset_id"), F.col(id_col).cast("string").alias("id")) \
        .join(F.broadcast(drawn), "dataset_id", "left_semi")
    # offsets are below max_offset: only each drawn dataset's first max_offset
    # ids (by id) are needed — an exact tree top-k, never a sort of the dataset
    first_ids = smallest_per_group(recs, "dataset_id", "id", max_offset, rank_col="pos")
    want = draws.select("sample", "draw", "dataset_id", F.col("offset").alias("pos"), "offset")
    picked = first_ids.join(F.broadcast(want), ["dataset_id", "pos"]) \
        .select("sample", "draw", "dataset_id", "offset", "id").checkpoint()
    return [picked.filter(F.col("sample") == i).drop("sample") for i in range(len(specs))]


# ---------------------------------------------------------------- J4

def check_min_fields(sample: DataFrame, new: DataFrame, minimum: int = DEFAULT_MIN_FIELDS,
                     id_col: str = "id") -> DataFrame:
    """Each sampled id must be present exactly once in ``new`` with at
    least ``minimum`` non-null fields. A null or 'null' id fails.
    Output: draw, id, n_rows, n_fields, status."""
    ids = sample.select("draw", F.col("id").cast("string").alias("id"))
    fields = [c for c in new.columns]
    per_id = (new.select(F.col(id_col).cast("string").alias("_id"), field_fill(new, fields).alias("_nf"))
              .join(bounded_broadcast(ids.select(F.col("id").alias("_id")).distinct()), "_id", "left_semi")
              .groupBy("_id").agg(F.count(F.lit(1)).alias("n_rows"), F.max("_nf").alias("n_fields")))
    j = ids.join(per_id, ids["id"] == per_id["_id"], "left")
    n_rows = F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint")
    status = (F.when(is_null_id(F.col("id")), F.lit(FAIL))
              .when(n_rows != 1, F.lit(FAIL))
              .when(F.col("n_fields") < minimum, F.lit(FAIL))
              .otherwise(F.lit(PASS)))
    return j.select("draw", "id", n_rows.alias("n_rows"),
                    F.when(n_rows == 1, F.col("n_fields")).cast("bigint").alias("n_fields"),
                    status.alias("status"))


# ---------------------------------------------------------------- J3 / P13 / U2

def changed_values(new: Column, old: Column) -> Column:
    """Value present on both sides (null = absent) and different."""
    return new.isNotNull() & old.isNotNull() & ~new.eqNullSafe(old)


def compare_records(old: DataFrame, new: DataFrame, ids: DataFrame | None = None,
                    ignore: list[str] = ASSERTION_FIELDS, id_col: str = "id") -> DataFrame:
    """Per id, compare the old and new record field by field.

    FAIL: not exactly one row per side, or an old field (not ignored) missing
    in new. WARN: a changed value or an added field. Else PASS. Null counts as
    absent on both sides. Output: id, n_old, n_new, missing, changed, added
    (comma-joined field names) and status.

    Plan: rows per id are counted on each side with aggregates over the id
    column only; ids with exactly one row on both sides are joined one to
    one (rows are never grouped, and repeated ids are never paired — they
    fail on their counts). ``ids`` (e.g. a sample) is applied first with a
    bounded broadcast semi-join.
    """
    fields_o = [c for c in old.columns if c != id_col]
    fields_n = [c for c in new.columns if c != id_col]
    if ids is not None:
        keep = bounded_broadcast(ids.select(F.col("id").cast("string").alias("_k")).distinct())
        old = old.join(keep, F.col(id_col).cast("string") == keep["_k"], "left_semi")
        new = new.join(keep, F.col(id_col).cast("string") == keep["_k"], "left_semi")
    o = old.filter(F.col(id_col).isNotNull()).withColumn("_id", F.col(id_col).cast("string"))
    n = new.filter(F.col(id_col).isNotNull()).withColumn("_id", F.col(id_col).cast("string"))
    ensure_checkpoint_dir(new.sparkSession)
    # counts per id, written once: both sides' single rows and the result read them
    cnt = (o.groupBy("_id").agg(F.count(F.lit(1)).alias("n_old"))
           .join(n.groupBy("_id").agg(F.count(F.lit(1)).alias("n_new")), "_id", "full_outer")).checkpoint()
    single = cnt.filter((F.col("n_old") == 1) & (F.col("n_new") == 1)).select("_id")
    ro = o.join(single, "_id", "left_semi").select("_id", *[F.col(f"`{f}`").alias(f"o__{f}") for f in fields_o])
    rn = n.join(single, "_id", "left_semi").select("_id", *[F.col(f"`{f}`").alias(f"n__{f}") for f in fields_n])
    pairs = ro.join(rn, "_id")
    miss, chg, add = [], [], []
    ignore_l = {x.lower() for x in ignore}
    for f in sorted(set(fields_o) | set(fields_n)):
        ov = F.col(f"`o__{f}`") if f in fields_o else F.lit(None)
        nv = F.col(f"`n__{f}`") if f in fields_n else F.lit(None)
        if f in fields_o and f in fields_n and old.schema[f].dataType != new.schema[f].dataType:
            ov, nv = ov.cast("string"), nv.cast("string")
        if f.lower() not in ignore_l:
            miss.append(F.when(ov.isNotNull() & nv.isNull(), F.lit(f)))
        chg.append(F.when(changed_values(nv, ov), F.lit(f)))
        add.append(F.when(nv.isNotNull() & ov.isNull(), F.lit(f)))

    def names(xs):
        return F.array_join(F.array(*xs), ",") if xs else F.lit("")

    diffs = pairs.select("_id", names(miss).alias("missing"), names(chg).alias("changed"),
                         names(add).alias("added"))
    out = cnt.join(diffs, "_id", "left").select(
        F.col("_id").alias("id"), F.coalesce(F.col("n_old"), F.lit(0)).cast("bigint").alias("n_old"),
        F.coalesce(F.col("n_new"), F.lit(0)).cast("bigint").alias("n_new"), "missing", "changed", "added")
    status = (F.when(~((F.col("n_old") == 1) & (F.col("n_new") == 1)), F.lit(FAIL))
              .when(F.col("missing") != "", F.lit(FAIL))
              .when((F.col("changed") != "") | (F.col("added") != ""), F.lit(WARN))
              .otherwise(F.lit(PASS)))
    return out.withColumn("status", status)
