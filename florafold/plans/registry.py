"""Registered queries: one per operator group of the inventory.

Each query takes ``(spark, sf_dir)``, derives the reference's input shape
from the driver tables (``florafold.sources.derived``) and runs the operator
over the whole tables. ``ORACLE`` holds the matching DuckDB SQL.
Array results are shown as ``|``-joined text so both engines hash alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.operators import flatten as FL
from florafold.sources import derived as D

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def arrays_as_text(df: DataFrame, sep: str = "|") -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(f"`{f.name}`").cast("array<string>"), sep).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# ---------------------------------------------------------------- C1 flatten --
_INDEX_SQL = """
WITH j AS (
  SELECT o.*, c.c_nationkey, c.c_acctbal, c.c_mktsegment
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), r AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 5 THEN NULL
         WHEN o_orderkey % 53 = 7 THEN CAST(o_orderkey - 1 AS VARCHAR)
         ELSE CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'img-' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS multimedia,
    CASE WHEN o_orderkey % 9 = 0 THEN 'checked' END AS annotations,
    (o_orderkey % 31 = 0 OR o_orderkey % 37 = 0) AS s_absent,
    'dr' || CAST(c_nationkey AS VARCHAR) AS v_dataResourceUid,
    o_orderstatus AS v_orderStatus,
    o_orderpriority AS v_order_priority,
    c_mktsegment AS v_market_segment,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'c' || CAST(o_orderkey % 10 AS VARCHAR) END AS v_comment,
    CAST(year(o_orderdate) AS VARCHAR) AS v_year,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS totalPrice,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_acctbal END AS acctBal,
    c_nationkey AS Nation_Key,
    o_custkey AS custKey,
    o_orderpriority = '1-URGENT' AS urgent,
    CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400000 AS eventDate,
    [o_orderstatus, o_orderpriority] AS flags
  FROM j
), s AS (
  SELECT id, multimedia, annotations,
    CASE WHEN s_absent THEN NULL ELSE v_dataResourceUid END AS dataResourceUid,
    CASE WHEN s_absent THEN NULL ELSE v_orderStatus END AS orderStatus,
    CASE WHEN s_absent THEN NULL ELSE v_order_priority END AS order_priority,
    CASE WHEN s_absent THEN NULL ELSE v_market_segment END AS market_segment,
    CASE WHEN s_absent THEN NULL ELSE v_comment END AS comment,
    CASE WHEN s_absent THEN NULL ELSE v_year END AS year,
    totalPrice, acctBal, Nation_Key, custKey, urgent, eventDate, flags
  FROM r
)
SELECT id, multimedia, annotations,
  CASE WHEN id IS NULL THEN dataResourceUid ELSE min(dataResourceUid) OVER w END AS dataResourceUid,
  CASE WHEN id IS NULL THEN orderStatus ELSE min(orderStatus) OVER w END AS orderStatus,
  CASE WHEN id IS NULL THEN order_priority ELSE min(order_priority) OVER w END AS order_priority,
  CASE WHEN id IS NULL THEN market_segment ELSE min(market_segment) OVER w END AS market_segment,
  CASE WHEN id IS NULL THEN comment ELSE min(comment) OVER w END AS comment,
  CASE WHEN id IS NULL THEN year ELSE min(year) OVER w END AS year,
  CASE WHEN id IS NULL THEN totalPrice ELSE min(totalPrice) OVER w END AS totalPrice,
  CASE WHEN id IS NULL THEN acctBal ELSE min(acctBal) OVER w END AS acctBal,
  CASE WHEN id IS NULL THEN Nation_Key ELSE min(Nation_Key) OVER w END AS Nation_Key,
  CASE WHEN id IS NULL THEN custKey ELSE min(custKey) OVER w END AS custKey,
  CASE WHEN id IS NULL THEN urgent ELSE min(urgent) OVER w END AS urgent,
  CASE WHEN id IS NULL THEN eventDate ELSE min(eventDate) OVER w END AS eventDate,
  array_to_string(CASE WHEN id IS NULL THEN flags ELSE min(flags) OVER w END, '|') AS flags
FROM s
WINDOW w AS (PARTITION BY id)
"""


@register("flatten_index", _INDEX_SQL)
def q_flatten_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(FL.flatten_index(D.index_records(spark, sf_dir)))


@register("flatten_index_pivot", _INDEX_SQL)
def q_flatten_index_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(FL.flatten_index_pivot(D.index_records(spark, sf_dir)))


# ---------------------------------------------------------------- facets / checks
from florafold.operators import checks as CK  # noqa: E402

_OLD_IV = """SELECT CAST(event_id AS VARCHAR) AS id,
  'dr' || CAST(user_id % 25 AS VARCHAR) AS dataResourceUid, event_type AS country,
  'state' || CAST(user_id % 7 AS VARCHAR) AS stateProvince,
  CASE WHEN event_id % 10 = 0 THEN 'generalised' END AS sensitive,
  CASE WHEN user_id % 3 = 0 THEN 'Endangered' WHEN user_id % 3 = 1 THEN 'Vulnerable' END AS stateConservation,
  ['sl' || CAST(user_id % 5 AS VARCHAR), 'sl' || CAST(event_id % 3 AS VARCHAR)] AS speciesListUid,
  'lga' || CAST(user_id % 11 AS VARCHAR) AS cl959, 'ibra' || CAST(event_id % 13 AS VARCHAR) AS cl1048,
  'meso' || CAST(user_id % 4 AS VARCHAR) AS cl966, 'imcra' || CAST(event_id % 2 AS VARCHAR) AS cl21,
  event_type, value, CASE WHEN event_id % 50 = 0 THEN 'flagged' END AS userAssertions
FROM events"""

_NEW_IV = """SELECT CAST(event_id AS VARCHAR) AS id,
  'dr' || CAST(user_id % 25 AS VARCHAR) AS dataResourceUid, event_type AS country,
  'state' || CAST(user_id % 7 AS VARCHAR) AS stateProvince,
  CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 10 = 0 THEN 'generalised' END AS sensitive,
  CASE WHEN user_id % 3 = 0 THEN 'Endangered' WHEN user_id % 3 = 1 THEN 'Vulnerable' END AS stateConservation,
  ['sl' || CAST(user_id % 5 AS VARCHAR), 'sl' || CAST(event_id % 3 AS VARCHAR)] AS speciesListUid,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'lga' || CAST(user_id % 11 AS VARCHAR) END AS cl959,
  CASE WHEN event_id % 13 = 1 THEN 'ibra_x' ELSE 'ibra' || CAST(event_id % 13 AS VARCHAR) END AS cl1048,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'meso' || CAST(user_id % 4 AS VARCHAR) END AS cl966,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE 'imcra' || CAST(event_id % 2 AS VARCHAR) END AS cl21,
  event_type, value, CAST(NULL AS VARCHAR) AS userAssertions,
  CASE WHEN event_id % 19 = 0 THEN 'x' END AS extra
FROM (SELECT * FROM events WHERE event_id % 37 <> 0
      UNION ALL SELECT * FROM events WHERE event_id % 37 <> 0 AND event_id % 41 = 0)"""

IV_FIELDS_OLD = ["id", "dataResourceUid", "country", "stateProvince", "sensitive", "stateConservation",
                 "speciesListUid", "cl959", "cl1048", "cl966", "cl21", "event_type", "value", "userAssertions"]
IV_FIELDS_NEW = IV_FIELDS_OLD + ["extra"]
MULTI_VALUED = {"speciesListUid"}


def _iv_ctes() -> str:
    return f"old_iv AS ({_OLD_IV}), new_iv AS ({_NEW_IV})"


def sql_facet(rel: str, field: str, limit: int = -1, sort: str = "index") -> str:
    if field in MULTI_VALUED:
        vals = f"SELECT unnest(list_distinct({field})) AS value FROM {rel}"
    else:
        vals = f"SELECT {field} AS value FROM {rel}"
    order = "value ASC" if sort == "index" else "cnt DESC, value ASC"
    lim = f" LIMIT {limit}" if limit >= 0 else ""
    return (f"SELECT value, count(*) AS cnt FROM ({vals}) v WHERE value IS NOT NULL "
            f"GROUP BY value ORDER BY {order}{lim}")


def sql_facet_compare(field: str, check_size: int = -1, fetch_size: int = -1, sort: str = "index",
                      old: str = "old_iv", new: str = "new_iv") -> str:
    pct = "round_even(CAST(o.cnt - n.cnt AS DOUBLE) / o.cnt * 100, 0)"
    return f"""SELECT '{field}' AS field, CAST(o.value AS VARCHAR) AS value,
  CAST(o.cnt AS BIGINT) AS old_count, CAST(n.cnt AS BIGINT) AS new_count,
  CAST({pct} AS BIGINT) AS drop_pct,
  CASE WHEN n.cnt IS NULL THEN 'FAIL'
       WHEN {pct} > 2 AND NOT (o.cnt < 1000 AND n.cnt > 0) THEN 'FAIL'
       WHEN n.cnt < o.cnt THEN 'WARN' ELSE 'PASS' END AS status
FROM ({sql_facet(old, field, check_size, sort)}) o
LEFT JOIN ({sql_facet(new, field, fetch_size, sort)}) n ON o.value = n.value
WHERE o.cnt > 0"""


@register("facet_counts_index", """
SELECT event_type AS value, CAST(count(*) AS BIGINT) AS count FROM events
WHERE event_type IS NOT NULL GROUP BY event_type""")
def q_facet_counts_index(spark, sf_dir):
    return CK.facet_counts(D.load_table(spark, sf_dir, "events"), "event_type")


@register("facet_counts_topk", """
SELECT o_custkey AS value, CAST(count(*) AS BIGINT) AS count FROM orders
WHERE o_custkey IS NOT NULL GROUP BY o_custkey ORDER BY count DESC, value ASC LIMIT 10""")
def q_facet_counts_topk(spark, sf_dir):
    return CK.facet_counts(D.load_table(spark, sf_dir, "orders"), "o_custkey", limit=10, sort="count")


@register("facet_counts_multivalued", """
SELECT value, CAST(count(*) AS BIGINT) AS count FROM
  (SELECT DISTINCT l_orderkey, l_returnflag AS value FROM lineitem WHERE l_returnflag IS NOT NULL) d
GROUP BY value""")
def q_facet_counts_multivalued(spark, sf_dir):
    li = D.load_table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("flags"))
    return CK.facet_counts(per_order, "flags")


@register("dataset_counts", f"""
WITH {_iv_ctes()}
SELECT dataResourceUid AS dataset_id, CAST(count(*) AS BIGINT) AS count FROM old_iv
WHERE dataResourceUid IS NOT NULL GROUP BY 1""")
def q_dataset_counts(spark, sf_dir):
    return CK.dataset_counts(D.index_version(spark, sf_dir, "old"))


@register("search_count", """
SELECT CAST(count(*) AS BIGINT) AS count FROM events WHERE event_type = 'click' AND value > 50""")
def q_search_count(spark, sf_dir):
    ev = D.load_table(spark, sf_dir, "events")
    cnt, _, _ = CK.search(ev, q=F.col("event_type") == "click", fq=[F.col("value") > 50])
    return cnt


@register("facet_compare_all", f"WITH {_iv_ctes()} {sql_facet_compare('dataResourceUid')}")
def q_facet_compare_all(spark, sf_dir):
    return CK.facet_compare(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"),
                            "dataResourceUid")


@register("facet_compare_topk", f"WITH {_iv_ctes()} {sql_facet_compare('cl1048', 10, 100, 'count')}")
def q_facet_compare_topk(spark, sf_dir):
    return CK.facet_compare(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"),
                            "cl1048", 10, 100, "count")


@register("facet_compare_multivalued",
          f"WITH {_iv_ctes()} {sql_facet_compare('speciesListUid', 100, 100, 'count')}")
def q_facet_compare_multivalued(spark, sf_dir):
    return CK.facet_compare(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"),
                            "speciesListUid", 100, 100, "count")


@register("check_total_count", f"""
WITH {_iv_ctes()}, c AS (SELECT (SELECT count(*) FROM old_iv) AS o, (SELECT count(*) FROM new_iv) AS n)
SELECT 'check_total_count' AS "check", CAST(o AS BIGINT) AS old_count, CAST(n AS BIGINT) AS new_count,
  CAST(n - o AS BIGINT) AS diff, CASE WHEN n < o THEN 'FAIL' ELSE 'PASS' END AS status FROM c""")
def q_check_total_count(spark, sf_dir):
    return CK.check_total_count(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"))


@register("check_asserted", f"""
WITH {_iv_ctes()}, c AS (SELECT (SELECT count(userAssertions) FROM old_iv) AS o,
                              (SELECT count(userAssertions) FROM new_iv) AS n)
SELECT 'check_asserted' AS "check", CAST(o AS BIGINT) AS pre_count, CAST(n AS BIGINT) AS post_count,
  CASE WHEN o > 0 AND n < o THEN 'FAIL' ELSE 'PASS' END AS status FROM c""")
def q_check_asserted(spark, sf_dir):
    return CK.check_asserted(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"))


def sql_sample(rel: str = "old_iv", n: int = 50, seed: int = 42, sfx: str = "") -> str:
    out = f"""ds AS (SELECT dataResourceUid AS dataset_id, count(*) AS cnt,
                 row_number() OVER (ORDER BY dataResourceUid) - 1 AS ds_idx
          FROM {rel} WHERE dataResourceUid IS NOT NULL GROUP BY 1),
nds AS (SELECT count(*) AS n FROM ds),
draws AS (SELECT r.range AS draw,
            ((r.range * 2654435761 + {seed * 40503 + 12345}) % 2147483647) % nds.n AS ds_idx,
            ((r.range * 1597334677 + {seed * 69069 + 12345}) % 2147483647) AS h2
          FROM range({n}) r, nds),
picks AS (SELECT d.draw, ds.dataset_id, d.h2 % least(ds.cnt, 20000) AS "offset"
          FROM draws d JOIN ds ON d.ds_idx = ds.ds_idx),
recs AS (SELECT dataResourceUid AS dataset_id, CAST(id AS VARCHAR) AS id,
           row_number() OVER (PARTITION BY dataResourceUid ORDER BY CAST(id AS VARCHAR) ASC NULLS FIRST) - 1 AS pos
         FROM {rel} WHERE dataResourceUid IN (SELECT dataset_id FROM picks)),
sample AS (SELECT p.draw, p.dataset_id, CAST(p."offset" AS BIGINT) AS "offset", r.id
           FROM picks p JOIN recs r ON r.dataset_id = p.dataset_id AND r.pos = p."offset")"""
    if sfx:
        for name in ("nds", "ds", "draws", "picks", "recs", "sample"):
            import re as _re
            out = _re.sub(rf"\b{name}\b", name + sfx, out)
    return out


@register("sample_records", f"WITH {_iv_ctes()}, {sql_sample()} SELECT * FROM sample")
def q_sample_records(spark, sf_dir):
    return CK.sample_records(D.index_version(spark, sf_dir, "old"), n=50, seed=42)


def _fill_sql(fields: list[str]) -> str:
    return " + ".join(f"CAST({f} IS NOT NULL AS INTEGER)" for f in fields)


def sql_min_fields(sample: str = "sample") -> str:
    return f"""
per_id AS (SELECT id AS _id, count(*) AS n_rows, max({_fill_sql(IV_FIELDS_NEW)}) AS n_fields
           FROM new_iv WHERE id IN (SELECT id FROM {sample}) GROUP BY id),
min_fields AS (
  SELECT s.draw, s.id, CAST(coalesce(p.n_rows, 0) AS BIGINT) AS n_rows,
    CAST(CASE WHEN coalesce(p.n_rows, 0) = 1 THEN p.n_fields END AS BIGINT) AS n_fields,
    CASE WHEN s.id IS NULL OR lower(s.id) = 'null' THEN 'FAIL'
         WHEN coalesce(p.n_rows, 0) <> 1 THEN 'FAIL'
         WHEN p.n_fields < 10 THEN 'FAIL' ELSE 'PASS' END AS status
  FROM {sample} s LEFT JOIN per_id p ON s.id = p._id)"""


@register("check_min_fields", f"WITH {_iv_ctes()}, {sql_sample()}, {sql_min_fields()} SELECT * FROM min_fields")
def q_check_min_fields(spark, sf_dir):
    old = D.index_version(spark, sf_dir, "old")
    new = D.index_version(spark, sf_dir, "new")
    return CK.check_min_fields(CK.sample_records(old, n=50, seed=42), new, minimum=10)


def sql_compare_records(ids_filter: str = "") -> str:
    both = sorted(set(IV_FIELDS_OLD) | set(IV_FIELDS_NEW) - {"id"})
    fo, fn = set(IV_FIELDS_OLD), set(IV_FIELDS_NEW)
    ign = {x.lower() for x in CK.ASSERTION_FIELDS}

    def ov(f):
        return f"o.r_{f}" if f in fo else "NULL"

    def nv(f):
        return f"n.r_{f}" if f in fn else "NULL"

    miss = [f"CASE WHEN {ov(f)} IS NOT NULL AND {nv(f)} IS NULL THEN '{f}' END"
            for f in both if f.lower() not in ign and f != "id"]
    chg = [f"CASE WHEN {nv(f)} IS NOT NULL AND {ov(f)} IS NOT NULL AND {nv(f)} IS DISTINCT FROM {ov(f)} "
           f"THEN '{f}' END" for f in both if f != "id"]
    add = [f"CASE WHEN {nv(f)} IS NOT NULL AND {ov(f)} IS NULL THEN '{f}' END" for f in both if f != "id"]

    def names(xs):
        return f"array_to_string(list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL), ',')"

    def side(rel, fields, tag):
        cols = ", ".join(f"first({f}) AS r_{f}" for f in fields if f != "id")
        return (f"SELECT id, count(*) AS n_{tag}, {cols} FROM {rel} WHERE id IS NOT NULL {ids_filter} "
                f"GROUP BY id")

    return f"""cmp AS (
  SELECT coalesce(o.id, n.id) AS id,
    CAST(coalesce(o.n_old, 0) AS BIGINT) AS n_old, CAST(coalesce(n.n_new, 0) AS BIGINT) AS n_new,
    CASE WHEN o.n_old = 1 AND n.n_new = 1 THEN {names(miss)} END AS missing,
    CASE WHEN o.n_old = 1 AND n.n_new = 1 THEN {names(chg)} END AS changed,
    CASE WHEN o.n_old = 1 AND n.n_new = 1 THEN {names(add)} END AS added
  FROM ({side('old_iv', IV_FIELDS_OLD, 'old')}) o
  FULL OUTER JOIN ({side('new_iv', IV_FIELDS_NEW, 'new')}) n ON o.id = n.id),
cmp_status AS (SELECT *, CASE WHEN NOT (n_old = 1 AND n_new = 1) THEN 'FAIL'
    WHEN missing <> '' THEN 'FAIL' WHEN changed <> '' OR added <> '' THEN 'WARN' ELSE 'PASS' END AS status
  FROM cmp)"""


@register("compare_records", f"WITH {_iv_ctes()}, {sql_compare_records()} SELECT * FROM cmp_status")
def q_compare_records(spark, sf_dir):
    return CK.compare_records(D.index_version(spark, sf_dir, "old"), D.index_version(spark, sf_dir, "new"))


# ---------------------------------------------------------------- J3 / U2 whole versions, T2 top-k in two phases
from florafold.operators import digests as DG  # noqa: E402
from florafold.operators import topk as TK  # noqa: E402

# the new version differs from the old one in the datasets of three users out of 25
_TOUCHED = "(SELECT CAST(event_id AS VARCHAR) FROM events WHERE user_id % 25 < 3)"


def _two_versions(spark, sf_dir):
    old, new = (D.index_version(spark, sf_dir, w) for w in ("old", "new"))
    touched = F.col("dataResourceUid").isin("dr0", "dr1", "dr2")
    return old, new.where(touched).unionByName(old.where(~touched), allowMissingColumns=True)


@register("compare_versions", f"""WITH {_iv_ctes()}, {sql_compare_records(f"AND id IN {_TOUCHED}")}
SELECT *, CASE WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed' WHEN n_old = 1 AND n_new = 1 THEN 'changed'
  ELSE 'repeated' END AS kind FROM cmp_status WHERE status <> 'PASS'""")
def q_compare_versions(spark, sf_dir):
    return DG.compare_versions(*_two_versions(spark, sf_dir))


@register("changed_datasets", f"""WITH {_iv_ctes()}, {sql_compare_records(f"AND id IN {_TOUCHED}")},
hit AS (SELECT DISTINCT o.dataResourceUid AS dataset FROM cmp_status c JOIN old_iv o ON c.id = o.id WHERE status <> 'PASS'),
o AS (SELECT dataResourceUid AS dataset, count(*) AS n FROM old_iv GROUP BY 1),
n AS (SELECT dataResourceUid AS dataset, count(*) AS n FROM new_iv GROUP BY 1)
SELECT dataset, CAST(o.n AS BIGINT) AS n_old,
  CAST(CASE WHEN dataset IN ('dr0', 'dr1', 'dr2') THEN coalesce(n.n, 0) ELSE o.n END AS BIGINT) AS n_new,
  dataset NOT IN (SELECT dataset FROM hit) AS same
FROM o LEFT JOIN n USING (dataset)""")
def q_changed_datasets(spark, sf_dir):
    old, new = _two_versions(spark, sf_dir)
    return DG.changed_datasets(DG.digest_tables(old, new))


@register("facet_topk_two_phases", """
SELECT l_partkey AS value, CAST(count(*) AS BIGINT) AS count FROM lineitem
WHERE l_partkey IS NOT NULL GROUP BY 1 ORDER BY count DESC, value LIMIT 25""")
def q_facet_topk_two_phases(spark, sf_dir):
    return TK.facet_topk(D.load_table(spark, sf_dir, "lineitem"), "l_partkey", 25)


# ---------------------------------------------------------------- C2 publish / retention
from florafold.operators import retention as RT  # noqa: E402
from florafold.plans import publish as PB  # noqa: E402


def _sql_worst(inner: str, check: str, empty: str = "PASS") -> str:
    sev = {"SKIP": 0, "PASS": 1, "WARN": 2, "FAIL": 3}[empty]
    return f"""SELECT '{check}' AS "check",
  CASE coalesce(max(CASE status WHEN 'FAIL' THEN 3 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 1 ELSE 0 END), {sev})
    WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' WHEN 1 THEN 'PASS' ELSE 'SKIP' END AS status
FROM ({inner}) x"""


def sql_checks() -> str:
    parts = [_sql_worst(sql_facet_compare(f, cs, fs, srt), name) for name, f, cs, fs, srt in PB.FACET_CHECKS]
    parts.append("""SELECT 'check_total_count' AS "check",
  CASE WHEN (SELECT count(*) FROM new_iv) < (SELECT count(*) FROM old_iv) THEN 'FAIL' ELSE 'PASS' END AS status""")
    parts.append(_sql_worst("SELECT status FROM min_fields", "check_min_fields_for_random_records", "FAIL"))
    parts.append(_sql_worst("""SELECT status FROM cmp_status
        UNION ALL SELECT 'FAIL' AS status FROM sample_c WHERE id IS NULL OR lower(id) = 'null'""",
                            "check_compare_random_records", "FAIL"))
    ctes = (f"{_iv_ctes()}, {sql_sample()}, {sql_min_fields()}, {sql_sample(seed=43, sfx='_c')}, "
            f"{sql_compare_records('AND id IN (SELECT id FROM sample_c)')}")
    return f"WITH {ctes}, checks AS ({' UNION ALL '.join(parts)})"


def _validate(spark, sf_dir):
    old = D.index_version(spark, sf_dir, "old")
    new = D.index_version(spark, sf_dir, "new")
    return PB.validate_and_publish(old, new, "occindex", "occindex-2024-06-30-10-05")


@register("validate_checks", f"{sql_checks()} SELECT * FROM checks")
def q_validate_checks(spark, sf_dir):
    return _validate(spark, sf_dir)[0]


@register("validate_checks_missing_field", f"""{sql_checks()}
SELECT "check", CASE WHEN "check" IN ('check_spatial_layer_country', 'check_sensitivity') THEN 'FAIL' ELSE status END AS status
FROM checks WHERE "check" IN ('check_spatial_layer_country', 'check_sensitivity', 'check_data_resources', 'check_total_count')""")
def q_validate_checks_missing_field(spark, sf_dir):
    """A field that the new version (or the old one) lacks can't pass its check."""
    old = D.index_version(spark, sf_dir, "old").drop("sensitive")
    new = D.index_version(spark, sf_dir, "new").drop("country")
    return PB.run_checks(old, new, ["check_spatial_layer_country", "check_sensitivity", "check_data_resources", "check_total_count"])


_ROLLUP_SQL = """SELECT CASE max(CASE status WHEN 'FAIL' THEN 3 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 1 ELSE 0 END)
    WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' WHEN 1 THEN 'PASS' ELSE 'SKIP' END AS status,
  CAST(count(*) AS BIGINT) AS n_checks,
  CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS n_fail,
  CAST(count(*) FILTER (WHERE status = 'WARN') AS BIGINT) AS n_warn,
  count(*) FILTER (WHERE status = 'FAIL') = 0 AS publish
FROM checks"""


@register("rollup_status", f"{sql_checks()} {_ROLLUP_SQL}")
def q_rollup_status(spark, sf_dir):
    return _validate(spark, sf_dir)[1]


@register("publish_decision", f"""{sql_checks()}, roll AS ({_ROLLUP_SQL})
SELECT 'occindex' AS alias, 'occindex-2024-06-30-10-05' AS version, status AS checks_status,
  CASE WHEN publish THEN 'switch' ELSE 'blocked' END AS action,
  CASE WHEN publish THEN 'PASS' ELSE 'FAIL' END AS status FROM roll""")
def q_publish_decision(spark, sf_dir):
    return _validate(spark, sf_dir)[2]


@register("publish_versions", """WITH v AS (SELECT event_id % 3 AS k, count(*) AS n FROM events GROUP BY 1)
SELECT CAST(number AS BIGINT) AS number, 'occindex-2024-0' || CAST(k + 1 AS VARCHAR) || '-01-00-00' AS version, action,
  number = 5 AS live, CAST((SELECT n FROM v WHERE v.k = c.k) AS BIGINT) AS n_rows, w5
FROM (VALUES (1, 0, 'publish', 'delete'), (2, 1, 'publish', NULL), (4, 2, 'publish', 'keep'), (5, 1, 'roll back', NULL)) c(number, k, action, w5)""")
def q_publish_versions(spark, sf_dir):
    """Three versions of the events published, a publisher that comes too late, a broken commit, a
    roll-back, W5 after it; per commit its version, whether readers follow it, and the rows of its data."""
    from florafold.plans import commits as CM
    root, alias = scratch_dir(spark, "publish"), "occindex"
    e = D.load_table(spark, sf_dir, "events")
    name = lambda k: f"occindex-2024-0{k + 1}-01-00-00"
    for k in (0, 1):
        CM.publish(e.where(F.col("event_id") % 3 == k), root, alias, name(k))
    try:  # its decision rests on commit 1
        CM.publish(e.limit(1), root, alias, name(7), base=1)
        raise AssertionError("two publishers won")
    except CM.PublishConflict:
        pass
    fs, p = CM._fs(spark, f"{root}/commits/{alias}/{3:020d}.json")
    fs.create(p, False).close()  # a publisher that crashed
    CM.publish(e.where(F.col("event_id") % 3 == 2), root, alias, name(2))
    CM.roll_back(spark, root, alias, name(1))
    log, stale = CM.history(spark, root, alias), CM.stale_versions(spark, root, alias)
    # rows of each version's folder: read from the data the commits name
    data = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("folder")).groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"))
    log = log.withColumn("folder", F.substring_index("path", "/", -1)).join(data, "folder", "left")
    return log.join(stale.select(F.col("name").alias("version"), F.col("action").alias("w5")), "version", "left").select(
        "number", "version", "action", (F.col("number") == CM.current(spark, root, alias)["number"]).alias("live"), "n_rows", "w5")


_VERSIONS_SQL = """v AS (SELECT DISTINCT CASE WHEN day(o_orderdate) % 5 = 0
      THEN 'occindex_' || strftime(o_orderdate, '%d_%m_%H_%M_%S')
      ELSE 'occindex-' || strftime(o_orderdate, '%Y-%m-%d-%H-%M') END AS name FROM orders)"""
PROTECTED = ["occindex-1999-01-02-00-00"]
LIVE = "occindex-2001-07-31-00-00"


@register("retain_versions", f"""WITH {_VERSIONS_SQL},
c AS (SELECT name FROM v WHERE regexp_matches(name, '^occindex-[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}$')
        AND name NOT IN ('{PROTECTED[0]}', '{LIVE}'))
SELECT name, CAST(row_number() OVER (ORDER BY name DESC) - 1 AS BIGINT) AS rank,
  CASE WHEN row_number() OVER (ORDER BY name DESC) - 1 < 1 THEN 'keep' ELSE 'delete' END AS action FROM c""")
def q_retain_versions(spark, sf_dir):
    return RT.retain_versions(D.version_names(spark, sf_dir), "occindex", keep=1,
                              protected=PROTECTED, live=LIVE)


@register("remove_all_except", f"""WITH {_VERSIONS_SQL}
SELECT name, 'delete' AS action FROM v WHERE name <> 'occindex_05_01_00_00_00'
  AND regexp_matches(name, 'occindex_[0-9]{{2}}_[0-9]{{2}}_[0-9]{{2}}_[0-9]{{2}}_[0-9]{{2}}')""")
def q_remove_all_except(spark, sf_dir):
    return RT.remove_all_except(D.version_names(spark, sf_dir), "occindex", "occindex_05_01_00_00_00")


@register("retain_by_size", """WITH d AS (
  SELECT 'occindex-' || strftime(o_orderdate, '%Y-%m-%d-%H-%M') AS name,
         CAST(count(*) * 1000000 + sum(o_custkey) AS BIGINT) AS size FROM orders GROUP BY o_orderdate),
b AS (SELECT * FROM d WHERE size > 3000000)
SELECT name, size, CAST(row_number() OVER (ORDER BY name DESC) - 1 AS BIGINT) AS rank,
  CASE WHEN row_number() OVER (ORDER BY name DESC) - 1 < 4 THEN 'keep' ELSE 'delete' END AS action FROM b""")
def q_retain_by_size(spark, sf_dir):
    return RT.retain_by_size(D.version_dirs(spark, sf_dir))


# ---------------------------------------------------------------- catalogue / planning
from florafold.operators import planning as PL  # noqa: E402
from florafold.sources import catalog as CT  # noqa: E402

EXCLUDED = ["dr3", "dr7"]

_INV_SQL = """o AS (SELECT o_orderkey AS k, o_custkey AS c,
    CASE WHEN o_custkey % 13 = 0 THEN 'dataset' || CAST(o_custkey AS VARCHAR)
         ELSE 'dr' || CAST(o_custkey AS VARCHAR) END AS ds,
    TIMESTAMP '2024-01-01 00:00:00' + (o_orderkey % 30) * INTERVAL 1 DAY
      + ((o_orderkey * 7919) % 86400) * INTERVAL 1 SECOND AS mod
  FROM orders),
inv AS (
  SELECT CASE WHEN k % 3 = 0 THEN 'pipelines-all-datasets/index-record/' || ds || '/' || ds || '-' || CAST(k AS VARCHAR) || '-of-99999.avro'
              ELSE 'pipelines-data/' || ds || '/1/verbatim/verbatim-' || CAST(k AS VARCHAR) || '-of-99999.avro' END AS key,
         CAST(k % 1000 + 1 AS BIGINT) AS size, mod AS modified FROM o WHERE k % 3 <> 2
  UNION ALL SELECT 'dwca-imports/' || ds || '/' || ds || '.zip', CAST(sum(k % 1000 + 1) * 1000 AS BIGINT), max(mod)
    FROM o GROUP BY c, ds
  UNION ALL SELECT 'dwca-imports/' || ds || '/notes.txt', CAST(10 AS BIGINT), max(mod) FROM o WHERE c % 7 = 0 GROUP BY c, ds
  UNION ALL SELECT 'pipelines-data/' || ds || '/1/interpretation-metrics.yml', CAST(c % 50 + 100 AS BIGINT), max(mod)
    FROM o WHERE k % 3 = 2 GROUP BY c, ds)"""


def sql_dataset_sizes(profile: str, lo: str | None = None, hi: str | None = None, excluded=()) -> str:
    prefix, regex, sub = CT.PROFILES[profile]
    iso = "strftime(modified, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
    conds = ["regexp_matches(dataset_id, '^dr[0-9]+$')",
             f"starts_with(key, '{prefix}' || dataset_id || '/{sub}')", f"regexp_matches(key, '{regex}')"]
    if excluded:
        conds.append("dataset_id NOT IN (" + ", ".join(f"'{e}'" for e in excluded) + ")")
    if lo:
        conds.append(f"{iso} >= '{lo}'")
    if hi:
        conds.append(f"{iso} <= '{hi}'")
    return f"""SELECT dataset_id, CAST(sum(size) AS BIGINT) AS size FROM (
  SELECT *, CASE WHEN starts_with(key, '{prefix}')
                 THEN regexp_extract(substr(key, {len(prefix) + 1}), '^([^/]+)/', 1) ELSE '' END AS dataset_id
  FROM inv) d WHERE {' AND '.join(conds)} GROUP BY dataset_id"""


@register("dataset_sizes", f"WITH {_INV_SQL} {sql_dataset_sizes('dwca', excluded=EXCLUDED)}")
def q_dataset_sizes(spark, sf_dir):
    return CT.catalog(D.inventory(spark, sf_dir), "dwca", excluded=EXCLUDED)


@register("catalog_index", f"WITH {_INV_SQL} {sql_dataset_sizes('index_avro', '2024-01-05', '2024-01-20')}")
def q_catalog_index(spark, sf_dir):
    return CT.catalog(D.inventory(spark, sf_dir), "index_avro", time_range=("2024-01-05", "2024-01-20"))


@register("catalog_verbatim", f"WITH {_INV_SQL} {sql_dataset_sizes('verbatim_avro')}")
def q_catalog_verbatim(spark, sf_dir):
    return CT.catalog(D.inventory(spark, sf_dir), "verbatim_avro")


@register("catalog_ingested_since", f"WITH {_INV_SQL} {sql_dataset_sizes('ingested_since', '2024-01-10')}")
def q_catalog_ingested_since(spark, sf_dir):
    return CT.catalog(D.inventory(spark, sf_dir), "ingested_since", time_range=("2024-01-10", None))


@register("named_dataset_sizes", f"""WITH {_INV_SQL},
ids AS (SELECT DISTINCT 'dr' || CAST(c_custkey AS VARCHAR) AS dataset_id FROM customer WHERE c_nationkey = 5),
d AS (SELECT *, CASE WHEN starts_with(key, 'dwca-imports/')
        THEN regexp_extract(substr(key, 14), '^([^/]+)/', 1) ELSE '' END AS dataset_id FROM inv)
SELECT dataset_id, CAST(sum(size) AS BIGINT) AS size FROM d
WHERE dataset_id IN (SELECT dataset_id FROM ids)
  AND starts_with(key, 'dwca-imports/' || dataset_id || '/' || dataset_id || '.zip')
GROUP BY dataset_id""")
def q_named_dataset_sizes(spark, sf_dir):
    c = D.load_table(spark, sf_dir, "customer")
    ids = c.filter(F.col("c_nationkey") == 5).select(
        F.concat(F.lit("dr"), F.col("c_custkey").cast("string")).alias("dataset_id"))
    return CT.named_dataset_sizes(D.inventory(spark, sf_dir), ids)


_PART_SIZES_SQL = """ps AS (SELECT 'dr' || CAST(p_partkey AS VARCHAR) AS dataset_id,
  CAST((p_partkey % 101) * p_size * 1000000 AS BIGINT) AS size FROM part)"""
_CLASS_SQL = "CASE WHEN size <= 5000000 THEN 'small' WHEN size < 5000000000 THEN 'large' ELSE 'xlarge' END"


def _part_sizes(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("dr"), F.col("p_partkey").cast("string")).alias("dataset_id"),
                    ((F.col("p_partkey") % 101) * F.col("p_size") * 1000000).cast("bigint").alias("size"))


@register("size_class", f"WITH {_PART_SIZES_SQL} SELECT dataset_id, size, {_CLASS_SQL} AS size_class FROM ps")
def q_size_class(spark, sf_dir):
    return _part_sizes(spark, sf_dir).withColumn("size_class", PL.size_class("size"))


@register("size_class_as_batches", f"""WITH {_PART_SIZES_SQL}
SELECT {_CLASS_SQL} AS size_class,
  CAST(row_number() OVER (PARTITION BY {_CLASS_SQL} ORDER BY size DESC, dataset_id ASC) - 1 AS BIGINT) AS position,
  dataset_id, size FROM ps""")
def q_size_class_as_batches(spark, sf_dir):
    return PL.size_class_as_batches(_part_sizes(spark, sf_dir))


@register("workload_class", """SELECT CAST(max(n) AS BIGINT) AS max_count,
  CASE WHEN max(n) > 20 THEN 'xlarge' ELSE 'small' END AS workload
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) t""")
def q_workload_class(spark, sf_dir):
    counts = D.load_table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("count"))
    return PL.workload_class(counts, 20)


@register("dispatch_mode", """SELECT s_nationkey AS nation, CAST(count(*) AS BIGINT) AS n,
  CASE WHEN count(*) = 0 THEN 'skip' WHEN count(*) > 3 THEN 'batch' ELSE 'direct' END AS mode
FROM supplier GROUP BY s_nationkey""")
def q_dispatch_mode(spark, sf_dir):
    s = D.load_table(spark, sf_dir, "supplier")
    g = s.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.withColumn("mode", PL.dispatch_mode(F.col("n"), 3))


@register("round_robin_batches", """WITH ids AS (
  SELECT 'dr' || CAST(s_suppkey AS VARCHAR) AS dataset_id, row_number() OVER (ORDER BY s_suppkey) - 1 AS i,
         count(*) OVER () AS c FROM supplier),
nb AS (SELECT least(CAST(ceil(max(c) / 40.0) AS BIGINT), 6) AS n FROM ids)
SELECT CAST(i % n AS INTEGER) AS batch,
  CAST(floor((c - 1 - i % n) / n) + 1 - 1 - floor(i / n) AS BIGINT) AS position,
  dataset_id, CAST(n AS INTEGER) AS n_batches FROM ids, nb""")
def q_round_robin_batches(spark, sf_dir):
    s = D.load_table(spark, sf_dir, "supplier")
    ids = s.select(F.concat(F.lit("dr"), F.col("s_suppkey").cast("string")).alias("dataset_id"), "s_suppkey")
    return PL.round_robin_batches(ids, 40, 6, order=[F.col("s_suppkey").asc()])


def sql_partition_by_size(src: str, specs) -> str:
    ctes = [f"r0 AS (SELECT dataset_id, size, row_number() OVER (ORDER BY size, dataset_id) - 1 AS r FROM {src})"]
    outs = []
    start = "0"
    for i, (name, nb, cap) in enumerate(specs):
        ctes.append(f"""t{i} AS (SELECT dataset_id, size, r - ({start}) AS t, (r - ({start})) % {nb} AS b
  FROM r0 WHERE r >= ({start}))""")
        if cap is None:
            outs.append(f"SELECT dataset_id, size, '{name}' AS category, CAST(b + 1 AS INTEGER) AS batch, "
                        f"CAST(t AS BIGINT) AS position FROM t{i}")
            break
        ctes.append(f"""l{i} AS (SELECT *, sum(size) OVER (PARTITION BY b ORDER BY t) AS load FROM t{i}),
c{i} AS (SELECT coalesce(min(t) FILTER (WHERE load > {cap}), (SELECT count(*) FROM t{i})) AS cut FROM l{i})""")
        outs.append(f"SELECT dataset_id, size, '{name}' AS category, CAST(b + 1 AS INTEGER) AS batch, "
                    f"CAST(t AS BIGINT) AS position FROM t{i} WHERE t < (SELECT cut FROM c{i})")
        start = f"{start} + (SELECT cut FROM c{i})"
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(outs)


ORDER_SPECS = [("small", 4, 200), ("large", 3, 1200), ("xlarge", 2, None)]


@register("partition_by_size", sql_partition_by_size(
    "(SELECT 'dr' || CAST(o_custkey AS VARCHAR) AS dataset_id, CAST(count(*) AS BIGINT) AS size "
    "FROM orders GROUP BY o_custkey)", ORDER_SPECS))
def q_partition_by_size(spark, sf_dir):
    o = D.load_table(spark, sf_dir, "orders")
    sizes = o.groupBy(F.concat(F.lit("dr"), F.col("o_custkey").cast("string")).alias("dataset_id")).agg(
        F.count(F.lit(1)).alias("size"))
    return PL.partition_by_size(sizes, ORDER_SPECS)


_IMAGES_SQL = """img AS (SELECT CASE WHEN user_id % 20 = 0 THEN 'no_dataresource'
    ELSE 'dr' || CAST(user_id % 20 AS VARCHAR) END AS dataset_id, CAST(ts AS DATE) AS uploaded,
    CAST(count(*) AS BIGINT) AS images FROM events GROUP BY 1, 2)"""


@register("recent_image_counts", f"""WITH {_IMAGES_SQL}
SELECT dataset_id, CAST(sum(images) AS BIGINT) AS images FROM img
WHERE uploaded BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND dataset_id <> 'no_dataresource'
GROUP BY dataset_id""")
def q_recent_image_counts(spark, sf_dir):
    return PL.recent_image_counts(D.image_uploads(spark, sf_dir), "2024-01-10", "2024-01-20")


SYNC_VERSION = "occindex-2024-01-25-10-05"


def _sync_cutoff() -> str:
    import datetime as _dt
    import re as _re
    d = _re.findall(r".*-(\d{4}-\d{2}-\d{2})-.*", SYNC_VERSION)[0]
    return (_dt.date.fromisoformat(d) - _dt.timedelta(days=PL.IMAGE_LOOKBACK_DAYS)).isoformat()


@register("image_sync_candidates", f"""WITH {_IMAGES_SQL}, {_INV_SQL},
recent AS (SELECT dataset_id FROM img WHERE uploaded >= DATE '{_sync_cutoff()}'
           AND uploaded <= current_date AND dataset_id <> 'no_dataresource'),
reidx AS ({sql_dataset_sizes('index_avro', _sync_cutoff())})
SELECT dataset_id FROM recent INTERSECT SELECT dataset_id FROM reidx""")
def q_image_sync_candidates(spark, sf_dir):
    cutoff = _sync_cutoff()
    recent = PL.recent_image_counts(D.image_uploads(spark, sf_dir), cutoff)
    reidx = CT.catalog(D.inventory(spark, sf_dir), "index_avro", time_range=(cutoff, None))
    return PL.image_sync_candidates(recent, reidx)


@register("expand_providers", """SELECT 'dr' || CAST(n_nationkey AS VARCHAR) AS dataset_id, 'dp1' AS via, true AS valid
FROM nation WHERE n_regionkey = 1""")
def q_expand_providers(spark, sf_dir):
    r = D.load_table(spark, sf_dir, "region")
    ids = r.filter(F.col("r_regionkey") == 1).select(F.concat(F.lit("dp"), F.col("r_regionkey").cast("string")).alias("uid"))
    return PL.expand_providers(ids, D.provider_registry(spark, sf_dir))


@register("touch_registry", """SELECT 'dr' || CAST(s_suppkey AS VARCHAR) AS uid,
  CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_name END AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'CC-BY 4.0' WHEN s_suppkey % 3 = 1 THEN '' END AS rights,
  CASE WHEN s_suppkey % 2 = 0 THEN 'CC0' END AS licenseType,
  CASE WHEN s_nationkey = 3 THEN '2024-02-01T00:00:00'
       WHEN s_suppkey % 4 = 0 THEN '2023-12-01T00:00:00' END AS lastChecked,
  s_nationkey FROM supplier""")
def q_touch_registry(spark, sf_dir):
    reg = D.dataset_registry(spark, sf_dir)
    ids = reg.filter(F.col("s_nationkey") == 3).select(F.col("uid").alias("dataset_id"))
    return PL.touch_registry(reg, ids, "2024-02-01T00:00:00")


@register("touch_registry_provider", """SELECT 'dr' || CAST(s_suppkey AS VARCHAR) AS uid,
  CASE WHEN s_suppkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) OR s_suppkey = 30 THEN '2024-02-01T00:00:00'
       WHEN s_suppkey % 4 = 0 THEN '2023-12-01T00:00:00' END AS lastChecked FROM supplier""")
def q_touch_registry_provider(spark, sf_dir):
    """A provider's members and a dataset of its own are touched."""
    reg, providers = D.dataset_registry(spark, sf_dir), D.provider_registry(spark, sf_dir)
    ids = providers.where("uid = 'dp1'").select(F.col("uid").alias("dataset_id")).unionByName(
        reg.where("uid = 'dr30'").select(F.col("uid").alias("dataset_id")))
    return PL.touch_registry(reg, ids, "2024-02-01T00:00:00", providers=providers).select("uid", "lastChecked")


@register("sensitive_columns", """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
  'id,multimedia,annotations,status,tags' AS published, o_orderstatus || '|' || o_orderpriority AS tags FROM orders""")
def q_sensitive_columns(spark, sf_dir):
    """Restricted originals of every type, in records and then flattened: none is published."""
    from florafold.operators.enrich import build_index_record
    from florafold.operators.flatten import flatten_index
    o = D.load_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.array("o_orderpriority").alias("sensitive_tags"), F.col("o_totalprice").alias("sensitive_price"), F.col("o_orderdate").alias("sensitive_date"),
        F.struct("o_custkey").alias("sensitive_customer"), F.col("o_custkey").alias("sensitive_key"), F.lit(None).alias("nothing"))
    rec = build_index_record(o)
    # a record whose maker put a restricted value into another map
    rec = rec.withColumn("multiValues", F.map_concat("multiValues", F.create_map(F.lit("sensitive_more"), F.array(F.lit("x"))))) \
        .withColumn("longs", F.create_map(F.lit("sensitive_count"), F.lit(1).cast("bigint"))) \
        .withColumn("multimedia", F.array().cast("array<string>")).withColumn("annotations", F.array().cast("array<string>"))
    flat = flatten_index(rec, merge_duplicate_ids=False)
    return flat.select("id", "status", F.lit(",".join(flat.columns)).alias("published"), F.array_join("tags", "|").alias("tags"))


# ---------------------------------------------------------------- lifecycle / export / scalar
from florafold import functions as FN  # noqa: E402
from florafold.operators import export as EX  # noqa: E402
from florafold.session import scratch_dir  # noqa: E402
from florafold.sources import sinks as SK  # noqa: E402
from florafold.sources.archive import read_text_table  # noqa: E402


def _orders_by_priority(spark, sf_dir):
    o = D.load_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderpriority").alias("dataset_id"))


@register("replace_dataset", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS dataset_id
FROM orders WHERE o_orderpriority <> '5-LOW' AND (o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0)""")
def q_replace_dataset(spark, sf_dir):
    table = scratch_dir(spark, "replace")
    base = _orders_by_priority(spark, sf_dir)
    base.write.mode("overwrite").partitionBy("dataset_id").parquet(table)
    SK.replace_dataset(base.filter((F.col("dataset_id") == "1-URGENT") & (F.col("o_orderkey") % 2 == 0)), table)
    SK.delete_datasets(spark, [table], ["5-LOW"])
    return spark.read.parquet(table).select("o_orderkey", "o_custkey", "o_totalprice",
                                            F.col("dataset_id").cast("string").alias("dataset_id"))


@register("replace_datasets_one_step", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS dataset_id
FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') AND (o_orderpriority <> '1-URGENT' OR o_orderkey % 2 = 0)""")
def q_replace_datasets_one_step(spark, sf_dir):
    """One call replaces a dataset and empties another, a call that comes too late changes nothing, a third deletes."""
    from florafold.plans import commits as CM
    from florafold.plans import datasets as DS
    root, base = scratch_dir(spark, "datasets"), _orders_by_priority(spark, sf_dir)
    DS.replace_datasets(base, root)
    asked = spark.createDataFrame([("1-URGENT",), ("4-NOT SPECIFIED",)], "id string")
    DS.replace_datasets(base.where("dataset_id = '1-URGENT' and o_orderkey % 2 = 0"), root, asked)
    try:  # decided on the first state
        DS.replace_datasets(base.where("dataset_id = '2-HIGH' and o_orderkey % 3 = 0"), root, base=1)
        raise AssertionError("a late call won")
    except CM.PublishConflict:
        pass
    DS.delete_datasets(spark, root, spark.createDataFrame([("5-LOW",), ("none",)], "id string"))
    return DS.read_datasets(spark, root)


@register("write_timestamped", """SELECT o_orderkey, o_orderstatus FROM orders""")
def q_write_timestamped(spark, sf_dir):
    import datetime as _dt
    path = SK.write_timestamped(D.load_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"),
                                scratch_dir(spark, "stamped"), _dt.datetime(2024, 1, 2, 3, 4, 5))
    assert path.endswith("/20240102T030405")
    return spark.read.parquet(path)


@register("deletion_plan", f"""WITH {_INV_SQL},
ids AS (SELECT 'dr' || CAST(c_custkey AS VARCHAR) AS ds FROM customer WHERE c_nationkey = 7),
k AS (SELECT key, CASE WHEN regexp_extract(key, '^dwca-exports/([^/]+)[.]zip', 1) <> ''
        THEN regexp_extract(key, '^dwca-exports/([^/]+)[.]zip', 1)
        ELSE regexp_extract(key, '^(?:pipelines-all-datasets/index-record|dwca-imports|pipelines-data)/([^/]+)/', 1) END AS ds
      FROM inv)
SELECT key, CASE WHEN starts_with(key, 'dwca-imports/' || ds || '/') THEN 'dwca'
  WHEN starts_with(key, 'pipelines-all-datasets/index-record/' || ds || '/') THEN 'index-record'
  WHEN starts_with(key, 'dwca-exports/' || ds || '.zip') THEN 'dwca-exports-zip'
  WHEN starts_with(key, 'pipelines-data/' || ds || '/') AND NOT contains(key, 'identifiers/')
       AND NOT contains(key, 'identifiers-backup/') THEN 'pipelines-data' END AS kind
FROM k WHERE ds IN (SELECT ds FROM ids) AND kind IS NOT NULL""")
def q_deletion_plan(spark, sf_dir):
    c = D.load_table(spark, sf_dir, "customer")
    ids = c.filter(F.col("c_nationkey") == 7).select(
        F.concat(F.lit("dr"), F.col("c_custkey").cast("string")).alias("dataset_id"))
    return SK.deletion_plan(D.inventory(spark, sf_dir), ids)


PREDICATE = {"type": "and", "predicates": [
    {"type": "in", "key": "o_orderstatus", "values": ["F"]},
    {"type": "in", "key": "o_orderpriority", "values": ["1-URGENT", "2-HIGH"]}]}


@register("predicate_filter", """SELECT * FROM orders
WHERE o_orderstatus IN ('F') AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_predicate_filter(spark, sf_dir):
    return EX.predicate_filter(D.load_table(spark, sf_dir, "orders"), PREDICATE)


@register("predicate_filter_tree", """SELECT * FROM events
WHERE (event_type IN ('click', 'view') OR (value BETWEEN 10 AND 20)) AND NOT (user_id IN (1, 2, 3))
  AND props IS NOT NULL""")
def q_predicate_filter_tree(spark, sf_dir):
    pred = {"type": "and", "predicates": [
        {"type": "or", "predicates": [{"type": "in", "key": "event_type", "values": ["click", "view"]},
                                      {"type": "range", "key": "value", "from": 10, "to": 20}]},
        {"type": "not", "predicate": {"type": "in", "key": "user_id", "values": [1, 2, 3]}},
        {"type": "isNotNull", "key": "props"}]}
    return EX.predicate_filter(D.load_table(spark, sf_dir, "events"), pred)


@register("predicate_filter_long_list", """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE ((o_orderkey % 3 = 0 AND o_orderkey < 600000) OR o_orderstatus = 'F') AND NOT (o_custkey % 2 = 0 AND o_custkey < 20000)""")
def q_predicate_filter_long_list(spark, sf_dir):
    """200,000 ids in one ``in`` under ``or``, and a long list under ``not``."""
    pred = {"type": "and", "predicates": [
        {"type": "or", "predicates": [{"type": "in", "key": "o_orderkey", "values": list(range(0, 600000, 3))},
                                      {"type": "in", "key": "o_orderstatus", "values": ["F"]}]},
        {"type": "not", "predicate": {"type": "in", "key": "o_custkey", "values": list(range(0, 20000, 2))}}]}
    return EX.predicate_filter(D.load_table(spark, sf_dir, "orders"), pred).select("o_orderkey", "o_custkey", "o_orderstatus")


@register("predicate_filter_within", """WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 50 <> 0 THEN
    (o_custkey * 7 + o_orderkey) % 3600 / 10.0 - 179.95 END AS x, (o_orderkey * 3) % 1800 / 10.0 - 89.95 AS y FROM orders),
edges(p, x1, y1, x2, y2) AS (VALUES (0, 100.0, -40.0, 160.0, -40.0), (0, 160.0, -40.0, 130.0, 20.0), (0, 130.0, 20.0, 100.0, -40.0),
  (0, 125.0, -30.0, 135.0, -30.0), (0, 135.0, -30.0, 130.0, -10.0), (0, 130.0, -10.0, 125.0, -30.0),
  (1, 170.0, -50.0, 190.0, -50.0), (1, 190.0, -50.0, 190.0, -20.0), (1, 190.0, -20.0, 170.0, -20.0), (1, 170.0, -20.0, 170.0, -50.0)),
crossed AS (SELECT o.id, o.status, e.p FROM o JOIN (SELECT p, x1 + s AS x1, y1, x2 + s AS x2, y2 FROM edges, (VALUES (0.0), (-360.0)) t(s)) e
  ON ((e.y1 > o.y) <> (e.y2 > o.y)) AND o.x < (e.x2 - e.x1) * (o.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY o.id, o.status, o.x, o.y, e.p HAVING count(*) % 2 = 1)
SELECT id, status FROM o WHERE (status = 'P' AND NOT id % 50 = 0) OR (id IN (SELECT id FROM crossed) AND NOT status = 'F')""")
def q_predicate_filter_within(spark, sf_dir):
    """Two polygons, one with a hole and one over the date line, under ``or`` and ``and``."""
    pred = {"type": "or", "predicates": [
        {"type": "and", "predicates": [{"type": "equals", "key": "status", "value": "P"}, {"type": "isNotNull", "key": "x"}]},
        {"type": "and", "predicates": [
            {"type": "within", "latitude": "y", "longitude": "x", "geometry": "MULTIPOLYGON (((100 -40, 160 -40, 130 20, 100 -40), "
             "(125 -30, 135 -30, 130 -10, 125 -30)), ((170 -50, -170 -50, -170 -20, 170 -20, 170 -50)))"},
            {"type": "not", "predicate": {"type": "equals", "key": "status", "value": "F"}}]}]}
    k = F.col("o_orderkey")
    x = F.when(k % 50 != 0, (F.col("o_custkey") * 7 + k) % 3600 / 10.0 - 179.95)
    o = D.load_table(spark, sf_dir, "orders").select(k.alias("id"), F.col("o_orderstatus").alias("status"), x.alias("x"),
                                                     ((k * 3) % 1800 / 10.0 - 89.95).alias("y"))
    return EX.predicate_filter(o, pred).select("id", "status")


@register("export_download", """WITH core AS (
  SELECT o_orderkey, 'dr' || CAST(o_custkey % 10 AS VARCHAR) AS dataset_id FROM orders
  WHERE o_orderstatus IN ('F') AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT 'core' AS resource, dataset_id, CAST(count(*) AS BIGINT) AS n_rows FROM core GROUP BY dataset_id
UNION ALL
SELECT 'lineitem' AS resource, c.dataset_id, CAST(count(*) AS BIGINT) FROM lineitem l
JOIN core c ON l.l_orderkey = c.o_orderkey GROUP BY c.dataset_id""")
def q_export_download(spark, sf_dir):
    o = D.load_table(spark, sf_dir, "orders").withColumn(
        "dataset_id", F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string")))
    li = D.load_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_extendedprice")
    dest = scratch_dir(spark, "export")
    EX.export_download(o, PREDICATE, {"lineitem": li}, dest, core_id="o_orderkey")
    parts = []
    for res in ("core", "lineitem"):
        r = spark.read.option("sep", "\t").option("header", "true").csv(f"{dest}/{res}")
        parts.append(r.groupBy(F.col("dataset_id").cast("string").alias("dataset_id"))
                     .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).withColumn("resource", F.lit(res)))
    return parts[0].unionByName(parts[1]).select("resource", "dataset_id", "n_rows")


@register("export_download_manifest", """WITH core AS (SELECT DISTINCT 'dr' || CAST(o_custkey % 10 AS VARCHAR) AS dataset_id FROM orders
  WHERE o_orderstatus IN ('F') AND o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT dataset_id, CASE WHEN s_suppkey IS NULL OR s_suppkey % 10 = 9 THEN 'Untitled dataset' ELSE s_name END AS name,
  'exports/req-7/' || dataset_id || '.zip' AS archive, true AS has_size, CAST((SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderstatus IN ('F') AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND 'dr' || CAST(o_custkey % 10 AS VARCHAR) = dataset_id) AS BIGINT) AS n_lineitem
FROM core LEFT JOIN supplier ON 'dr' || CAST(s_suppkey AS VARCHAR) = dataset_id""")
def q_export_download_manifest(spark, sf_dir):
    """C6 with its manifest; every core row is there twice, extension rows are not repeated."""
    ds = F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string"))
    o = D.load_table(spark, sf_dir, "orders").withColumn("dataset_id", ds)
    li = D.load_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    dest = scratch_dir(spark, "export")
    EX.export_download(o.unionByName(o), PREDICATE, {"lineitem": li}, dest, "o_orderkey", registry=D.dataset_registry(spark, sf_dir), request_id="req-7")
    n = read_text_table(spark, f"{dest}/lineitem").groupBy(F.col("dataset_id").cast("string").alias("dataset_id")).agg(F.count(F.lit(1)).alias("n_lineitem"))
    return spark.read.json(f"{dest}/manifest").join(n, "dataset_id", "left").select(
        "dataset_id", "name", "archive", F.col("size_label").rlike("^[0-9.]+(MB|GB)$").alias("has_size"), "n_lineitem")


@register("export_manifest", f"""WITH {_INV_SQL},
z AS ({sql_dataset_sizes('dwca')}),
r AS (SELECT 'dr' || CAST(s_suppkey AS VARCHAR) AS uid, CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_name END AS name,
        CASE WHEN s_suppkey % 3 = 0 THEN 'CC-BY 4.0' WHEN s_suppkey % 3 = 1 THEN '' END AS rights,
        CASE WHEN s_suppkey % 2 = 0 THEN 'CC0' END AS licenseType FROM supplier),
j AS (SELECT z.dataset_id, z.size, r.name, r.rights, r.licenseType,
        (z.size * 100) // 1048576 AS q, (z.size * 100) % 1048576 AS rem FROM z LEFT JOIN r ON z.dataset_id = r.uid),
m AS (SELECT *, CAST(q + CASE WHEN rem > 524288 OR (rem = 524288 AND q % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100.0 AS mb FROM j)
SELECT dataset_id, coalesce(name, 'Untitled dataset') AS name,
  coalesce(nullif(rights, ''), nullif(licenseType, ''), '') AS licence,
  CASE WHEN mb > 1024 THEN CAST(round_even(mb / 1024.0, 2) AS VARCHAR) || 'GB' ELSE CAST(mb AS VARCHAR) || 'MB' END AS size_label,
  'exports/req-1/' || dataset_id || '.zip' AS archive
FROM m""")
def q_export_manifest(spark, sf_dir):
    z = CT.catalog(D.inventory(spark, sf_dir), "dwca")
    return EX.export_manifest(D.dataset_registry(spark, sf_dir), z, "req-1")


@register("scalar_functions", r"""SELECT page_id,
  CASE WHEN contains(url, 'multimedia') OR contains(url, 'image') OR contains(url, 'images') OR contains(url, 'sounds')
       THEN 'multimedia' ELSE 'occurrence' END AS media_type,
  nullif(regexp_extract(url, '([^/]*)$', 1), '') AS file_name,
  regexp_extract(url, '([^/]*)/[^/]*$', 1) AS folder,
  regexp_extract(url, '^[a-zA-Z0-9+.-]+://([^/]*)', 1) AS bucket,
  regexp_extract(url, '^[a-zA-Z0-9+.-]+://[^/]*/?(.*)$', 1) AS path,
  coalesce(lower(trim(CASE page_id % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'off' WHEN 2 THEN 'TRUE ' END))
           IN ('y', 'yes', 't', 'true', 'on', '1'), false) AS flag,
  (CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN 'NULL' ELSE CAST(page_id AS VARCHAR) END) IS NULL
    OR lower(CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN 'NULL' ELSE CAST(page_id AS VARCHAR) END) = 'null'
    AS null_id,
  CASE WHEN page_id % 3 = 0 THEN 'dr' WHEN page_id % 3 = 1 THEN 'dp' END AS id_kind
FROM pages""")
def q_scalar_functions(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "pages")
    k = F.col("page_id")
    flag_text = F.when(k % 4 == 0, F.lit(" Yes")).when(k % 4 == 1, F.lit("off")).when(k % 4 == 2, F.lit("TRUE "))
    some_id = F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit("NULL")).otherwise(k.cast("string"))
    uid = F.when(k % 3 == 0, F.concat(F.lit("dr"), k.cast("string"))).when(
        k % 3 == 1, F.concat(F.lit("dp"), k.cast("string"))).otherwise(F.lit("x1"))
    sp = FN.split_uri("url")
    return p.select("page_id", FN.media_type("url").alias("media_type"),
                    FN.file_name("url", strict=False).alias("file_name"), FN.folder("url").alias("folder"),
                    sp["bucket"].alias("bucket"), sp["path"].alias("path"),
                    FN.parse_flag(flag_text).alias("flag"), FN.is_null_id(some_id).alias("null_id"),
                    FN.id_kind(uid, strict=False).alias("id_kind"))


@register("version_name_date", """SELECT event_id,
  'occindex-' || strftime(ts, '%Y-%m-%d-%H-%M') AS version,
  strftime(ts, '%Y-%m-%d') AS version_date FROM events""")
def q_version_name_date(spark, sf_dir):
    e = D.load_table(spark, sf_dir, "events")
    v = FN.version_name("occindex", F.col("ts"))
    return e.select("event_id", v.alias("version"), FN.version_date(v).alias("version_date"))


@register("id_list", """SELECT n_nationkey, unnest(['dr' || CAST(n_nationkey AS VARCHAR), 'dp' || CAST(n_regionkey AS VARCHAR)]) AS dataset_id
FROM nation""")
def q_id_list(spark, sf_dir):
    n = D.load_table(spark, sf_dir, "nation")
    text = F.concat(F.lit("  dr"), F.col("n_nationkey").cast("string"), F.lit(" \t dp"),
                    F.col("n_regionkey").cast("string"), F.lit("  "))
    return n.select("n_nationkey", F.explode(FN.id_list(text)).alias("dataset_id"))


@register("days_between", """SELECT user_id, CAST(d AS DATE) AS day FROM (
  SELECT user_id, unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d
  FROM events GROUP BY user_id)""")
def q_days_between(spark, sf_dir):
    e = D.load_table(spark, sf_dir, "events")
    r = e.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    return r.select("user_id", F.explode(FN.days_between("lo", "hi")).alias("day"))


# ---------------------------------------------------------------- flagship (entry)
@register("flagship", f"""WITH f AS ({_INDEX_SQL})
SELECT dataResourceUid AS value, CAST(count(*) AS BIGINT) AS count FROM f
WHERE dataResourceUid IS NOT NULL GROUP BY dataResourceUid""")
def q_flagship(spark, sf_dir):
    """C1 then A3: flatten the index records and facet the flat table by dataset."""
    flat = FL.flatten_index(D.index_records(spark, sf_dir))
    return CK.facet_counts(flat, "dataResourceUid")


@register("facet_compare_many", f"""WITH {_iv_ctes()}
{' UNION ALL '.join(f"SELECT * FROM ({sql_facet_compare(f, cs, fs, srt)})" for _, f, cs, fs, srt in PB.FACET_CHECKS)}""")
def q_facet_compare_many(spark, sf_dir):
    old = D.index_version(spark, sf_dir, "old")
    new = D.index_version(spark, sf_dir, "new")
    return CK.facet_compare_many(old, new, [(f, cs, fs, srt) for _, f, cs, fs, srt in PB.FACET_CHECKS])


# ---------------------------------------------------------------- S1 / U3, P1-P3, W1, A1 as queries
from florafold.sources.scan import scan_records  # noqa: E402


@register("scan_records", """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders""")
def q_scan_records(spark, sf_dir):
    root = scratch_dir(spark, "scan")
    o = D.load_table(spark, sf_dir, "orders")
    hi = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    o.filter(hi).select("o_orderkey", "o_custkey", "o_orderstatus").write.parquet(f"{root}/dr1")
    o.filter(~hi).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.parquet(f"{root}/dr2")
    return scan_records(spark, [f"{root}/dr*"]).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


_KEY_ROWS_SQL = """WITH e AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, unnest([
    'dataResourceUid', 'orderStatus', 'order.priority', 'sensitive_segment',
    CASE WHEN o_orderkey % 3 = 0 THEN 'Market-Segment' ELSE 'market segment' END, 'comment', 'year']) AS key
  FROM orders WHERE o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL FROM orders WHERE o_orderkey % 31 = 0 OR o_orderkey % 37 = 0)"""


@register("map_entries", f"""{_KEY_ROWS_SQL} SELECT id, key FROM e""")
def q_map_entries(spark, sf_dir):
    return FL.map_entries(D.index_records_by_order(spark, sf_dir), "strings").select("id", "key")


@register("drop_sensitive", f"""{_KEY_ROWS_SQL}
SELECT id, regexp_replace(key, '[^0-9a-zA-Z]+', '_', 'g') AS key FROM e WHERE key NOT LIKE 'sensitive\\_%' ESCAPE '\\'""")
def q_drop_sensitive(spark, sf_dir):
    rec = D.index_records_by_order(spark, sf_dir)
    e = FL.drop_sensitive(FL.map_entries(rec, "strings"))
    return e.select("id", FL.sanitize_key("key").alias("key"))


@register("dedupe_keys", f"""{_KEY_ROWS_SQL},
s0 AS (SELECT id, regexp_replace(key, '[^0-9a-zA-Z]+', '_', 'g') AS key FROM e
       WHERE key NOT LIKE 'sensitive\\_%' ESCAPE '\\'),
s AS (SELECT * FROM s0 UNION ALL SELECT id, upper(key) FROM s0 WHERE lower(key) = 'market_segment'),
r AS (SELECT id, key, row_number() OVER (PARTITION BY id, lower(key) ORDER BY key DESC) AS rn FROM s)
SELECT id, key FROM r WHERE rn = 1 AND lower(key) <> 'year'""")
def q_dedupe_keys(spark, sf_dir):
    rec = D.index_records_by_order(spark, sf_dir)
    e = FL.drop_sensitive(FL.map_entries(rec, "strings")).withColumn("key", FL.sanitize_key("key"))
    # every record also gets an upper-case spelling of its segment key
    e = e.unionByName(e.filter(F.lower("key") == "market_segment").withColumn("key", F.upper("key")))
    return FL.dedupe_keys(e, existing=["YEAR"]).select("id", "key")


@register("pivot_first", """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS orderStatus, o_orderpriority AS order_priority
FROM orders WHERE o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0""")
def q_pivot_first(spark, sf_dir):
    rec = D.index_records_by_order(spark, sf_dir)
    e = FL.map_entries(rec, "strings").withColumn("key", FL.sanitize_key("key")) \
        .filter(F.col("key").isin("orderStatus", "order_priority"))
    return FL.pivot_first(e, ["orderStatus", "order_priority"])


@register("sanitize_key", f"""{_KEY_ROWS_SQL}
SELECT id, regexp_replace(key, '[^0-9a-zA-Z]+', '_', 'g') AS key FROM e""")
def q_sanitize_key(spark, sf_dir):
    e = FL.map_entries(D.index_records_by_order(spark, sf_dir), "strings")
    return e.select("id", FL.sanitize_key("key").alias("key"))


@register("delete_datasets", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority AS dataset_id
FROM orders WHERE o_orderpriority NOT IN ('2-HIGH', '4-NOT SPECIFIED')""")
def q_delete_datasets(spark, sf_dir):
    table = scratch_dir(spark, "delete")
    _orders_by_priority(spark, sf_dir).write.partitionBy("dataset_id").parquet(table)
    SK.delete_datasets(spark, [table], ["2-HIGH", "4-NOT SPECIFIED", "9-NONE"])
    return spark.read.parquet(table).select("o_orderkey", "o_custkey", "o_totalprice",
                                            F.col("dataset_id").cast("string").alias("dataset_id"))


@register("field_fill", f"""WITH {_iv_ctes()}
SELECT id, CAST({_fill_sql(IV_FIELDS_NEW)} AS INTEGER) AS n_fields FROM new_iv""")
def q_field_fill(spark, sf_dir):
    new = D.index_version(spark, sf_dir, "new")
    return new.select("id", CK.field_fill(new).alias("n_fields"))
