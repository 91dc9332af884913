"""Registered queries for the enrichment operators (I-class definitions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from florafold.operators import enrich as EN
from florafold.operators import flatten as FL
from florafold.plans.registry import ORACLE, arrays_as_text, register
from florafold.sources import derived as D

OCC_SQL = """occ AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
      || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS id,
    'dr' || CAST(l_suppkey % 20 AS VARCHAR) AS dataset_id, p_name AS scientificName,
    'sp' || CAST(l_partkey % 30 AS VARCHAR) AS taxon,
    ((l_orderkey * 7 + l_linenumber * 13) % 400 - 200) / 10.0 AS decimalLatitude,
    ((l_partkey * 11 + l_orderkey) % 1000 - 500) / 10.0 AS decimalLongitude,
    CAST(l_shipdate AS DATE) AS eventDate, 'cat' || CAST(l_orderkey % 997 AS VARCHAR) AS catalogNumber,
    'zone' || CAST(l_suppkey % 5 AS VARCHAR) AS zone, l_partkey, l_extendedprice,
    CASE WHEN l_linenumber % 7 = 0 THEN 'abc' WHEN l_linenumber % 7 = 1 THEN '95.5' WHEN l_linenumber % 7 = 2 THEN ' 0 '
         ELSE CAST((l_orderkey * 7 + l_linenumber * 13) % 400 - 200 AS VARCHAR) || 'e-1' END AS verbatimLatitude,
    CASE WHEN l_linenumber % 7 = 2 THEN '0' WHEN l_orderkey % 17 = 0 THEN ''
         ELSE CAST((l_partkey * 11 + l_orderkey) % 1000 - 500 AS VARCHAR) || 'e-1' END AS verbatimLongitude,
    CASE WHEN l_orderkey % 11 = 0 THEN 'not-a-date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS verbatimEventDate,
    CASE WHEN l_orderkey % 13 = 0 THEN 'many' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS verbatimCount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""

RULES = {"decimalLatitude": ("verbatimLatitude", "double"), "decimalLongitude": ("verbatimLongitude", "double"),
         "eventDate": ("verbatimEventDate", "date"), "individualCount": ("verbatimCount", "int")}

INTERP_SQL = """t AS (SELECT id, dataset_id,
    TRY_CAST(nullif(trim(verbatimLatitude), '') AS DOUBLE) AS la, nullif(trim(verbatimLatitude), '') AS tla,
    TRY_CAST(nullif(trim(verbatimLongitude), '') AS DOUBLE) AS lo, nullif(trim(verbatimLongitude), '') AS tlo,
    CAST(try_strptime(nullif(trim(verbatimEventDate), ''), '%Y-%m-%d') AS DATE) AS ed, nullif(trim(verbatimEventDate), '') AS ted,
    TRY_CAST(nullif(trim(verbatimCount), '') AS INTEGER) AS ic, nullif(trim(verbatimCount), '') AS tic
  FROM occ),
interp AS (SELECT id, dataset_id,
    CASE WHEN NOT coalesce(abs(la) > 90 OR abs(lo) > 180, false) THEN la END AS decimalLatitude,
    CASE WHEN NOT coalesce(abs(la) > 90 OR abs(lo) > 180, false) THEN lo END AS decimalLongitude,
    ed AS eventDate, ic AS individualCount,
    list_filter([CASE WHEN tla IS NOT NULL AND la IS NULL THEN 'DECIMALLATITUDE_INVALID' END,
                 CASE WHEN tlo IS NOT NULL AND lo IS NULL THEN 'DECIMALLONGITUDE_INVALID' END,
                 CASE WHEN ted IS NOT NULL AND ed IS NULL THEN 'EVENTDATE_INVALID' END,
                 CASE WHEN tic IS NOT NULL AND ic IS NULL THEN 'INDIVIDUALCOUNT_INVALID' END,
                 CASE WHEN abs(la) > 90 OR abs(lo) > 180 THEN 'COORDINATE_OUT_OF_RANGE' END,
                 CASE WHEN la = 0 AND lo = 0 THEN 'ZERO_COORDINATE' END], lambda x: x IS NOT NULL) AS issues
  FROM t)"""


def _interp(spark, sf_dir):
    return EN.interpret(D.occurrences(spark, sf_dir), RULES, lat="decimalLatitude", lon="decimalLongitude",
                        keep=["id", "dataset_id"])


@register("interpret", f"""WITH {OCC_SQL}, {INTERP_SQL}
SELECT id, dataset_id, decimalLatitude, decimalLongitude, eventDate, individualCount,
  array_to_string(issues, '|') AS issues FROM interp""")
def q_interpret(spark, sf_dir):
    return arrays_as_text(_interp(spark, sf_dir))


ISSUE_CODES = ["DECIMALLATITUDE_INVALID", "DECIMALLONGITUDE_INVALID", "EVENTDATE_INVALID",
               "INDIVIDUALCOUNT_INVALID", "COORDINATE_OUT_OF_RANGE", "ZERO_COORDINATE"]


@register("event_intervals", """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
p AS (SELECT *, k % 6 AS how, CAST(date_trunc('month', d) AS DATE) AS m, CAST(date_trunc('year', d) AS DATE) AS y FROM o)
SELECT k AS id, CAST(CASE how WHEN 0 THEN y WHEN 1 THEN m WHEN 2 THEN d WHEN 3 THEN d END AS DATE) AS start,
  CAST(CASE how WHEN 0 THEN y + INTERVAL 1 YEAR - INTERVAL 1 DAY WHEN 1 THEN m + INTERVAL 1 MONTH - INTERVAL 1 DAY WHEN 2 THEN d
    WHEN 3 THEN d + INTERVAL 40 DAY END AS DATE) AS "end",
  CASE how WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' WHEN 3 THEN 'range' END AS precision,
  CASE how WHEN 4 THEN 'EVENTDATE_REVERSED' WHEN 5 THEN 'EVENTDATE_INVALID' END AS issue FROM p""")
def q_event_intervals(spark, sf_dir):
    """Years, months, days, ranges, reversed ranges and days that do not exist."""
    from florafold.functions.dates import event_interval
    d, how = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    text = (F.when(how == 0, F.date_format(d, "yyyy")).when(how == 1, F.date_format(d, "yyyy-MM")).when(how == 2, iso(d))
            .when(how == 3, F.concat_ws("/", iso(d), iso(F.date_add(d, 40)))).when(how == 4, F.concat_ws("/", iso(d), iso(F.date_add(d, -1))))
            .otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-02-30"))))
    return D.load_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), event_interval(text).alias("e")).select("id", "e.*")


@register("written_coordinates", """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 80 AS deg, o_custkey % 60 AS mi, o_orderkey % 59 AS se FROM orders)
SELECT k AS id, CASE k % 4 WHEN 0 THEN deg + mi / 60.0 + se / 3600.0 WHEN 1 THEN -(deg + (mi + 0.5) / 60.0) WHEN 2 THEN -(deg + 0.25) END AS latitude
FROM o""")
def q_written_coordinates(spark, sf_dir):
    """Degrees, minutes and seconds with signs and without, plain numbers, and more degrees than a latitude has."""
    from florafold.functions.dates import degrees
    k = F.col("o_orderkey")
    t = lambda c: c.cast("string")
    deg, mi, se = t(k % 80), t(F.col("o_custkey") % 60), t(k % 59)
    text = (F.when(k % 4 == 0, F.concat(deg, F.lit("°"), mi, F.lit("'"), se, F.lit('"N'))).when(k % 4 == 1, F.concat(deg, F.lit(" "), mi, F.lit(".5 s")))
            .when(k % 4 == 2, F.concat(F.lit("-"), deg, F.lit(".25"))).otherwise(F.concat(t(k % 80 + 91), F.lit("°N"))))
    return D.load_table(spark, sf_dir, "orders").select(k.alias("id"), degrees(text, 90).alias("latitude"))


@register("interpret_written", """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 80 AS deg, o_custkey % 60 AS mi, o_orderkey % 59 AS se,
    CAST(o_orderdate AS DATE) AS d, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)
SELECT k AS id, CASE k % 4 WHEN 0 THEN deg + mi / 60.0 + se / 3600.0 WHEN 1 THEN -(deg + (mi + 0.5) / 60.0) WHEN 2 THEN -(deg + 0.25) END AS latitude,
  CASE k % 5 WHEN 0 THEN -(100 + deg + mi / 60.0) WHEN 1 THEN deg + 0.5 END AS longitude,
  CASE k % 3 WHEN 0 THEN m WHEN 1 THEN d END AS day, CASE k % 3 WHEN 0 THEN CAST(m + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) WHEN 1 THEN d + 9 END AS dayEnd,
  CASE k % 3 WHEN 0 THEN 'month' WHEN 1 THEN 'range' END AS dayPrecision,
  concat_ws('|', CASE WHEN k % 4 = 3 THEN 'LATITUDE_INVALID' END, CASE WHEN k % 5 = 2 THEN 'LONGITUDE_INVALID' END,
    CASE WHEN k % 3 = 2 THEN CASE WHEN k % 2 = 0 THEN 'DAY_REVERSED' ELSE 'DAY_INVALID' END END) AS issues FROM o""")
def q_interpret_written(spark, sf_dir):
    """Coordinates in degrees, minutes and seconds, months and ranges of days, through F12."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    t = lambda c: c.cast("string")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    deg, mi, se = t(k % 80), t(F.col("o_custkey") % 60), t(k % 59)
    lat = (F.when(k % 4 == 0, F.concat(deg, F.lit("° "), mi, F.lit("' "), se, F.lit('" N '))).when(k % 4 == 1, F.concat(deg, F.lit(" "), mi, F.lit(".5 S")))
           .when(k % 4 == 2, F.concat(F.lit(" -"), deg, F.lit(".25"))).otherwise(F.concat(deg, F.lit("°E"))))
    lon = (F.when(k % 5 == 0, F.concat(t(k % 80 + 100), F.lit("°"), mi, F.lit("'W"))).when(k % 5 == 1, F.concat(deg, F.lit(".5E")))
           .when(k % 5 == 2, F.lit("190 E")).when(k % 5 == 3, F.lit("  ")))
    day = (F.when(k % 3 == 0, F.date_format(d, "yyyy-MM")).when(k % 3 == 1, F.concat_ws("/", iso(d), iso(F.date_add(d, 9))))
           .when(k % 2 == 0, F.concat_ws("/", iso(d), iso(F.date_add(d, -1)))).otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-13"))))
    o = D.load_table(spark, sf_dir, "orders").select(k.alias("id"), lat.alias("la"), lon.alias("lo"), day.alias("dd"))
    rules = {"latitude": ("la", "latitude"), "longitude": ("lo", "longitude"), "day": ("dd", "interval")}
    return arrays_as_text(EN.interpret(o, rules, keep=["id"]))


_PLACED = """o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 31 <> 0 THEN 'r' || CAST(o_custkey % 7 AS VARCHAR) END AS region,
    (o_orderkey * 7 % 700) / 10.0 - 35.05 AS y, CASE WHEN o_orderkey % 37 <> 0 THEN (o_custkey * 11 + o_orderkey) % 900 / 10.0 - 45.05 END AS x FROM orders),
edges AS (SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS region, e.* FROM region, LATERAL (VALUES
    (r_regionkey * 8.0, 5.0, r_regionkey * 8.0 + 12, 5.0), (r_regionkey * 8.0 + 12, 5.0, r_regionkey * 8.0 + 6, 30.0),
    (r_regionkey * 8.0 + 6, 30.0, r_regionkey * 8.0, 5.0)) e(x1, y1, x2, y2)),
v AS (SELECT DISTINCT region, x, y, way, vx, vy FROM o, LATERAL (VALUES (0, x, y), (1, x, -y), (2, -x, y), (3, -x, -y), (4, y, x)) t(way, vx, vy)),
hit AS (SELECT region, x, y, way, vx, vy FROM v JOIN edges e USING (region) WHERE ((e.y1 > vy) <> (e.y2 > vy))
  AND vx < (e.x2 - e.x1) * (vy - e.y1) / (e.y2 - e.y1) + e.x1 GROUP BY region, x, y, way, vx, vy HAVING count(*) % 2 = 1),
best AS (SELECT region, x, y, min(way) AS way, arg_min(vx, way) AS vx, arg_min(vy, way) AS vy FROM hit GROUP BY region, x, y)"""


@register("place_coordinates", f"""WITH {_PLACED}
SELECT o.id, o.region, coalesce(b.vy, o.y) AS decimalLatitude, coalesce(b.vx, o.x) AS decimalLongitude,
  CASE b.way WHEN 0 THEN 'SEEN' WHEN 1 THEN 'SEEN|PRESUMED_NEGATED_LATITUDE' WHEN 2 THEN 'SEEN|PRESUMED_NEGATED_LONGITUDE'
    WHEN 3 THEN 'SEEN|PRESUMED_NEGATED_LATITUDE|PRESUMED_NEGATED_LONGITUDE' WHEN 4 THEN 'SEEN|PRESUMED_SWAPPED_COORDINATE'
    ELSE CASE WHEN o.x IS NOT NULL AND o.region IN (SELECT region FROM edges) THEN 'SEEN|REGION_COORDINATE_MISMATCH' ELSE 'SEEN' END END AS issues
FROM o LEFT JOIN best b ON o.region = b.region AND o.x = b.x AND o.y = b.y""")
def q_place_coordinates(spark, sf_dir):
    """Triangles as regions; two of the seven regions stated have none."""
    from florafold.operators.coordinates import place_coordinates
    k, x0 = F.col("o_orderkey"), F.col("r_regionkey") * 8.0
    pt = lambda x, y: F.struct(x.alias("x"), F.lit(y).alias("y"))
    regions = D.load_table(spark, sf_dir, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("region"),
                                                           F.array(pt(x0, 5.0), pt(x0 + 12, 5.0), pt(x0 + 6, 30.0)).alias("ring"))
    o = D.load_table(spark, sf_dir, "orders").select(
        k.alias("id"), F.when(k % 31 != 0, F.concat(F.lit("r"), (F.col("o_custkey") % 7).cast("string"))).alias("region"),
        (k * 7 % 700 / 10.0 - 35.05).alias("decimalLatitude"),
        F.when(k % 37 != 0, (F.col("o_custkey") * 11 + k) % 900 / 10.0 - 45.05).alias("decimalLongitude"), F.array(F.lit("SEEN")).alias("issues"))
    return arrays_as_text(place_coordinates(o, regions, "region"))


@register("interpretation_metrics", f"""WITH {OCC_SQL}, {INTERP_SQL}
SELECT dataset_id, CAST(count(*) AS BIGINT) AS records,
  CAST(count(decimalLatitude) AS BIGINT) AS parsed_decimalLatitude,
  CAST(count(eventDate) AS BIGINT) AS parsed_eventDate,
  {", ".join(f"CAST(count(*) FILTER (WHERE list_contains(issues, '{c}')) AS BIGINT) AS issue_{c}" for c in ISSUE_CODES)}
FROM interp GROUP BY dataset_id""")
def q_interpretation_metrics(spark, sf_dir):
    return EN.interpretation_metrics(_interp(spark, sf_dir), fields=["decimalLatitude", "eventDate"],
                                     issue_codes=ISSUE_CODES)


@register("build_index_record", f"""WITH {OCC_SQL}, {INTERP_SQL}
SELECT id, CAST(NULL AS VARCHAR) AS multimedia, CAST(NULL AS VARCHAR) AS annotations,
  min(dataset_id) OVER w AS dataset_id, min(decimalLatitude) OVER w AS decimalLatitude,
  min(decimalLongitude) OVER w AS decimalLongitude, min(individualCount) OVER w AS individualCount,
  min(CAST(date_diff('day', DATE '1970-01-01', eventDate) AS BIGINT) * 86400000) OVER w AS eventDate,
  array_to_string(min(issues) OVER w, '|') AS issues FROM interp WINDOW w AS (PARTITION BY id)""")
def q_build_index_record(spark, sf_dir):
    rec = EN.build_index_record(_interp(spark, sf_dir))
    rec = rec.withColumn("multimedia", F.lit(None).cast("array<string>")) \
        .withColumn("annotations", F.lit(None).cast("array<string>"))
    return arrays_as_text(FL.flatten_index(rec))


_CUST_KEY = """CAST(length('dr' || CAST(c_nationkey AS VARCHAR)) AS VARCHAR) || ':dr' || CAST(c_nationkey AS VARCHAR) || '|'
  || CAST(length(CAST(c_custkey AS VARCHAR)) AS VARCHAR) || ':' || CAST(c_custkey AS VARCHAR)"""
_UUID_SQL = """substr(md5(k), 1, 8) || '-' || substr(md5(k), 9, 4) || '-' || substr(md5(k), 13, 4) || '-'
  || substr(md5(k), 17, 4) || '-' || substr(md5(k), 21, 12)"""
ASSIGN_SQL = f"""a AS (SELECT c.c_custkey, c.k AS unique_key, e.uuid IS NULL AS is_new,
    coalesce(e.uuid, {_UUID_SQL.replace('k)', 'c.k)')}) AS uuid
  FROM (SELECT c_custkey, {_CUST_KEY} AS k FROM customer) c
  LEFT JOIN (SELECT {_CUST_KEY} AS k, 'known-' || CAST(c_custkey AS VARCHAR) AS uuid FROM customer
             WHERE c_custkey % 2 = 0) e ON c.k = e.k)"""


def _assign(spark, sf_dir):
    c = D.load_table(spark, sf_dir, "customer").withColumn(
        "dataset_id", F.concat(F.lit("dr"), F.col("c_nationkey").cast("string")))
    existing = c.filter(F.col("c_custkey") % 2 == 0).select(
        EN.unique_key(F.col("dataset_id"), F.col("c_custkey")).alias("unique_key"),
        F.concat(F.lit("known-"), F.col("c_custkey").cast("string")).alias("uuid"))
    return EN.assign_uuids(c, existing, ["c_custkey"]), existing


@register("assign_uuids", f"WITH {ASSIGN_SQL} SELECT c_custkey, unique_key, uuid, is_new FROM a")
def q_assign_uuids(spark, sf_dir):
    return _assign(spark, sf_dir)[0].select("c_custkey", "unique_key", "uuid", "is_new")


@register("uuid_check", f"""WITH {ASSIGN_SQL}
SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) FILTER (WHERE is_new) AS BIGINT) AS n_new,
  CASE WHEN count(*) FILTER (WHERE is_new) * 100 > 40 * count(*) AND EXISTS (SELECT 1 FROM customer WHERE c_custkey % 2 = 0)
       THEN 'FAIL' ELSE 'PASS' END AS status FROM a""")
def q_uuid_check(spark, sf_dir):
    return EN.uuid_check(*_assign(spark, sf_dir), 40)


@register("uuid_check_all_new", """SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) AS BIGINT) AS n_new,
  CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM customer""")
def q_uuid_check_all_new(spark, sf_dir):
    """Ids existed before, and every key is new: the guard's worst case."""
    c = D.load_table(spark, sf_dir, "customer").withColumn("dataset_id", F.lit("dr|0"))
    existing = c.select(EN.unique_key(F.lit("dr"), F.col("c_custkey")).alias("unique_key"), F.lit("u").alias("uuid"))
    return EN.uuid_check(EN.assign_uuids(c, existing, ["c_custkey"]), existing, 5)


@register("lookup_vocabulary", """WITH v AS (SELECT DISTINCT lower(trim(' ' || lower(p_type) || ' ')) AS lbl,
    'T_' || p_type AS canonical FROM part WHERE p_size <= 25)
SELECT p.p_partkey, p.p_type, v.canonical AS p_type_norm FROM part p
LEFT JOIN v ON lower(trim(p.p_type)) = v.lbl""")
def q_lookup_vocabulary(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part")
    vocab = p.filter(F.col("p_size") <= 25).select(
        F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")).alias("label"),
        F.concat(F.lit("T_"), F.col("p_type")).alias("canonical")).distinct()
    return EN.lookup_vocabulary(p.select("p_partkey", "p_type"), vocab, "p_type")


TAXA_SQL = """taxa AS (SELECT DISTINCT p_name AS name, 'species' AS rank, 'sp:' || p_name AS taxon_id FROM part
    WHERE p_partkey % 3 = 0
  UNION SELECT DISTINCT split_part(p_name, ' ', 1), 'genus', 'g:' || split_part(p_name, ' ', 1) FROM part)"""


@register("match_names", f"""WITH {OCC_SQL}, {TAXA_SQL}
SELECT o.id, o.scientificName, coalesce(e.taxon_id, g.taxon_id) AS taxon_id,
  CASE WHEN e.taxon_id IS NOT NULL THEN 'exact' WHEN g.taxon_id IS NOT NULL THEN 'genus' ELSE 'none' END AS match_type
FROM occ o
LEFT JOIN taxa e ON lower(trim(o.scientificName)) = lower(trim(e.name))
LEFT JOIN (SELECT * FROM taxa WHERE rank = 'genus') g
  ON regexp_split_to_array(lower(trim(o.scientificName)), '\\s+')[1] = lower(trim(g.name))""")
def q_match_names(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part")
    species = p.filter(F.col("p_partkey") % 3 == 0).select(
        F.col("p_name").alias("name"), F.lit("species").alias("rank"),
        F.concat(F.lit("sp:"), F.col("p_name")).alias("taxon_id"))
    g = F.split(F.col("p_name"), " ")[0]
    genus = p.select(g.alias("name"), F.lit("genus").alias("rank"), F.concat(F.lit("g:"), g).alias("taxon_id"))
    taxa = species.unionByName(genus).distinct()
    occ = D.occurrences(spark, sf_dir).select("id", "scientificName")
    return EN.match_names(occ, taxa)


# ---------------------------------------------------------------- names
# a taxonomy with a species for each part: genus word + word with the key in letters
BACKBONE_SQL = """sp AS (SELECT p_partkey AS k, split_part(p_name, ' ', 1) AS g,
    split_part(p_name, ' ', 2) || translate(CAST(p_partkey AS VARCHAR), '0123456789', 'abcdefghij') AS e FROM part),
taxa AS (SELECT 'sp:' || CAST(k AS VARCHAR) AS taxon_id, g || ' ' || e AS name, 'species' AS rank, 'g:' || g AS parent_id,
    CASE WHEN k % 7 = 0 OR (k % 7 = 1 AND k % 3 = 0) THEN 'sp:' || CAST(k + 1 AS VARCHAR) END AS accepted_id FROM sp
  UNION ALL SELECT DISTINCT 'g:' || g, g, 'genus', 'f:' || substr(g, 1, 1), NULL FROM sp
  UNION ALL SELECT DISTINCT 'f:' || substr(g, 1, 1), substr(g, 1, 1) || 'idae', 'family', 'o:all', NULL FROM sp
  UNION ALL SELECT 'o:all', 'Omnia', 'order', NULL, NULL)"""


def _backbone(spark, sf_dir):
    k = F.col("p_partkey")
    word = F.split("p_name", " ")
    sp = D.load_table(spark, sf_dir, "part").select(
        k.alias("k"), word[0].alias("g"), F.concat(word[1], F.translate(k.cast("string"), "0123456789", "abcdefghij")).alias("e"))
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    none = F.lit(None).cast("string")
    k = F.col("k")
    species = sp.select(text("sp:", k).alias("taxon_id"), F.initcap(F.concat_ws(" ", "g", "e")).alias("name"), F.lit("species").alias("rank"),
                        text("g:", F.col("g")).alias("parent_id"),
                        F.when((k % 7 == 0) | ((k % 7 == 1) & (k % 3 == 0)), text("sp:", k + 1)).alias("accepted_id"))
    letter = F.substring("g", 1, 1)
    genera = sp.select(text("g:", F.col("g")), F.initcap("g"), F.lit("genus"), text("f:", letter), none).distinct()
    families = sp.select(text("f:", letter), F.concat(letter, F.lit("idae")), F.lit("family"), F.lit("o:all"), none).distinct()
    order = spark.range(1).select(F.lit("o:all"), F.lit("Omnia"), F.lit("order"), none, none)
    return sp, species.union(genera).union(families).union(order)


@register("match_taxa", f"""WITH RECURSIVE {BACKBONE_SQL},
chain AS (SELECT t.taxon_id, t.taxon_id AS cur, 0 AS d FROM taxa t
  UNION ALL SELECT c.taxon_id, t.accepted_id, c.d + 1 FROM chain c JOIN taxa t ON c.cur = t.taxon_id JOIN taxa u ON u.taxon_id = t.accepted_id),
acc AS (SELECT taxon_id, arg_max(cur, d) AS to_id FROM chain GROUP BY taxon_id),
names AS (SELECT name, taxon_id, to_id FROM taxa JOIN acc USING (taxon_id) WHERE rank = 'species'),
li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 7 AS how, g, e, (l_orderkey + l_partkey) % 97 AS gap
  FROM lineitem JOIN sp ON l_partkey = k),
texts AS (SELECT *, CASE WHEN gap <> 0 THEN CASE how WHEN 2 THEN g || ' ' || left(e, length(e) - 3) || right(e, 2) WHEN 3 THEN g || ' unknownx'
    WHEN 4 THEN g || ' ' || e || ' minor' WHEN 5 THEN 'zzz ' || e ELSE g || ' ' || e END END AS canonical FROM li),
wrong AS (SELECT DISTINCT canonical FROM texts LEFT JOIN names ON canonical = name WHERE name IS NULL AND canonical IS NOT NULL),
near AS (SELECT canonical, min(struct_pack(d := levenshtein(canonical, name), n := name)) AS best FROM wrong JOIN names
  ON abs(length(canonical) - length(name)) <= 1 AND levenshtein(canonical, name) <= 1 GROUP BY canonical),
above AS (SELECT *, CASE WHEN gap = 0 OR how = 5 THEN 'f:' || substr(g, 1, 1) WHEN how <> 4 THEN 'g:' || g END AS up FROM texts)
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS id,
  coalesce(n.to_id, f.to_id, t.up, b.to_id) AS taxon_id, coalesce(n.taxon_id, f.taxon_id, t.up, b.taxon_id) AS matched_id,
  CASE WHEN n.taxon_id IS NOT NULL THEN CASE WHEN n.taxon_id <> n.to_id THEN 'accepted' ELSE 'exact' END
    WHEN f.taxon_id IS NOT NULL THEN 'fuzzy' ELSE 'higher-rank' END AS match_type
FROM above t LEFT JOIN names n ON t.canonical = n.name LEFT JOIN near ON t.canonical = near.canonical LEFT JOIN names f ON f.name = near.best.n
LEFT JOIN names b ON b.name = t.g || ' ' || t.e""")
def q_match_taxa(spark, sf_dir):
    """Records whose names are written with authors, misspelt, of unknown species or genus, infraspecific, upper-case or missing."""
    from florafold.operators.joins import bounded_broadcast
    from florafold.operators.names import match_taxa
    sp, taxa = _backbone(spark, sf_dir)
    how, e, g = F.col("l_linenumber") % 7, F.col("e"), F.initcap("g")
    name = F.concat_ws(" ", g, e)
    misspelt = F.concat(e.substr(F.lit(1), F.length("e") - 3), e.substr(F.length("e") - 1, F.lit(2)))
    text = (F.when(how == 1, F.concat(name, F.lit(" (L.) Smith ex de Vries, 1900"))).when(how == 2, F.concat_ws(" ", g, misspelt))
            .when(how == 3, F.concat(g, F.lit("  cf. unknownx"))).when(how == 4, F.concat(name, F.lit(" subsp. minor Müll.")))
            .when(how == 5, F.concat(F.lit("Zzz "), e)).when(how == 6, F.upper(name)).otherwise(name))
    li = D.load_table(spark, sf_dir, "lineitem").join(bounded_broadcast(sp).withColumnRenamed("k", "l_partkey"), "l_partkey")
    occ = li.select(F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
                    F.when((F.col("l_orderkey") + F.col("l_partkey")) % 97 != 0, text).alias("scientificName"),
                    F.concat(F.substring("g", 1, 1), F.lit("idae")).alias("family"))
    return match_taxa(occ, taxa, higher={"family": "family"}) \
        .select("id", "taxon_id", "matched_id", "match_type")


@register("taxon_classification", f"""WITH {BACKBONE_SQL}
SELECT taxon_id, CASE rank WHEN 'species' THEN taxon_id END AS species_id, CASE rank WHEN 'species' THEN parent_id WHEN 'genus' THEN taxon_id END AS genus_id,
  CASE WHEN rank IN ('species', 'genus') THEN 'f:' || substr(split_part(name, ' ', 1), 1, 1) WHEN rank = 'family' THEN taxon_id END AS family_id,
  'o:all' AS order_id FROM taxa""")
def q_taxon_classification(spark, sf_dir):
    from florafold.operators.names import classification
    return classification(_backbone(spark, sf_dir)[1], ["species", "genus", "family", "order"])


SENS_SQL = """rules AS (SELECT p_name AS taxon,
    CASE WHEN min(p_size) = 10 THEN NULL ELSE 'zone' || CAST((min(p_size) // 10) % 5 AS VARCHAR) END AS zone,
    CASE WHEN min(p_size) = 50 THEN 'withhold' ELSE 'generalise' END AS action,
    CASE WHEN min(p_size) IN (20, 30) THEN 1 ELSE 0 END AS k
  FROM part WHERE p_size % 10 = 0 GROUP BY p_name)"""


def _sens_rules(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part").filter(F.col("p_size") % 10 == 0)
    g = p.groupBy(F.col("p_name").alias("taxon")).agg(F.min("p_size").alias("m"))
    return g.select("taxon",
                    F.when(F.col("m") == 10, F.lit(None).cast("string"))
                    .otherwise(F.concat(F.lit("zone"), (F.floor(F.col("m") / 10) % 5).cast("string"))).alias("zone"),
                    F.when(F.col("m") == 50, F.lit("withhold")).otherwise(F.lit("generalise")).alias("action"),
                    F.when(F.col("m").isin(20, 30), F.lit(1)).otherwise(F.lit(0)).alias("k"))


@register("restrict_sensitive", f"""WITH {OCC_SQL}, {SENS_SQL},
j AS (SELECT o.*, coalesce(z.action, a.action) AS act, coalesce(z.k, a.k) AS kk FROM occ o
  LEFT JOIN (SELECT * FROM rules WHERE zone IS NOT NULL) z ON lower(trim(o.scientificName)) = lower(trim(z.taxon)) AND o.zone = z.zone
  LEFT JOIN (SELECT * FROM rules WHERE zone IS NULL) a ON lower(trim(o.scientificName)) = lower(trim(a.taxon)))
SELECT id,
  CASE WHEN act = 'withhold' THEN NULL WHEN act = 'generalise' THEN floor(decimalLatitude * pow(10.0, kk)) / pow(10.0, kk)
       ELSE decimalLatitude END AS decimalLatitude,
  CASE WHEN act = 'withhold' THEN NULL WHEN act = 'generalise' THEN floor(decimalLongitude * pow(10.0, kk)) / pow(10.0, kk)
       ELSE decimalLongitude END AS decimalLongitude,
  act AS sensitive,
  CASE WHEN act IS NOT NULL THEN decimalLatitude END AS sensitive_decimalLatitude,
  CASE WHEN act IS NOT NULL THEN decimalLongitude END AS sensitive_decimalLongitude
FROM j""")
def q_restrict_sensitive(spark, sf_dir):
    occ = D.occurrences(spark, sf_dir).select("id", "scientificName", "zone", "decimalLatitude", "decimalLongitude")
    out = EN.restrict_sensitive(occ, _sens_rules(spark, sf_dir))
    return out.select("id", "decimalLatitude", "decimalLongitude", "sensitive", "sensitive_decimalLatitude",
                      "sensitive_decimalLongitude")


# ---------------------------------------------------------------- geometry
def _layers(spark, sf_dir):
    r = D.load_table(spark, sf_dir, "region")
    n = D.load_table(spark, sf_dir, "nation")

    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    x0 = F.col("r_regionkey") * 20 - 50
    sq = r.select(F.lit("cl_region").alias("layer_id"),
                  F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("region_id"),
                  F.array(pt(x0, F.lit(-20)), pt(x0 + 20, F.lit(-20)), pt(x0 + 20, F.lit(20)), pt(x0, F.lit(20)))
                  .alias("ring"))
    b = F.col("n_nationkey") * 4 - 50
    tri = n.select(F.lit("cl_band").alias("layer_id"),
                   F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("region_id"),
                   F.array(pt(b, F.lit(-20)), pt(b + 4, F.lit(-20)), pt(b + 2, F.lit(20))).alias("ring"))
    return sq.unionByName(tri)


LAYERS_SQL = """polys AS (
  SELECT 'cl_region' AS layer_id, 'r' || CAST(r_regionkey AS VARCHAR) AS region_id,
    [{'x': r_regionkey * 20 - 50.0, 'y': -20.0}, {'x': r_regionkey * 20 - 30.0, 'y': -20.0},
     {'x': r_regionkey * 20 - 30.0, 'y': 20.0}, {'x': r_regionkey * 20 - 50.0, 'y': 20.0}] AS ring FROM region
  UNION ALL
  SELECT 'cl_band', 'n' || CAST(n_nationkey AS VARCHAR),
    [{'x': n_nationkey * 4 - 50.0, 'y': -20.0}, {'x': n_nationkey * 4 - 46.0, 'y': -20.0},
     {'x': n_nationkey * 4 - 48.0, 'y': 20.0}] FROM nation),
edges AS (SELECT layer_id, region_id, ring[i].x AS x1, ring[i].y AS y1,
    ring[(i % len(ring)) + 1].x AS x2, ring[(i % len(ring)) + 1].y AS y2
  FROM polys, LATERAL generate_series(1, len(ring)) t(i)),
pts AS (SELECT DISTINCT decimalLongitude AS x, decimalLatitude AS y FROM occ
  WHERE decimalLongitude IS NOT NULL AND decimalLatitude IS NOT NULL),
inside AS (SELECT p.x, p.y, e.layer_id, e.region_id FROM pts p JOIN edges e
  ON e.y1 <> e.y2 AND ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.x, p.y, e.layer_id, e.region_id HAVING count(*) % 2 = 1),
per_point AS (SELECT x, y, min(region_id) FILTER (WHERE layer_id = 'cl_region') AS cl_region,
    min(region_id) FILTER (WHERE layer_id = 'cl_band') AS cl_band FROM inside GROUP BY x, y),
sampled AS (SELECT o.id, p.cl_region, p.cl_band FROM occ o
  LEFT JOIN per_point p ON o.decimalLongitude = p.x AND o.decimalLatitude = p.y)"""


def _sampled(spark, sf_dir):
    occ = D.occurrences(spark, sf_dir).select("id", "decimalLatitude", "decimalLongitude")
    return EN.sample_layers(occ, _layers(spark, sf_dir)).select("id", "cl_region", "cl_band")


@register("sample_layers", f"WITH {OCC_SQL}, {LAYERS_SQL} SELECT * FROM sampled")
def q_sample_layers(spark, sf_dir):
    return _sampled(spark, sf_dir)


@register("sample_layers_date_line", f"""WITH {OCC_SQL},
o AS (SELECT id, decimalLatitude AS y, (decimalLongitude + 535.0) % 360.0 - 180.0 AS x FROM occ),
edges AS (SELECT n_nationkey AS k, x1 + s AS x1, y1, x2 + s AS x2, y2 FROM nation, LATERAL (VALUES
    (140.0 + 2 * n_nationkey, -15.0, 178.0 + 2 * n_nationkey, -18.0), (178.0 + 2 * n_nationkey, -18.0, 179.0 + 2 * n_nationkey, 19.0),
    (179.0 + 2 * n_nationkey, 19.0, 140.0 + 2 * n_nationkey, -15.0)) e(x1, y1, x2, y2), (VALUES (0.0), (-360.0)) t(s)),
pts AS (SELECT DISTINCT x, y FROM o),
inside AS (SELECT p.x, p.y, e.k FROM pts p JOIN edges e
  ON ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.x, p.y, e.k HAVING count(*) % 2 = 1),
least AS (SELECT x, y, min('n' || CAST(k AS VARCHAR)) AS cl_triangle FROM inside GROUP BY x, y)
SELECT o.id, l.cl_triangle FROM o LEFT JOIN least l ON o.x = l.x AND o.y = l.y""")
def q_sample_layers_date_line(spark, sf_dir):
    """Triangles on both sides of the date line and over it; longitudes of rings and records from -180 to 180."""
    k = F.col("n_nationkey")

    def pt(x, y):
        return F.struct((F.pmod(x + 180.0, F.lit(360.0)) - 180.0).alias("x"), F.lit(y).alias("y"))

    layers = D.load_table(spark, sf_dir, "nation").select(
        F.lit("cl_triangle").alias("layer_id"), F.concat(F.lit("n"), k.cast("string")).alias("region_id"),
        F.array(pt(140.0 + 2 * k, -15.0), pt(178.0 + 2 * k, -18.0), pt(179.0 + 2 * k, 19.0)).alias("ring"))
    lon = F.pmod(F.col("decimalLongitude") + 535.0, F.lit(360.0)) - 180.0
    occ = D.occurrences(spark, sf_dir).select("id", "decimalLatitude", lon.alias("decimalLongitude"))
    return EN.sample_layers(occ, layers).select("id", "cl_triangle")


@register("sample_grids", f"""WITH {OCC_SQL},
g AS (SELECT p_partkey % 8 - 4 AS cy, p_partkey % 20 - 10 AS cx, min(p_retailprice) AS price, min(p_size) AS size
  FROM part GROUP BY 1, 2)
SELECT o.id, g.price AS el_price, CAST(g.size AS DOUBLE) AS el_size FROM occ o
LEFT JOIN g ON floor(o.decimalLatitude / 5.0) = g.cy AND floor(o.decimalLongitude / 5.0) = g.cx""")
def q_sample_grids(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 8 - 4).alias("cy"), (F.col("p_partkey") % 20 - 10).alias("cx"),
        F.explode(F.create_map(F.lit("el_price"), F.col("p_retailprice"), F.lit("el_size"), F.col("p_size").cast("double")))
        .alias("layer_id", "value"))
    occ = D.occurrences(spark, sf_dir).select("id", "decimalLatitude", "decimalLongitude")
    return EN.sample_grids(occ, p, 5.0).select("id", "el_price", "el_size")


def _ranges(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "part")
    g = p.groupBy(F.pmod(F.col("p_partkey"), F.lit(30)).alias("t")).agg(
        F.min("p_size").alias("mn"), F.max("p_size").alias("mx"))
    x0 = F.col("t") * 3 - 45
    w = F.col("mn") % 20 + 5
    y0 = -10 - F.col("mx") % 7

    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return g.select(F.concat(F.lit("sp"), F.col("t").cast("string")).alias("taxon"),
                    F.array(pt(x0, y0), pt(x0 + w, y0), pt(x0 + w, y0 + 15), pt(x0, y0 + 15)).alias("ring"))


RANGES_SQL = """rg AS (SELECT 'sp' || CAST(t AS VARCHAR) AS taxon,
    [{'x': CAST(t * 3 - 45 AS DOUBLE), 'y': CAST(-10 - mx % 7 AS DOUBLE)},
     {'x': CAST(t * 3 - 45 + mn % 20 + 5 AS DOUBLE), 'y': CAST(-10 - mx % 7 AS DOUBLE)},
     {'x': CAST(t * 3 - 45 + mn % 20 + 5 AS DOUBLE), 'y': CAST(-10 - mx % 7 + 15 AS DOUBLE)},
     {'x': CAST(t * 3 - 45 AS DOUBLE), 'y': CAST(-10 - mx % 7 + 15 AS DOUBLE)}] AS ring
  FROM (SELECT p_partkey % 30 AS t, min(p_size) AS mn, max(p_size) AS mx FROM part GROUP BY 1)),
redges AS (SELECT taxon, ring[i].x AS x1, ring[i].y AS y1, ring[(i % len(ring)) + 1].x AS x2,
    ring[(i % len(ring)) + 1].y AS y2 FROM rg, LATERAL generate_series(1, len(ring)) t(i)),
opts AS (SELECT DISTINCT taxon, decimalLongitude AS x, decimalLatitude AS y FROM occ_todo
  WHERE decimalLongitude IS NOT NULL AND decimalLatitude IS NOT NULL),
rin AS (SELECT p.taxon, p.x, p.y FROM opts p JOIN redges e ON p.taxon = e.taxon
  AND e.y1 <> e.y2 AND ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.taxon, p.x, p.y HAVING count(*) % 2 = 1),
rvec AS (SELECT *, cos(radians(y1)) * cos(radians(x1)) AS a_x, cos(radians(y1)) * sin(radians(x1)) AS a_y, sin(radians(y1)) AS a_z,
    cos(radians(y2)) * cos(radians(x2)) AS b_x, cos(radians(y2)) * sin(radians(x2)) AS b_y, sin(radians(y2)) AS b_z FROM redges),
rnorm AS (SELECT *, a_y * b_z - a_z * b_y AS nx, a_z * b_x - a_x * b_z AS ny, a_x * b_y - a_y * b_x AS nz FROM rvec),
rpair AS (SELECT p.taxon, p.x, p.y, e.*, cos(radians(p.y)) * cos(radians(p.x)) AS px, cos(radians(p.y)) * sin(radians(p.x)) AS py,
    sin(radians(p.y)) AS pz, sqrt(nx * nx + ny * ny + nz * nz) AS nn FROM opts p JOIN rnorm e ON p.taxon = e.taxon),
rnear AS (SELECT taxon, x, y, min(CASE
    WHEN nn > 0 AND (ny * a_z - nz * a_y) * px + (nz * a_x - nx * a_z) * py + (nx * a_y - ny * a_x) * pz >= 0
      AND (b_y * nz - b_z * ny) * px + (b_z * nx - b_x * nz) * py + (b_x * ny - b_y * nx) * pz >= 0
    THEN abs(asin(greatest(-1.0, least(1.0, (nx * px + ny * py + nz * pz) / nn)))) * 6371.0
    ELSE 2 * 6371.0 * asin(least(1.0, sqrt(least(
      pow(sin((radians(y1) - radians(y)) / 2), 2) + cos(radians(y)) * cos(radians(y1)) * pow(sin((radians(x1) - radians(x)) / 2), 2),
      pow(sin((radians(y2) - radians(y)) / 2), 2) + cos(radians(y)) * cos(radians(y2)) * pow(sin((radians(x2) - radians(x)) / 2), 2)))))
    END) AS d FROM rpair GROUP BY taxon, x, y),
rdist AS (SELECT n.taxon, n.x, n.y, CASE WHEN i.taxon IS NOT NULL THEN 0.0 ELSE n.d END AS distance
  FROM rnear n LEFT JOIN rin i ON n.taxon = i.taxon AND n.x = i.x AND n.y = i.y),
outl AS (SELECT o.id, round(r.distance, 3) AS distance, false AS cached FROM occ_todo o
  LEFT JOIN rdist r ON o.taxon = r.taxon AND o.decimalLongitude = r.x AND o.decimalLatitude = r.y)"""


@register("distribution_outliers", f"""WITH {OCC_SQL},
occ_todo AS (SELECT * FROM occ WHERE NOT (split_part(id, '-', 1)::BIGINT % 5 = 0)), {RANGES_SQL}
SELECT * FROM outl UNION ALL
SELECT id, -1.0 AS distance, true AS cached FROM occ WHERE split_part(id, '-', 1)::BIGINT % 5 = 0""")
def q_distribution_outliers(spark, sf_dir):
    occ = D.occurrences(spark, sf_dir)
    cache = occ.filter(F.split("id", "-")[0].cast("bigint") % 5 == 0).select("id", F.lit(-1.0).alias("distance"))
    out = EN.distribution_outliers(occ, _ranges(spark, sf_dir), cache)
    return out.select("id", F.round("distance", 3).alias("distance"), "cached")


# ---------------------------------------------------------------- clusters / jackknife
CLUSTER_SQL = """cb AS (
  SELECT id, dataset_id AS ds, 'location' AS reason,
    scientificName || '|' || CAST(eventDate AS VARCHAR) || '|' || CAST(floor(decimalLatitude / 0.01) AS VARCHAR)
      || '|' || CAST(floor(decimalLongitude / 0.01) AS VARCHAR) AS k
  FROM occ WHERE scientificName IS NOT NULL AND eventDate IS NOT NULL AND decimalLatitude IS NOT NULL
    AND decimalLongitude IS NOT NULL
  UNION ALL SELECT id, dataset_id, 'identifier', catalogNumber FROM occ WHERE catalogNumber IS NOT NULL),
cs AS (SELECT reason, k, min(id) AS cluster_id, count(*) AS cluster_size, count(DISTINCT ds) AS n_datasets
  FROM cb GROUP BY reason, k HAVING count(DISTINCT ds) >= 2),
clusters AS (SELECT b.id, b.reason, s.cluster_id, CAST(s.cluster_size AS BIGINT) AS cluster_size,
    CAST(s.n_datasets AS BIGINT) AS n_datasets FROM cb b JOIN cs s ON b.reason = s.reason AND b.k = s.k)"""


@register("cluster_records", f"WITH {OCC_SQL}, {CLUSTER_SQL} SELECT * FROM clusters")
def q_cluster_records(spark, sf_dir):
    return EN.cluster_records(D.occurrences(spark, sf_dir))


JACK_SQL = """jd AS (SELECT DISTINCT l_partkey AS g, l_extendedprice AS x FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_extendedprice IS NOT NULL),
jw AS (SELECT g, x, lag(x) OVER (PARTITION BY g ORDER BY x) AS px, lead(x) OVER (PARTITION BY g ORDER BY x) AS nx,
    count(*) OVER (PARTITION BY g) AS n, avg(x) OVER (PARTITION BY g) AS m, stddev_samp(x) OVER (PARTITION BY g) AS s
  FROM jd),
jack AS (SELECT g AS l_partkey, x AS l_extendedprice, CAST(n AS BIGINT) AS n,
  coalesce(n >= 10 AND s > 0 AND (CASE WHEN x >= m THEN (x - px) * (x - m) ELSE (nx - x) * (m - x) END) / s
           > 0.95 * sqrt(n) + 0.2, false) AS is_outlier FROM jw)"""


@register("jackknife_outliers", f"WITH {JACK_SQL} SELECT * FROM jack")
def q_jackknife_outliers(spark, sf_dir):
    return EN.jackknife_outliers(D.load_table(spark, sf_dir, "lineitem"), "l_partkey", "l_extendedprice")


# ---------------------------------------------------------------- J16 / J17
@register("image_sync", """SELECT m.page_id, m.url AS identifier, i.image_id FROM pages m
LEFT JOIN (SELECT url, min('img-' || CAST(page_id AS VARCHAR)) AS image_id FROM pages WHERE page_id % 3 <> 0
           GROUP BY url) i ON m.url = i.url""")
def q_image_sync(spark, sf_dir):
    p = D.load_table(spark, sf_dir, "pages")
    mm = p.select("page_id", F.col("url").alias("identifier"))
    images = p.filter(F.col("page_id") % 3 != 0).select(
        F.col("url").alias("identifier"), F.concat(F.lit("img-"), F.col("page_id").cast("string")).alias("image_id"))
    return EN.image_sync(mm, images)


@register("apply_annotations", """WITH a AS (
  SELECT doc_id, 'quality=' || CAST(quality AS VARCHAR) AS annotation FROM labels
  UNION SELECT doc_id, 'toxic=' || CAST(toxic AS VARCHAR) FROM labels),
per AS (SELECT doc_id, list_sort(list(DISTINCT annotation)) AS l FROM a GROUP BY doc_id)
SELECT d.doc_id AS id, d.lang, coalesce(array_to_string(p.l, '|'), '') AS annotations_applied
FROM documents d LEFT JOIN per p ON d.doc_id = p.doc_id""")
def q_apply_annotations(spark, sf_dir):
    docs = D.load_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    lab = D.load_table(spark, sf_dir, "labels")
    ann = lab.select(F.col("doc_id").alias("id"), F.concat(F.lit("quality="), F.col("quality").cast("string")).alias("annotation")) \
        .unionByName(lab.select(F.col("doc_id").alias("id"),
                                F.concat(F.lit("toxic="), F.col("toxic").cast("string")).alias("annotation")))
    out = EN.apply_annotations(docs, ann)
    return arrays_as_text(out.withColumn("id", F.col("id").cast("bigint")))


# ---------------------------------------------------------------- C8 full index
@register("assemble_index", f"""WITH {OCC_SQL}, {LAYERS_SQL},
occ_todo AS (SELECT * FROM occ), {RANGES_SQL}, {CLUSTER_SQL}, {JACK_SQL},
s1 AS (SELECT id, min(cl_region) AS cl_region, min(cl_band) AS cl_band FROM sampled GROUP BY id),
s2 AS (SELECT o.id, bool_or(j.is_outlier) AS is_outlier FROM occ o JOIN jack j
       ON o.l_partkey = j.l_partkey AND o.l_extendedprice = j.l_extendedprice GROUP BY o.id),
s3 AS (SELECT id, CAST(count(*) AS BIGINT) AS n_dup_reasons FROM clusters GROUP BY id),
s4 AS (SELECT id, min(distance) AS distance FROM outl GROUP BY id)
SELECT o.id, o.dataset_id, s1.cl_region, s1.cl_band, s2.is_outlier, s3.n_dup_reasons, s4.distance
FROM occ o LEFT JOIN s1 ON o.id = s1.id LEFT JOIN s2 ON o.id = s2.id LEFT JOIN s3 ON o.id = s3.id
LEFT JOIN s4 ON o.id = s4.id""")
def q_assemble_index(spark, sf_dir):
    from florafold.plans.jobs import full_index
    return full_index(spark, D.occurrences(spark, sf_dir), _layers(spark, sf_dir), _ranges(spark, sf_dir),
                      jackknife=("l_partkey", "l_extendedprice")) \
        .select("id", "dataset_id", "cl_region", "cl_band", "is_outlier", "n_dup_reasons",
                F.round("distance", 3).alias("distance"))


# ---------------------------------------------------------------- S10 / S11 / S12
@register("archive_roundtrip", """SELECT o.o_orderkey, 'dr' || CAST(o.o_custkey % 10 AS VARCHAR) AS dataset_id,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_lineitem, false AS duplicate
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON o.o_orderkey = l.l_orderkey""")
def q_archive_roundtrip(spark, sf_dir):
    from florafold.session import scratch_dir
    from florafold.sources.archive import read_archive
    from florafold.sources.sinks import export_archive
    o = D.load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string")).alias("dataset_id"))
    li = D.load_table(spark, sf_dir, "lineitem").join(o.select("o_orderkey", "dataset_id"),
                                                      F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("o_orderkey", "l_linenumber", "l_quantity", "dataset_id")
    root = scratch_dir(spark, "archive")
    export_archive(o, {"lineitem": li}, root)
    core, _ = read_archive(spark, root, "core", ["lineitem"], "o_orderkey")
    return core.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                       F.col("dataset_id").cast("string").alias("dataset_id"),
                       F.col("n_lineitem").cast("bigint").alias("n_lineitem"), "duplicate")


@register("event_documents", """SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(NULL AS VARCHAR) AS parent_id,
  'event' AS kind, o_orderstatus AS key_field FROM orders
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
  || '-' || CAST(l_suppkey AS VARCHAR), CAST(l_orderkey AS VARCHAR), 'occurrence', CAST(l_linenumber AS VARCHAR)
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def q_event_documents(spark, sf_dir):
    docs = _event_documents(spark, sf_dir)
    key = F.coalesce(F.get_json_object("document", "$.o_orderstatus"), F.get_json_object("document", "$.l_linenumber"))
    return docs.select("doc_id", "parent_id", "kind", key.alias("key_field"))


def _event_documents(spark, sf_dir):
    from florafold.operators.export import event_documents
    ev = D.load_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("eventID"), "o_orderstatus",
                                                       "o_totalprice")
    li = D.load_table(spark, sf_dir, "lineitem")
    occ = li.select(F.concat_ws("-", *[F.col(c).cast("string") for c in
                                       ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
                    F.col("l_orderkey").alias("eventID"), "l_linenumber", "l_quantity")
    return event_documents(ev, occ)


_NOTE_SQL = """CASE o_orderkey % 5 WHEN 0 THEN o_orderstatus || chr(10) || o_orderpriority
    WHEN 1 THEN '"' || o_orderpriority || '" said' WHEN 2 THEN 'a' || chr(9) || 'b' || chr(92) || 'c ' WHEN 3 THEN '' END"""


@register("archive_values", f"""SELECT 'core' AS resource, o_orderkey, {_NOTE_SQL} AS note,
  CAST(NULL AS INTEGER) AS line_number, CAST(NULL AS DOUBLE) AS quantity FROM orders
UNION ALL SELECT 'lineitem', l_orderkey, NULL, l_linenumber, l_quantity FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def q_archive_values(spark, sf_dir):
    """Field values of core and extension after export and read: line breaks, quotes, tabs,
    backslashes, empty and null text."""
    from florafold.session import scratch_dir
    from florafold.sources.archive import read_archive
    from florafold.sources.sinks import export_archive
    k = F.col("o_orderkey") % 5
    note = (F.when(k == 0, F.concat_ws("\n", "o_orderstatus", "o_orderpriority"))
            .when(k == 1, F.concat(F.lit('"'), "o_orderpriority", F.lit('" said')))
            .when(k == 2, F.lit("a\tb\\c ")).when(k == 3, F.lit("")))
    o = D.load_table(spark, sf_dir, "orders").select(
        "o_orderkey", note.alias("note"), F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string")).alias("dataset_id"))
    li = D.load_table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey") \
        .join(o.select("o_orderkey", "dataset_id"), "o_orderkey") \
        .select("o_orderkey", "l_linenumber", "l_quantity", "dataset_id")
    root = scratch_dir(spark, "archive")
    export_archive(o, {"lineitem": li}, root)
    core, ext = read_archive(spark, root, "core", ["lineitem"], "o_orderkey")
    key = F.col("o_orderkey").cast("bigint").alias("o_orderkey")
    return core.select(F.lit("core").alias("resource"), key, "note", F.lit(None).cast("int").alias("line_number"),
                       F.lit(None).cast("double").alias("quantity")).unionByName(
        ext["lineitem"].select(F.lit("lineitem").alias("resource"), key, F.lit(None).cast("string").alias("note"),
                               F.col("l_linenumber").cast("int").alias("line_number"),
                               F.col("l_quantity").cast("double").alias("quantity")))


@register("event_document_bodies", """SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, o_orderkey AS event_id, o_orderstatus AS status,
  o_totalprice AS total_price, CAST(NULL AS INTEGER) AS line_number, CAST(NULL AS DOUBLE) AS quantity,
  'eventID,o_orderstatus,o_totalprice' AS fields FROM orders
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
  || '-' || CAST(l_suppkey AS VARCHAR), l_orderkey, NULL, NULL, l_linenumber, l_quantity,
  'eventID,id,l_linenumber,l_quantity'
FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def q_event_document_bodies(spark, sf_dir):
    """Every field of every document, and the list of its field names."""
    body = F.from_json("document", "eventID bigint, id string, o_orderstatus string, o_totalprice double, "
                                   "l_linenumber int, l_quantity double").alias("b")
    return _event_documents(spark, sf_dir).select(
        "doc_id", body, F.array_join(F.array_sort(F.json_object_keys("document")), ",").alias("fields")).select(
        "doc_id", F.col("b.eventID").alias("event_id"), F.col("b.o_orderstatus").alias("status"),
        F.col("b.o_totalprice").alias("total_price"), F.col("b.l_linenumber").alias("line_number"),
        F.col("b.l_quantity").alias("quantity"), "fields")


NESTED_SQL = """ev AS (SELECT o_orderkey AS eventID, o_orderstatus AS status FROM orders WHERE o_orderkey % 10 <> 9),
oc AS (SELECT CASE WHEN l_suppkey % 50 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 1 ELSE l_orderkey END AS eventID,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS id,
    l_linenumber AS line, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity FROM lineitem)"""


@register("event_documents_nested", f"""WITH {NESTED_SQL},
sized AS (SELECT oc.*, strlen(CAST(to_json(struct_pack(id := id, line := line, quantity := quantity)) AS VARCHAR)) AS bytes
  FROM oc WHERE eventID IN (SELECT eventID FROM ev)),
placed AS (SELECT *, (sum(bytes) OVER (PARTITION BY eventID ORDER BY id, line, quantity ROWS UNBOUNDED PRECEDING) - bytes) // 600 AS part FROM sized),
pieces AS (SELECT eventID, part, list(struct_pack(id := id, line := line, quantity := quantity) ORDER BY id, line, quantity) AS kids
  FROM placed GROUP BY eventID, part),
numbered AS (SELECT *, row_number() OVER (PARTITION BY eventID ORDER BY part) - 1 AS no, count(*) OVER (PARTITION BY eventID) AS n FROM pieces)
SELECT ev.eventID AS event_id, CAST(coalesce(no, 0) AS INTEGER) AS piece, CAST(coalesce(n, 1) AS INTEGER) AS n_pieces,
  CAST(coalesce(len(kids), 0) AS INTEGER) AS n_children,
  '{{"eventID":' || CAST(ev.eventID AS VARCHAR) || ',"status":"' || status || '","piece":' || CAST(coalesce(no, 0) AS VARCHAR) || ',"occurrences":'
    || coalesce(CAST(to_json(kids) AS VARCHAR), '[]') || '}}' AS document
FROM ev LEFT JOIN numbered USING (eventID)""")
def q_event_documents_nested(spark, sf_dir):
    """Whole documents; a third of the occurrences belong to one event, which spans many pieces."""
    return _nested(spark, sf_dir)[0].withColumnRenamed("eventID", "event_id")


@register("event_documents_unplaced", f"""WITH {NESTED_SQL}
SELECT eventID AS event_id, id FROM oc WHERE eventID IS NULL OR eventID NOT IN (SELECT eventID FROM ev)""")
def q_event_documents_unplaced(spark, sf_dir):
    return _nested(spark, sf_dir)[1].select(F.col("eventID").alias("event_id"), "id")


def _nested(spark, sf_dir):
    from florafold.operators.export import nested_documents
    ev = D.load_table(spark, sf_dir, "orders").where("o_orderkey % 10 <> 9").select(
        F.col("o_orderkey").alias("eventID"), F.col("o_orderstatus").alias("status"))
    event = F.when(F.col("l_suppkey") % 50 != 0, F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(F.col("l_orderkey")))
    occ = D.load_table(spark, sf_dir, "lineitem").select(
        event.alias("eventID"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("id"),
        F.col("l_linenumber").alias("line"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity").cast("int")).alias("quantity"))
    return nested_documents(ev, occ, "eventID", ["id", "line", "quantity"], max_bytes=600)


@register("archive_documents", """WITH li AS (SELECT l_orderkey AS k, CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS VARCHAR) AS part FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
SELECT CAST(o_orderkey AS VARCHAR) AS core_id, CAST(count(k) AS INTEGER) AS n_children, CAST(coalesce(
  to_json(list(struct_pack(line := line, part := part) ORDER BY line, part) FILTER (WHERE k IS NOT NULL)), '[]') AS VARCHAR) AS items
FROM orders LEFT JOIN li ON k = o_orderkey GROUP BY o_orderkey""")
def q_archive_documents(spark, sf_dir):
    """Records of an archive that was written and read again, with their extension rows nested."""
    from florafold.operators.export import nested_documents
    from florafold.session import scratch_dir
    from florafold.sources.archive import read_archive
    from florafold.sources.sinks import export_archive
    ds = F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string")).alias("dataset_id")
    o = D.load_table(spark, sf_dir, "orders").select("o_orderkey", ds)
    li = D.load_table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), "dataset_id")
    root = scratch_dir(spark, "archive")
    export_archive(o, {"lineitem": li}, root)
    core, ext = read_archive(spark, root, "core", ["lineitem"], "o_orderkey")
    docs, _ = nested_documents(core.select("o_orderkey"), ext["lineitem"].drop("dataset_id"), "o_orderkey", ["line", "part"], "items")
    return docs.select(F.col("o_orderkey").alias("core_id"), "n_children", F.get_json_object("document", "$.items").alias("items"))


@register("search_facet", """SELECT event_type AS value, CAST(count(*) AS BIGINT) AS count FROM events
WHERE value > 50 AND event_type IS NOT NULL GROUP BY 1""")
def q_search_facet(spark, sf_dir):
    """The facet of a search."""
    from florafold.operators.checks import search
    ev = D.load_table(spark, sf_dir, "events")
    return search(ev, fq=[F.col("value") > 50], facet="event_type")[2]


@register("search_page", """SELECT * FROM events WHERE event_type = 'click' ORDER BY value DESC, event_id LIMIT 20""")
def q_search_page(spark, sf_dir):
    """One page of a search, in order."""
    from florafold.operators.checks import search
    ev = D.load_table(spark, sf_dir, "events")
    return search(ev, q=F.col("event_type") == "click", page_size=20,
                  order=[F.col("value").desc(), F.col("event_id").asc()])[1]


@register("export_values", """SELECT o.o_orderkey, 'dr' || CAST(o.o_custkey % 10 AS VARCHAR) AS dataset_id, o.o_totalprice, l.l_linenumber,
  l.l_quantity FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderstatus IN ('F') AND o.o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_export_values(spark, sf_dir):
    """The written core and extension rows, joined again."""
    from florafold.operators.export import export_download
    from florafold.plans.registry import PREDICATE
    from florafold.session import scratch_dir
    from florafold.sources.archive import read_archive
    o = D.load_table(spark, sf_dir, "orders").withColumn(
        "dataset_id", F.concat(F.lit("dr"), (F.col("o_custkey") % 10).cast("string")))
    li = D.load_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    dest = scratch_dir(spark, "export")
    export_download(o, PREDICATE, {"lineitem": li}, dest, core_id="o_orderkey")
    core, ext = read_archive(spark, dest, "core", ["lineitem"], "o_orderkey")
    rows = core.select("o_orderkey", "dataset_id", "o_totalprice").join(ext["lineitem"].drop("dataset_id"), "o_orderkey", "left")
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "dataset_id",
                       F.col("o_totalprice").cast("double").alias("o_totalprice"),
                       F.col("l_linenumber").cast("int").alias("l_linenumber"),
                       F.col("l_quantity").cast("double").alias("l_quantity"))


# ---------------------------------------------------------------- composite planning jobs
from florafold.plans import jobs as JB  # noqa: E402
from florafold.plans.registry import (_INV_SQL, _IMAGES_SQL, SYNC_VERSION, _sync_cutoff, sql_dataset_sizes,  # noqa: E402
                                      sql_partition_by_size)

ZIP_SPECS = [("small", 4, 50000000), ("large", 3, 200000000), ("xlarge", 2, None)]


@register("plan_ingest", f"""WITH {_INV_SQL}, z AS ({sql_dataset_sizes('dwca', excluded=['dr3', 'dr7'])}),
pb AS ({sql_partition_by_size('z', ZIP_SPECS)}) SELECT * FROM pb""")
def q_plan_ingest(spark, sf_dir):
    return JB.plan_ingest(D.inventory(spark, sf_dir), ZIP_SPECS, excluded=["dr3", "dr7"])


@register("plan_image_sync", f"""WITH {_IMAGES_SQL}, {_INV_SQL},
recent AS (SELECT dataset_id FROM img WHERE uploaded >= DATE '{_sync_cutoff()}'
           AND uploaded <= current_date AND dataset_id <> 'no_dataresource'),
reidx AS ({sql_dataset_sizes('index_avro', _sync_cutoff())}),
cand AS (SELECT dataset_id FROM recent INTERSECT SELECT dataset_id FROM reidx),
ids AS (SELECT dataset_id, row_number() OVER (ORDER BY dataset_id) - 1 AS i, count(*) OVER () AS c FROM cand),
nb AS (SELECT least(CAST(ceil(max(c) / 4.0) AS BIGINT), 3) AS n FROM ids)
SELECT CAST(i % n AS INTEGER) AS batch, CAST(floor((c - 1 - i % n) / n) - floor(i / n) AS BIGINT) AS position,
  dataset_id, CAST(n AS INTEGER) AS n_batches FROM ids, nb""")
def q_plan_image_sync(spark, sf_dir):
    return JB.plan_image_sync(D.image_uploads(spark, sf_dir), D.inventory(spark, sf_dir), None, 4, 3, version=SYNC_VERSION)


@register("plan_dataset_load", f"""WITH {_INV_SQL},
ids AS (SELECT 'dr' || CAST(n_nationkey AS VARCHAR) AS dataset_id FROM nation WHERE n_regionkey = 2),
d AS (SELECT *, CASE WHEN starts_with(key, 'dwca-imports/')
        THEN regexp_extract(substr(key, 14), '^([^/]+)/', 1) ELSE '' END AS dataset_id FROM inv),
s AS (SELECT dataset_id, CAST(sum(size) AS BIGINT) AS size FROM d
      WHERE dataset_id IN (SELECT dataset_id FROM ids)
        AND starts_with(key, 'dwca-imports/' || dataset_id || '/' || dataset_id || '.zip') GROUP BY dataset_id)
SELECT dataset_id, size, CASE WHEN size <= 5000000 THEN 'small' WHEN size < 5000000000 THEN 'large'
  ELSE 'xlarge' END AS size_class FROM s""")
def q_plan_dataset_load(spark, sf_dir):
    r = D.load_table(spark, sf_dir, "region")
    ids = r.filter(F.col("r_regionkey") == 2).select(
        F.concat(F.lit("dp"), F.col("r_regionkey").cast("string")).alias("uid"))
    classes, _ = JB.plan_dataset_load(ids, D.provider_registry(spark, sf_dir), D.inventory(spark, sf_dir), 2, 3)
    return classes


_LOAD_SIZES_SQL = f"""{_INV_SQL},
ids AS (SELECT 'dr' || CAST(n_nationkey AS VARCHAR) AS dataset_id FROM nation WHERE n_regionkey = 2),
d AS (SELECT *, CASE WHEN starts_with(key, 'dwca-imports/')
        THEN regexp_extract(substr(key, 14), '^([^/]+)/', 1) ELSE '' END AS dataset_id FROM inv),
s AS (SELECT dataset_id, CAST(sum(size) AS BIGINT) AS size FROM d
      WHERE dataset_id IN (SELECT dataset_id FROM ids)
        AND starts_with(key, 'dwca-imports/' || dataset_id || '/' || dataset_id || '.zip') GROUP BY dataset_id),
c AS (SELECT *, CASE WHEN size <= 5000000 THEN 'small' WHEN size < 5000000000 THEN 'large'
  ELSE 'xlarge' END AS size_class FROM s)"""


def _load_dispatch(spark, sf_dir):
    ids = D.load_table(spark, sf_dir, "region").filter(F.col("r_regionkey") == 2).select(
        F.concat(F.lit("dp"), F.col("r_regionkey").cast("string")).alias("uid"))
    return JB.plan_load_dispatch(ids, D.provider_registry(spark, sf_dir), D.inventory(spark, sf_dir), 3)


@register("plan_load_dispatch", f"""WITH {_LOAD_SIZES_SQL},
n AS (SELECT k.size_class, CAST(count(c.dataset_id) AS BIGINT) AS n
  FROM (VALUES ('small'), ('large'), ('xlarge')) k(size_class) LEFT JOIN c ON c.size_class = k.size_class
  GROUP BY k.size_class)
SELECT size_class, n, CASE WHEN n = 0 THEN 'skip' WHEN n > 3 THEN 'batch' ELSE 'direct' END AS mode FROM n""")
def q_plan_load_dispatch(spark, sf_dir):
    return _load_dispatch(spark, sf_dir)[0]


@register("plan_load_class_lists", f"""WITH {_LOAD_SIZES_SQL}
SELECT size_class, CAST(row_number() OVER (PARTITION BY size_class ORDER BY size DESC, dataset_id) - 1 AS BIGINT) AS position,
  dataset_id, size FROM c""")
def q_plan_load_class_lists(spark, sf_dir):
    return _load_dispatch(spark, sf_dir)[1]


_INGEST_COLUMNS = "scientificName, taxon, catalogNumber, zone, l_partkey, l_extendedprice"


@register("ingest_dataset", f"""WITH {OCC_SQL}, {INTERP_SQL.replace('SELECT id, dataset_id,', f'SELECT id, dataset_id, {_INGEST_COLUMNS},')},
{SENS_SQL},
taxa AS (SELECT p_name AS name, 'species' AS rank, 'sp:' || p_name AS taxon_id FROM part
  UNION SELECT split_part(p_name, ' ', 1), 'genus', 'g:' || split_part(p_name, ' ', 1) FROM part),
exact AS (SELECT lower(trim(name)) AS n, min(taxon_id) AS taxon_id FROM taxa GROUP BY 1),
genus AS (SELECT lower(trim(name)) AS n, min(taxon_id) AS taxon_id FROM taxa WHERE rank = 'genus' GROUP BY 1),
vocab AS (SELECT lower(trim(p_name)) AS n, min(upper(p_name)) AS canonical FROM part GROUP BY 1),
keyed AS (SELECT *, CAST(length(dataset_id) AS VARCHAR) || ':' || dataset_id || '|' || CAST(length(id) AS VARCHAR)
    || ':' || id AS k0, CAST(split_part(id, '-', 1) AS BIGINT) % 2 <> 0 AS is_new, lower(trim(scientificName)) AS n
  FROM interp),
named AS (SELECT i.*, CASE WHEN i.is_new THEN {_UUID_SQL.replace('(k)', '(i.k0)')} ELSE 'u-' || i.id END AS uuid, v.canonical,
    coalesce(e.taxon_id, g.taxon_id) AS taxon_id,
    CASE WHEN e.n IS NOT NULL THEN 'exact' WHEN g.n IS NOT NULL THEN 'genus' ELSE 'none' END AS match_type,
    coalesce(z.action, a.action) AS act, coalesce(z.k, a.k) AS kk
  FROM keyed i LEFT JOIN vocab v ON i.n = v.n LEFT JOIN exact e ON i.n = e.n
  LEFT JOIN genus g ON split_part(i.n, ' ', 1) = g.n
  LEFT JOIN (SELECT * FROM rules WHERE zone IS NOT NULL) z ON i.n = lower(trim(z.taxon)) AND i.zone = z.zone
  LEFT JOIN (SELECT * FROM rules WHERE zone IS NULL) a ON i.n = lower(trim(a.taxon)))
SELECT uuid AS id, catalogNumber, dataset_id, match_type, scientificName, canonical AS scientificName_norm,
  act AS sensitive, taxon, taxon_id, k0 AS unique_key, uuid, zone,
  CASE WHEN act = 'withhold' THEN NULL WHEN act = 'generalise'
       THEN floor(decimalLatitude * pow(10.0, kk)) / pow(10.0, kk) + 0.0 ELSE decimalLatitude END AS decimalLatitude,
  CASE WHEN act = 'withhold' THEN NULL WHEN act = 'generalise'
       THEN floor(decimalLongitude * pow(10.0, kk)) / pow(10.0, kk) + 0.0 ELSE decimalLongitude END AS decimalLongitude,
  l_extendedprice, individualCount, l_partkey, is_new,
  CAST(date_diff('day', DATE '1970-01-01', eventDate) AS BIGINT) * 86400000 AS eventDate,
  array_to_string(issues, '|') AS issues FROM named""")
def q_ingest_dataset(spark, sf_dir):
    """C7 end to end into a fresh dataset-partitioned table, read back and flattened."""
    from florafold.session import scratch_dir
    occ, sides = _ingest_inputs(spark, sf_dir)
    table = scratch_dir(spark, "ingest")
    JB.ingest_dataset(occ, *sides, table, max_new_pct=100)
    return arrays_as_text(FL.flatten_index(spark.read.parquet(table).drop("dataset_id"), merge_duplicate_ids=False))


def _ingest_inputs(spark, sf_dir):
    occ = D.occurrences(spark, sf_dir).drop("decimalLatitude", "decimalLongitude", "eventDate")
    p = D.load_table(spark, sf_dir, "part")
    vocab = p.select(F.col("p_name").alias("label"), F.upper("p_name").alias("canonical")).distinct()
    g = F.split(F.col("p_name"), " ")[0]
    taxa = p.select(F.col("p_name").alias("name"), F.lit("species").alias("rank"),
                    F.concat(F.lit("sp:"), F.col("p_name")).alias("taxon_id")).unionByName(
        p.select(g.alias("name"), F.lit("genus").alias("rank"), F.concat(F.lit("g:"), g).alias("taxon_id"))).distinct()
    existing = occ.filter(F.split("id", "-")[0].cast("bigint") % 2 == 0).select(
        EN.unique_key(F.col("dataset_id"), F.col("id")).alias("unique_key"), F.concat(F.lit("u-"), F.col("id")).alias("uuid"))
    return occ, (RULES, vocab, "scientificName", taxa, existing, ["id"], _sens_rules(spark, sf_dir))


@register("ingest_archive", ORACLE["ingest_dataset"].replace("AS issues FROM named", """AS issues,
  CASE WHEN CAST(substr(catalogNumber, 4) AS BIGINT) % 2 = 0 THEN 'img-' || catalogNumber END AS image_id FROM named"""))
def q_ingest_archive(spark, sf_dir):
    """C7 from an archive's files on, with stored images; the guard against new ids fails first."""
    from florafold.session import scratch_dir
    from florafold.sources.sinks import export_archive
    occ, sides = _ingest_inputs(spark, sf_dir)
    root, table = scratch_dir(spark, "archive"), scratch_dir(spark, "ingest")
    export_archive(occ, {}, root)
    images = occ.where("cast(substr(catalogNumber, 4) as bigint) % 2 = 0").select(
        F.col("catalogNumber").alias("identifier"), F.concat(F.lit("img-"), F.col("catalogNumber")).alias("image_id")).distinct()
    how = {"images": images, "url_col": "catalogNumber", "table": table}
    try:
        JB.ingest_archive(spark, root, "core", "id", *sides, max_new_pct=10, **how)
        raise AssertionError("half of the ids are new")
    except ValueError:
        pass
    JB.ingest_archive(spark, root, "core", "id", *sides, max_new_pct=90, **how)
    flat = FL.flatten_index(spark.read.parquet(table).drop("dataset_id"), merge_duplicate_ids=False)
    return arrays_as_text(flat.withColumn("l_partkey", F.col("l_partkey").cast("bigint"))
                          .withColumn("l_extendedprice", F.col("l_extendedprice").cast("double")))


@register("index_and_publish", f"""WITH {OCC_SQL}, {LAYERS_SQL},
s AS (SELECT o.*, p.cl_region AS cl959, p.cl_band AS cl1048 FROM occ o LEFT JOIN per_point p ON o.decimalLongitude = p.x AND o.decimalLatitude = p.y)
SELECT CAST(number AS BIGINT) AS number, 'occindex-2024-0' || CAST(number AS VARCHAR) || '-01-00-00' AS version, count(*) AS n_rows, count(cl959) AS n_cl959,
  count(cl1048) AS n_cl1048, CAST(count(*) FILTER (WHERE number = 2 AND zone = 'zone1') AS BIGINT) AS n_annotated, number = 2 AS live
FROM s, (VALUES (1), (2)) v(number) WHERE number = 2 OR split_part(id, '-', 2) <> '1' GROUP BY number""")
def q_index_and_publish(spark, sf_dir):
    """A first index, a larger one with annotations that passes its checks, a smaller one that fails them."""
    from florafold.plans import commits as CM
    from florafold.session import scratch_dir
    root, alias = scratch_dir(spark, "index"), "occindex"
    occ = D.occurrences(spark, sf_dir).withColumn("dataResourceUid", F.col("dataset_id"))
    layers = _layers(spark, sf_dir).replace({"cl_region": "cl959", "cl_band": "cl1048"}, subset=["layer_id"])
    notes = occ.where("zone = 'zone1'").select("id", F.lit("checked").alias("annotation"))
    flags = {"jackknife": False, "clustering": False, "outlier": False}
    checks = ["check_data_resources", "check_total_count", "check_spatial_layer_cl959", "check_spatial_layer_cl1048"]
    name = lambda k: f"occindex-2024-0{k}-01-00-00"
    some = occ.where(F.split("id", "-")[1] != "1")
    none = notes.where("false")
    JB.index_and_publish(spark, some, layers, _ranges(spark, sf_dir), root, alias, name(1), none, flags)
    JB.index_and_publish(spark, occ, layers, _ranges(spark, sf_dir), root, alias, name(2), notes, flags, checks=checks)
    failed = JB.index_and_publish(spark, some.where("dataset_id = 'dr1'"), layers, _ranges(spark, sf_dir), root, alias, name(3), none, flags, checks=checks)
    assert failed[2].first()["action"] == "blocked"
    log, live = CM.history(spark, root, alias), CM.current(spark, root, alias)["number"]
    data = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").withColumn(
        "folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    per = data.groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"), F.count("cl959").alias("n_cl959"), F.count("cl1048").alias("n_cl1048"),
                                     F.count(F.when(F.size("annotations_applied") > 0, 1)).alias("n_annotated"))
    return log.withColumn("folder", F.substring_index("path", "/", -1)).join(per, "folder").select(
        "number", "version", "n_rows", "n_cl959", "n_cl1048", "n_annotated", (F.col("number") == live).alias("live"))


@register("object_inventory", """SELECT 'dr' || CAST(c_nationkey AS VARCHAR) AS dataset_id,
  CAST(sum(strlen(CAST(c_custkey AS VARCHAR) || ' ' || c_name) + 1) AS BIGINT) AS bytes, true AS written_now
FROM customer GROUP BY c_nationkey""")
def q_object_inventory(spark, sf_dir):
    """S2 over text files of the customers, a folder per nation: bytes listed per dataset."""
    from florafold.session import scratch_dir
    from florafold.sources.catalog import object_inventory
    root = scratch_dir(spark, "objects")
    D.load_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("dr"), F.col("c_nationkey").cast("string")).alias("dataset"),
        F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name").alias("line")) \
        .write.partitionBy("dataset").text(root)
    listed = object_inventory(spark, root, "*.txt")
    now = F.max("modified") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return listed.groupBy(F.regexp_extract("key", "^dataset=([^/]+)/", 1).alias("dataset_id")).agg(
        F.sum("size").cast("bigint").alias("bytes"), now.alias("written_now"))


@register("cluster_records_near", f"""WITH RECURSIVE {OCC_SQL},
nrec AS (SELECT id, dataset_id AS ds, taxon AS t, date_trunc('month', eventDate) AS d, CAST(floor(decimalLatitude) AS BIGINT) AS cy,
    CAST(floor(decimalLongitude) AS BIGINT) AS cx FROM occ WHERE taxon IS NOT NULL AND eventDate IS NOT NULL
    AND decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL),
blocks AS (SELECT DISTINCT t, d, cy, cx FROM nrec),
links AS (SELECT a.t, a.d, a.cy, a.cx, b.cy AS ny, b.cx AS nx FROM blocks a JOIN blocks b ON a.t = b.t AND a.d = b.d
  WHERE abs(a.cy - b.cy) <= 1 AND abs(a.cx - b.cx) <= 1),
reach AS (SELECT t, d, cy, cx, cy AS ly, cx AS lx FROM blocks
  UNION SELECT r.t, r.d, l.ny, l.nx, r.ly, r.lx FROM reach r
  JOIN links l ON r.t = l.t AND r.d = l.d AND r.cy = l.cy AND r.cx = l.cx),
comp AS (SELECT t, d, cy, cx, min(ly * 1000 + lx) AS label FROM reach GROUP BY t, d, cy, cx),
member AS (SELECT n.id, n.ds, c.t, c.d, c.label FROM nrec n
  JOIN comp c ON n.t = c.t AND n.d = c.d AND n.cy = c.cy AND n.cx = c.cx),
groups AS (SELECT t, d, label, min(id) AS cluster_id, count(*) AS cluster_size, count(DISTINCT ds) AS n_datasets
  FROM member GROUP BY t, d, label HAVING count(DISTINCT ds) >= 2)
SELECT m.id, 'location_near' AS reason, g.cluster_id, CAST(g.cluster_size AS BIGINT) AS cluster_size,
  CAST(g.n_datasets AS BIGINT) AS n_datasets FROM member m JOIN groups g ON m.t = g.t AND m.d = g.d AND m.label = g.label""")
def q_cluster_records_near(spark, sf_dir):
    """J14 with neighbouring cells, per taxon and month (also tested against a brute-force union-find)."""
    occ = D.occurrences(spark, sf_dir).withColumn("eventMonth", F.trunc("eventDate", "month"))
    return EN.cluster_records_near(occ, taxon_col="taxon", date_col="eventMonth", cell=1.0)


@register("plan_dataset_load_batches", f"""WITH {_INV_SQL},
ids AS (SELECT 'dr' || CAST(n_nationkey AS VARCHAR) AS dataset_id FROM nation WHERE n_regionkey = 2),
d AS (SELECT *, CASE WHEN starts_with(key, 'dwca-imports/')
        THEN regexp_extract(substr(key, 14), '^([^/]+)/', 1) ELSE '' END AS dataset_id FROM inv),
s AS (SELECT dataset_id, CAST(sum(size) AS BIGINT) AS size FROM d
      WHERE dataset_id IN (SELECT dataset_id FROM ids)
        AND starts_with(key, 'dwca-imports/' || dataset_id || '/' || dataset_id || '.zip') GROUP BY dataset_id),
r AS (SELECT dataset_id, row_number() OVER (ORDER BY size DESC, dataset_id ASC) - 1 AS i, count(*) OVER () AS c FROM s),
nb AS (SELECT least(CAST(ceil(max(c) / 2.0) AS BIGINT), 3) AS n FROM r)
SELECT CAST(i % n AS INTEGER) AS batch, CAST(floor((c - 1 - i % n) / n) - floor(i / n) AS BIGINT) AS position,
  dataset_id, CAST(n AS INTEGER) AS n_batches FROM r, nb""")
def q_plan_dataset_load_batches(spark, sf_dir):
    r = D.load_table(spark, sf_dir, "region")
    ids = r.filter(F.col("r_regionkey") == 2).select(
        F.concat(F.lit("dp"), F.col("r_regionkey").cast("string")).alias("uid"))
    _, batches = JB.plan_dataset_load(ids, D.provider_registry(spark, sf_dir), D.inventory(spark, sf_dir), 2, 3)
    return batches
