"""Stand-in inputs derived by Spark from the driver tables.

The reference reads occurrence index records, object-store listings, search
facets and registry entries. The test tables are TPC-H-like, so every query
first derives the reference's input shape from them with ordinary joins and
projections; the derived frames grow with the tables. Edge cases (null and
empty maps, duplicate ids, case-colliding keys, sensitive keys) are placed by
key arithmetic so DuckDB oracles can reproduce them exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florafold.session import load_table


def _k(name: str = "o_orderkey"):
    return F.col(name)


def index_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index records (id, multimedia, annotations, seven typed maps) from orders ⨝ customer.

    Placement (k = o_orderkey):
      id null when k % 97 = 5; id of k-1 (duplicate id) when k % 53 = 7;
      strings map null when k % 31 = 0, empty when k % 37 = 0;
      key 'Market-Segment' when k % 3 = 0 else 'market segment';
      key 'CustKey' when k % 4 = 0 else 'custKey' (longs);
      'comment' value null when k % 7 = 0; doubles map null when k % 11 = 0.
    """
    k = _k()
    rid = (F.when(k % 97 == 5, F.lit(None).cast("string"))
           .when(k % 53 == 7, (k - 1).cast("string"))
           .otherwise(k.cast("string")))
    return _records(_orders_customers(spark, sf_dir), rid)


def index_records_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records keyed by the plain order key (unique, never null)."""
    return _records(_orders_customers(spark, sf_dir), _k().cast("string"))


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load_table(spark, sf_dir, "orders")
    c = load_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "left")


def _records(j: DataFrame, rid) -> DataFrame:
    k = _k()
    year = F.year("o_orderdate")
    strings_entries = F.array(
        F.struct(F.lit("dataResourceUid").alias("key"), F.concat(F.lit("dr"), F.col("c_nationkey").cast("string")).alias("value")),
        F.struct(F.lit("orderStatus").alias("key"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("order.priority").alias("key"), F.col("o_orderpriority").alias("value")),
        F.struct(F.lit("sensitive_segment").alias("key"), F.col("c_mktsegment").alias("value")),
        F.struct(F.when(k % 3 == 0, F.lit("Market-Segment")).otherwise(F.lit("market segment")).alias("key"),
                 F.col("c_mktsegment").alias("value")),
        F.struct(F.lit("comment").alias("key"),
                 F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), (k % 10).cast("string"))).alias("value")),
        F.struct(F.lit("year").alias("key"), year.cast("string").alias("value")),
    )
    strings = (F.when(k % 31 == 0, F.lit(None).cast("map<string,string>"))
               .when(k % 37 == 0, F.create_map().cast("map<string,string>"))
               .otherwise(F.map_from_entries(strings_entries)))
    doubles = F.when(k % 11 == 0, F.lit(None).cast("map<string,double>")).otherwise(
        F.create_map(F.lit("totalPrice"), F.col("o_totalprice"), F.lit("acctBal"), F.col("c_acctbal")))
    ints = F.create_map(F.lit("year"), year, F.lit("Nation_Key"), F.col("c_nationkey"))
    longs = F.map_from_entries(F.array(F.struct(
        F.when(k % 4 == 0, F.lit("CustKey")).otherwise(F.lit("custKey")).alias("key"),
        F.col("o_custkey").alias("value"))))
    booleans = F.create_map(F.lit("urgent"), F.col("o_orderpriority") == F.lit("1-URGENT"))
    dates = F.create_map(F.lit("eventDate"),
                         F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * F.lit(86400000))
    multi = F.create_map(F.lit("flags"), F.array(F.col("o_orderstatus"), F.col("o_orderpriority")))
    multimedia = F.when(k % 5 == 0, F.array(F.concat(F.lit("img-"), k.cast("string")))).otherwise(
        F.array().cast("array<string>"))
    annotations = F.when(k % 9 == 0, F.array(F.lit("checked"))).otherwise(F.lit(None).cast("array<string>"))
    return j.select(rid.alias("id"), multimedia.alias("multimedia"), annotations.alias("annotations"),
                    strings.alias("strings"), doubles.alias("doubles"), ints.alias("ints"),
                    longs.alias("longs"), booleans.alias("booleans"), dates.alias("dates"),
                    multi.alias("multiValues"))


def index_version(spark: SparkSession, sf_dir: str, which: str = "old") -> DataFrame:
    """A flat index version from events (k = event_id, u = user_id).

    old: every event. new: drops k % 37 = 0, repeats k % 41 = 0 (two rows),
    changes cl1048 when k % 13 = 1, loses 'sensitive' when k % 20 = 0, loses
    cl959/cl966/cl21 when k % 23 = 0, has no assertions, and adds 'extra'
    when k % 19 = 0.
    """
    e = load_table(spark, sf_dir, "events")
    k, u = F.col("event_id"), F.col("user_id")
    s = lambda c: c.cast("string")
    base = {
        "id": s(k),
        "dataResourceUid": F.concat(F.lit("dr"), s(u % 25)),
        "country": F.col("event_type"),
        "stateProvince": F.concat(F.lit("state"), s(u % 7)),
        "sensitive": F.when(k % 10 == 0, F.lit("generalised")),
        "stateConservation": F.when(u % 3 == 0, F.lit("Endangered")).when(u % 3 == 1, F.lit("Vulnerable")),
        "speciesListUid": F.array(F.concat(F.lit("sl"), s(u % 5)), F.concat(F.lit("sl"), s(k % 3))),
        "cl959": F.concat(F.lit("lga"), s(u % 11)),
        "cl1048": F.concat(F.lit("ibra"), s(k % 13)),
        "cl966": F.concat(F.lit("meso"), s(u % 4)),
        "cl21": F.concat(F.lit("imcra"), s(k % 2)),
        "event_type": F.col("event_type"),
        "value": F.col("value"),
        "userAssertions": F.when(k % 50 == 0, F.lit("flagged")),
    }
    if which == "old":
        return e.select(*[v.alias(n) for n, v in base.items()])
    new = dict(base)
    new["cl1048"] = F.when(k % 13 == 1, F.lit("ibra_x")).otherwise(base["cl1048"])
    new["sensitive"] = F.when(k % 20 == 0, F.lit(None).cast("string")).otherwise(base["sensitive"])
    for c in ("cl959", "cl966", "cl21"):
        new[c] = F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(base[c])
    new["userAssertions"] = F.lit(None).cast("string")
    new["extra"] = F.when(k % 19 == 0, F.lit("x"))
    kept = e.filter(k % 37 != 0)
    twice = kept.filter(k % 41 == 0)
    rows = kept.unionByName(twice)
    return rows.select(*[v.alias(n) for n, v in new.items()])


def version_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version names from order dates; old-style names when day % 5 = 0."""
    d = F.col("o_orderdate")
    name = F.when(F.dayofmonth(d) % 5 == 0, F.concat(F.lit("occindex_"), F.date_format(d, "dd_MM_HH_mm_ss"))) \
        .otherwise(F.concat(F.lit("occindex-"), F.date_format(d, "yyyy-MM-dd-HH-mm")))
    return load_table(spark, sf_dir, "orders").select(name.alias("name")).distinct()


def version_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version directories with sizes: one per order date."""
    o = load_table(spark, sf_dir, "orders")
    return o.groupBy("o_orderdate").agg(
        F.concat(F.lit("occindex-"), F.date_format(F.first("o_orderdate"), "yyyy-MM-dd-HH-mm")).alias("name"),
        (F.count(F.lit(1)) * 1000000 + F.sum("o_custkey")).cast("bigint").alias("size")).drop("o_orderdate")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-store listing ``(key, size, modified)`` derived from orders.

    Dataset = customer ('dr<c>'; folder 'dataset<c>' when c % 13 = 0, which
    is not a dataset id). Per customer: one archive 'dwca-imports/<ds>/<ds>.zip'
    (size = sum over its orders of (k % 1000 + 1) * 1000) and, when c % 7 = 0,
    a non-matching 'notes.txt'; per order k: an index avro file when k % 3 = 0,
    a verbatim avro file when k % 3 = 1; per customer with a k % 3 = 2 order:
    '1/interpretation-metrics.yml'. Modified times fall in January 2024.
    """
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    ds = F.when(c % 13 == 0, F.concat(F.lit("dataset"), c.cast("string"))).otherwise(
        F.concat(F.lit("dr"), c.cast("string")))
    mod = (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
           + F.make_dt_interval(F.pmod(k, F.lit(30)), F.lit(0), F.lit(0), F.pmod(k * 7919, F.lit(86400))))
    o = o.withColumn("ds", ds).withColumn("mod", mod)
    per_order = o.select(
        F.when(k % 3 == 0, F.concat(F.lit("pipelines-all-datasets/index-record/"), F.col("ds"), F.lit("/"),
                                    F.col("ds"), F.lit("-"), k.cast("string"), F.lit("-of-99999.avro")))
        .when(k % 3 == 1, F.concat(F.lit("pipelines-data/"), F.col("ds"), F.lit("/1/verbatim/verbatim-"),
                                   k.cast("string"), F.lit("-of-99999.avro"))).alias("key"),
        (k % 1000 + 1).cast("bigint").alias("size"), F.col("mod").alias("modified")).filter(F.col("key").isNotNull())
    per_cust = o.groupBy("o_custkey", "ds").agg(
        (F.sum(k % 1000 + 1) * 1000).cast("bigint").alias("zsize"), F.max("mod").alias("zmod"),
        F.max(F.when(k % 3 == 2, F.col("mod"))).alias("mmod"))
    # archive, notes and metrics objects all come from the one per-customer aggregate
    obj = F.explode(F.array(
        F.struct(F.concat(F.lit("dwca-imports/"), F.col("ds"), F.lit("/"), F.col("ds"), F.lit(".zip")).alias("key"),
                 F.col("zsize").alias("size"), F.col("zmod").alias("modified")),
        F.when(F.col("o_custkey") % 7 == 0, F.struct(
            F.concat(F.lit("dwca-imports/"), F.col("ds"), F.lit("/notes.txt")).alias("key"),
            F.lit(10).cast("bigint").alias("size"), F.col("zmod").alias("modified"))),
        F.when(F.col("mmod").isNotNull(), F.struct(
            F.concat(F.lit("pipelines-data/"), F.col("ds"), F.lit("/1/interpretation-metrics.yml")).alias("key"),
            (F.col("o_custkey") % 50 + 100).cast("bigint").alias("size"), F.col("mmod").alias("modified")))))
    per_cust_objs = per_cust.select(obj.alias("o")).filter(F.col("o").isNotNull()).select("o.*")
    return per_order.unionByName(per_cust_objs)


def image_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images uploaded per dataset and day, from events (dataset 'dr<u % 20>',
    'no_dataresource' when u % 20 = 0)."""
    e = load_table(spark, sf_dir, "events")
    u = F.col("user_id")
    ds = F.when(u % 20 == 0, F.lit("no_dataresource")).otherwise(F.concat(F.lit("dr"), (u % 20).cast("string")))
    return e.groupBy(ds.alias("dataset_id"), F.to_date("ts").alias("uploaded")).agg(
        F.count(F.lit(1)).cast("bigint").alias("images"))


def provider_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of providers: region 'dp<r>' with its nations 'dr<n>' as members."""
    r = load_table(spark, sf_dir, "region")
    n = load_table(spark, sf_dir, "nation")
    members = n.groupBy("n_regionkey").agg(F.collect_list(F.struct(
        F.concat(F.lit("dr"), F.col("n_nationkey").cast("string")).alias("uid"),
        F.concat(F.lit("/ws/dataResource/dr"), F.col("n_nationkey").cast("string")).alias("uri"))).alias("dataResources"))
    return r.join(members, r.r_regionkey == members.n_regionkey, "left").select(
        F.concat(F.lit("dp"), F.col("r_regionkey").cast("string")).alias("uid"), F.col("r_name").alias("name"),
        "dataResources")


def dataset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of datasets from suppliers: uid 'dr<s>', name, rights, licenseType, lastChecked."""
    s = load_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("dr"), k.cast("string")).alias("uid"),
        F.when(k % 10 == 9, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("name"),
        F.when(k % 3 == 0, F.lit("CC-BY 4.0")).when(k % 3 == 1, F.lit("")).alias("rights"),
        F.when(k % 2 == 0, F.lit("CC0")).alias("licenseType"),
        F.when(k % 4 == 0, F.lit("2023-12-01T00:00:00")).alias("lastChecked"),
        F.col("s_nationkey"))


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrence records from lineitem ⨝ part (k = l_orderkey, n = l_linenumber).

    Coordinates are tenths of a degree (exact in any engine); verbatim text
    columns carry bad values: latitude 'abc' (n % 7 = 0), '95.5' (n % 7 = 1),
    ' 0 ' with longitude '0' (n % 7 = 2); empty longitude when k % 17 = 0;
    'not-a-date' when k % 11 = 0; count 'many' when k % 13 = 0.
    """
    li = load_table(spark, sf_dir, "lineitem")
    p = load_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey, "left")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    lat10 = F.pmod(k * 7 + n * 13, F.lit(400)) - 200
    lon10 = F.pmod(F.col("l_partkey") * 11 + k, F.lit(1000)) - 500
    s = lambda c: c.cast("string")
    return j.select(
        F.concat_ws("-", s(k), s(n), s(F.col("l_partkey")), s(F.col("l_suppkey"))).alias("id"),
        F.concat(F.lit("dr"), s(F.col("l_suppkey") % 20)).alias("dataset_id"),
        F.col("p_name").alias("scientificName"),
        F.concat(F.lit("sp"), s(F.col("l_partkey") % 30)).alias("taxon"),
        (lat10 / 10.0).alias("decimalLatitude"), (lon10 / 10.0).alias("decimalLongitude"),
        F.col("l_shipdate").cast("date").alias("eventDate"),
        F.concat(F.lit("cat"), s(k % 997)).alias("catalogNumber"),
        F.concat(F.lit("zone"), s(F.col("l_suppkey") % 5)).alias("zone"),
        F.col("l_partkey"), F.col("l_extendedprice"),
        F.when(n % 7 == 0, F.lit("abc")).when(n % 7 == 1, F.lit("95.5")).when(n % 7 == 2, F.lit(" 0 "))
        .otherwise(F.concat(s(lat10), F.lit("e-1"))).alias("verbatimLatitude"),
        F.when(n % 7 == 2, F.lit("0")).when(k % 17 == 0, F.lit(""))
        .otherwise(F.concat(s(lon10), F.lit("e-1"))).alias("verbatimLongitude"),
        F.when(k % 11 == 0, F.lit("not-a-date")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("verbatimEventDate"),
        F.when(k % 13 == 0, F.lit("many")).otherwise(s(F.col("l_quantity").cast("int"))).alias("verbatimCount"),
    )
