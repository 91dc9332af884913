"""Scalar functions, predicate compiler, sinks, export labels, enrichment edges."""

import datetime as dt

from pyspark.sql import functions as F

from florafold import functions as FN
from florafold.functions.predicate import predicate_to_column
from florafold.operators import enrich as EN
from florafold.operators.export import size_mb_label
from florafold.sources import sinks as SK


def test_scalars(spark):
    df = spark.createDataFrame([(" YES ", "a/images/x.jpg", "s3://bkt/some/path.zip", "occindex-2024-01-31-10-05")],
                               "f string, p string, u string, v string")
    r = df.select(FN.parse_flag("f").alias("f"), FN.media_type("p").alias("m"), FN.file_name("p").alias("fn"),
                  FN.folder("p").alias("fo"), FN.split_uri("u").alias("s"), FN.version_date("v").alias("d"),
                  FN.licence(F.lit(""), F.lit("CC0")).alias("l")).first()
    assert r["f"] is True and r["m"] == "multimedia" and r["fn"] == "x.jpg" and r["fo"] == "images"
    assert r["s"]["bucket"] == "bkt" and r["s"]["path"] == "some/path.zip"
    assert r["d"] == "2024-01-31" and r["l"] == "CC0"


def test_size_label_rounds_exact_half_to_even(spark):
    # 0.125 MiB * 100 = 12.5 cents exactly → half to even → 12
    cases = {131072: "0.12MB", 393216: "0.38MB", 5 * 1048576: "5.0MB", 2048 * 1048576: "2.0GB"}
    df = spark.createDataFrame([(k,) for k in cases], "b bigint")
    got = {r["b"]: r["l"] for r in df.select("b", size_mb_label("b").alias("l")).collect()}
    assert got == cases
    assert round(131072 / 1024 / 1024, 2) == 0.12 and round(393216 / 1024 / 1024, 2) == 0.38


def test_predicate_tree(spark):
    df = spark.createDataFrame([("Victoria", 1), ("NSW", 2), (None, 3)], "stateProvince string, n int")
    p = {"type": "and", "predicates": [{"type": "in", "key": "stateProvince", "values": ["Victoria"]}]}
    assert df.filter(predicate_to_column(p)).count() == 1
    q = {"type": "not", "predicate": p}
    assert df.filter(predicate_to_column(q)).count() == 2


def test_days_and_ids(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), dt.date(2024, 2, 2), "  dr1 \t dr2  ")], "a date, b date, t string")
    r = df.select(F.size(FN.days_between("a", "b")).alias("n"), FN.id_list("t").alias("ids"),
                  F.size(FN.days_between("b", "a")).alias("e")).first()
    assert r["n"] == 4 and r["ids"] == ["dr1", "dr2"] and r["e"] == 0


def test_replace_and_delete_dataset(spark, tmp_path):
    t = str(tmp_path / "tbl")
    df = spark.createDataFrame([(1, "dr1"), (2, "dr1"), (3, "dr2")], "k int, dataset_id string")
    df.write.partitionBy("dataset_id").parquet(t)
    SK.replace_dataset(spark.createDataFrame([(9, "dr1")], "k int, dataset_id string"), t)
    got = sorted((r["k"], r["dataset_id"]) for r in spark.read.parquet(t).collect())
    assert got == [(3, "dr2"), (9, "dr1")]
    assert SK.delete_datasets(spark, [t], ["dr2", "dr404"]) == 1
    assert [r["k"] for r in spark.read.parquet(t).collect()] == [9]


def test_deletion_plan_retains_identifiers(spark):
    inv = spark.createDataFrame([("pipelines-data/dr1/1/identifiers/ala_uuid/x.avro",),
                                 ("pipelines-data/dr1/1/verbatim/v.avro",), ("dwca-imports/dr1/dr1.zip",),
                                 ("dwca-exports/dr1.zip",), ("dwca-imports/dr10/dr10.zip",)], "key string")
    ids = spark.createDataFrame([("dr1",)], "dataset_id string")
    got = {r["key"]: r["kind"] for r in SK.deletion_plan(inv, ids).collect()}
    assert got == {"pipelines-data/dr1/1/verbatim/v.avro": "pipelines-data", "dwca-imports/dr1/dr1.zip": "dwca",
                   "dwca-exports/dr1.zip": "dwca-exports-zip"}
    keep_dwca = SK.deletion_plan(inv, ids, retain_dwca=True, retain_identifiers=False)
    assert "dwca-imports/dr1/dr1.zip" not in {r["key"] for r in keep_dwca.collect()}


def test_interpret_issues(spark):
    df = spark.createDataFrame([("1", "abc", "10"), ("2", "95", "10"), ("3", "0", "0"), ("4", "", "5")],
                               "id string, la string, lo string")
    out = {r["id"]: (r["lat"], r["issues"]) for r in EN.interpret(
        df, {"lat": ("la", "double"), "lon": ("lo", "double")}, lat="lat", lon="lon", keep=["id"]).collect()}
    assert out["1"] == (None, ["LAT_INVALID"])
    assert out["2"] == (None, ["COORDINATE_OUT_OF_RANGE"])
    assert out["3"] == (0.0, ["ZERO_COORDINATE"])
    assert out["4"] == (None, [])


def test_point_in_polygon_and_jackknife(spark):
    polys = spark.createDataFrame([("L", "sq", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])],
                                  "layer_id string, region_id string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(5.0, 5.0), (15.0, 5.0), (5.0, 9.99)], "x double, y double")
    inside = {(r["x"], r["y"]) for r in EN.points_in_polygons(pts, polys, ["layer_id", "region_id"]).collect()}
    assert inside == {(5.0, 5.0), (5.0, 9.99)}
    vals = [float(v) for v in range(1, 12)] + [100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    out = {r["v"]: r["is_outlier"] for r in EN.jackknife_outliers(df, "g", "v").collect()}
    # the far value is flagged; values whose gap toward the mean is small are not
    assert out[100.0] is True and not any(out[v] for v in vals[:10])


def test_predicate_reaches_parquet_scan(spark):
    from florafold.operators.export import predicate_filter
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    p = {"type": "and", "predicates": [{"type": "in", "key": "o_orderstatus", "values": ["F"]},
                                       {"type": "in", "key": "o_orderpriority", "values": ["1-URGENT", "2-HIGH"]}]}
    plan = predicate_filter(df, p).select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(o_orderstatus,F)" in pushed and "In(o_orderpriority" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderpriority:string>" in plan
