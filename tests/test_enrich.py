"""Enrichment operators (our definitions): clusters, range outliers with a
cache, persistent ids, sensitive-rule precedence, vocabulary and names."""

import datetime as dt

from pyspark.sql import functions as F

from florafold.operators import enrich as EN


def test_cluster_records_needs_two_datasets(spark):
    d = dt.date(2024, 1, 1)
    rows = [("a", "dr1", "Sp x", d, 1.001, 2.001, "c1"), ("b", "dr2", "Sp x", d, 1.004, 2.002, "c9"),
            ("c", "dr1", "Sp x", d, 1.002, 2.003, "c8"), ("d", "dr1", "Sp y", d, 5.0, 5.0, "c1"),
            ("e", "dr3", "Sp z", d, 9.0, 9.0, "c7"), ("f", "dr3", "Sp z", d, 9.0, 9.0, "c6")]
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate date, "
                                     "decimalLatitude double, decimalLongitude double, catalogNumber string")
    out = {(r["id"], r["reason"]): (r["cluster_id"], r["cluster_size"], r["n_datasets"])
           for r in EN.cluster_records(df).collect()}
    # a, b, c share taxon/date/0.01° cell across dr1 and dr2; e, f are one dataset only
    assert out[("a", "location")] == ("a", 3, 2) and out[("b", "location")] == ("a", 3, 2)
    assert ("e", "location") not in out
    # a and d share an identifier but come from one dataset
    assert ("a", "identifier") not in out


def test_distribution_outliers_inside_outside_cached(spark):
    ranges = spark.createDataFrame([("t1", [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])],
                                   "taxon string, ring array<struct<x:double,y:double>>")
    recs = spark.createDataFrame([("in", "t1", 5.0, 5.0), ("out", "t1", 11.0, 0.0), ("none", "t9", 1.0, 1.0),
                                  ("cached", "t1", 50.0, 50.0)],
                                 "id string, taxon string, decimalLongitude double, decimalLatitude double")
    cache = spark.createDataFrame([("cached", 123.0)], "id string, distance double")
    out = {r["id"]: (r["distance"], r["cached"]) for r in EN.distribution_outliers(recs, ranges, cache).collect()}
    assert out["in"] == (0.0, False)
    assert abs(out["out"][0] - 111.19) < 0.1 and out["out"][1] is False  # one degree of longitude at the equator
    assert out["none"] == (None, False)
    assert out["cached"] == (123.0, True)


def test_distribution_outliers_make_records_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "id string, taxon string, decimalLatitude double, decimalLongitude double"
    recs = spark.createDataFrame([(str(i), "t", i / 10, 0.5) for i in range(30)] + [(None, "t", 0.5, 0.5), ("3", "t", 9.0, 9.0)], schema)
    ranges = spark.createDataFrame([("t", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])], "taxon string, ring array<struct<x:double,y:double>>")
    cache = spark.createDataFrame([("3", 7.0), ("3", 8.0), ("77", 1.0), (None, 2.0)], "id string, distance double")
    out = EN.distribution_outliers(recs.mapInArrow(counted, schema), ranges, cache).collect()
    assert sorted(r["distance"] for r in out if r["cached"]) == [7.0, 8.0]
    rest = [r["id"] for r in out if not r["cached"]]
    assert len(rest) == 30 and None in rest and not {"3", "77"} & set(rest) and seen.value == 32


def test_assign_uuids_is_stable_and_keeps_known(spark):
    recs = spark.createDataFrame([("dr1", "k1"), ("dr1", "k2")], "dataset_id string, occ string")
    existing = spark.createDataFrame([("3:dr1|2:k1", "known-1"), ("3:dr1|2:k1", "known-0")], "unique_key string, uuid string")
    a = {r["occ"]: (r["uuid"], r["is_new"]) for r in EN.assign_uuids(recs, existing, ["occ"]).collect()}
    b = {r["occ"]: r["uuid"] for r in EN.assign_uuids(recs, existing.limit(0), ["occ"]).collect()}
    assert a["k1"] == ("known-0", False)
    assert a["k2"][1] is True and a["k2"][0] == b["k2"] and len(a["k2"][0]) == 36
    chk = EN.uuid_check(EN.assign_uuids(recs, existing, ["occ"]), existing, 40).first()
    assert (chk["n_total"], chk["n_new"], chk["status"]) == (2, 1, "FAIL")
    assert EN.uuid_check(EN.assign_uuids(recs, existing, ["occ"]), existing, 40, override=True).first()["status"] == "PASS"
    # all keys new while ids existed: the worst case fails; without any earlier id it passes
    other = spark.createDataFrame([("x", "u")], "unique_key string, uuid string")
    assert EN.uuid_check(EN.assign_uuids(recs, other, ["occ"]), other, 5).first()["status"] == "FAIL"
    assert EN.uuid_check(EN.assign_uuids(recs, other.limit(0), ["occ"]), other.limit(0), 5).first()["status"] == "PASS"


def test_unique_keys_differ_whatever_the_terms_hold(spark):
    recs = spark.createDataFrame([("dr1", "a|b", "c"), ("dr1", "a", "b|c"), ("dr1", "a", "1:b|c")], "dataset_id string, x string, y string")
    none = spark.createDataFrame([], "unique_key string, uuid string")
    assert EN.assign_uuids(recs, none, ["x", "y"]).select("uuid").distinct().count() == 3


def test_index_record_keeps_all_types_and_hides_originals(spark):
    import datetime
    from florafold.operators import flatten as FL
    df = spark.sql("""SELECT 'r1' AS id, CAST(1.25 AS DECIMAL(8,2)) AS price, named_struct('a', 1) AS s, map('k', 'v') AS m,
      timestamp'2024-01-02 10:20:30' AS seen, 12.5D AS sensitive_decimalLatitude, X'4142' AS raw""")
    r = EN.build_index_record(df).first()
    assert r["doubles"] == {"price": 1.25} and r["strings"]["s"] == '{"a":1}' and r["strings"]["m"] == '{"k":"v"}'
    assert r["strings"]["raw"] == "QUI=" and r["strings"]["sensitive_decimalLatitude"] == "12.5"
    when = datetime.datetime(2024, 1, 2, 10, 20, 30, tzinfo=datetime.timezone.utc)
    assert r["dates"]["seen"] == int(when.timestamp() * 1000)
    flat = FL.flatten_index(EN.build_index_record(df))
    assert not [c for c in flat.columns if c.lower().startswith("sensitive_")]


def test_restrict_sensitive_zone_rule_wins_and_most_restrictive(spark):
    df = spark.createDataFrame([("a", "Sp x", "z1", 12.345, 45.678), ("b", "Sp x", "z2", 12.345, 45.678),
                                ("c", "Sp y", "z1", 1.0, 2.0)],
                               "id string, scientificName string, zone string, decimalLatitude double, "
                               "decimalLongitude double")
    rules = spark.createDataFrame([("sp x", "z1", "withhold", 0), ("sp x", "z1", "generalise", 1),
                                   ("Sp x", None, "generalise", 1)], "taxon string, zone string, action string, k int")
    out = {r["id"]: r for r in EN.restrict_sensitive(df, rules).collect()}
    assert out["a"]["sensitive"] == "withhold" and out["a"]["decimalLatitude"] is None
    assert out["a"]["sensitive_decimalLatitude"] == 12.345
    assert out["b"]["sensitive"] == "generalise" and out["b"]["decimalLatitude"] == 12.3
    assert out["c"]["sensitive"] is None and out["c"]["decimalLatitude"] == 1.0


def test_vocabulary_and_names(spark):
    df = spark.createDataFrame([(" Adult ",), ("larva",), ("egg",)], "lifeStage string")
    vocab = spark.createDataFrame([("adult", "ADULT"), ("LARVA", "LARVA")], "label string, canonical string")
    got = {r["lifeStage"]: r["lifeStage_norm"] for r in EN.lookup_vocabulary(df, vocab, "lifeStage").collect()}
    assert got == {" Adult ": "ADULT", "larva": "LARVA", "egg": None}
    names = spark.createDataFrame([("Acacia dealbata",), ("Acacia unknown",), ("Nothing here",)], "scientificName string")
    taxa = spark.createDataFrame([("Acacia dealbata", "species", "t1"), ("Acacia", "genus", "t0")],
                                 "name string, rank string, taxon_id string")
    m = {r["scientificName"]: (r["taxon_id"], r["match_type"]) for r in EN.match_names(names, taxa).collect()}
    assert m == {"Acacia dealbata": ("t1", "exact"), "Acacia unknown": ("t0", "genus"), "Nothing here": (None, "none")}


def test_build_index_record_roundtrip(spark):
    from florafold.operators.flatten import flatten_index
    df = spark.createDataFrame([("r1", "a", 1.5, 3, dt.date(1970, 1, 2), ["x"]), ("r2", None, None, None, None, None)],
                               "id string, s string, d double, i int, dd date, mv array<string>")
    rec = EN.build_index_record(df)
    assert rec.filter("id = 'r2'").select(F.size("strings")).first()[0] == 0
    flat = {r["id"]: r for r in flatten_index(rec, merge_duplicate_ids=False).collect()}
    assert flat["r1"]["s"] == "a" and flat["r1"]["d"] == 1.5 and flat["r1"]["i"] == 3
    assert flat["r1"]["dd"] == 86400000 and flat["r1"]["mv"] == ["x"]


def test_cluster_records_near_matches_union_find(spark):
    import random
    rnd = random.Random(5)
    d = dt.date(2024, 1, 1)
    rows = []
    for i in range(400):
        t = f"Sp {rnd.randint(0, 2)}"
        rows.append((f"r{i:03d}", f"dr{rnd.randint(0, 3)}", t, d, rnd.randint(0, 40) / 100.0 + 0.001,
                     rnd.randint(0, 40) / 100.0 + 0.001))
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate date, "
                                     "decimalLatitude double, decimalLongitude double")
    got = {r["id"]: (r["cluster_id"], r["cluster_size"], r["n_datasets"])
           for r in EN.cluster_records_near(df, cell=0.01).collect()}
    # brute force: union records of the same taxon whose cells touch
    import math
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    cells = [(r[2], math.floor(r[4] / 0.01), math.floor(r[5] / 0.01)) for r in rows]
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if cells[i][0] == cells[j][0] and abs(cells[i][1] - cells[j][1]) <= 1 and abs(cells[i][2] - cells[j][2]) <= 1:
                parent[find(i)] = find(j)
    comps = {}
    for i in range(len(rows)):
        comps.setdefault(find(i), []).append(i)
    exp = {}
    for members in comps.values():
        ds = {rows[i][1] for i in members}
        if len(ds) >= 2:
            cid = min(rows[i][0] for i in members)
            for i in members:
                exp[rows[i][0]] = (cid, len(members), len(ds))
    assert got == exp


def test_assemble_index_flags_and_remove_records(spark):
    from florafold.sources.sinks import remove_records
    idx = spark.createDataFrame([("a", "dr1"), ("b", "dr2")], "id string, dataResourceUid string")
    s1 = spark.createDataFrame([("a", 1)], "id string, x int")
    s2 = spark.createDataFrame([("b", 2)], "id string, y int")
    out = EN.assemble_index(idx, {"one": s1, "two": s2}, flags={"two": False})
    assert out.columns == ["id", "dataResourceUid", "x"] and out.count() == 2
    gone = remove_records(idx, spark.createDataFrame([("dr2",)], "ds string"))
    assert [r["id"] for r in gone.collect()] == ["a"]


def test_build_index_record_mixed_float_types(spark):
    df = spark.createDataFrame([("r1", 1.5, 2.5)], "id string, a float, b double")
    rec = EN.build_index_record(df).first()
    assert rec["doubles"] == {"a": 1.5, "b": 2.5}


def test_ingest_guard_stops_before_writing_and_images_are_attached(spark):
    import pytest

    from florafold.operators import enrich as EN
    from florafold.plans.jobs import ingest_dataset
    occ = spark.createDataFrame([("1", "dr1", "A b", "z", "10", "20", "http://i/1"), ("2", "dr1", None, None, "", "x", None)],
                                "id string, dataset_id string, scientificName string, zone string, la string, lo string, identifier string")
    rules = {"decimalLatitude": ("la", "double"), "decimalLongitude": ("lo", "double")}
    vocab = spark.createDataFrame([("a b", "A B")], "label string, canonical string")
    taxa = spark.createDataFrame([("A b", "species", "t1")], "name string, rank string, taxon_id string")
    existing = occ.limit(1).select(EN.unique_key(F.lit("other"), F.col("id")).alias("unique_key"), F.lit("u").alias("uuid"))
    sens = spark.createDataFrame([], "taxon string, zone string, action string, k int")
    images = spark.createDataFrame([("http://i/1", "img-1")], "identifier string, image_id string")
    args = (occ, rules, vocab, "scientificName", taxa, existing, ["id"], sens)
    with pytest.raises(ValueError, match="2 of 2 ids are new"):
        ingest_dataset(*args, max_new_pct=5)
    rows = ingest_dataset(*args, max_new_pct=100, images=images).select("strings").collect()
    assert sorted((r["strings"].get("image_id") or "") for r in rows) == ["", "img-1"]


def test_cluster_records_near_across_tiles(spark):
    """A diagonal chain over many tiles, on both sides of zero, is one cluster; a gap of one cell parts it."""
    d = dt.date(2024, 1, 1)
    rows = [(f"r{i + 100:03d}", f"dr{i % 2}", "Sp a", d, i + 0.5, 0.5 - i) for i in range(-80, 80) if i != 40]
    rows += [("z1", "dr0", "Sp|a", d, 0.5, 0.5), ("z2", "dr1", "Sp a", dt.date(2024, 1, 2), 0.5, 0.5), ("z3", None, "Sp b", d, 0.5, None)]
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate date, "
                                     "decimalLatitude double, decimalLongitude double")
    got = {(r["cluster_id"], r["cluster_size"], r["n_datasets"]) for r in EN.cluster_records_near(df, cell=1.0).collect()}
    assert got == {("r020", 120, 2), ("r141", 39, 2)}


def test_cluster_records_near_keeps_blocks_out_of_the_driver(spark):
    """Files of blocks are a small part of their rows, and were broadcast for their size."""
    rows = [(f"{y}-{x}", f"dr{x % 2}", "Sp a", dt.date(2024, 1, 1), y + 0.5, x + 0.5) for y in range(40) for x in range(40)]
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate date, "
                                     "decimalLatitude double, decimalLongitude double")
    plan = EN.cluster_records_near(df, cell=1.0)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [node" in plan and "SortMergeJoin [_t" in plan
    assert "BroadcastHashJoin [node" not in plan and "BroadcastHashJoin [_t" not in plan


def test_cluster_records_near_links_few_nodes(spark, monkeypatch):
    """Blocks that touch inside a tile reach the graph as one node."""
    seen = []
    parts = EN.connected_blocks

    def watched(edges, nodes):
        seen.append((edges.count(), nodes.count()))
        return parts(edges, nodes)
    monkeypatch.setattr(EN, "connected_blocks", watched)
    d = dt.date(2024, 1, 1)
    rows = [(f"{y}-{x}", f"dr{x % 2}", "Sp a", d, y + 0.5, x + 0.5) for y in range(40) for x in range(40)]
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate date, "
                                     "decimalLatitude double, decimalLongitude double")
    got = EN.cluster_records_near(df, cell=1.0).select("cluster_size", "n_datasets").distinct().collect()
    assert [tuple(r) for r in got] == [(1600, 2)] and seen[0][1] == 4


def test_index_record_compiles(spark, capsys):
    """Wide records do not become one generated method of more than 8000 bytes, which the JVM never compiles."""
    import re
    df = spark.range(3).select(F.col("id"), *[F.when(F.col("id") % 2 == i % 2, F.concat(F.lit("v"), F.col("id"))).alias(f"c{i}") for i in range(40)])
    rec = EN.build_index_record(df, keep=["c1"])
    rec.explain("codegen")
    assert all(int(n) <= 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))
    rows = {r["id"]: r for r in rec.collect()}
    assert rows["1"]["strings"] == {f"c{i}": "v1" for i in range(1, 40, 2)} and rows["1"]["c1"] == "v1" and rows["0"]["c1"] is None


def test_uuid_from_key_layout(spark):
    import hashlib
    import uuid
    got = spark.createDataFrame([("2:dr|1:x",), ("",), (None,)], "k string").select("k", EN.uuid_from_key(F.col("k")).alias("u")).collect()
    assert [r["u"] for r in got] == [str(uuid.UUID(hashlib.md5(r["k"].encode()).hexdigest())) if r["k"] is not None else "" for r in got]


def test_ingest_writes_from_narrow_rows(spark, tmp_path, monkeypatch):
    """The write exchanges typed rows, not records with maps, and the guard meets the known ids only."""
    from florafold.plans import jobs
    seen = []
    spread = jobs.SK._spread
    monkeypatch.setattr(jobs.SK, "_spread", lambda df, col: seen.append(df.columns) or spread(df, col))
    check = EN.uuid_check
    monkeypatch.setattr(EN, "uuid_check", lambda df, *a: seen.append(df.columns) or check(df, *a))
    occ = spark.createDataFrame([("1", "dr1", "A b", "z", "10"), ("2", "dr2", "C", None, ""), ("3", None, "C", None, "x")],
                                "id string, dataset_id string, scientificName string, zone string, la string")
    vocab = spark.createDataFrame([("a b", "A B")], "label string, canonical string")
    taxa = spark.createDataFrame([("A b", "species", "t1")], "name string, rank string, taxon_id string")
    existing = occ.limit(1).select(EN.unique_key(F.col("dataset_id"), F.col("id")).alias("unique_key"), F.lit("u").alias("uuid"))
    sens = spark.createDataFrame([], "taxon string, zone string, action string, k int")
    occ = occ.withColumn("lo", F.col("la"))
    rules = {"decimalLatitude": ("la", "double"), "decimalLongitude": ("lo", "double")}
    made = jobs.ingest_dataset(occ, rules, vocab, "scientificName", taxa, existing, ["id"], sens, str(tmp_path / "t"), max_new_pct=100)
    assert "taxon_id" not in seen[0] and "strings" not in seen[1]
    back = spark.read.parquet(str(tmp_path / "t"))
    key = lambda r: (r["id"], r["dataset_id"], sorted(r["strings"].items()), sorted(r["doubles"].items()))
    assert sorted(map(key, back.collect()), key=str) == sorted(map(key, made.collect()), key=str)
    assert {(r["dataset_id"], r["strings"].get("taxon_id")) for r in made.collect()} == {("dr1", "t1"), ("dr2", None), (None, None)}


def _exchanged_joins(df):
    return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def test_jackknife_of_hot_groups_equals_windows(spark):
    """Groups above ``hot_rows`` take the ranked way, with the same findings; the others are not ranked."""
    import random
    rng = random.Random(4)
    rows = [(f"g{i % 3}", float(rng.randrange(50))) for i in range(300)] + [("g0", 900.0), ("g1", -700.0), ("g1", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    some = EN.jackknife_outliers(df, "g", "x")
    got = {(r["g"], r["x"]): (r["n"], r["is_outlier"]) for r in some.collect()}
    assert got == {(r["g"], r["x"]): (r["n"], r["is_outlier"]) for r in EN.jackknife_outliers(df, "g", "x", hot_rows=100).collect()}
    assert got == {(r["g"], r["x"]): (r["n"], r["is_outlier"]) for r in EN.jackknife_outliers(df, "g", "x", hot_rows=101).collect()}
    assert {k for k, v in got.items() if v[1]} == {("g0", 900.0), ("g1", -700.0)} and _exchanged_joins(some) == 0


def test_clusters_exchange_few_rows(spark):
    """Blocks of one record and of one dataset give no clusters; the records meet the clusters without an exchange."""
    rows = [(f"i{k}", f"d{k % 2}", "t", "2020-01-01", float(k // 2), 1.0, "c" if k < 3 else None) for k in range(20)]
    rows += [("i99", "d0", "t", "2020-01-02", 1.0, 1.0, None), ("i98", "d0", "t", "2020-01-02", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id string, dataset_id string, scientificName string, eventDate string, "
                                     "decimalLatitude double, decimalLongitude double, catalogNumber string")
    out = EN.cluster_records(df)
    got = sorted((r["id"], r["reason"], r["cluster_id"], r["cluster_size"], r["n_datasets"]) for r in out.collect())
    want = [(f"i{k}", "location", min(f"i{k}", f"i{k ^ 1}"), 2, 2) for k in range(20)]
    assert got == sorted(want + [(f"i{k}", "identifier", "i0", 3, 2) for k in range(3)]) and _exchanged_joins(out) == 0


def test_records_are_not_exchanged_for_few_names_or_images(spark):
    """Whatever Spark's estimates of them: here no side is broadcast by its estimate."""
    from florafold.operators import enrich as EN
    rows = spark.createDataFrame([("1", "A b", "u1"), ("2", "C", None), ("3", "A x", "u2")], "id string, scientificName string, identifier string")
    taxa = spark.createDataFrame([("A b", "species", "t1"), ("A", "genus", "t2"), ("A b", "species", "t3")], "name string, rank string, taxon_id string")
    images = spark.createDataFrame([("u1", "i2"), ("u1", "i1")], "identifier string, image_id string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = EN.image_sync(EN.match_names(rows, taxa), images)
        assert _exchanged_joins(out) == 0
        assert {(r["id"], r["taxon_id"], r["match_type"], r["image_id"]) for r in out.collect()} == {
            ("1", "t1", "exact", "i1"), ("2", None, "none", None), ("3", "t2", "genus", None)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
