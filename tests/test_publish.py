"""Commits of versions: two publishers, crashes, roll-backs, deletion of old data."""

import os
import random

import pytest
from pyspark.sql import functions as F

from florafold.operators import checks as CK
from florafold.operators.export import nested_documents
from florafold.plans import commits as CM
from florafold.plans import publish as PB

V = [f"occindex-2024-01-0{k}-00-00" for k in range(1, 6)]


def _df(spark, n):
    return spark.range(n)


def test_readers_see_old_or_new_only(spark, tmp_path):
    root = str(tmp_path)
    assert CM.current(spark, root, "occindex") is None and CM.history(spark, root, "occindex").count() == 0
    with pytest.raises(ValueError, match="no version"):
        CM.read_current(spark, root, "occindex")
    CM.publish(_df(spark, 3), root, "occindex", V[0])
    folder = CM.stage(_df(spark, 5), root, V[1])  # written, not committed
    assert CM.read_current(spark, root, "occindex").count() == 3
    CM.publish(_df(spark, 5), root, "occindex", V[1], staged=folder)
    assert CM.read_current(spark, root, "occindex").count() == 5
    with pytest.raises(ValueError, match="exists"):
        CM.publish(_df(spark, 1), root, "occindex", V[0])
    assert CM.current(spark, root, "other") is None


def test_two_publishers_cannot_both_win(spark, tmp_path):
    root = str(tmp_path)
    base = CM.last_number(spark, root, "a")
    CM.publish(_df(spark, 1), root, "a", V[0], base)
    with pytest.raises(CM.PublishConflict):
        CM.publish(_df(spark, 2), root, "a", V[1], base)
    assert CM.current(spark, root, "a")["version"] == V[0]
    assert [r["folder"].startswith(V[1]) for r in CM.abandoned(spark, root, ["a"]).collect()] == [True]
    CM.publish(_df(spark, 2), root, "a", V[1])
    assert [r["number"] for r in CM.history(spark, root, "a").orderBy("number").collect()] == [1, 2]


def test_a_broken_commit_counts_for_nothing(spark, tmp_path):
    root = str(tmp_path)
    CM.publish(_df(spark, 1), root, "a", V[0])
    for number, text in ((2, ""), (3, '{"number": 3, "alias": "a", "vers')):
        (tmp_path / "commits" / "a" / f"{number:020d}.json").write_text(text)
        assert CM.current(spark, root, "a")["version"] == V[0]
    with pytest.raises(CM.PublishConflict):
        CM.publish(_df(spark, 1), root, "a", V[1], base=2)
    assert CM.publish(_df(spark, 1), root, "a", V[1])["number"] == 4


def test_roll_back_and_deletion(spark, tmp_path):
    root = str(tmp_path)
    for k in range(4):
        CM.publish(_df(spark, k + 1), root, "occindex", V[k])
    CM.roll_back(spark, root, "occindex", V[1])
    assert CM.read_current(spark, root, "occindex").count() == 2
    marked = {r["name"]: r["action"] for r in CM.stale_versions(spark, root, "occindex").collect()}
    assert marked == {V[3]: "keep", V[2]: "delete", V[0]: "delete"}  # the live one is not listed
    assert CM.delete_stale(spark, root, "occindex") == [V[0], V[2]]
    assert CM.read_current(spark, root, "occindex").count() == 2
    assert sorted(f[:len(V[0])] for f in os.listdir(tmp_path / "data")) == [V[1], V[3]]
    with pytest.raises(ValueError, match="deleted"):
        CM.roll_back(spark, root, "occindex", V[0])
    with pytest.raises(ValueError, match="never had"):
        CM.roll_back(spark, root, "occindex", V[4])


def test_a_decision_never_points_to_missing_data(spark, tmp_path):
    root = str(tmp_path)
    passed = CK.rollup_status(spark.createDataFrame([("a", "PASS")], "check string, status string"))
    with pytest.raises(ValueError, match="never had"):
        PB.publish_version(spark, PB.publish_decision(passed, "occindex", V[0]), root)
    assert PB.current_version(spark, root, "occindex") is None
    PB.publish_version(spark, PB.publish_decision(passed, "occindex", V[0]), root, _df(spark, 4))
    live = CM.read_current(spark, root, "occindex")
    with pytest.raises(ValueError, match="exists"):  # the live version as input of itself
        PB.publish_version(spark, PB.publish_decision(passed, "occindex", V[0]), root, live)
    assert CM.read_current(spark, root, "occindex").count() == 4
    PB.publish_version(spark, PB.publish_decision(passed, "occindex", V[1]), root, live.where("id > 1"))
    assert spark.table("occindex").count() == 2


def test_nested_documents_equal_grouping(spark):
    import json
    rng = random.Random(3)
    parents = [(k, f"p{k}") for k in range(20)] + [(None, "no key"), (7, "again")]
    kids = [(3 if i % 3 == 0 else rng.choice([*range(12), 77, None]), f"c{i:04}", rng.choice([None, "é" * rng.randint(0, 90), '"\\'])) for i in range(600)]
    kids += [kids[5]] * 3
    p = spark.createDataFrame(parents, "k long, name string")
    c = spark.createDataFrame(kids, "k long, id string, note string").repartition(5)
    docs, unplaced = nested_documents(p, c, "k", ["id"], "kids", max_bytes=700)
    rows = docs.collect()
    known = {k for k, _ in parents if k is not None}
    assert sorted(r["id"] for r in unplaced.collect()) == sorted(i for k, i, _ in kids if k not in known)
    for k, name in parents:
        mine = sorted([r for r in rows if r["k"] == k and json.loads(r["document"])["name"] == name], key=lambda r: r["piece"])
        want = sorted([(i, n) for q, i, n in kids if q == k and k is not None], key=lambda x: (x[0], x[1] or ""))
        got = [(d["id"], d["note"]) for r in mine for d in json.loads(r["document"])["kids"]]
        assert got == want and [r["piece"] for r in mine] == list(range(len(mine))) and all(r["n_pieces"] == len(mine) for r in mine)
        sizes = [[len(json.dumps({"id": d["id"], "note": d["note"]}, ensure_ascii=False, separators=(",", ":")).encode())
                  for d in json.loads(r["document"])["kids"]] for r in mine]
        assert all(sum(s[:-1]) < 700 for s in sizes)  # a piece ends with the child that fills it
    assert max(r["n_pieces"] for r in rows if r["k"] == 3) > 10
    none, lost = nested_documents(p, c.where("false"), "k", ["id"])
    assert none.count() == len(parents) and lost.count() == 0


@pytest.mark.parametrize("hot_rows", [0, 40, 150])
def test_nested_documents_of_hot_keys_equal_others(spark, hot_rows):
    rng = random.Random(4)
    kids = [(3 if i % 3 == 0 else 5 if i % 3 == 1 and i < 300 else rng.choice([*range(9), 77, 78, None]), f"c{rng.randrange(500):03}", i % 7) for i in range(600)]
    kids += [(77, f"d{i}", 1) for i in range(60)]
    p = spark.createDataFrame([(k, f"p{k}") for k in range(12)] + [(None, "no key"), (3, "again")], "k long, name string")
    c = spark.createDataFrame(kids, "k long, id string, n long").repartition(5)
    rows = lambda x: sorted(map(str, x.collect()))
    want = [rows(x) for x in nested_documents(p, c, "k", ["id", "n"], "kids", max_bytes=300)]
    assert [rows(x) for x in nested_documents(p, c, "k", ["id", "n"], "kids", max_bytes=300, hot_rows=hot_rows)] == want
    assert len(want[1]) == sum(k in (None, 77, 78) for k, _, _ in kids)


def test_nested_documents_read_children_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    c = spark.range(600).selectExpr("id % 50 as k", "cast(id as string) as id").mapInArrow(counted, "k long, id string")
    docs, unplaced = nested_documents(spark.range(40).toDF("k"), c, "k", ["id"])
    assert docs.count() == 40 and unplaced.count() == 120 and seen.value == 600


def test_sensitive_arrays_and_types_without_a_map(spark):
    from florafold.operators import enrich as EN
    df = spark.range(1).select("id", F.array(F.lit("x")).alias("sensitive_tags"), F.array(F.lit("y")).alias("tags"), F.lit(None).alias("nothing"))
    r = EN.build_index_record(df).first()
    assert r["multiValues"] == {"tags": ["y"]} and r["strings"] == {"sensitive_tags": '["x"]'}
    with pytest.raises(TypeError, match="gap"):
        EN.build_index_record(df.select("id", F.expr("interval 1 day").alias("gap")))


def test_version_cutoff_and_provider_alone(spark):
    from florafold.operators import planning as PL
    assert PL.version_cutoff(spark, "occindex-2024-03-05-10-05") == "2024-02-27"
    with pytest.raises(ValueError, match="date"):
        PL.version_cutoff(spark, "occindex_05_03_10_05_00")
    ids = spark.createDataFrame([("dp1",), ("dr5",)], "uid string")
    reg = spark.createDataFrame([("dp1", [("dr1", "x")])], "uid string, dataResources array<struct<uid:string,uri:string>>")
    with pytest.raises(ValueError, match="alone"):
        PL.expand_providers(ids, reg, mixed="raise")
