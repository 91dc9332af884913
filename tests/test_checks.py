"""Facet checks, totals, sampling, record comparison: threshold edges and metamorphic cases."""

import pytest

from florafold.operators import checks as CK
from florafold.plans import publish as PB


def _facet_df(spark, counts, field="f"):
    rows = [(f"{v}",) for v, c in counts.items() for _ in range(c)]
    return spark.createDataFrame(rows, f"{field} string")


@pytest.mark.parametrize("old,new,status", [
    (1000, 980, "WARN"),    # 2 % drop: not above 2
    (1000, 975, "WARN"),    # 2.5 % rounds half to even → 2
    (1000, 970, "FAIL"),    # 3 %
    (999, 960, "WARN"),     # old < 1000 and new > 0: never severe
    (1000, 1000, "PASS"),
    (1000, 1200, "PASS"),
    (1000, 0, "FAIL"),      # value absent in new
])
def test_facet_compare_rule(spark, old, new, status):
    o = _facet_df(spark, {"v": old})
    n = _facet_df(spark, {"v": new} if new else {"w": 1})
    r = CK.facet_compare(o, n, "f").collect()
    assert len(r) == 1 and r[0]["status"] == status


def test_empty_old_facet_passes(spark):
    o = spark.createDataFrame([(None,)], "f string")
    n = _facet_df(spark, {"v": 3})
    per = CK.facet_compare(o, n, "f")
    assert per.count() == 0
    assert CK.facet_status(per).first()["status"] == "PASS"


def test_total_count_and_asserted(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, userAssertions string")
    b = a.filter("id < 3")
    assert CK.check_total_count(a, b).first()["status"] == "FAIL"
    assert CK.check_total_count(b, a).first()["status"] == "PASS"
    assert CK.check_asserted(a, b).first()["status"] == "FAIL"
    none = a.filter("userAssertions is null")
    assert CK.check_asserted(none, none).first()["status"] == "PASS"


def test_compare_with_itself_is_all_pass(spark):
    df = spark.createDataFrame([("1", "a", 1.0), ("2", None, 2.0)], "id string, x string, y double")
    out = CK.compare_records(df, df)
    assert {r["status"] for r in out.collect()} == {"PASS"}


def test_compare_records_statuses(spark):
    old = spark.createDataFrame([("1", "a", 1.0, "u"), ("2", "b", 2.0, None), ("3", "c", 3.0, None),
                                 ("4", "d", 4.0, None)],
                                "id string, x string, y double, userAssertions string")
    new = spark.createDataFrame([("1", "a", 1.0, None), ("2", "B", 2.0, None), ("3", None, 3.0, "z"),
                                 ("4", "d", 4.0, None), ("4", "d", 4.0, None)],
                                "id string, x string, y double, extra string")
    st = {r["id"]: r["status"] for r in CK.compare_records(old, new).collect()}
    assert st == {"1": "PASS", "2": "WARN", "3": "FAIL", "4": "FAIL"}


def test_min_fields_null_ids(spark):
    new = spark.createDataFrame([("a", 1, 2), ("b", None, None)], "id string, p int, q int")
    sample = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (3, "NULL"), (4, "zz")], "draw long, id string")
    st = {r["draw"]: r["status"] for r in CK.check_min_fields(sample, new, minimum=3).collect()}
    assert st == {0: "PASS", 1: "FAIL", 2: "FAIL", 3: "FAIL", 4: "FAIL"}


def test_sample_records_is_repeatable(spark):
    rows = [(f"dr{i % 3}", f"id{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "dataResourceUid string, id string")
    a = sorted(CK.sample_records(df, 20, 7).collect())
    b = sorted(CK.sample_records(df, 20, 7).collect())
    assert a == b and len(a) == 20
    ids = {r["id"] for r in df.collect()}
    assert all(r["id"] in ids for r in a)


def test_rollup_and_publish(spark):
    checks = spark.createDataFrame([("a", "PASS"), ("b", "WARN")], "check string, status string")
    roll = CK.rollup_status(checks)
    assert roll.first()["publish"] is True and roll.first()["status"] == "WARN"
    dec = PB.publish_decision(roll, "occindex", "occindex-2024-01-01-00-00").first()
    assert dec["action"] == "switch"
    dec2 = PB.publish_decision(roll, "occindex", "v", checks_only=True).first()
    assert dec2["action"] == "skip" and dec2["status"] == "SKIP"
    failing = spark.createDataFrame([("a", "FAIL")], "check string, status string")
    assert PB.publish_decision(CK.rollup_status(failing), "b", "v").first()["action"] == "blocked"


def test_publish_version_writes_pointer(spark, tmp_path):
    checks = spark.createDataFrame([("a", "PASS")], "check string, status string")
    dec = PB.publish_decision(CK.rollup_status(checks), "occindex", "occindex-2024-01-01-00-00")
    new = spark.createDataFrame([(1,)], "x int")
    row = PB.publish_version(spark, dec, str(tmp_path), new)
    assert row["action"] == "switch"
    assert PB.current_version(spark, str(tmp_path), "occindex") == "occindex-2024-01-01-00-00"
    assert spark.table("occindex").count() == 1
