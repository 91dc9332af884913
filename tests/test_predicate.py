"""Long lists of values in a predicate give the rows that comparing them one by one gives."""

import random

import pytest

from florafold.functions import predicate as P


def test_long_lists_equal_short_ones(spark, monkeypatch):
    rows = [(i if i % 7 else None, f"s{i % 5}", float(i % 11)) for i in range(200)] + [(3, "s3", 3.0)] * 4
    df = spark.createDataFrame(rows, "k long, `a.b` string, x double").repartition(3)
    ks = {"type": "in", "key": "k", "values": [3, 3, None, *range(40, 120)]}
    names = {"type": "in", "key": "a.b", "values": ["s1", "s3", "zz"]}
    xs = {"type": "in", "key": "x", "values": [1, 2.0, 5.0]}
    trees = [ks, {"type": "not", "predicate": ks}, {"type": "or", "predicates": [ks, names]}, {"type": "and", "predicates": [ks, {"type": "not", "predicate": names}]},
             {"type": "not", "predicate": {"type": "or", "predicates": [ks, {"type": "and", "predicates": [names, xs]}]}},
             {"type": "and", "predicates": [ks, ks, {"type": "range", "key": "x", "from": 2}]}]
    plain = [sorted(map(str, P.predicate_filter(df, t).collect())) for t in trees]
    monkeypatch.setattr(P, "LONG_LIST", 1)
    for t, want in zip(trees, plain):
        got = P.predicate_filter(df, t)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and "INSET" not in plan


def _inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def test_within_equals_ray_casting_under_and_or_not(spark):
    rng = random.Random(3)
    rows = [(i, rng.uniform(-5, 15), rng.uniform(-5, 15)) for i in range(400)]
    rows += [(400, None, 3.0), (401, 3.0, None), (402, float("nan"), 3.0), (403, 3.0, float("nan")), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "id long, `lat.` double, lon double").repartition(3)
    outer, hole, other = [(0, 0), (10, 1), (9, 9), (1, 10)], [(3, 3), (6, 3), (5, 6)], [(4, 4), (14, 4), (14, 7)]
    wkt = lambda ring: "(" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + ")"
    node = {"type": "within", "latitude": "lat.", "longitude": "lon"}
    one = {**node, "geometry": f"POLYGON({wkt(outer)}, {wkt(hole)})"}
    both = {**node, "geometry": f"multipolygon ( ({wkt(outer)},{wkt(hole)}), ({wkt(other)}))"}
    place = lambda r: r[1] is not None and r[2] is not None and r[1] == r[1] and r[2] == r[2]
    in_one = {r for r in rows if place(r) and _inside(r[2], r[1], outer) and not _inside(r[2], r[1], hole)}
    in_both = in_one | {r for r in rows if place(r) and _inside(r[2], r[1], other)}
    low = {"type": "range", "key": "id", "to": 200}
    cases = [(one, lambda r: r in in_one), (both, lambda r: r in in_both),
             ({"type": "not", "predicate": one}, lambda r: r not in in_one),
             ({"type": "and", "predicates": [both, {"type": "not", "predicate": one}, low]}, lambda r: r in in_both - in_one and r[0] <= 200),
             ({"type": "or", "predicates": [one, low]}, lambda r: r in in_one or r[0] <= 200)]
    for tree, keep in cases:
        got = P.predicate_filter(df, tree)
        assert got.columns == df.columns
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(r) for r in rows if keep(r))
    assert P.predicate_filter(df.limit(0), both).count() == 0


@pytest.mark.parametrize("text", ["POINT (1 2)", "POLYGON ((1 2, 3 4, 1 2))", "POLYGON ((0 0, 1 0, 1 1, 0 0)", "POLYGON EMPTY", "POLYGON ((0, 1 0, 1 1))"])
def test_what_is_no_polygon_raises(text):
    with pytest.raises(ValueError):
        P.polygon_rings(text)


def test_within_needs_a_table():
    with pytest.raises(ValueError):
        P.predicate_to_column({"type": "within", "geometry": "POLYGON ((0 0, 1 0, 1 1, 0 0))"})
