"""Coordinates held against the stated region, and written forms through F12, against plain loops."""

import datetime
import random

from florafold.operators import coordinates as CO
from florafold.operators import enrich as EN

BOXES = {"a": [(10.0, 20.0, 30.0, 35.0)], "b": [(-40.0, -20.0, -10.0, -5.0), (100.0, 5.0, 120.0, 15.0)], "c": [(-5.0, -5.0, 5.0, 5.0)]}


def _want(region, x, y):
    if region not in BOXES or x is None or y is None or not (abs(x) <= 180 and abs(y) <= 90):
        return x, y, []
    ways = [(x, y, []), (x, -y, [CO.NEGATED_LATITUDE]), (-x, y, [CO.NEGATED_LONGITUDE]), (-x, -y, [CO.NEGATED_LATITUDE, CO.NEGATED_LONGITUDE]), (y, x, [CO.SWAPPED])]
    for a, b, codes in ways:
        if any(x0 <= a < x1 and y0 <= b < y1 for x0, y0, x1, y1 in BOXES[region]):
            return a, b, codes
    return x, y, [CO.MISMATCH]


def test_coordinates_as_the_region_proves_them(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        region = rng.choice(["a", "b", "c"])
        x0, y0, x1, y1 = rng.choice(BOXES[region])
        x, y = rng.uniform(x0 - 2, x1 + 2), rng.uniform(y0 - 2, y1 + 2)
        x, y = rng.choice([(x, y), (x, -y), (-x, y), (-x, -y), (y, x)])
        rows.append((i, region, y, x, ["SEEN"], "other"))
    rows += [(600, None, 1.0, 1.0, None, "n"), (601, "z", 1.0, 1.0, [], "n"), (602, "a", None, 1.0, None, "n"), (603, "a", 91.0, 12.0, [], "n"),
             (604, "a", float("nan"), 12.0, [], "n"), (605, "c", 0.0, 0.0, [], "n"), (605, "c", 0.0, 0.0, [], "n"), rows[0]]
    df = spark.createDataFrame(rows, "id long, region string, `lat.` double, lon double, issues array<string>, _x string").repartition(4)
    rings = [(r, [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]) for r, boxes in BOXES.items() for x0, y0, x1, y1 in boxes]
    polygons = spark.createDataFrame(rings, "region string, ring array<struct<x: double, y: double>>")
    out = CO.place_coordinates(df, polygons, "region", "lat.", "lon")
    assert out.columns == df.columns
    want = []
    for i, region, y, x, seen, other in rows:
        a, b, codes = _want(region, x, y)
        want.append((i, region, b, a, (seen or []) + codes, other))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert {r["issues"][0] for r in CO.place_coordinates(df.drop("issues"), polygons, "region", "lat.", "lon").collect() if r["issues"]} >= {CO.SWAPPED, CO.MISMATCH}
    assert CO.place_coordinates(df.limit(0), polygons, "region", "lat.", "lon").count() == 0
    assert CO.place_coordinates(df, polygons.limit(0), "region", "lat.", "lon").where("size(issues) > 1").count() == 0


def test_written_forms_through_interpret(spark):
    rows = [("35°30'S", "149 7.5 E", "2020-02"), ("12.5", "-190", "2021-05-03/01"), (" ", None, ""), ("S", "1W", "2020-05-01/03")]
    df = spark.createDataFrame(rows, "a string, o string, d string")
    out = EN.interpret(df, {"lat": ("a", "latitude"), "lon": ("o", "longitude"), "seen": ("d", "interval")}, lat="lat", lon="lon")
    day = lambda m, d: datetime.date(2020, m, d)
    assert out.columns == ["lat", "lon", "seen", "seenEnd", "seenPrecision", "issues"]
    assert [tuple(r) for r in out.collect()] == [
        (-35.5, 149.125, day(2, 1), day(2, 29), "month", []), (12.5, None, None, None, None, ["LON_INVALID", "SEEN_REVERSED"]),
        (None, None, None, None, None, []), (None, -1.0, day(5, 1), day(5, 3), "range", ["LAT_INVALID"])]
