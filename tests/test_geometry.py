"""Grid-cell joins of points and polygons against plain loops."""

import math
import random

from florafold.operators import enrich as EN

RING = "array<struct<x:double,y:double>>"


def _inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _polygons(rng, n):
    out = []
    for k in range(n):
        cx, cy, r, m = rng.uniform(-8, 8), rng.uniform(-8, 8), rng.choice([0.2, 1.5, 6.0]), rng.randint(3, 40)
        ring = [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / m),
                 cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / m)) for i in range(m)]
        if k % 3 == 0:  # corners on the grid, level and upright edges, repeated corners
            ring = [(round(a), round(b)) for a, b in ring]
        out.append((f"t{k % 4}", f"p{k}", [(float(a), float(b)) for a, b in ring]))
    return out


def _points(rng, polys):
    pts = {(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(300)}
    pts |= {(float(rng.randint(-9, 9)), float(rng.randint(-9, 9))) for _ in range(150)}
    pts |= {rng.choice(rng.choice(polys)[2]) for _ in range(100)}
    pts |= {(float(rng.randint(-9, 9)), rng.uniform(-9, 9)) for _ in range(50)}
    return sorted(pts)


def test_points_in_polygons_equals_ray_casting(spark):
    rng = random.Random(5)
    polys = _polygons(rng, 45)
    pts = _points(rng, polys)
    want = {(x, y, name) for _, name, ring in polys for x, y in pts if _inside(x, y, ring)}
    pf = spark.createDataFrame(polys, f"taxon string, name string, ring {RING}")
    for cell in (1.0, 0.37, 7.0):
        got = EN.points_in_polygons(spark.createDataFrame(pts, "x double, y double"), pf, ["name"], cell=cell).collect()
        assert len(got) == len(want) and {(r["x"], r["y"], r["name"]) for r in got} == want, cell


def test_points_meet_only_polygons_of_their_taxon_and_both_cells_are_join_keys(spark):
    rng = random.Random(6)
    polys = [(f"t{k}", name, ring) for k, (_, name, ring) in enumerate(_polygons(rng, 12))]
    pts = [(f"t{k % 12}", x, y) for k, (x, y) in enumerate(_points(rng, polys))]
    pf = spark.createDataFrame(polys, f"taxon string, name string, ring {RING}")
    out = EN.points_in_polygons(spark.createDataFrame(pts, "taxon string, x double, y double"), pf, ["taxon"],
                                match=["taxon"])
    want = {(t, x, y) for t, x, y in pts if any(u == t and _inside(x, y, ring) for u, _, ring in polys)}
    assert {(r["taxon"], r["x"], r["y"]) for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    join = [line for line in plan.splitlines() if "Join Inner" in line and "taxon" in line][0]
    assert "_col#" in join and "_row#" in join


def _unwrapped(ring):
    """The ring without jumps over the date line, closed along a pole if it goes around one."""
    out, off = [], 0.0
    for (x1, y1), (x2, _) in zip(ring, ring[1:] + ring[:1]):
        out.append((x1 + off, y1))
        off += 360.0 if -360 < x2 - x1 < -180 else -360.0 if 180 < x2 - x1 < 360 else 0.0
    if off:
        pole = -90.0 if sum(y for _, y in ring) < 0 else 90.0
        (x, y) = ring[0]
        out += [(x + off, y), (x + off, pole), (x, pole)]
    return out


def _inside_anywhere(x, y, ring):
    return any(_inside(x + s, y, _unwrapped(ring)) for s in (-360.0, 0.0, 360.0))


def test_rings_over_the_date_line_and_around_a_pole(spark):
    rng = random.Random(9)
    polys = [("over", [(170.0, -10.0), (-175.0, -12.0), (-170.5, 11.0), (172.0, 9.0)]), ("beyond", [(175.0, 0.0), (190.0, 0.0), (186.0, 20.0)]),
             ("south", [(-120.0, -60.0), (0.0, -70.0), (110.0, -65.5)]), ("north", [(100.0, 70.0), (-20.0, 75.0), (-140.0, 60.0)]),
             ("world", [(-180.0, -80.0), (180.0, -80.0), (180.0, -20.0), (-180.0, -20.0)]), ("plain", [(-179.0, 1.0), (-170.0, 1.0), (-170.0, 8.0)])]
    pts = sorted({(rng.uniform(-180, 180), rng.uniform(-89, 89)) for _ in range(500)} | {(rng.choice([-1, 1]) * rng.uniform(165, 180), rng.uniform(-20, 25))
                 for _ in range(400)} | {(180.0, 1.5), (-180.0, 1.5), (-180.0, -70.0)})
    pf = spark.createDataFrame(polys, f"name string, ring {RING}")
    want = {(x, y, n) for n, ring in polys for x, y in pts if _inside_anywhere(x, y, ring)}
    for cell in (1.0, 2.3):
        got = EN.points_in_polygons(spark.createDataFrame(pts, "x double, y double"), pf, ["name"], cell=cell).collect()
        assert len(got) == len(want) and {(r["x"], r["y"], r["name"]) for r in got} == want


def test_the_index_grows_with_the_boundary(spark):
    from florafold.operators.geometry import polygon_cells
    square = spark.createDataFrame([("a", [(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0)])], f"name string, ring {RING}")
    sizes = {}
    for cell in (1.0, 0.25):
        boundary, inside = polygon_cells(square, ["name"], cell)
        n = 40 / cell
        sizes[cell] = inside.count()
        assert boundary.count() < 12 * n and sizes[cell] < n * 2 * math.log2(n)  # the area holds n * n cells
    assert sizes[0.25] < 7 * sizes[1.0]  # 16 times with the area


def _vector(lat, lon):
    p, q = math.radians(lat), math.radians(lon)
    return math.cos(p) * math.cos(q), math.cos(p) * math.sin(q), math.sin(p)


def _to_edge(lat, lon, ring):
    """Km to the nearest of many points along each edge's great-circle arc."""
    p, best = _vector(lat, lon), math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        a, b = _vector(y1, x1), _vector(y2, x2)
        lo, hi = 0.0, 1.0

        def km(t):
            v = [u + t * (w - u) for u, w in zip(a, b)]
            size = math.sqrt(sum(c * c for c in v)) or 1.0
            v = [c / size for c in v]
            return 2 * 6371.0 * math.asin(min(1.0, math.dist(p, v) / 2))

        grid = [k / 64 for k in range(65)]
        t = min(grid, key=km)
        lo, hi = max(0.0, t - 1 / 64), min(1.0, t + 1 / 64)
        for _ in range(100):
            u, w = lo + (hi - lo) / 3, hi - (hi - lo) / 3
            lo, hi = (lo, w) if km(u) < km(w) else (u, hi)
        best = min(best, km(lo), km(0.0), km(1.0))
    return best


def test_range_distances_equal_the_nearest_edge(spark):
    rng = random.Random(7)
    polys = [(f"t{k}", ring) for k, (_, _, ring) in enumerate(_polygons(rng, 7))]
    polys += [("t9", [(170.0, 88.0), (179.5, 89.9), (-179.0, 80.0)]), ("t8", [(-60.0, 50.0), (70.0, 55.0), (60.0, 20.0), (-60.0, 50.0)]),
              ("t8", [(170.0, -10.0), (-170.0, -12.0), (-175.0, 5.0)]), ("t7", [(5.0, 5.0)])]
    recs = [(str(i), f"t{i % 11}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(250)]
    recs += [("pole", "t9", 90.0, 0.0), ("none", "t1", None, 5.0), ("west", "t8", 0.0, -179.9), ("on", "t8", 50.0, -60.0)]

    def want(taxon, lat, lon):
        rings = [ring for t, ring in polys if t == taxon]
        if not rings or lat is None:
            return None
        if any(_inside_anywhere(lon, lat, ring) for ring in rings):
            return 0.0
        return min(_to_edge(lat, lon, ring) for ring in rings)

    got = EN.distribution_outliers(
        spark.createDataFrame(recs, "id string, taxon string, decimalLatitude double, decimalLongitude double"),
        spark.createDataFrame(polys, f"taxon string, ring {RING}"))
    found = {r["id"]: r["distance"] for r in got.collect()}
    assert got.count() == len(recs)
    for i, taxon, lat, lon in recs:
        w = want(taxon, lat, lon)
        assert (found[i] is None) == (w is None) and (w is None or abs(found[i] - w) < 1e-4), (i, taxon, found[i], w)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Join Inner, (taxon" in line]
    assert not keys  # never on the taxon alone
    assert len([x for x in got._jdf.queryExecution().sparkPlan().toString().splitlines() if "Exchange" in x]) < 15
