"""Points, polygons and distances to polygon edges (used by J13 and J15).

A polygon is a ring: array<struct<x, y>> of degrees, closed or not. An edge longer than 180 and
shorter than 360 degrees of longitude runs over the date line; longitudes beyond
180 are taken as they are. A ring around a pole is closed along it (the pole on the
side of its mean latitude).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florafold.session import ensure_checkpoint_dir

EARTH_RADIUS_KM = 6371.0
_FAN = 3  # a cell of the pyramid has 2**_FAN x 2**_FAN cells of the next level


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def polygon_edges(polys: DataFrame, key_cols: list[str], ring_col: str = "ring") -> DataFrame:
    """Polygon rings → one row per edge, unwrapped over the date line.

    A ring that reaches beyond 180 degrees is listed once more, shifted by 360, so
    that points of either side meet it (_copy tells the listings apart)."""
    ring = F.col("_r")
    n = F.size(ring)
    nxt = lambda i: F.element_at(ring, (F.pmod(i + 1, n) + 1).cast("int"))
    dx = lambda p, i: nxt(i)["x"] - p["x"]
    turn = lambda p, i: F.when((dx(p, i) > 180) & (dx(p, i) < 360), -1).when((dx(p, i) < -180) & (dx(p, i) > -360), 1).otherwise(0)
    turns = F.filter(F.transform(ring, lambda p, i: F.struct(i.alias("i"), turn(p, i).alias("t"))), lambda s: s["t"] != 0)
    before = lambda i: F.aggregate(F.filter("_turns", lambda s: s["i"] < i), F.lit(0), lambda a, s: a + s["t"]) * 360.0
    at = lambda i, p: F.struct((p["x"] + before(i)).alias("x"), p["y"].alias("y"))
    p = polys.select(*key_cols, F.transform(F.col(ring_col), lambda p: F.struct(
        p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))).alias("_r")).where(n > 0).withColumn("_turns", turns)
    p = p.withColumn("_path", F.concat(F.transform(ring, lambda p, i: at(i, p)),
                                       F.array(at(n, F.element_at(ring, 1)))))
    # a path that comes back shifted by whole turns goes around a pole
    first, last = F.element_at("_path", 1), F.element_at("_path", -1)
    pole = F.when(F.aggregate(ring, F.lit(0.0), lambda a, q: a + q["y"]) < 0, -90.0).otherwise(90.0)
    corner = lambda v, y: F.struct(v["x"].alias("x"), y.alias("y"))
    p = p.withColumn("_path", F.when(first["x"] == last["x"], F.col("_path")).otherwise(
        F.concat("_path", F.array(corner(last, pole), corner(first, pole), first))))
    xs = F.transform("_path", lambda q: q["x"])
    low, high = F.array_min(xs), F.array_max(xs)
    copies = F.filter(F.array(F.lit(0), F.lit(-1), F.lit(1)),
                      lambda s: (s == 0) | ((low + s * 360 < 180) & (high + s * 360 > -180) & ((low < -180) | (high > 180))))
    p = p.select(*key_cols, "_path", F.explode(copies).alias("_copy"))
    edges = p.select(*key_cols, "_copy", F.posexplode("_path").alias("_i", "_p"), F.try_element_at("_path", F.col("_i") + 2).alias("_q")) \
        .where("_q is not null")
    shift = F.col("_copy") * 360.0
    return edges.select(*key_cols, "_copy", (F.col("_p.x") + shift).alias("x1"), F.col("_p.y").alias("y1"),
                        (F.col("_q.x") + shift).alias("x2"), F.col("_q.y").alias("y2"))


def _crossing(x1, y1, x2, y2, y) -> Column:
    """Where the line through an edge meets height ``y``; null for a level edge."""
    return (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1


def polygon_cells(polys: DataFrame, key_cols: list[str], cell: float) -> tuple[DataFrame, DataFrame]:
    """Grid index of polygons: (cells on the boundary, with one row per edge touching them;
    what lies wholly inside).

    Inside, a row's run of cells between two boundary cells is cut into segments of
    1, 2, 4, ... cells at multiples of their length (_level, _seg): a run of n cells takes at most
    2 log2(n) rows, so the index grows with the boundary, not with the area.
    ``_odd`` is 1 when a boundary cell's reference point (``_rx``, ``_ry``, off the
    cell's corners and centre) lies inside by the even-odd rule."""
    x1, y1, x2, y2, row = (F.col(c) for c in ("x1", "y1", "x2", "y2", "_row"))
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    keys = [*key_cols, "_copy"]
    ensure_checkpoint_dir(polys.sparkSession)
    rows = polygon_edges(polys, key_cols).checkpoint().withColumn("_row", F.explode(F.sequence(
        F.floor(low / cell).cast("bigint"), F.floor(high / cell).cast("bigint"))))
    enter = F.coalesce(_crossing(x1, y1, x2, y2, F.greatest(low, row * cell)), x1)
    leave = F.coalesce(_crossing(x1, y1, x2, y2, F.least(high, (row + 1) * cell)), x2)
    rim = cell * 1e-9  # an edge on a cell's rim belongs to both cells
    rows = rows.withColumn("_from", F.floor((F.least(enter, leave) - rim) / cell).cast("bigint")) \
        .withColumn("_to", F.floor((F.greatest(enter, leave) + rim) / cell).cast("bigint")) \
        .withColumn("_ry", (row + 0.57721566) * cell)
    ry = F.col("_ry")
    at = [*keys, "_row"]
    touching = rows.select(*at, F.explode(F.sequence("_from", "_to")).alias("_col"), "x1", "y1", "x2", "y2")
    # a row's cells: touched ones, and the runs between them, known by their first cell
    cols = touching.groupBy(*at, "_col").agg(F.lit(1).alias("_n"))
    after = F.lead("_col").over(Window.partitionBy(*at).orderBy("_col"))
    cols = cols.withColumn("_next", after)
    runs = F.array(F.struct(F.col("_col").alias("_col"), F.lit(None).cast("bigint").alias("_end")),
                   F.struct((F.col("_col") + 1).alias("_col"), F.when(F.col("_next") > F.col("_col") + 1, F.col("_next")).alias("_end")))
    refs = cols.select(*at, F.posexplode(runs).alias("_k", "_s")).where("_k = 0 or _s._end is not null") \
        .select(*at, F.col("_s._col").alias("_col"), F.col("_s._end").alias("_end")) \
        .withColumn("_x", (F.col("_col") + 0.41421356) * cell)
    # edges right of a reference point: counted along the row, from the right
    crossings = rows.where((y1 > ry) != (y2 > ry)).select(*at, F.lit(None).cast("bigint").alias("_col"),
                                                         F.lit(None).cast("bigint").alias("_end"),
                                                         _crossing(x1, y1, x2, y2, ry).alias("_x"))
    right = F.sum(F.when(F.col("_col").isNull(), 1).otherwise(0)).over(
        Window.partitionBy(*at).orderBy(F.col("_x").desc(), F.col("_col").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0))
    # the index of the polygons is written once: points meet its boundary and its inside
    refs = refs.unionByName(crossings).withColumn("_odd", right % 2).where("_col is not null").checkpoint()
    boundary = touching.join(refs.where("_end is null").drop("_end"), [*at, "_col"]) \
        .withColumnRenamed("_x", "_rx").withColumn("_ry", ry_of(cell))
    inside = refs.where("_end is not null and _odd = 1")
    level = F.col("_level")
    first = F.expr("shiftright(_col + shiftleft(1L, _level) - 1, _level)")
    last = F.expr("shiftright(_end, _level)")
    inside = inside.select(*keys, "_row", "_col", "_end", F.explode(F.array(*[F.lit(v) for v in range(levels(cell))])).alias("_level"))
    inside = inside.select(*keys, "_row", level, first.alias("_a"), last.alias("_b")).where("_a < _b")
    segs = F.array(F.when(F.expr("_a & 1 = 1"), F.col("_a")), F.when(F.expr("_b & 1 = 1"), F.col("_b") - 1))
    inside = inside.select(*keys, "_row", "_level", F.explode(segs).alias("_seg")).where("_seg is not null")
    return boundary, inside


def ry_of(cell: float) -> Column:
    return (F.col("_row") + 0.57721566) * cell


def levels(cell: float) -> int:
    """Lengths of segments: 1, 2, 4, ... cells, up to twice around the globe."""
    return math.ceil(math.log2(720 / cell)) + 1


def points_in_polygons(points: DataFrame, polys: DataFrame, key_cols: list[str], x: str = "x",
                       y: str = "y", cell: float = 1.0, match: list[str] = ()) -> DataFrame:
    """(point, polygon) pairs where the point lies inside (even-odd rule; a
    point on a boundary counts as just right of and above itself).

    Points and polygons meet by grid cell (equi-join on both cell numbers, and
    on ``match``, key columns that the points carry too): a segment of cells wholly
    inside decides at once; a cell on the boundary by the edges touching it, crossed on the
    way from the point, level and then upright, to the cell's reference point.
    ``points`` must be distinct. Choose ``cell`` so that a cell is touched by
    few edges."""
    boundary, within = polygon_cells(polys, key_cols, cell)
    placed = points.select(*match, F.col(x).alias("_px"), F.col(y).alias("_py")) \
        .withColumn("_col", F.floor(F.col("_px") / cell).cast("bigint")) \
        .withColumn("_row", F.floor(F.col("_py") / cell).cast("bigint"))
    px, py, rx, ry, x1, y1, x2, y2 = (F.col(c) for c in ("_px", "_py", "_rx", "_ry", "x1", "y1", "x2", "y2"))
    meet = _crossing(x1, y1, x2, y2, py)
    level = ((y1 > py) != (y2 > py)) & ((px < meet) != (rx < meet))
    height = _crossing(y1, x1, y2, x2, rx)
    upright = ((x1 > rx) != (x2 > rx)) & ((height > py) != (height > ry))
    keys = [k for k in key_cols if k not in match]
    parity = (F.count(F.when(level, 1)) + F.count(F.when(upright, 1)) + F.max("_odd")) % 2
    on = placed.join(boundary, [*match, "_col", "_row"]).groupBy(*match, "_px", "_py", *keys, "_copy").agg(parity.alias("_k"))
    on = on.filter(F.col("_k") == 1).select(px.alias(x), py.alias(y), *key_cols)
    placed = placed.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in range(levels(cell))]))) \
        .withColumn("_seg", F.expr("shiftright(_col, _level)"))
    return on.unionByName(placed.join(within, [*match, "_row", "_level", "_seg"]).select(px.alias(x), py.alias(y), *key_cols))


# ---------------------------------------------------------------- distances

def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    r1, r2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = r2 - r1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(r1) * F.cos(r2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def _unit(lon, lat) -> list[Column]:
    lo, la = F.radians(_c(lon)), F.radians(_c(lat))
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _dot(a, b) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def _cross(a, b) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def edge_distance_km(x, y, x1, y1, x2, y2) -> Column:
    """Great-circle distance from a point to the shorter great-circle arc between two vertices."""
    p, a, b = _unit(x, y), _unit(x1, y1), _unit(x2, y2)
    n = _cross(a, b)
    size = F.sqrt(_dot(n, n))
    beside = (size > 0) & (_dot(_cross(n, a), p) >= 0) & (_dot(_cross(b, n), p) >= 0)
    ends = F.least(haversine_km(y, x, y1, x1), haversine_km(y, x, y2, x2))
    off = F.abs(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(n, p) / size)))) * EARTH_RADIUS_KM
    return F.when(beside, off).otherwise(ends)


def _cells(df: DataFrame, x: Column, y: Column, cell: float, p: str) -> DataFrame:
    return df.withColumn(f"{p}x", F.floor((F.pmod(x + 180, F.lit(360.0))) / cell).cast("bigint")) \
        .withColumn(f"{p}y", F.floor((y + 90) / cell).cast("bigint"))


def _centre(p: str, cell: float) -> tuple[Column, Column]:
    """(latitude, longitude) of a cell's centre, pulled to the pole where a coarse cell reaches beyond it."""
    return F.least((F.col(f"{p}y") + 0.5) * cell - 90, F.lit(90.0)), (F.col(f"{p}x") + 0.5) * cell - 180


def _pyramid(rows: DataFrame, p: str, reach: Column, cell: float, depth: int) -> list[DataFrame]:
    """Cells of (taxon, <p>x, <p>y) by level, finest first, each with the km around its centre that holds all below it."""
    out = [rows.groupBy("taxon", f"{p}x", f"{p}y").agg(F.max(reach).alias(f"{p}r")).checkpoint()]
    for k in range(1, depth):
        fine, size = out[-1], cell * (1 << (_FAN * k))
        (la, lo), at = _centre(p, size / (1 << _FAN)), out[-1].columns
        fine = fine.withColumn("_la", la).withColumn("_lo", lo).withColumn(f"{p}x", F.shiftright(f"{p}x", _FAN)) \
            .withColumn(f"{p}y", F.shiftright(f"{p}y", _FAN))
        up = haversine_km(_centre(p, size)[0], _centre(p, size)[1], "_la", "_lo") + F.col(f"{p}r")
        out.append(fine.groupBy("taxon", f"{p}x", f"{p}y").agg(F.max(up).alias(f"{p}r")).select(at).checkpoint())
    return out


def nearest_edge_km(points: DataFrame, edges: DataFrame, cell: float = 0.25) -> DataFrame:
    """(taxon, x, y, distance): km from each point to the nearest edge of its taxon.

    ``points(taxon, x, y)`` are distinct; ``edges(taxon, x1, y1, x2, y2)`` are great-circle arcs.
    Both are summed up in a pyramid of cells, an edge in the cell of its middle.
    The descent keeps, for each cell of points, the cells of edges whose least
    possible distance is not above the smallest greatest possible one, level by
    level down to ``cell`` degrees; only there do points meet edges. Each
    level joins on (taxon, parent cell), 64 children at most a side. Points of a
    taxon without edges are left out."""
    ensure_checkpoint_dir(points.sparkSession)
    a, b = _unit("x1", "y1"), _unit("x2", "y2")
    m = [u + v for u, v in zip(a, b)]
    edges = edges.select("taxon", "x1", "y1", "x2", "y2",
                         F.degrees(F.atan2(m[1], m[0])).alias("_mx"), F.degrees(F.atan2(m[2], F.sqrt(m[0] * m[0] + m[1] * m[1]))).alias("_my"))
    edges = _cells(edges, F.col("_mx"), F.col("_my"), cell, "e").checkpoint()
    points = _cells(points.select("taxon", "x", "y"), F.col("x"), F.col("y"), cell, "p").checkpoint()
    depth = next(k for k in range(1, 20) if cell * (1 << (_FAN * k)) >= 360)
    (ela, elo), (pla, plo) = _centre("e", cell), _centre("p", cell)
    half = F.greatest(haversine_km("_my", "_mx", "y1", "x1"), haversine_km("_my", "_mx", "y2", "x2"))
    sides = {"e": _pyramid(edges, "e", haversine_km(ela, elo, "_my", "_mx") + half, cell, depth),
             "p": _pyramid(points, "p", haversine_km(pla, plo, "y", "x"), cell, depth)}
    zero = F.lit(0).cast("bigint")
    pairs = sides["p"][-1].select("taxon", zero.alias("_px"), zero.alias("_py"), zero.alias("_ex"), zero.alias("_ey")).distinct()
    for k in reversed(range(depth)):
        size = cell * (1 << (_FAN * k))
        for p in "pe":
            level = sides[p][k].withColumn(f"_{p}x", F.shiftright(f"{p}x", _FAN)).withColumn(f"_{p}y", F.shiftright(f"{p}y", _FAN))
            pairs = pairs.join(level, ["taxon", f"_{p}x", f"_{p}y"])
        (ela, elo), (pla, plo) = _centre("e", size), _centre("p", size)
        apart, around = haversine_km(pla, plo, ela, elo), F.col("pr") + F.col("er") + 1e-6
        least = F.min("_most").over(Window.partitionBy("taxon", "px", "py"))
        pairs = pairs.withColumn("_least", apart - around).withColumn("_most", apart + around).withColumn("_bound", least) \
            .where("_least <= _bound").select("taxon", F.col("px").alias("_px"), F.col("py").alias("_py"),
                                              F.col("ex").alias("_ex"), F.col("ey").alias("_ey")).checkpoint()
    pairs = pairs.select("taxon", *[F.col(f"_{c}").alias(c) for c in ("px", "py", "ex", "ey")])
    return points.join(pairs, ["taxon", "px", "py"]).join(edges, ["taxon", "ex", "ey"]).groupBy("taxon", "x", "y") \
        .agg(F.min(edge_distance_km("x", "y", "x1", "y1", "x2", "y2")).alias("distance"))
