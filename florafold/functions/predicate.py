"""JSON predicate tree → Spark ``Column``.

Shape (as in download requests)::

    {"type": "and", "predicates": [{"type": "in", "key": "stateProvince",
                                    "values": ["Victoria"]}]}

``and`` and ``in`` follow the reference's requests. The other node types
(``or``, ``not``, ``equals``, ``range``, ``isNull``, ``isNotNull``, ``like``)
are our own definition, and so is ``within``::

    {"type": "within", "geometry": "POLYGON ((140 -40, 150 -40, 150 -30, 140 -40))",
     "latitude": "decimalLatitude", "longitude": "decimalLongitude"}

with a POLYGON or MULTIPOLYGON of well-known text, holes included, and the two
columns named as shown if they are not given. Compiling happens once on the driver over the
(small) predicate tree; the result is a built-in expression that Catalyst
pushes down to the scan where it can. An ``in`` with a long list becomes a join
with the list's values and a ``within`` one with the places inside, wherever they
stand in the tree (:func:`predicate_filter`).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florafold.operators.geometry import points_in_polygons

#: Longer lists of an ``in`` are joined, not compared one by one.
LONG_LIST = 1000


def predicate_to_column(predicate: Any, joined: Callable[[dict], Column] | None = None) -> Column:
    """``joined(node)`` gives the column of a node that needs a join: ``within``, and ``in`` with more than ``LONG_LIST`` values."""
    if isinstance(predicate, str):
        predicate = json.loads(predicate)
    if predicate is None or predicate == {}:
        return F.lit(True)
    kind = predicate.get("type")
    if kind in ("and", "or"):
        parts = [predicate_to_column(p, joined) for p in predicate.get("predicates", [])]
        if not parts:
            return F.lit(kind == "and")
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if kind == "and" else (out | p)
        return out
    if kind == "not":
        return ~F.coalesce(predicate_to_column(predicate["predicate"], joined), F.lit(False))
    key = predicate.get("key")
    col = F.col(f"`{key}`") if key else None
    # leaves stay plain comparisons so Parquet receives them as pushed filters;
    # a null leaf filters the row out exactly like false, except under `not`,
    # which treats null as false before negating
    if kind == "within":
        if not joined:
            raise ValueError("a within predicate needs predicate_filter")
        return joined(predicate)
    if kind == "in":
        if joined and len(predicate.get("values", [])) > LONG_LIST:
            return joined(predicate)
        return col.isin(list(predicate.get("values", [])))
    if kind == "equals":
        return col == F.lit(predicate["value"])
    if kind == "range":
        conds = []
        if predicate.get("from") is not None:
            conds.append(col >= F.lit(predicate["from"]))
        if predicate.get("to") is not None:
            conds.append(col <= F.lit(predicate["to"]))
        out = conds[0] if conds else F.lit(True)
        for c in conds[1:]:
            out = out & c
        return out
    if kind == "isNull":
        return col.isNull()
    if kind == "isNotNull":
        return col.isNotNull()
    if kind == "like":
        return col.like(predicate["value"])
    raise ValueError(f"unknown predicate type: {kind!r}")


def polygon_rings(text: str) -> list[tuple[int, bool, list[tuple[float, float]]]]:
    """(polygon, is a hole, [(x, y), ..]) for each ring of a POLYGON or MULTIPOLYGON in well-known text."""
    kind = re.match(r"\s*(MULTIPOLYGON|POLYGON)\s*(?:Z\s*)?\(", text, re.I)
    if not kind:
        raise ValueError(f"not a polygon: {text[:40]!r}")
    depth, rings, polygon, first = 0, [], -1, True
    base = 2 if kind[1].upper() == "MULTIPOLYGON" else 1  # the depth at which a polygon's rings are listed
    polygon += base == 1
    for token in re.findall(r"[()]|[^()]+", text[kind.end() - 1:]):
        if token == "(":
            depth += 1
            if depth == base == 2:
                polygon, first = polygon + 1, True
        elif token == ")":
            depth -= 1
        elif depth == base + 1:
            ring = [tuple(float(v) for v in point.split()[:2]) for point in token.split(",")]
            if any(len(p) < 2 for p in ring) or len(set(ring)) < 3:
                raise ValueError(f"not a ring: {token[:40]!r}")
            rings.append((polygon, not first, ring))
            first = False
        elif token.strip(" ,\t\n\r"):
            raise ValueError(f"not a polygon: {token[:40]!r}")
    if depth or not rings:
        raise ValueError(f"not a polygon: {text[:40]!r}")
    return rings


def places_within(df: DataFrame, geometry: str, latitude: str, longitude: str, cell: float = 1.0) -> DataFrame:
    """(x, y): the distinct places of ``df`` that lie inside a polygon and in none of its holes.

    A place on a ring counts as just right of and above itself. Rings may run over the
    date line (an edge longer than 180 degrees does)."""
    spark = df.sparkSession
    rings = [(i, p, hole, [{"x": x, "y": y} for x, y in ring]) for i, (p, hole, ring) in enumerate(polygon_rings(geometry))]
    rings = spark.createDataFrame(rings, "_ring int, _polygon int, _hole boolean, ring array<struct<x: double, y: double>>")
    places = df.select(F.col(f"`{longitude}`").cast("double").alias("x"), F.col(f"`{latitude}`").cast("double").alias("y")) \
        .where("x is not null and y is not null and not isnan(x) and not isnan(y)").distinct()
    inside = points_in_polygons(places, rings, ["_ring", "_polygon", "_hole"], cell=cell)
    return inside.groupBy("x", "y", "_polygon").agg(F.max("_hole").alias("_hole")).where("not _hole").select("x", "y").distinct()


def predicate_filter(df: DataFrame, predicate) -> DataFrame:
    """Rows matching a JSON predicate tree.

    Short nodes are pushed down to the scan where possible. A long list of values
    is a table of its own, made distinct and left-joined on its key, so that rows are neither lost nor
    repeated and the match counts like any other node under ``and``, ``or`` and
    ``not``; Spark broadcasts a small list and shuffles a large one. Values are read as the key's type;
    a null key matches no list. A ``within`` polygon is met by the distinct places of the rows through
    the polygon's cells, and the places inside are joined in the same way; a null
    or not-a-number coordinate lies nowhere."""
    tables = []

    def joined(node: dict) -> Column:
        n = len(tables)
        if node["type"] == "within":
            lat, lon = node.get("latitude", "decimalLatitude"), node.get("longitude", "decimalLongitude")
            table = places_within(df, node["geometry"], lat, lon).select(F.col("x").alias(f"__in{n}"), F.col("y").alias(f"__y{n}"))
            x, y = F.col(f"`{lon}`").cast("double"), F.col(f"`{lat}`").cast("double")
            tables.append((table, (x == F.col(f"__in{n}")) & (y == F.col(f"__y{n}"))))
            known = x.isNotNull() & y.isNotNull()
        else:
            key = node["key"]
            table = df.sparkSession.createDataFrame([(str(v),) for v in node["values"] if v is not None], "v string")
            table = table.select(F.col("v").cast(df.schema[key].dataType).alias(f"__in{n}")).where(f"__in{n} is not null").distinct()
            tables.append((table, F.col(f"`{key}`") == F.col(f"__in{n}")))
            known = F.col(f"`{key}`").isNotNull()
        return F.when(known, F.col(f"__in{n}").isNotNull())

    condition = predicate_to_column(predicate, joined)
    if not tables:
        return df.filter(condition)
    out = df
    for table, on in tables:
        out = out.join(table, on, "left")
    return out.filter(condition).select(*[f"`{c}`" for c in df.columns])
