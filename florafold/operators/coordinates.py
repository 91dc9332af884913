"""coordinates whose signs or order are wrong, proven by the region a record states (I-class: issue codes in common use).

A record says where it is twice: by its coordinates and by a region (a country, a
state). Where the coordinates lie outside the region, but lie inside with a sign
turned or with latitude and longitude swapped, that is what was meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florafold.operators.geometry import points_in_polygons
from florafold.session import ensure_checkpoint_dir

NEGATED_LATITUDE, NEGATED_LONGITUDE = "PRESUMED_NEGATED_LATITUDE", "PRESUMED_NEGATED_LONGITUDE"
SWAPPED, MISMATCH = "PRESUMED_SWAPPED_COORDINATE", "REGION_COORDINATE_MISMATCH"


def _variants(x: Column, y: Column) -> list[tuple[Column, Column, list[str]]]:
    """Longitude, latitude and issues, the likeliest first."""
    return [(x, y, []), (x, -y, [NEGATED_LATITUDE]), (-x, y, [NEGATED_LONGITUDE]), (-x, -y, [NEGATED_LATITUDE, NEGATED_LONGITUDE]), (y, x, [SWAPPED])]


def place_coordinates(df: DataFrame, polygons: DataFrame, region: str, lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                      issues: str = "issues", cell: float = 1.0) -> DataFrame:
    """``df`` with its coordinates as the region proves them; no row is dropped or repeated.

    ``polygons(region, ring)`` may hold several rings of a region, which are its parts. In this order the coordinates
    as they are, with the latitude turned, the longitude turned, both turned, and swapped are held against the
    stated region; the first that lies inside replaces them, and its codes are added to ``issues`` (array of text, made
    where there is none). If none does, they stay and REGION_COORDINATE_MISMATCH is added. Nothing is said of records without a
    region or coordinates, with a region that has no polygon, or with coordinates beyond 90 and 180 degrees.

    Distinct (region, place)s meet the polygons, so records of one place cost one test, and a region with a
    third of all records is spread over its cells."""
    ensure_checkpoint_dir(df.sparkSession)
    polygons = polygons.select(F.col(region).alias("_region"), "ring")
    x, y = F.col("_x"), F.col("_y")
    places = df.select(F.col(f"`{region}`").alias("_region"), F.col(f"`{lon}`").cast("double").alias("_x"), F.col(f"`{lat}`").cast("double").alias("_y")) \
        .where((F.abs(x) <= 180) & (F.abs(y) <= 90)).distinct()
    places = places.join(polygons.select("_region").distinct(), "_region", "left_semi").checkpoint()
    ways = F.array(*[F.struct(F.lit(k).alias("way"), a.alias("vx"), b.alias("vy")) for k, (a, b, _) in enumerate(_variants(x, y))])
    held = places.select("_region", "_x", "_y", F.explode(ways).alias("v")).select("_region", "_x", "_y", "v.*").where("abs(vy) <= 90")
    inside = points_in_polygons(held.select("_region", "vx", "vy").distinct(), polygons.withColumn("_part", F.monotonically_increasing_id()).checkpoint(),
                                ["_region", "_part"], x="vx", y="vy", cell=cell, match=["_region"])
    proven = held.join(inside.select("_region", "vx", "vy").distinct(), ["_region", "vx", "vy"]).groupBy("_region", "_x", "_y").agg(F.min("way").alias("_way"))
    judged = places.join(proven, ["_region", "_x", "_y"], "left").withColumn("_judged", F.lit(True))
    # names of df may be any, so its columns are put aside as one
    out = df.select(F.struct("*").alias("_row"), F.col(f"`{region}`").alias("_region"), F.col(f"`{lon}`").cast("double").alias("_x"),
                    F.col(f"`{lat}`").cast("double").alias("_y")).join(judged, ["_region", "_x", "_y"], "left")
    way, new_x, new_y = F.col("_way"), x, y
    said = F.when(F.col("_judged") & way.isNull(), F.array(F.lit(MISMATCH))).otherwise(F.array().cast("array<string>"))
    for k, (a, b, codes) in list(enumerate(_variants(x, y)))[1:]:
        new_x, new_y = F.when(way == k, a).otherwise(new_x), F.when(way == k, b).otherwise(new_y)
        said = F.when(way == k, F.array(*map(F.lit, codes))).otherwise(said)
    said = F.concat(F.coalesce(F.col(f"_row.`{issues}`"), F.array().cast("array<string>")), said) if issues in df.columns else said
    turned = F.coalesce(way, F.lit(0)) > 0
    value = {lon: F.when(turned, new_x).otherwise(F.col(f"_row.`{lon}`")), lat: F.when(turned, new_y).otherwise(F.col(f"_row.`{lat}`")), issues: said}
    columns = [*df.columns, *([] if issues in df.columns else [issues])]
    return out.select(*[value.get(c, F.col(f"_row.`{c}`")).alias(c) for c in columns])
