"""Record enrichment (I-class rows: our own definitions, from public
standards and literature — not parity with the reference, whose pipelines
are an external program).

F12 interpret, F13 build_index_record, A10 interpretation_metrics,
J9 assign_uuids, J10 lookup_vocabulary, J11 match_names, J12 restrict_sensitive,
J13 sample_layers, J14 cluster_records, J15 distribution_outliers,
J16 image_sync, J17 apply_annotations, W7 jackknife_outliers, J8 assemble_index.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florafold.functions.dates import degrees, event_interval
from florafold.operators.components import connected_components
from florafold.operators.geometry import haversine_km, nearest_edge_km, points_in_polygons, polygon_edges  # noqa: F401
from florafold.operators.joins import bounded_broadcast, exchanged
from florafold.operators.ranking import with_global_rank
from florafold.session import ensure_checkpoint_dir, written

# ---- our parameters (I-class) -------------------------------------------------
ISSUE_INVALID = "_INVALID"                 # suffix: present but unparseable
ISSUE_OUT_OF_RANGE = "COORDINATE_OUT_OF_RANGE"
ISSUE_ZERO = "ZERO_COORDINATE"
EARTH_RADIUS_KM = 6371.0
JACKKNIFE_MIN_N = 10                       # Chapman 2005 (recalled, unchecked)
JACKKNIFE_SLOPE, JACKKNIFE_OFFSET = 0.95, 0.2
_TILE_BITS = 5
_TILE = 1 << _TILE_BITS                    # cells along a side of a tile of the cluster grid
# ------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- F12 / F13 / A10

def interpret(df: DataFrame, rules: dict[str, tuple[str, str]], lat: str | None = None,
              lon: str | None = None, keep: list[str] = ()) -> DataFrame:
    """typed parse with issue flags; no row is dropped.

    ``rules``: output name → (source text column, type) with type one of
    'double', 'int', 'date' (yyyy-MM-dd), 'latitude' and 'longitude' (decimal degrees, or
    degrees, minutes and seconds) or 'interval' (a date, month, year or range: the first day, with
    the last day and the precision in <name>End and <name>Precision; '<NAME>_REVERSED' when
    it ends before it begins). Text is trimmed; empty = absent.
    Issues: '<NAME>_INVALID' when present but unparseable; with ``lat``/``lon``
    (output names) 'COORDINATE_OUT_OF_RANGE' (|lat| > 90 or |lon| > 180,
    value then nulled) and 'ZERO_COORDINATE' (both 0)."""
    texts, typed, issues = {}, {}, []
    for name, (src, typ) in rules.items():
        texts[name] = F.nullif(F.trim(F.col(src)), F.lit(""))
    # step 1: parse once (a separate projection, so each parse runs once per row)
    step1 = df.select(*[F.col(k) for k in keep],
                      *[t.alias(f"_t_{n}") for n, t in texts.items()],
                      *[_parse(t, rules[n][1]).alias(n) for n, t in texts.items()])
    for name, (_, typ) in rules.items():
        t, v = F.col(f"_t_{name}"), F.col(name)
        if typ == "interval":
            typed |= {name: v["start"], f"{name}End": v["end"], f"{name}Precision": v["precision"]}
            issues.append(F.concat(F.lit(name.upper()), F.regexp_extract(v["issue"], "_[A-Z]+$", 0)))
            continue
        typed[name] = v
        issues.append(F.when(t.isNotNull() & v.isNull(), F.lit(name.upper() + ISSUE_INVALID)))
    if lat and lon:
        la, lo = typed[lat], typed[lon]
        bad = (F.abs(la) > 90) | (F.abs(lo) > 180)
        issues.append(F.when(bad, F.lit(ISSUE_OUT_OF_RANGE)))
        issues.append(F.when((la == 0) & (lo == 0), F.lit(ISSUE_ZERO)))
        typed[lat] = F.when(~F.coalesce(bad, F.lit(False)), la)
        typed[lon] = F.when(~F.coalesce(bad, F.lit(False)), lo)
    return step1.select(*[F.col(k) for k in keep], *[v.alias(n) for n, v in typed.items()],
                        drop_nulls(F.array(*issues)).alias("issues"))


def _parse(t: Column, typ: str) -> Column:
    if typ == "date":
        return F.to_date(F.try_to_timestamp(t, F.lit("yyyy-MM-dd")))
    if typ in ("latitude", "longitude"):
        return degrees(t, 90 if typ == "latitude" else 180)
    if typ == "interval":
        return event_interval(t)
    return t.try_cast(typ)


def drop_nulls(arr: Column) -> Column:
    """Remove null elements (code-generated; no lambda). Duplicates collapse too."""
    return F.array_except(arr, F.array(F.lit(None).cast("string")))


_MAP_OF_TYPE = [("strings", (T.StringType,)), ("doubles", (T.DoubleType, T.FloatType, T.DecimalType)),
                ("ints", (T.IntegerType, T.ShortType, T.ByteType)), ("longs", (T.LongType,)),
                ("booleans", (T.BooleanType,)), ("dates", (T.DateType, T.TimestampType, T.TimestampNTZType))]


def build_index_record(df: DataFrame, id_col: str = "id", keep: list[str] = ()) -> DataFrame:
    """typed columns → the index record's typed maps (inverse of flattening).
    Dates and timestamps become epoch milliseconds; arrays go to
    ``multiValues``; decimals to ``doubles``; structs and maps become JSON text
    and binaries base64 text in ``strings``. Columns named ``sensitive_*`` (the
    originals of restricted values) go to ``strings`` whatever their type (arrays as JSON
    text), where flattening drops them. Null values are left out of the maps, so a column of
    type void has no entries. Types without a map (intervals) raise. Columns of ``keep`` also stand beside the maps."""
    maps = {}
    for f in df.schema.fields:
        if f.name == id_col:
            continue
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.MapType)):
            maps.setdefault("strings", []).append((f.name, F.to_json(col)))
            continue
        if isinstance(f.dataType, T.BinaryType):
            maps.setdefault("strings", []).append((f.name, F.base64(col)))
            continue
        if isinstance(f.dataType, T.NullType):
            continue  # holds no value
        if f.name.startswith("sensitive_"):
            text = F.to_json(col) if isinstance(f.dataType, T.ArrayType) else col.cast("string")
            maps.setdefault("strings", []).append((f.name, text))
            continue
        for mname, types in _MAP_OF_TYPE:
            if isinstance(f.dataType, types):
                v = col.cast("double") if isinstance(f.dataType, T.DecimalType) else col
                if mname == "dates":
                    v = F.unix_millis(v.cast("timestamp"))
                maps.setdefault(mname, []).append((f.name, v))
                break
        else:
            if isinstance(f.dataType, T.ArrayType):
                maps.setdefault("multiValues", []).append((f.name, F.col(f"`{f.name}`").cast("array<string>")))
            elif isinstance(f.dataType, T.StringType):  # char and varchar
                maps.setdefault("strings", []).append((f.name, col))
            else:
                raise TypeError(f"column {f.name!r}: no map of an index record holds {f.dataType.simpleString()}")
    out = [F.col(id_col).cast("string").alias("id")]
    for mname in ["strings", "doubles", "ints", "longs", "booleans", "dates", "multiValues"]:
        entries = maps.get(mname)
        if not entries:
            continue
        # a filter over the whole map: one branch per column made a generated method too long for the JVM to compile
        m = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in entries]), F.array(*[v for _, v in entries]))
        out.append(F.map_filter(m, lambda _, v: v.isNotNull()).alias(mname))
    return df.select(*out, *[F.col(f"`{c}`") for c in keep])


def interpretation_metrics(df: DataFrame, dataset_col: str = "dataset_id", fields: list[str] = (),
                           issue_codes: list[str] = ()) -> DataFrame:
    """A10: per dataset: records, parsed values per field, and records per issue code."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("records")]
    aggs += [F.count(F.col(f)).cast("bigint").alias(f"parsed_{f}") for f in fields]
    aggs += [F.count(F.when(F.array_contains("issues", code), 1)).cast("bigint").alias(f"issue_{code}")
             for code in issue_codes]
    return df.groupBy(dataset_col).agg(*aggs)


# ---------------------------------------------------------------- J9

def uuid_from_key(key: Column) -> Column:
    """Name-based id: md5 of the key, laid out as a UUID (8-4-4-4-12)."""
    return F.coalesce(F.regexp_replace(F.md5(key), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(""))


def unique_key(*terms: Column) -> Column:
    """The terms, each after its length, joined by '|': no two lists of terms
    give the same key, whatever characters they hold. Null counts as empty."""
    text = [F.coalesce(t.cast("string"), F.lit("")) for t in terms]
    return F.concat_ws("|", *[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in text])


def assign_uuids(records: DataFrame, existing: DataFrame, keys: list[str],
                 dataset_col: str = "dataset_id") -> DataFrame:
    """Unique key = dataset + key terms (:func:`unique_key`); a key already in
    ``existing(unique_key, uuid)`` keeps its id, a new one gets the
    name-based id (reruns agree). Adds unique_key, uuid, is_new."""
    r = records.withColumn("unique_key", unique_key(F.col(dataset_col), *[F.col(k) for k in keys]))
    # one id per key, deterministic even if the existing table repeats a key
    ex = existing.groupBy("unique_key").agg(F.min("uuid").alias("_known"))
    j = r.join(ex, "unique_key", "left")
    return (j.withColumn("is_new", F.col("_known").isNull())
            .withColumn("uuid", F.coalesce(F.col("_known"), uuid_from_key(F.col("unique_key")))).drop("_known"))


def uuid_check(assigned: DataFrame, existing: DataFrame, max_new_pct: float, override: bool = False) -> DataFrame:
    """J9 guard: FAIL when new ids exceed ``max_new_pct`` percent of all
    records while ids existed before (``existing`` has rows), unless overridden."""
    known = not existing.isEmpty()
    a = assigned.agg(F.count(F.lit(1)).cast("bigint").alias("n_total"),
                     F.count(F.when(F.col("is_new"), 1)).cast("bigint").alias("n_new"))
    too_many = (F.col("n_new") * 100 > F.lit(max_new_pct) * F.col("n_total")) & F.lit(known)
    return a.select("n_total", "n_new",
                    F.when(too_many & F.lit(not override), F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"))


# ---------------------------------------------------------------- J10 / J11

def _norm(c: Column) -> Column:
    return F.lower(F.trim(c))


def lookup_vocabulary(df: DataFrame, vocab: DataFrame, field: str, out: str | None = None,
                      label_col: str = "label", value_col: str = "canonical") -> DataFrame:
    """Normalise ``field`` through a label list (exact match on
    lower-cased, trimmed text). Adds ``<out>`` (null when unmatched)."""
    out = out or f"{field}_norm"
    v = vocab.groupBy(_norm(F.col(label_col)).alias("_lbl")).agg(F.min(F.col(value_col)).alias(out))
    return df.join(bounded_broadcast(v), _norm(F.col(field)) == F.col("_lbl"), "left").drop("_lbl")


def match_names(df: DataFrame, taxa: DataFrame, name_col: str = "scientificName") -> DataFrame:
    """Exact match of the normalised name to a species/any-rank name,
    else match of its first word (genus) to a genus name. Adds taxon_id,
    match_type ('exact' | 'genus' | 'none')."""
    t = taxa.select(_norm(F.col("name")).alias("_n"), F.col("rank"), F.col("taxon_id"))
    exact = t.groupBy(F.col("_n").alias("_e")).agg(F.min("taxon_id").alias("_te"))
    genus = t.filter(F.col("rank") == "genus").groupBy(F.col("_n").alias("_g")).agg(F.min("taxon_id").alias("_tg"))
    # written and weighed first: planned by their estimates, few names would still have all records exchanged
    exact, genus = (bounded_broadcast(written(side, "taxa")) for side in (exact, genus))
    n = _norm(F.col(name_col))
    g = F.element_at(F.split(n, r"\s+"), 1)
    j = df.withColumn("_nn", n).withColumn("_gg", g) \
        .join(exact, F.col("_nn") == F.col("_e"), "left") \
        .join(genus, F.col("_gg") == F.col("_g"), "left")
    return (j.withColumn("taxon_id", F.coalesce(F.col("_te"), F.col("_tg")))
            .withColumn("match_type", F.when(F.col("_te").isNotNull(), F.lit("exact"))
                        .when(F.col("_tg").isNotNull(), F.lit("genus")).otherwise(F.lit("none")))
            .drop("_nn", "_gg", "_e", "_te", "_g", "_tg"))


# ---------------------------------------------------------------- J12

def restrict_sensitive(df: DataFrame, rules: DataFrame, taxon_col: str = "scientificName",
                       zone_col: str = "zone", lat: str = "decimalLatitude",
                       lon: str = "decimalLongitude") -> DataFrame:
    """Rules (taxon, zone nullable, action 'withhold' | 'generalise', k).
    A zone rule beats a zone-less rule. Originals go to sensitive_<col>; the
    public value is null (withhold) or the grid corner floor(x·10^k)/10^k
    (generalise); ``sensitive`` holds the action."""
    r = rules.select(_norm(F.col("taxon")).alias("_t"), F.col("zone").alias("_z"), "action", "k")
    # one rule per (taxon, zone): the most restrictive (withhold, else the coarsest grid)
    strict = [F.when(F.max((F.col("action") == "withhold").cast("int")) == 1, F.lit("withhold"))
              .otherwise(F.lit("generalise")).alias("_a"), F.min("k").alias("_k")]
    zoned = r.filter(F.col("_z").isNotNull()).groupBy("_t", "_z").agg(*strict) \
        .select(F.col("_t").alias("_tz"), "_z", F.col("_a").alias("_az"), F.col("_k").alias("_kz"))
    anyz = r.filter(F.col("_z").isNull()).groupBy("_t").agg(*strict) \
        .select(F.col("_t").alias("_ta"), F.col("_a").alias("_aa"), F.col("_k").alias("_ka"))
    t = _norm(F.col(taxon_col))
    j = df.withColumn("_tn", t) \
        .join(bounded_broadcast(zoned), (F.col("_tn") == F.col("_tz")) & (F.col(zone_col) == F.col("_z")), "left") \
        .join(bounded_broadcast(anyz), F.col("_tn") == F.col("_ta"), "left")
    action = F.coalesce(F.col("_az"), F.col("_aa"))
    k = F.coalesce(F.col("_kz"), F.col("_ka"))
    scale = F.pow(F.lit(10.0), k.cast("double"))

    def public(c):
        return (F.when(action == "withhold", F.lit(None).cast("double"))
                .when(action == "generalise", F.floor(F.col(c) * scale) / scale)
                .otherwise(F.col(c)))

    return (j.withColumn("sensitive", action)
            .withColumn(f"sensitive_{lat}", F.when(action.isNotNull(), F.col(lat)))
            .withColumn(f"sensitive_{lon}", F.when(action.isNotNull(), F.col(lon)))
            .withColumn(lat, public(lat)).withColumn(lon, public(lon))
            .drop("_tn", "_tz", "_z", "_az", "_kz", "_ta", "_aa", "_ka"))


# ---------------------------------------------------------------- J13 / J15 geometry

def sample_layers(df: DataFrame, layers: DataFrame, lat: str = "decimalLatitude",
                  lon: str = "decimalLongitude", cell: float = 1.0, max_layers: int = 10000,
                  places: DataFrame | None = None) -> DataFrame:
    """Attach, per layer, the region containing each record's point.

    ``layers(layer_id, region_id, ring)``. ``places`` may hold the records' coordinates
    where that is cheaper to read than ``df``. Distinct coordinates are sampled
    once; a point inside several regions of a layer takes the least region
    id. Output: the records plus one column per layer id."""
    pts = (df if places is None else places).select(F.col(lon).alias("x"), F.col(lat).alias("y")).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull()).distinct()
    inside = points_in_polygons(pts, layers, ["layer_id", "region_id"], cell=cell)
    per_point = inside.groupBy("x", "y", "layer_id").agg(F.min("region_id").alias("region_id"))
    # layer names become columns: bounded by the layer table, enforced before collecting
    names = layers.select("layer_id").distinct().limit(max_layers + 1).collect()
    if len(names) > max_layers:
        raise ValueError(f"more than {max_layers} layers")
    layer_ids = sorted(r[0] for r in names)
    wide = per_point.groupBy("x", "y").pivot("layer_id", layer_ids).agg(F.first("region_id"))
    wide = bounded_broadcast(written(wide, "regions"))  # few different coordinates go to the records
    return df.join(wide, (df[lon] == wide["x"]) & (df[lat] == wide["y"]), "left").drop("x", "y")


def sample_grids(df: DataFrame, grids: DataFrame, res: float, lat: str = "decimalLatitude",
                 lon: str = "decimalLongitude", layer_ids: list[str] | None = None) -> DataFrame:
    """J13, continuous layers: ``grids(layer_id, cy, cx, value)`` hold a value per
    cell of ``res`` degrees; each record takes its cell's value (null without
    one, the least of repeated cells). Output: the records plus one column per
    layer id (found in the grids when not given)."""
    if layer_ids is None:
        layer_ids = sorted(r[0] for r in grids.select("layer_id").distinct().collect())
    wide = grids.groupBy(F.col("cy").cast("bigint").alias("_cy"), F.col("cx").cast("bigint").alias("_cx")) \
        .pivot("layer_id", layer_ids).agg(F.min("value"))
    placed = df.withColumn("_cy", F.floor(F.col(lat) / res).cast("bigint")) \
        .withColumn("_cx", F.floor(F.col(lon) / res).cast("bigint"))
    return placed.join(wide, ["_cy", "_cx"], "left").drop("_cy", "_cx")


def distribution_outliers(df: DataFrame, ranges: DataFrame, cache: DataFrame | None = None,
                          id_col: str = "id", taxon_col: str = "taxon", lat: str = "decimalLatitude",
                          lon: str = "decimalLongitude", cell: float = 1.0) -> DataFrame:
    """Distance (km) of a record outside its taxon's expert range.

    0 inside the range polygon; outside, the least great-circle distance to the
    range's edges (arcs between its vertices). Records without a range get null. Ids in ``cache(id, distance)`` reuse
    the cached value; only the others are computed.
    Output: id, distance, cached."""
    todo = df.select(F.col(id_col).alias("id"), F.col(taxon_col).alias("taxon"),
                     F.col(lon).alias("x"), F.col(lat).alias("y"))
    if cache is not None:
        # both written, the records with whether their id is cached: they are made once, not for each of points, distances and cached ids
        cache = written(cache.select("id", "distance"), "cache")
        known = cache.select("id").distinct().withColumn("_cached", F.lit(True))
        records = written(todo.join(known, "id", "left"), "records")
        todo, reused = records.where("_cached is null").drop("_cached"), records.where("_cached").select("id")
    ensure_checkpoint_dir(df.sparkSession)
    # distinct points, written once: both the inside test and the distances read them
    pts = todo.select("taxon", "x", "y").filter(F.col("x").isNotNull() & F.col("y").isNotNull()) \
        .distinct().checkpoint()
    inside = points_in_polygons(pts, ranges.select("taxon", "ring"), ["taxon"], cell=cell, match=["taxon"]).distinct().checkpoint()
    # distances only for points outside their range (most are inside)
    outside = pts.join(inside, ["taxon", "x", "y"], "left_anti")
    dist = nearest_edge_km(outside, polygon_edges(ranges, ["taxon"])).unionByName(inside.withColumn("distance", F.lit(0.0)))
    out = todo.join(dist, ["taxon", "x", "y"], "left").select("id", "distance", F.lit(False).alias("cached"))
    if cache is not None:
        kept = cache.join(reused, "id", "left_semi") \
            .select("id", F.col("distance").cast("double"), F.lit(True).alias("cached"))
        out = out.unionByName(kept)
    return out


# ---------------------------------------------------------------- J14

def cluster_records(df: DataFrame, id_col: str = "id", dataset_col: str = "dataset_id",
                    taxon_col: str = "scientificName", date_col: str = "eventDate",
                    lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                    ident_col: str | None = "catalogNumber", cell: float = 0.01) -> DataFrame:
    """Records that likely describe the same event, as clusters.

    Block 'location': same taxon, date and ``cell``-degree grid cell. Block
    'identifier': same identifier value. A block is a duplicate cluster when
    its records come from at least two datasets. Instead of emitting every
    pair inside a block, each record gets its block's cluster: representative
    (least id), size and dataset count. Output: id, reason, cluster_id,
    cluster_size, n_datasets (one row per record and reason)."""
    base = df.select(F.col(id_col).cast("string").alias("id"), F.col(dataset_col).alias("_ds"),
                     F.col(taxon_col).alias("_t"), F.col(date_col).cast("string").alias("_d"),
                     F.floor(F.col(lat) / cell).alias("_cy"), F.floor(F.col(lon) / cell).alias("_cx"),
                     (F.col(ident_col).cast("string") if ident_col else F.lit(None).cast("string")).alias("_i"))
    loc_key = F.concat_ws("|", F.col("_t"), F.col("_d"), F.col("_cy").cast("string"), F.col("_cx").cast("string"))
    blocks = [("location", loc_key, F.col("_t").isNotNull() & F.col("_d").isNotNull() & F.col("_cy").isNotNull()
               & F.col("_cx").isNotNull())]
    if ident_col:
        blocks.append(("identifier", F.col("_i"), F.col("_i").isNotNull()))
    # a record's blocks side by side, so that one pass and one join serve both reasons
    found = F.array(*[F.when(ok, F.struct(F.lit(reason).alias("reason"), key.alias("_k"))) for reason, key, ok in blocks])
    b = base.select("id", "_ds", F.explode(found).alias("_b")).where("_b is not null").select("id", "_ds", "_b.*")
    # blocks of one record are most: only hashes of blocks are exchanged to leave them out; equal hashes of two blocks leave out nothing
    b = b.withColumn("_h", F.xxhash64("reason", "_k"))
    shared = written(b.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h"), "shared")
    b = b.join(bounded_broadcast(shared), "_h", "left_semi").drop("_h")
    stats = b.groupBy("reason", "_k").agg(F.min("id").alias("cluster_id"), F.count(F.lit(1)).cast("bigint").alias("cluster_size"),
                                          F.countDistinct("_ds").cast("bigint").alias("n_datasets"))
    stats = bounded_broadcast(written(stats.filter(F.col("n_datasets") >= 2), "clusters"))
    return b.drop("_ds").join(stats, ["reason", "_k"]) \
        .select("id", "reason", "cluster_id", "cluster_size", "n_datasets")


# ---------------------------------------------------------------- W7

def jackknife_outliers(df: DataFrame, group_col: str, value_col: str, id_col: str | None = None,
                       min_n: int = JACKKNIFE_MIN_N, hot_rows: int = 100_000) -> DataFrame:
    """Reverse-jackknife outliers of ``value`` per group.

    Over a group's distinct values x (sorted), mean m and sample stddev s:
    for x ≥ m, y = (x − previous) · (x − m); for x < m, y = (next − x) · (m − x);
    C = y / s; an outlier when n ≥ ``min_n`` and C > 0.95·√n + 0.2.
    Groups of at most ``hot_rows`` rows are windows. For larger ones neighbours come from a
    distributed rank over (group, x) and equi-joins on rank ± 1, group statistics from an
    aggregate, so a huge group is never one task. Output: group, value, n, is_outlier
    (per distinct value; join back on (group, value) for records)."""
    d = df.select(F.col(group_col).alias("g"), F.col(value_col).cast("double").alias("x")) \
        .filter(F.col("g").isNotNull() & F.col("x").isNotNull())
    hot = written(d.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows).select("g"), "hot")
    group, beside = Window.partitionBy("g"), Window.partitionBy("g").orderBy("x")
    j = d.join(bounded_broadcast(hot), "g", "left_anti").distinct().select(
        "g", "x", F.count(F.lit(1)).over(group).alias("n"), F.avg("x").over(group).alias("m"), F.stddev("x").over(group).alias("s"),
        F.lag("x").over(beside).alias("px"), F.lead("x").over(beside).alias("nx"))
    if not hot.isEmpty():
        j = j.unionByName(_ranked_neighbours(d.join(bounded_broadcast(hot), "g", "left_semi").distinct()))
    px, nx = F.col("px"), F.col("nx")
    y = F.when(F.col("x") >= F.col("m"), (F.col("x") - px) * (F.col("x") - F.col("m"))) \
        .otherwise((nx - F.col("x")) * (F.col("m") - F.col("x")))
    c = y / F.col("s")
    thr = F.lit(JACKKNIFE_SLOPE) * F.sqrt(F.col("n").cast("double")) + F.lit(JACKKNIFE_OFFSET)
    out = F.coalesce((F.col("n") >= min_n) & (F.col("s") > 0) & (c > thr), F.lit(False))
    return j.select(F.col("g").alias(group_col), F.col("x").alias(value_col),
                    F.col("n").cast("bigint").alias("n"), out.alias("is_outlier"))


def _ranked_neighbours(d: DataFrame) -> DataFrame:
    """Distinct ``d(g, x)`` with n, m and s of the group, and px and nx, the values beside x in it, whatever the group's size."""
    stats = d.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.stddev("x").alias("s"))
    ensure_checkpoint_dir(d.sparkSession)
    # ranked once and written: the rank feeds three joins (row, previous, next)
    r = with_global_rank(d, [F.col("g").asc(), F.col("x").asc()], "rk").checkpoint()
    prev = r.select(F.col("g").alias("pg"), F.col("x").alias("px"), (F.col("rk") + 1).alias("rk"))
    nxt = r.select(F.col("g").alias("ng"), F.col("x").alias("nx"), (F.col("rk") - 1).alias("rk"))
    j = r.join(prev, "rk", "left").join(nxt, "rk", "left").join(stats, "g")
    return j.select("g", "x", "n", "m", "s", F.when(F.col("pg") == F.col("g"), F.col("px")).alias("px"),
                    F.when(F.col("ng") == F.col("g"), F.col("nx")).alias("nx"))


# ---------------------------------------------------------------- J16 / J17 / J8

def image_sync(multimedia: DataFrame, images: DataFrame, url_col: str = "identifier") -> DataFrame:
    """Attach the stored image id to each multimedia row by identifier URL."""
    im = bounded_broadcast(written(images.groupBy(F.col(url_col).alias("_u")).agg(F.min("image_id").alias("image_id")), "images"))
    return multimedia.join(im, multimedia[url_col] == im["_u"], "left").drop("_u")


def apply_annotations(index: DataFrame, annotations: DataFrame, id_col: str = "id") -> DataFrame:
    """Attach each record's annotation labels (sorted, distinct).

    Per record the list holds distinct labels, so its length is bounded by
    the label vocabulary, not by how many times a record was annotated.
    Records without annotations get an empty list."""
    if annotations.isEmpty():  # the records need not be exchanged
        return index.withColumn("annotations_applied", F.array().cast("array<string>"))
    per = annotations.select(F.col(id_col).cast("string").alias("_aid"), F.col("annotation")).distinct() \
        .groupBy("_aid").agg(F.array_sort(F.collect_list("annotation")).alias("annotations_applied"))
    j = index.join(per, F.col(id_col).cast("string") == F.col("_aid"), "left").drop("_aid")
    return j.withColumn("annotations_applied", F.coalesce(F.col("annotations_applied"), F.array().cast("array<string>")))


def assemble_index(index: DataFrame, sides: dict[str, DataFrame], flags: dict[str, bool] | None = None,
                   id_col: str = "id") -> DataFrame:
    """Left-join each enabled side table (keyed by ``id``) onto the index.
    One row per index record: every side must be unique per id."""
    flags = flags or {}
    out = index
    for name, side in sides.items():
        if flags.get(name, True):
            out = out.join(side, id_col, "left")
    return out


def connected_blocks(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Connected components of a graph given as ``nodes(node)`` and
    ``edges(a, b)``: every node gets the least node id of its component, in a
    number of rounds that grows with the logarithm of the longest chain."""
    ensure_checkpoint_dir(nodes.sparkSession)
    parts = connected_components(edges, "a", "b").withColumnRenamed("component", "label")
    return nodes.select("node").join(exchanged(parts), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"))


def _tile_parts(cells: DataFrame) -> DataFrame:
    """Distinct ``cells(_t, _d, _cy, _cx)`` with (_ry, _rx), the first cell of the part each belongs to:
    cells of one tile that hang together (3×3) within it.

    Tiles hold at most ``_TILE``² cells and come whole, one after the other; each batch links the cells of all its
    tiles at once, so many tiles of one cell cost no more than a full one."""
    tile = ["_t", "_d", "_ty", "_tx"]
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cells.withColumn("_ty", F.shiftright("_cy", _TILE_BITS)).withColumn("_tx", F.shiftright("_cx", _TILE_BITS)) \
        .repartition(n, *tile).sortWithinPartitions(*tile)
    schema = placed.select("_t", "_d", "_cy", "_cx", F.col("_cy").alias("_ry"), F.col("_cx").alias("_rx")).schema

    def link(batches):
        import numpy as np
        import pandas as pd

        def parts(pdf):
            y, x = pdf["_cy"].to_numpy(), pdf["_cx"].to_numpy()
            side = _TILE + 2  # an empty rim keeps the cells of two tiles apart
            spot = pdf.groupby(tile, sort=False).ngroup().to_numpy().astype(np.int64) * (side * side) \
                + (y % _TILE + 1) * side + x % _TILE + 1
            order = np.argsort(spot)
            y, x, spot = y[order], x[order], spot[order]
            a, b = [], []
            for step in (1, side - 1, side, side + 1):
                at = np.minimum(np.searchsorted(spot, spot + step), len(spot) - 1)
                hit = np.flatnonzero(spot[at] == spot + step)
                a.append(hit)
                b.append(at[hit])
            a, b = np.concatenate(a), np.concatenate(b)
            root = np.arange(len(spot))
            while True:  # the larger root of a link hangs under the smaller one, then all point to their roots
                ra, rb = root[a], root[b]
                apart = ra != rb
                if not apart.any():
                    break
                a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
                np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
                while (root[root] != root).any():
                    root = root[root]
            pdf = pdf[["_t", "_d"]].iloc[order]
            return pdf.assign(_cy=y, _cx=x, _ry=y[root], _rx=x[root])

        rest = None
        for pdf in batches:
            pdf = pd.concat([rest, pdf], ignore_index=True) if rest is not None and len(rest) else pdf
            if not len(pdf):
                continue
            last = (pdf[tile] == pdf[tile].iloc[-1]).all(axis=1).to_numpy()
            rest = pdf[last]
            if not last.all():
                yield parts(pdf[~last])
        if rest is not None and len(rest):
            yield parts(rest)

    return placed.mapInPandas(link, schema)


def cluster_records_near(df: DataFrame, id_col: str = "id", dataset_col: str = "dataset_id",
                         taxon_col: str = "scientificName", date_col: str = "eventDate",
                         lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                         cell: float = 0.01) -> DataFrame:
    """J14 with neighbouring cells: blocks of the same taxon and date whose
    grid cells touch (3×3) are linked, and the linked blocks form one
    cluster (single linkage). Each block links to at most its 8 neighbour
    cells, so no pairs of records are formed; blocks are linked inside tiles of the grid
    first, so that only the parts of tiles that touch across a tile's edge form a graph. A cluster is reported when its
    records come from at least two datasets. Output: id, reason
    ('location_near'), cluster_id (least id), cluster_size, n_datasets."""
    base = df.select(F.col(id_col).cast("string").alias("id"), F.col(dataset_col).alias("_ds"),
                     F.col(taxon_col).alias("_t"), F.col(date_col).cast("string").alias("_d"),
                     F.floor(F.col(lat) / cell).cast("bigint").alias("_cy"),
                     F.floor(F.col(lon) / cell).cast("bigint").alias("_cx")) \
        .filter(F.col("_t").isNotNull() & F.col("_d").isNotNull() & F.col("_cy").isNotNull()
                & F.col("_cx").isNotNull())
    at = ["_t", "_d", "_cy", "_cx"]
    ensure_checkpoint_dir(df.sparkSession)
    # one row per block, written once: links and records read it
    blocks = written(_tile_parts(base.select(*at).distinct()), "blocks")
    edge = lambda c: F.pmod(F.col(c), F.lit(_TILE)).isin(0, _TILE - 1)
    rim = blocks.where(edge("_cy") | edge("_cx"))
    tile = lambda c: F.shiftright(c, _TILE_BITS)
    steps = F.array(*[F.struct((F.col("_cy") + dy).alias("y"), (F.col("_cx") + dx).alias("x"))
                      for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy, dx) > (0, 0)])
    over = rim.select("_t", "_d", tile("_cy").alias("_ty"), tile("_cx").alias("_tx"), "_ry", "_rx", F.explode(steps).alias("_n")) \
        .where((tile("_n.y") != F.col("_ty")) | (tile("_n.x") != F.col("_tx"))) \
        .select("_t", "_d", "_ry", "_rx", F.col("_n.y").alias("_cy"), F.col("_n.x").alias("_cx"))
    key = lambda y, x: unique_key(F.col("_t"), F.col("_d"), F.col(y), F.col(x))
    edges = over.join(exchanged(rim.select(*at, F.col("_ry").alias("_sy"), F.col("_rx").alias("_sx"))), at) \
        .select(key("_ry", "_rx").alias("a"), key("_sy", "_sx").alias("b"))
    comp = connected_blocks(edges, blocks.select(key("_ry", "_rx").alias("node")).distinct())
    labels = blocks.withColumn("node", key("_ry", "_rx")).join(exchanged(comp), "node").select(*at, "label")
    rec = base.join(exchanged(labels), at).select("id", "_ds", "label")
    stats = rec.groupBy("label").agg(F.min("id").alias("cluster_id"),
                                     F.count(F.lit(1)).cast("bigint").alias("cluster_size"),
                                     F.countDistinct("_ds").cast("bigint").alias("n_datasets"))
    return rec.join(stats.filter(F.col("n_datasets") >= 2), "label").select(
        "id", F.lit("location_near").alias("reason"), "cluster_id", "cluster_size", "n_datasets")
