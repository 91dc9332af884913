"""Download export: predicate filter, archive files, manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from florafold.functions.predicate import predicate_filter
from florafold.functions.scalar import licence
from florafold.operators.joins import hot_keys, split_by_hot_key
from florafold.session import written
from florafold.sources.sinks import export_archive

# ---- fixed values that must equal the reference's ----------------------------
UNTITLED_DATASET = "Untitled dataset"
MIB = 1048576
# ------------------------------------------------------------------------------


def size_mb_label(nbytes) -> F.Column:
    """F8 with exact rounding of bytes / 2^20 to 2 decimals (half to even on
    the exact value, as Python's ``round`` does on a float), then 'MB', or
    'GB' (MiB / 1024 rounded to 2) above 1024 MiB."""
    b = (F.col(nbytes) if isinstance(nbytes, str) else nbytes).cast("bigint")
    num = b * 100
    q = F.floor(num / MIB)
    r = num - q * MIB
    half = MIB // 2
    up = (r > half) | ((r == half) & (F.pmod(q, F.lit(2)) == 1))
    cents = q + F.when(up, 1).otherwise(0)
    mb = cents.cast("double") / 100.0
    gb = F.bround(mb / 1024.0, 2)
    return F.when(mb > 1024, F.concat(gb.cast("string"), F.lit("GB"))).otherwise(
        F.concat(mb.cast("string"), F.lit("MB")))


def export_manifest(registry: DataFrame, archives: DataFrame, request_id: str) -> DataFrame:
    """Per requested dataset: name ('Untitled dataset' when unknown),
    licence (rights, else licence type, else ''), size label, archive path."""
    a = archives.select("dataset_id", "size")
    r = registry.select(F.col("uid").alias("dataset_id"), "name", "rights", "licenseType")
    j = a.join(r, "dataset_id", "left")
    return j.select(
        "dataset_id",
        F.coalesce(F.col("name"), F.lit(UNTITLED_DATASET)).alias("name"),
        licence(F.col("rights"), F.col("licenseType")).alias("licence"),
        size_mb_label("size").alias("size_label"),
        F.concat(F.lit(f"exports/{request_id}/"), F.col("dataset_id"), F.lit(".zip")).alias("archive"))


def export_download(core: DataFrame, predicate, extensions: dict[str, DataFrame], dest: str,
                    core_id: str, dataset_col: str = "dataset_id", registry: DataFrame | None = None,
                    request_id: str | None = None) -> DataFrame:
    """Filter the core by the predicate, keep extension rows of the kept
    core records, write the archive. Returns the descriptor.

    An extension with a dataset column is kept by a semi-join on id and dataset; one without
    gets the dataset of its core record, once for each dataset that has the id. With ``registry`` the
    manifest (A11) of the written files, a row per dataset, goes to ``dest/manifest`` as JSON."""
    kept = predicate_filter(core, predicate)
    ids = kept.select(core_id, dataset_col).distinct()
    ext = {name: e.join(ids, [core_id, dataset_col], "left_semi") if dataset_col in e.columns else e.join(ids, core_id)
           for name, e in extensions.items()}
    desc = export_archive(kept, ext, dest, dataset_col)
    if registry is not None:
        from florafold.sources.catalog import object_inventory
        files = object_inventory(core.sparkSession, dest).withColumn(
            "dataset_id", F.regexp_extract("key", dataset_col + "=([^/]+)/", 1)).where("dataset_id <> ''")
        sizes = files.groupBy("dataset_id").agg(F.sum("size").cast("bigint").alias("size"))
        export_manifest(registry, sizes, request_id or "").write.mode("overwrite").json(f"{dest.rstrip('/')}/manifest")
    return desc


def event_documents(events: DataFrame, occurrences: DataFrame, event_id: str = "eventID",
                    occurrence_id: str = "id") -> DataFrame:
    """JSON documents for an event index: one parent document per event
    and one child document per occurrence pointing at its event
    (parent/child layout). Every output row is one record, so an event with
    millions of occurrences never becomes one value. Output: doc_id,
    parent_id, kind, document."""
    ev = events.select(F.col(event_id).cast("string").alias("doc_id"),
                       F.lit(None).cast("string").alias("parent_id"), F.lit("event").alias("kind"),
                       F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("document"))
    occ = occurrences.join(events.select(event_id), event_id, "left_semi")
    oc = occ.select(F.col(occurrence_id).cast("string").alias("doc_id"),
                    F.col(event_id).cast("string").alias("parent_id"), F.lit("occurrence").alias("kind"),
                    F.to_json(F.struct(*[F.col(c) for c in occurrences.columns])).alias("document"))
    return ev.unionByName(oc)


def nested_documents(parents: DataFrame, children: DataFrame, key: str, order: list[str], child_name: str = "occurrences",
                     max_bytes: int = 1 << 20, hot_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """One JSON document per parent, holding its children.

    Returns (documents, unplaced). Documents: the key, piece (from 0), n_pieces,
    n_children and document, a JSON object of the parent's fields, the piece's number and the
    array ``child_name`` of its children (without the key) in the order given. A parent's
    children go into as many pieces as their bytes ask for: the piece ends with the child
    that reaches ``max_bytes``. Children are written once and meet their parents in one exchange by key;
    the pieces of a key with more than ``hot_rows`` children follow from running sums over range partitions,
    carried over partition ends, so that a parent with a third of all children is never one group.

    A parent without children has one piece with an empty array; a repeated
    key gives each of its parents all pieces. ``unplaced``: the children whose
    key is null or names no parent. ``order`` should tell a parent's children apart;
    equal ones come in the order of their whole JSON."""
    children = written(children, "children")
    hot = hot_keys(children, key, hot_rows)
    options = {"ignoreNullFields": "false"}

    def documents(heads: DataFrame, bodies: DataFrame, at: list[str]) -> DataFrame:
        docs = heads.join(bodies, at, "left")
        kids = F.coalesce(F.transform("_c", lambda c: c["_child"]), F.array().cast(bodies.select(F.transform("_c", lambda c: c["_child"]).alias("x")).schema["x"].dataType))
        docs = docs.select(F.col(key), F.coalesce("_no", F.lit(0)).cast("int").alias("piece"), F.coalesce("n_pieces", F.lit(1)).alias("n_pieces"),
                           F.size(kids).alias("n_children"), "_parent", kids.alias("_kids"))
        document = F.to_json(F.struct("_parent.*", "piece", F.col("_kids").alias(child_name)), options)
        return docs.select(key, "piece", "n_pieces", "n_children", document.alias("document"))

    heads, rare = parents.select(F.col(key), F.struct(*parents.columns).alias("_parent")), children.where(F.col(key).isNotNull())
    if hot is None:
        docs = documents(heads, _pieces(rare, key, order, max_bytes, options), [key])
    else:
        docs = documents(heads.join(hot, key, "left_anti"), _pieces(rare.join(hot, key, "left_anti"), key, order, max_bytes, options), [key])
        heads = heads.join(hot, key, "left_semi")
        named = F.broadcast(heads.select(key).distinct())  # hot keys alone
        bodies = _ranked_pieces(rare.join(hot, key, "left_semi").join(named, key, "left_semi"), key, order, max_bytes, options)
        # parents meet the narrow list of pieces; bodies come by (key, piece), which spreads a large parent
        heads = heads.join(bodies.select(key, "piece", "_no", "n_pieces"), key, "left")
        docs = docs.unionByName(documents(heads, bodies.drop("_no", "n_pieces"), [key, "piece"]))
    return docs, split_by_hot_key(children, parents.select(key).distinct(), key, hot)[1]


def _collected(rows: DataFrame, key: str, piece: Column) -> DataFrame:
    return rows.select(key, piece.cast("int").alias("piece"), "_rank", "_child").groupBy(key, "piece").agg(
        F.sort_array(F.collect_list(F.struct("_rank", "_child"))).alias("_c"))


def _numbered(pieces: DataFrame, key: str) -> DataFrame:
    """With _no and n_pieces: a child larger than a piece leaves numbers out."""
    by = Window.partitionBy(key)
    return pieces.withColumn("_no", F.row_number().over(by.orderBy("piece")) - 1).withColumn(
        "n_pieces", F.count(F.lit(1)).over(by).cast("int"))


def _pieces(children: DataFrame, key: str, order: list[str], max_bytes: int, options: dict) -> DataFrame:
    """key, piece, _c, _no and n_pieces: all steps within the one exchange by key, which moves the bare fields."""
    fields = F.struct(*[c for c in children.columns if c != key])
    rows = children.repartition(key).withColumn("_json", F.to_json(fields, options)).withColumn("_size", F.octet_length("_json").cast("bigint"))
    upto = Window.partitionBy(key).orderBy(*order, "_json").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_size").over(upto)).withColumn("_rank", F.row_number().over(upto)).withColumn("_child", fields)
    return _numbered(_collected(rows, key, F.floor((F.col("_sum") - F.col("_size")) / max_bytes)), key)


def _ranked_pieces(children: DataFrame, key: str, order: list[str], max_bytes: int, options: dict) -> DataFrame:
    """The same for keys of any number of children."""
    from florafold.operators.ranking import with_global_rank, with_running_sum

    rows = children.select(key, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                           F.struct(*[c for c in children.columns if c != key]).alias("_child"))
    rows = rows.withColumn("_json", F.to_json("_child", options)).withColumn("_size", F.octet_length("_json").cast("bigint"))
    ranked = with_global_rank(rows, [key, *[f"_o{i}" for i in range(len(order))], "_json"], "_rank").drop("_json")
    summed = with_running_sum(ranked, "_rank", key, "_size", "_sum")
    bodies = _collected(summed, key, F.floor((F.col("_sum") - F.col("_size")) / max_bytes)).checkpoint()
    return bodies.join(_numbered(bodies.select(key, "piece"), key), [key, "piece"])
