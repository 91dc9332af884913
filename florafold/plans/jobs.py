"""Composite jobs a user calls (C1-C8). Each is a plain composition of the
operators; at most single rows (a check, a cutoff, a decision) reach the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florafold.operators import enrich as EN
from florafold.operators import flatten as FL
from florafold.operators import planning as PL
from florafold.operators.joins import bounded_broadcast
from florafold.session import scratch_dir, written
from florafold.sources import catalog as CT
from florafold.sources.archive import read_archive
from florafold.sources import sinks as SK

# re-exports of the composite jobs defined next to their operators
flatten_index = FL.flatten_index                     # C1
from florafold.plans import commits  # noqa: E402
from florafold.plans.publish import validate_and_publish  # noqa: E402,F401  C2


def plan_ingest(inventory: DataFrame, specs, profile: str = "dwca", excluded=()) -> DataFrame:
    """List datasets of a profile, keep valid ones, split them into size-balanced batches."""
    sizes = CT.catalog(inventory, profile, excluded=excluded)
    return PL.partition_by_size(sizes, specs)


def plan_dataset_load(ids: DataFrame, registry: DataFrame, inventory: DataFrame,
                      min_per_batch: int, max_batches: int) -> tuple[DataFrame, DataFrame]:
    """C4: expand providers, look up archive sizes, classify; batches when there are many.
    Returns (per-dataset classes, round-robin batches)."""
    expanded = PL.expand_providers(ids, registry, mixed="raise")
    sizes = CT.named_dataset_sizes(inventory, expanded)
    classes = sizes.withColumn("size_class", PL.size_class("size"))
    batches = PL.round_robin_batches(sizes.select("dataset_id", "size"), min_per_batch, max_batches,
                                     order=[F.col("size").desc(), F.col("dataset_id").asc()])
    return classes, batches


def plan_load_dispatch(ids: DataFrame, registry: DataFrame, inventory: DataFrame,
                       min_per_batch: int) -> tuple[DataFrame, DataFrame]:
    """C4, how the datasets are handed on: per size class the number of datasets
    and the way of loading them (P11; a class without datasets is skipped), and
    the classes as lists (P10). Returns (dispatch, class lists)."""
    sizes = CT.named_dataset_sizes(inventory, PL.expand_providers(ids, registry, mixed="raise"))
    lists = PL.size_class_as_batches(sizes.select("dataset_id", "size"))
    classes = ids.sparkSession.createDataFrame([(c,) for c in PL.CLASS_ORDER], "size_class string")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    counts = lists.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"))
    dispatch = classes.join(counts, "size_class", "left").select(
        "size_class", n.alias("n"), PL.dispatch_mode(n, min_per_batch).alias("mode"))
    return dispatch, lists


def plan_image_sync(images: DataFrame, inventory: DataFrame, cutoff: str | None, min_per_batch: int,
                    max_batches: int, version: str | None = None) -> DataFrame:
    """Datasets with new images since the cutoff that were also re-indexed, in batches.
    Without a cutoff it is seven days before the date in the name of ``version``."""
    cutoff = cutoff or PL.version_cutoff(images.sparkSession, version or "")
    recent = PL.recent_image_counts(images, cutoff)
    reidx = CT.catalog(inventory, "index_avro", time_range=(cutoff, None))
    cand = PL.image_sync_candidates(recent, reidx)
    return PL.round_robin_batches(cand, min_per_batch, max_batches)


def ingest_dataset(occ: DataFrame, rules: dict, vocab: DataFrame, vocab_field: str, taxa: DataFrame,
                   existing_ids: DataFrame, id_terms: list[str], sensitive_rules: DataFrame,
                   table: str | None = None, max_new_pct: float | None = None,
                   images: DataFrame | None = None, url_col: str = "identifier") -> DataFrame:
    """Interpret → persistent ids → vocabulary → names → images → sensitive
    data → index records (persistent ids after names where a key term is theirs); written per dataset (S7) when ``table`` is given.

    With ``max_new_pct`` the guard of J9 runs before anything is written and
    raises when it fails. With ``images(identifier, image_id)`` each record gets
    the stored image of its ``url_col`` (J16)."""
    keep = [c for c in occ.columns if c not in {src for src, _ in rules.values()}]
    typed = EN.interpret(occ, rules, lat="decimalLatitude", lon="decimalLongitude",
                         keep=[c for c in keep if c not in rules])
    terms = list(dict.fromkeys(["dataset_id", *id_terms]))
    plain = typed.select(terms) if set(terms) <= set(typed.columns) else None
    # the records are exchanged to meet the known ids: before the columns of vocabulary and names, unless a key term is one of them
    if plain is not None:
        typed = EN.assign_uuids(typed, existing_ids, id_terms)
    typed = EN.lookup_vocabulary(typed, vocab, vocab_field)
    typed = EN.match_names(typed, taxa)
    if plain is None:
        typed = EN.assign_uuids(typed, existing_ids, id_terms)
    if max_new_pct is not None:
        # vocabulary and names neither add nor drop records, so the guard does without them unless a key term is theirs
        assigned = typed if plain is None else EN.assign_uuids(plain, existing_ids, id_terms)
        check = EN.uuid_check(assigned, existing_ids, max_new_pct).first()
        if check["status"] == "FAIL":
            raise ValueError(f"{check['n_new']} of {check['n_total']} ids are new, above {max_new_pct} percent")
    if images is not None:
        typed = EN.image_sync(typed, images.withColumnRenamed("identifier", url_col), url_col)
    typed = EN.restrict_sensitive(typed, sensitive_rules)

    def records(rows):
        return EN.build_index_record(rows.withColumn("id", F.col("uuid")), keep=["dataset_id"])

    if table:
        SK.replace_dataset(typed, table, form=records)
    return records(typed)


def ingest_archive(spark: SparkSession, root: str, core: str, core_id: str, *args, sep: str = "\t", **kw) -> DataFrame:
    """C7 from an extracted archive on: read its core file (S11), then :func:`ingest_dataset` with the
    remaining arguments. The core's id column becomes ``id``; all its fields are text until interpreted."""
    occ, _ = read_archive(spark, root, core, [], core_id, sep, duplicates=False)
    return ingest_dataset(occ if core_id == "id" else occ.withColumnRenamed(core_id, "id"), *args, **kw)


def full_index(spark: SparkSession, occ: DataFrame, layers: DataFrame, ranges: DataFrame,
               annotations: DataFrame | None = None, flags: dict | None = None,
               jackknife: tuple[str, str] = ("taxon", "value")) -> DataFrame:
    """Sampling (J13), jackknife (W7), clusters (J14), range outliers (J15),
    annotations (J17), assembled onto the records (J8).

    ``flags`` switches a side off by name (``sampling``, ``jackknife``,
    ``clustering``, ``outlier``); a side that is off is not computed.
    ``jackknife`` names the group and the value column of W7. Regions are
    attached by coordinates, without an exchange on id. What the sides read of the records is
    written once as a narrow table; their findings are added up per id in one
    aggregate and joined once, so the wide records are read and exchanged once."""
    flags = flags or {}
    group, value = jackknife
    on = lambda name: flags.get(name, True)
    used = {"jackknife": [group, value], "outlier": ["taxon"], "clustering": ["dataset_id", "scientificName", "eventDate", "catalogNumber"]}
    used = {name: columns for name, columns in used.items() if on(name)}
    narrow = None
    if used:
        path = scratch_dir(spark, "sides")
        names = dict.fromkeys(["id", "decimalLatitude", "decimalLongitude", *(c for columns in used.values() for c in columns)])
        occ.select(*[F.col(f"`{c}`") for c in names]).write.parquet(path)
        narrow = spark.read.parquet(path)

    def outlying_values():
        # every value has its finding, so the values found outlying, a few, say all: the others are not exchanged
        jk = written(EN.jackknife_outliers(narrow, group, value).where("is_outlier").select(group, value, "is_outlier"), "outliers")
        values = narrow.select("id", F.col(group), F.col(value).cast("double").alias(value)).where(
            F.col(group).isNotNull() & F.col(value).isNotNull())
        return values.join(bounded_broadcast(jk), [group, value], "left").select("id", F.coalesce("is_outlier", F.lit(False)).alias("is_outlier"))

    def duplicates():
        return EN.cluster_records(narrow).select("id", F.lit(1).cast("bigint").alias("n_dup_reasons"))

    def out_of_range():
        return EN.distribution_outliers(narrow, ranges).select("id", "distance")

    build = {"jackknife": (outlying_values, F.max("is_outlier").alias("is_outlier")),
             "clustering": (duplicates, F.sum("n_dup_reasons").alias("n_dup_reasons")),
             "outlier": (out_of_range, F.min("distance").alias("distance"))}
    base = EN.sample_layers(occ, layers, places=narrow) if on("sampling") else occ
    if annotations is not None:
        base = EN.apply_annotations(base, annotations)
    if not used:
        return base
    findings = [build[name][0]() for name in build if name in used]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), findings)
    return EN.assemble_index(base, {"findings": rows.groupBy("id").agg(*[build[name][1] for name in build if name in used])})


def index_and_publish(spark: SparkSession, occ: DataFrame, layers: DataFrame, ranges: DataFrame, root: str, alias: str, version: str,
                      annotations: DataFrame | None = None, flags: dict | None = None, jackknife: tuple[str, str] = ("taxon", "value"),
                      **checks):
    """C8 followed by C2: the full index is written once, compared with the version readers follow, and
    committed if no check fails; then old versions are marked (W5). The first version has nothing to be
    compared with and is committed as it is. ``checks`` go to :func:`validate_and_publish`. Returns its result
    (None, None, None, None for a first version)."""
    base = commits.last_number(spark, root, alias)
    index = full_index(spark, occ, layers, ranges, annotations, flags, jackknife)
    folder = commits.stage(index, root, version)
    new, live = spark.read.parquet(folder), commits.current(spark, root, alias)
    if live is None:
        commits.publish(new, root, alias, version, base, folder)
        return None, None, None, None
    return validate_and_publish(spark.read.parquet(live["path"]), new, alias, version, root=root, staged=folder, **checks)
