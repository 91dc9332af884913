"""Scientific names: parsing, and matching to a taxonomy.

I-class: our own definition, from the public nomenclatural codes' name formats.

A taxonomy is a table of taxon_id, name, rank, parent_id and accepted_id (null
for accepted names). Links to unknown taxa and to the taxon itself are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florafold.operators.joins import bounded_broadcast, exchanged
from florafold.session import ensure_checkpoint_dir, written

# ---- fixed values of the codes' name formats -----------------------------------
INFRA_MARKERS = {"subsp": "subspecies", "ssp": "subspecies", "var": "variety", "subvar": "subvariety", "f": "form", "forma": "form",
                 "fo": "form", "cv": "cultivar"}
QUALIFIERS = ["cf", "aff", "nr", "sp", "spp"]
# lower-case words that begin or join authors
AUTHOR_WORDS = ["de", "del", "della", "der", "den", "di", "du", "da", "la", "le", "van", "von", "zu", "ex", "et", "in", "and", "fil", "emend", "non", "nom", "auct"]
# --------------------------------------------------------------------------------

SMALL_BYTES = 8 << 20  # of taxa that are broadcast

_LETTERS = r"\p{L}[\p{L}\-]+"
_NOT_A_NAME = r"(?!(?:" + "|".join([*INFRA_MARKERS, *QUALIFIERS, *AUTHOR_WORDS]) + r")(?:\.|\s|$))"
#: A part of the name is lower-case, or all of the text is upper-case (which has been lowered before).
_PART = _NOT_A_NAME + r"\p{Ll}[\p{Ll}\-]+(?=\s|$|,)"
_NAME = (r"^(" + _LETTERS + r")(?:\s+\((" + _LETTERS + r")\))?(?:\s+(?:" + "|".join(QUALIFIERS) + r")\.?(?=\s|$))?"
         r"(?:\s+(" + _PART + r"))?(?:\s+(?:(" + "|".join(INFRA_MARKERS) + r")\.?\s+)?(" + _PART + r"))?[\s,]*(.*)$")


def parsed_name(name: Column) -> Column:
    """Struct of canonical, genus, subgenus, epithet, infra_epithet, rank and authorship of a name as written.

    ``canonical`` is lower-case: genus, epithet and infraspecific epithet, one space
    between them. White space is collapsed, hybrid signs are dropped, text
    without lower-case letters is lowered first, and qualifiers (cf., sp., ..)
    are passed over. rank is that of the lowest part: uninomial, species,
    subspecies (also a third word without a marker), or the marker's. All are null for text that
    does not begin with a word; missing parts are null."""
    text = F.array(F.trim(F.regexp_replace(F.regexp_replace(name, r"[×✕]|(?<=^|\s)[xX](?=\s)", " "), r"\s+", " ")))
    # arrays of one, so that the text and its groups are each worked out once, however often they are used below
    text = F.transform(text, lambda t: F.when(t.rlike(r"\p{Ll}"), t).otherwise(F.lower(t)))
    groups = F.transform(text, lambda t: F.array(*[F.nullif(F.regexp_extract(t, _NAME, i), F.lit("")) for i in range(1, 7)]))
    return F.transform(groups, _parts)[0]


def _parts(groups: Column) -> Column:
    """Parts of a name by the groups of ``_NAME``."""
    group = lambda i: groups[i - 1]
    genus, epithet, infra = F.lower(group(1)), group(3), group(5)
    markers = F.create_map(*[F.lit(x) for kv in INFRA_MARKERS.items() for x in kv])
    rank = (F.when(infra.isNotNull() & group(4).isNotNull(), F.element_at(markers, group(4))).when(infra.isNotNull(), "subspecies")
            .when(epithet.isNotNull(), "species").when(genus.isNotNull(), "uninomial"))
    return F.struct(F.when(genus.isNotNull(), F.concat_ws(" ", genus, epithet, infra)).alias("canonical"), genus.alias("genus"),
                    F.lower(group(2)).alias("subgenus"), epithet.alias("epithet"), infra.alias("infra_epithet"), rank.alias("rank"),
                    group(6).alias("authorship"))


def deletions(name: Column, edits: int = 1) -> Column:
    """The name and all names left by taking out up to ``edits`` characters: two names
    within ``edits`` changes of each other share one of them."""
    out = F.array(name)
    for _ in range(edits):
        shorter = F.flatten(F.transform(out, lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.concat(
            F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))))
        out = F.array_distinct(F.concat(out, shorter))
    return out


def _links(taxa: DataFrame, col: str) -> DataFrame:
    """(id, to) of links to other known taxa."""
    known = taxa.select(F.col("taxon_id").alias("to")).distinct()
    return taxa.where(f"{col} is not null and {col} <> taxon_id").groupBy(F.col("taxon_id").alias("id")) \
        .agg(F.min(col).alias("to")).join(exchanged(known), "to", "left_semi").select("id", "to")


def accepted_taxa(taxa: DataFrame) -> DataFrame:
    """(taxon_id, accepted_taxon): the end of each taxon's chain of accepted_id links, itself without one.

    Pointer jumping: each round doubles the part of the chain a taxon looks
    along, so rounds grow with the logarithm of the longest chain. A taxon
    whose links lead into a circle counts as accepted itself."""
    ensure_checkpoint_dir(taxa.sparkSession)
    links = jump = _links(taxa, "accepted_id").checkpoint()
    n = links.count()
    for _ in range(max(1, n.bit_length() + 1)):
        after = jump.select(F.col("id").alias("to"), F.col("to").alias("_end"))
        step = jump.join(exchanged(after), "to", "left")
        if step.where("_end is not null").isEmpty():
            break
        jump = step.select("id", F.coalesce("_end", "to").alias("to")).checkpoint()
    # an end that has a link itself lies on a circle
    ends = jump.join(exchanged(links.select(F.col("id").alias("to"))), "to", "left_anti").select(F.col("id").alias("taxon_id"), F.col("to").alias("_to"))
    return taxa.select("taxon_id").distinct().join(exchanged(ends), "taxon_id", "left") \
        .select("taxon_id", F.coalesce("_to", "taxon_id").alias("accepted_taxon"))


def ancestors(taxa: DataFrame, max_doublings: int = 7) -> DataFrame:
    """(taxon_id, ancestor_id, distance) for every taxon above another, along parent_id.

    Path doubling: with all ancestors up to distance d and each taxon's
    ancestor at distance d, one join gives those up to 2 d. Chains longer than
    2 ** max_doublings, or circles, raise."""
    ensure_checkpoint_dir(taxa.sparkSession)
    jump = _links(taxa, "parent_id").checkpoint()
    above = jump.select("id", "to", F.lit(1).alias("distance"))
    for k in range(max_doublings):
        if jump.isEmpty():
            return above.select(F.col("id").alias("taxon_id"), F.col("to").alias("ancestor_id"), "distance")
        far = jump.select("id", F.col("to").alias("_via"))
        more = far.join(above.withColumnRenamed("id", "_via"), "_via").select("id", "to", (F.col("distance") + (1 << k)).alias("distance"))
        above = above.unionByName(more).checkpoint()
        jump = far.join(jump.withColumnRenamed("id", "_via"), "_via").select("id", "to").checkpoint()
    if not jump.isEmpty():
        raise ValueError("parent links run in a circle, or are deeper than %d" % (1 << max_doublings))
    return above.select(F.col("id").alias("taxon_id"), F.col("to").alias("ancestor_id"), "distance")


def classification(taxa: DataFrame, ranks: list[str]) -> DataFrame:
    """taxon_id and, for each rank, <rank>_id: the nearest taxon of that rank at or above it."""
    of = taxa.select(F.col("taxon_id").alias("ancestor_id"), "rank")
    up = ancestors(taxa).unionByName(taxa.select("taxon_id", F.col("taxon_id").alias("ancestor_id"), F.lit(0).alias("distance")).distinct())
    return up.join(of, "ancestor_id").groupBy("taxon_id").agg(
        *[F.min_by(F.when(F.col("rank") == r, F.col("ancestor_id")), F.when(F.col("rank") == r, F.col("distance"))).alias(f"{r}_id") for r in ranks])


def match_taxa(df: DataFrame, taxa: DataFrame, name_col: str = "scientificName", higher: dict[str, str] | None = None,
               edits: int = 1, least_length: int = 6) -> DataFrame:
    """``df`` with taxon_id (accepted), matched_id and match_type.

    Tried in this order, on names in canonical form:

    * ``exact``: the taxonomy has the name, as an accepted one;
    * ``accepted``: it has it as a synonym; taxon_id is the accepted taxon its links lead to;
    * ``fuzzy``: one with at most ``edits`` changed, missing or added characters (the least distance,
      then the least name); only for names of ``least_length`` characters or more;
    * ``higher-rank``: the species of an infraspecific name, the genus, or the record's own classification:
      ``higher`` maps a rank to the column with its name, lowest rank first;
    * ``none``.

    Of several taxa with one name the accepted one counts, then the least taxon_id. Each different name is
    parsed and matched once, whatever the number of its records; candidates of misspelt names meet
    by shared deletions (an equi-join), never all against all."""
    ensure_checkpoint_dir(df.sparkSession)
    higher = higher or {}
    taxa = taxa.select("taxon_id", F.lower(F.trim(F.regexp_replace("name", r"\s+", " "))).alias("_name"), "rank", "parent_id", "accepted_id")
    accepted = accepted_taxa(taxa)
    t = taxa.join(exchanged(accepted), "taxon_id").select(
        "_name", "rank", F.struct((F.col("accepted_taxon") != F.col("taxon_id")).alias("synonym"), F.col("taxon_id").alias("id"),
                                  F.col("accepted_taxon").alias("to")).alias("_t"))
    by_name = written(t.where("_name is not null").groupBy("_name").agg(F.min("_t").alias("_t")), "taxa")
    known = bounded_broadcast(by_name, SMALL_BYTES)
    # each different text is parsed once, whatever the number of its records
    texts = df.select(F.col(name_col).alias("_text")).where("_text is not null").distinct()
    parsed = written(texts.select("_text", parsed_name(F.col("_text")).alias("_p")), "names") \
        .select("_text", "_p", F.col("_p.canonical").alias("_canonical")).where("_canonical is not null")
    names = parsed.groupBy("_canonical").agg(F.first("_p").alias("_p"))
    exact = written(names.join(known.withColumnRenamed("_name", "_canonical"), "_canonical", "left"), "exact")
    left = exact.where("_t is null").select("_canonical")
    wide = lambda d, c: d.where(F.length(c) >= least_length - edits).withColumn("_key", F.explode(deletions(F.col(c), edits))).withColumn("_key", F.xxhash64("_key"))
    # some twenty keys a name: exchanged, however small the names themselves
    keys = exchanged(wide(by_name.select("_name"), "_name"))
    pairs = wide(left, "_canonical").where(F.length("_canonical") >= least_length).join(keys, "_key") \
        .select("_canonical", "_name").distinct().withColumn("_d", F.levenshtein("_canonical", "_name")).where(F.col("_d") <= edits)
    near = pairs.groupBy("_canonical").agg(F.min(F.struct("_d", "_name")).alias("_n")).select("_canonical", F.col("_n._name").alias("_name"))
    fuzzy = near.join(known, "_name").select("_canonical", F.col("_t").alias("_f"))
    # names above: the species of an infraspecific name, then the genus
    genera = t.where("rank = 'genus'").groupBy(F.col("_name").alias("_genus")).agg(F.min("_t").alias("_g"))
    binomial = F.when(F.col("_p.infra_epithet").isNotNull(), F.concat_ws(" ", "_p.genus", "_p.epithet"))
    found = exact.join(fuzzy, "_canonical", "left").withColumn("_binomial", binomial).withColumn("_genus", F.col("_p.genus")) \
        .join(known.select(F.col("_name").alias("_binomial"), F.col("_t").alias("_b")), "_binomial", "left").join(genera, "_genus", "left")
    found = found.select("_canonical", "_t", "_f", F.coalesce("_b", "_g").alias("_h"))
    of_text = exchanged(parsed.select("_text", "_canonical")).join(exchanged(found), "_canonical").drop("_canonical")
    out = df.withColumn("_text", F.col(name_col)).join(of_text, "_text", "left")
    above = [F.col("_h")]
    for i, (rank, column) in enumerate(higher.items()):
        of = t.where(F.col("rank") == rank).groupBy(F.col("_name").alias(f"_n{i}")).agg(F.min("_t").alias(f"_h{i}"))
        out = out.withColumn(f"_n{i}", F.lower(F.trim(F.col(column)))).join(of, f"_n{i}", "left").drop(f"_n{i}")
        above.append(F.col(f"_h{i}"))
    up = F.coalesce(*above)
    pick = F.coalesce(F.col("_t"), F.col("_f"), up)
    kind = (F.when(F.col("_t").isNotNull(), F.when(F.col("_t.synonym"), "accepted").otherwise("exact"))
            .when(F.col("_f").isNotNull(), "fuzzy").when(up.isNotNull(), "higher-rank").otherwise("none"))
    return out.withColumn("_pick", pick).withColumn("match_type", kind).withColumn("taxon_id", F.col("_pick.to")) \
        .withColumn("matched_id", F.col("_pick.id")).drop("_text", "_t", "_f", "_h", "_pick", *[f"_h{i}" for i in range(len(higher))])
