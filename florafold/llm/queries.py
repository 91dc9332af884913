"""Registered queries of the subpackage, and their SQL."""

from __future__ import annotations

import functools
import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, load_table
from . import decontaminate, exact_dedup, filter_audit, html_extract, language_id, license_scan, multi_index, ngram_join
from . import packing, repeats, toxicity, url_filter, whitening

#: Host, path and verdict of the URL rules.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@functools.cache
def _ship(application: str) -> str:
    """This package as a zip file on the driver, for ``addPyFile``."""
    root = Path(__file__).resolve().parents[1]
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="florafold-"), "florafold.zip")
    Path(path).write_bytes(raw.getvalue())
    return path


def shipped(query):
    """The query, with this package sent to the Python workers first."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _ship(spark.sparkContext.applicationId)
        if os.path.basename(path) not in spark.sparkContext._python_includes:  # sent once for each application
            spark.sparkContext.addPyFile(path)
        return query(spark, sf_dir)

    return run


def _remainder(column: str, n: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(load_table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return ngram_join.near_duplicates(load_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return repeats.remove_repeats(load_table(spark, sf_dir, "documents"), digest=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", (_remainder("doc_id", 4) == 2).alias("held_out"))
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_remainder("doc_id", 4) != 2)
    model = toxicity.fit(docs.where("not held_out"), labels)
    return toxicity.score_texts(docs, model, threshold=0.3)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(docs, hash_col="text_sha256").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang",
                                                         (_remainder("doc_id", 5) == 0).alias("held_out"))
    model = language_id.fit(docs.where("not held_out"))
    return language_id.predict(docs.drop("lang"), model, keep_text=False)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return packing.pack_documents(load_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(load_table(spark, sf_dir, "documents")).drop("spans")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(load_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    vectors = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors)).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return filter_audit.audit(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "labels"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    vectors = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.search(multi_index.build(vectors), vectors.where("vec_id % 100 = 0"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: shipped(f) for f in (
    op1_url_filters, op2_ngram_jaccard, op3_substring_dedup, op4_toxicity, op5_decontamination, op6_exact_dedup,
    op7_language_id, op8_packing, op9_license_scans, op10_html_extraction, op11_embedding_whitening, op12_filter_audit,
    op13_nearest_neighbours, pipeline)}

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    """SQL: table ``each`` with one row per word."""
    return rf"""each as (
            select doc_id, generate_subscripts(w, 1) as j, unnest(w) as word, len(w) as n
            from (select doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') as w from documents)),"""


def _gram(n: int) -> str:
    """SQL: the ``n`` words from this one on, null where the document ends before."""
    return " || ' ' || ".join(["word"] + [f"lead(word, {k}) over (partition by doc_id order by j)" for k in range(1, n)])


ORACLE = {
    "op1_url_filters": rf"""
        with parts as (
            select page_id,
                   translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   coalesce(regexp_extract(url, '{_PARTS}', 2), '') as path
            from pages),
        ruled as (
            select *, case
                when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
                when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
                when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
            from parts)
        select page_id, host, path, rule,
               case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
        from ruled""",
    "op2_ngram_jaccard": rf"""
        with recursive {_words(_LOWER)}
        shingles as (
            select distinct doc_id, shingle from (select doc_id, {_gram(5)} as shingle from each) where shingle is not null
            union all select doc_id, string_agg(word, ' ' order by j) from each where n < 5 group by doc_id),
        sets as (select doc_id, count(*) as n, md5(string_agg(shingle, chr(10) order by shingle)) as s from shingles group by doc_id),
        classes as (select s, n, min(doc_id) as class from sets group by s, n),
        members as (select class, n, shingle from classes join shingles on doc_id = class),
        links as (
            select a.class as a, b.class as b
            from members a join members b on a.shingle = b.shingle and a.class <> b.class
            group by a.class, b.class, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reached as (select class as a, class as b from classes union select r.a, l.b from reached r join links l on r.b = l.a),
        least as (select a, min(b) as component from reached group by a)
        select doc_id, cast(coalesce(sets.n, 0) as bigint) as n_shingles, coalesce(component, doc_id) as component_id
        from documents left join sets using (doc_id) left join classes using (s) left join least on class = a""",
    "op3_substring_dedup": rf"""
        with {_words("coalesce(text, '')")}
        grams as (select doc_id, j, {_gram(13)} as g from each),
        windows as (select doc_id, j, min(doc_id) over (partition by g) as owner from grams where g is not null),
        covered as (select distinct doc_id, unnest(generate_series(j, j + 12)) as j from windows where owner < doc_id),
        kept as (
            select e.doc_id, count(*) as n_words, count(c.j) as n_removed, string_agg(word, ' ' order by e.j) filter (c.j is null) as t
            from each e left join covered c on e.doc_id = c.doc_id and e.j = c.j group by e.doc_id)
        select doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
               sha256(coalesce(t, '')) as kept_sha256
        from documents left join kept using (doc_id)""",
    "op6_exact_dedup": rf"""
        with norm as (select doc_id, sha256({_NORM}) as text_sha256 from documents),
        groups as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from norm group by text_sha256)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from norm join groups using (text_sha256)""",
    "op12_filter_audit": r"""
        with words as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
            from documents),
        sets as (
            select doc_id, part,
                   case when len(w) < 50 then 'A' else '' end
                   || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
                   || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end
                   || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
                   || case when min(doc_id) over (partition by t) < doc_id then 'E' else '' end as fails
            from words),
        marks as (select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic from labels group by doc_id),
        cells as (
            select part, fails, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
            from sets left join marks using (doc_id) group by part, fails),
        letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
        orders as (
            select a.f || b.f || c.f || d.f || e.f as filter_order
            from letters a, letters b, letters c, letters d, letters e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps as (
            select filter_order, cast(step as int) as step, substr(filter_order, step, 1) as f, substr(filter_order, 1, step - 1) as before
            from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
        hits as (
            select part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) as fail,
                   length(translate(before, fails, '')) < length(before) as earlier
            from cells, steps),
        counted as (
            select part, filter_order, step, f,
                   coalesce(sum(n) filter (not fail and not earlier), 0) as kept,
                   coalesce(sum(n) filter (fail and not earlier), 0) as removed,
                   coalesce(sum(n) filter (fail and earlier), 0) as redundant,
                   coalesce(sum(n) filter (fails = f), 0) as unique_fails,
                   coalesce(sum(good) filter (fail and not earlier), 0) as good_lost,
                   coalesce(sum(toxic) filter (fail and not earlier), 0) as toxic_lost
            from hits group by part, filter_order, step, f)
        select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
               cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
               cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
               cast(sum(removed) over (partition by part, f) as bigint) as shapley
        from counted""",
}
