"""Registered queries: SQL where there is some, brute force on the small tables, and the pipeline's stages."""

import brute
import pytest
from oracle_harness import compare, duck

import __spark_entry__ as E
import corpus_pipeline
from florafold.llm import queries as Q
from florafold.session import load_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in load_table(spark, SF, "documents").collect()]


def test_all_are_registered():
    assert set(Q.QUERIES) <= set(E.queries()) and set(Q.ORACLE) <= set(E.oracle_sql())
    assert [n for n in Q.QUERIES if n.startswith("op")] == sorted((n for n in Q.QUERIES if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, Q.QUERIES[name], Q.ORACLE[name], SF)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["hash_match"], r


def test_near_duplicates_match_brute_force(spark, docs):
    got = Q.QUERIES["op2_ngram_jaccard"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.components(docs) and len(got) == len(docs)


def test_repeats_match_brute_force(spark, docs):
    got = Q.QUERIES["op3_substring_dedup"](spark, SF).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute.repeats(docs) and len(got) == len(docs)


def test_licenses_match_brute_force(spark, docs):
    from florafold.llm.license_scan import PHRASES
    got = {r["doc_id"]: r for r in Q.QUERIES["op9_license_scans"](spark, SF).collect()}
    for d, t in docs:
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute.license_base(t, PHRASES)


def test_pipeline_stages(spark, docs):
    """Each stage against brute force on its own input; clean documents stay."""
    import re
    benchmark = [(r["item_id"], r["text"]) for r in load_table(spark, SF, "benchmark").collect()]
    norm = lambda t: re.sub(r"[^0-9a-z\u0080-\U0010ffff]+", " ", brute.ascii_lower(t or ""))
    table, columns = load_table(spark, SF, "documents"), ["doc_id", "text", "lang", "source", "n_chars"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in table.collect()}
        out = stage(spark, table, SF).checkpoint()
        rows = out.collect()
        if k == 4:
            assert {r["doc_id"] for r in rows} == set(before)
            break
        assert out.columns == columns
        after = {r["doc_id"] for r in rows}
        assert len(after) == len(rows) and all(r["text"] == before[r["doc_id"]] for r in rows)
        if k == 0:
            assert len(after) >= 0.98 * len(before)
        if k == 1:
            assert after == {d for d, w in brute.exact(before.items()).items() if w[0] == d}
        if k == 2:
            assert after == {d for d, w in brute.components(before.items()).items() if w[1] == d}
        if k == 3:
            whole = {d for d, t in before.items() if any(norm(x).strip() in norm(t) for _, x in benchmark)}
            assert not whole & after and len(before) - len(after) <= len(whole) + 3
        table = out


def test_pipeline_runs(spark):
    got = Q.QUERIES["pipeline"](spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0
