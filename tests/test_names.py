"""Names as written, links of a taxonomy, and misspelt names."""

import random

import pytest
from pyspark.sql import functions as F

from florafold.operators import names as N

TAXA = "taxon_id string, name string, rank string, parent_id string, accepted_id string"


def test_parsed_names(spark):
    want = {
        "Acacia dealbata Link": ("acacia dealbata", "acacia", None, "dealbata", None, "species", "Link"),
        "Acacia dealbata subsp. subalpina Tindale & Kodela": ("acacia dealbata subalpina", "acacia", None, "dealbata", "subalpina", "subspecies", "Tindale & Kodela"),
        "Eucalyptus   globulus var. compacta": ("eucalyptus globulus compacta", "eucalyptus", None, "globulus", "compacta", "variety", None),
        "Poa annua f. minor (L.) Foo": ("poa annua minor", "poa", None, "annua", "minor", "form", "(L.) Foo"),
        "Canis lupus dingo Meyer, 1793": ("canis lupus dingo", "canis", None, "lupus", "dingo", "subspecies", "Meyer, 1793"),
        "Aus (Bus) cus Smith": ("aus cus", "aus", "bus", "cus", None, "species", "Smith"),
        "Aus bus de Vries ex van Foo": ("aus bus", "aus", None, "bus", None, "species", "de Vries ex van Foo"),
        "Aus cf. bus": ("aus bus", "aus", None, "bus", None, "species", None), "Aus sp.": ("aus", "aus", None, None, None, "uninomial", None),
        "× Aus bus": ("aus bus", "aus", None, "bus", None, "species", None), "Aus x bus": ("aus bus", "aus", None, "bus", None, "species", None),
        "AUS BUS": ("aus bus", "aus", None, "bus", None, "species", None), "Rosaceae": ("rosaceae", "rosaceae", None, None, None, "uninomial", None),
        "Rosaceae Juss.": ("rosaceae", "rosaceae", None, None, None, "uninomial", "Juss."), "Aus novae-zelandiae": ("aus novae-zelandiae", "aus", None, "novae-zelandiae", None, "species", None),
        "": (None,) * 7, " 12 ": (None,) * 7, None: (None,) * 7}
    df = spark.createDataFrame([(k,) for k in want], "name string").select("name", N.parsed_name(F.col("name")).alias("p"))
    got = {r["name"]: tuple(r["p"]) for r in df.collect()}
    assert {k: v for k, v in got.items() if want[k] != (None,) * 7} == {k: v for k, v in want.items() if v != (None,) * 7}
    assert all(got[k][0] is None for k in ("", " 12 ", None))


def test_accepted_names_of_chains_circles_and_dangling_links(spark):
    rows = [(f"a{i}", f"n{i}", "species", None, f"a{i + 1}" if i < 40 else None) for i in range(41)]
    rows += [("c1", "x", "species", None, "c2"), ("c2", "y", "species", None, "c3"), ("c3", "z", "species", None, "c2"),
             ("d1", "d", "species", None, "gone"), ("s1", "s", "species", None, "s1"), ("l", "l", "species", None, None)]
    got = {r["taxon_id"]: r["accepted_taxon"] for r in N.accepted_taxa(spark.createDataFrame(rows, TAXA)).collect()}
    assert all(got[f"a{i}"] == "a40" for i in range(41)) and len(got) == len(rows)
    assert all(got[t] == t for t in ("c1", "c2", "c3", "d1", "s1", "l"))
    assert N.accepted_taxa(spark.createDataFrame([], TAXA)).count() == 0


def test_ancestors(spark):
    rng = random.Random(2)
    parent = {i: rng.randrange(max(0, i - 4), i) for i in range(1, 60)}
    rows = [(str(i), str(i), "rank", str(parent[i]) if i else None, None) for i in range(60)] + [("lost", "q", "rank", "nobody", None)]
    want = set()
    for i in range(1, 60):
        j, d = i, 0
        while j:
            j, d = parent[j], d + 1
            want.add((str(i), str(j), d))
    got = [tuple(r) for r in N.ancestors(spark.createDataFrame(rows, TAXA)).collect()]
    assert set(got) == want and len(got) == len(want)
    with pytest.raises(ValueError, match="circle"):
        N.ancestors(spark.createDataFrame([("a", "a", "r", "b", None), ("b", "b", "r", "a", None)], TAXA))


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_misspelt_names_equal_comparing_all(spark, edits):
    rng = random.Random(edits)
    word = lambda: "".join(rng.choices("abc", k=rng.randint(3, 6)))
    backbone = sorted({f"{word()} {word()}" for _ in range(60)})
    texts = set(rng.sample(backbone, 10))
    for _ in range(120):
        t = list(rng.choice(backbone))
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(t))
            if t[i] != " ":
                t[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "z"])
        texts.add("".join(t))
    texts = sorted(t for t in texts if all(len(w) > 1 for w in t.split(" ")) and t.count(" ") == 1)
    taxa = spark.createDataFrame([(f"t{i:02}", n, "species", None, None) for i, n in enumerate(backbone)], TAXA)
    got = {r["scientificName"]: (r["match_type"], r["taxon_id"]) for r in
           N.match_taxa(spark.createDataFrame([(t,) for t in texts], "scientificName string"), taxa, edits=edits).collect()}
    for t in texts:
        near = min((( _distance(t, n), n) for n in backbone))
        want = ("exact", f"t{backbone.index(t):02}") if t in backbone else ("fuzzy", f"t{backbone.index(near[1]):02}") \
            if near[0] <= edits and len(t) >= 6 else ("none", None)
        assert got[t] == want, (t, near)


def test_match_order_and_repeated_rows(spark):
    taxa = spark.createDataFrame([
        ("s1", "Aus bus", "species", "g1", None), ("s2", "Aus bus", "species", "g1", "s1"), ("s0", "Aus cus", "species", "g1", "s1"),
        ("g1", "Aus", "genus", "f1", None), ("f1", "Ausidae", "family", None, None), ("g2", "Zus", "genus", None, "g1"), ("n", None, "species", None, None)], TAXA)
    rows = [("Aus bus", None), ("Aus bus", None), ("Aus cus L.", None), ("Aus buss", None), ("Aus bus minor", None), ("Aus dus", None), ("Zus zzzz", None),
            ("Qus qqqq", "AUSIDAE "), (None, "Ausidae"), ("Qus qqqq", None), ("", "none")]
    df = spark.createDataFrame(rows, "scientificName string, family string")
    got = sorted((r["scientificName"] or "", r["family"] or "", r["taxon_id"], r["match_type"], r["matched_id"]) for r in N.match_taxa(df, taxa, higher={"family": "family"}).collect())
    assert got == sorted([("Aus bus", "", "s1", "exact", "s1")] * 2 + [
        ("Aus cus L.", "", "s1", "accepted", "s0"), ("Aus buss", "", "s1", "fuzzy", "s1"), ("Aus bus minor", "", "s1", "higher-rank", "s1"),
        ("Aus dus", "", "s1", "fuzzy", "s1"), ("Zus zzzz", "", "g1", "higher-rank", "g2"), ("Qus qqqq", "AUSIDAE ", "f1", "higher-rank", "f1"),
        ("", "Ausidae", "f1", "higher-rank", "f1"), ("Qus qqqq", "", None, "none", None), ("", "none", None, "none", None)], key=lambda r: (r[0], r[1]))
    assert N.match_taxa(df, taxa.where("false")).where("match_type <> 'none'").count() == 0


def test_records_are_joined_by_text_and_not_parsed_again(spark):
    taxa = spark.createDataFrame([("1", "Abies alba", "species", None, None)], "taxon_id string, name string, rank string, parent_id string, accepted_id string")
    df = spark.createDataFrame([("Abies alba Mill.",), ("Abies  alba",), ("Abies  alba",), (None,), ("123",)], "scientificName string")
    out = N.match_taxa(df, taxa)
    assert "regexp_extract" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r[0] or "", r["match_type"]) for r in out.select("scientificName", "match_type").collect()) == [
        ("", "none"), ("123", "none"), ("Abies  alba", "exact"), ("Abies  alba", "exact"), ("Abies alba Mill.", "exact")]


def test_keys_of_misspelt_names_are_not_broadcast(spark):
    """Each name has some twenty keys, which Spark's sizes leave out of account."""
    taxa = spark.createDataFrame([("1", "Aus busius", "species", None, None), ("2", "Aus", "genus", None, None)], TAXA)
    out = N.match_taxa(spark.createDataFrame([("Aus busiuss",), ("Aus busius",)], "scientificName string"), taxa)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [_key" in plan and "BroadcastHashJoin [_key" not in plan
    assert {r["scientificName"]: (r["taxon_id"], r["match_type"]) for r in out.collect()} == {"Aus busiuss": ("1", "fuzzy"), "Aus busius": ("1", "exact")}
