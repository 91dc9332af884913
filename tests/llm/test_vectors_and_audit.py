"""Embedding whitening, filter audit and the multi-index against plain versions, and their edge cases."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from florafold.llm import filter_audit, multi_index, queries as Q, whitening
from florafold.session import load_table

SF = "/root/testdata/sf0.001"


def vectors_of(spark, rows):
    """(vec_id, embedding) rows with extra columns named like those the operators make."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.select("*", *[F.lit("clash").alias(c) for c in ("n", "component", "rank", "score", "_hash", "_cell", "bucket", "_x", "cell", "kind")])


def bad_vectors(d):
    return [(None, [1.0] * d), (901, None), (902, []), (903, [None] + [1.0] * (d - 1)), (904, [math.nan] * d), (905, [math.inf] + [0.0] * (d - 1)),
            (906, [1.0] * (d + 1))]


def plain_whitening(x):
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = u - s / n
    e, w = np.linalg.eigh(c.T @ c / n)
    return n, s, e[::-1], w[:, ::-1]


def check_whitening(rows, vectors, k):
    """``rows`` of the operator against numpy over the usable (id, vector) pairs."""
    x = (np.floor(64 * np.array([v for _, v in vectors], dtype=np.float32).astype(float)) + 1_000_000).astype(np.int64)
    n, s, e, w = plain_whitening(x)
    want = Counter()
    for (i, _), row in zip(vectors, x):
        want[(i, int(((n * row - s) ** 2).sum()))] += k
    assert Counter((r["vec_id"], int(r["deviation"])) for r in rows) == want and all(r["n"] == n for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["vec_id"], {})[r["component"]] = r
    white = ((x - s / n) @ w[:, :k]) / np.sqrt(e[:k])
    got = np.array([[by_id[i][c]["whitened"] for c in range(1, k + 1)] for i, _ in vectors])
    assert np.allclose(got * np.sign((got * white).sum(0)), white, atol=1e-8)
    assert np.allclose([by_id[vectors[0][0]][c]["explained"] for c in range(1, k + 1)], e[:k] / e.sum(), rtol=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in rows)


def test_whitening_of_the_query_matches_numpy(spark):
    rows = [r.asDict() for r in Q.QUERIES["op11_embedding_whitening"](spark, SF).collect()]
    vectors = [(r["vec_id"], r["embedding"]) for r in load_table(spark, SF, "embeddings").collect()]
    check_whitening(rows, vectors, 16)


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    good = [(i, v.tolist()) for i, v in enumerate((rng.standard_normal((60, 5)) * [5, 4, 3, 2, 1]).astype(np.float32))]
    good += [(70, good[0][1]), (71, good[0][1]), (71, good[3][1])]
    df = vectors_of(spark, good + bad_vectors(5)[1:]).repartition(3)
    rows = [r.asDict() for r in whitening.whiten(df, whitening.fit(df)).collect()]
    once = [g for g in good if g[0] != 71]
    check = [r for r in rows if r["vec_id"] != 71]
    assert len(rows) == len(good) * 5
    # 71 repeats vectors that the fit list holds once already
    check_whitening(check, once, 5)
    nulls = vectors_of(spark, good + [(None, good[1][1])])
    assert whitening.whiten(nulls, whitening.fit(nulls)).where("vec_id is null").count() == 5
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], bad_vectors(2)[1:6]):
        df = vectors_of(spark, few)
        assert whitening.whiten(df, whitening.fit(df)).count() == 0
    line = vectors_of(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)])
    model = whitening.fit(line)
    assert len(model.eigenvalues) == 1 and whitening.whiten(line, model).count() == 20  # a space of one dimension
    far = spark.createDataFrame([(i, [float(i) * 2**40, 0.5]) for i in range(9)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(far, whitening.fit(far)).collect()}
    x = [[i * 2**46 + 1_000_000, 32 + 1_000_000] for i in range(9)]
    s = [sum(c) for c in zip(*x)]
    assert got == {i: sum((9 * a - b) ** 2 for a, b in zip(x[i], s)) for i in range(9)}  # beyond a long


def test_chebyshev_rounds_find_close_eigenvalues(spark):
    rng = np.random.default_rng(8)
    scale = np.concatenate([np.linspace(3, 2.9, 6), np.linspace(2.8, 2.0, 50)])
    rows = [(i, v.tolist()) for i, v in enumerate((rng.standard_normal((400, 56)) * scale).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df, k=6, guard=6)
    x = (np.floor(64 * np.array([v for _, v in rows]).astype(np.float32).astype(float)) + 1_000_000).astype(np.int64)
    _, _, e, w = plain_whitening(x)
    assert np.allclose(model.eigenvalues, e[:6], rtol=1e-12) and model.residual < 1e-11 and model.passes > 20
    assert np.allclose(np.abs((model.components * w[:, :6]).sum(0)), 1, atol=1e-9)


def plain_audit(docs, labels):
    """{(part, order, step): counts}; docs are (id, text, part)."""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}  # a null id has no label
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and least[t] < d}
        fails.append((part or "", {k for k, v in f.items() if v}, d in good, d in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        rows = [x for x in fails if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                earlier = [x for x in rows if f in x[1] and x[1] & set(order[:k])]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(gone)
                out[part, order, k + 1] = [len(left), len(gone), len(earlier), sum(x[1] == {f} for x in rows),
                                           sum(x[2] for x in gone), sum(x[3] for x in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_edges(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(9000)}" for _ in range(40_000))
    clean = " ".join(f"v{i}" for i in range(60))
    docs = [(1, None, "a"), (2, "", "a"), (3, " \t", None), (4, clean, "a"), (5, clean, "b"), (6, clean, ""), (6, clean, "b"), (7, clean + " #", "b"),
            (8, clean.upper(), "b"), (9, long, "b"), (10, long, "a"), (None, clean, "a"), (None, clean, "a"), (None, None, None), (11, "x " * 70, "a"),
            (12, "x " * 70, "a"), (13, "Éß " * 55, "b"), (14, clean.replace(" ", " "), "a"), (15, clean + " ", "a")]
    labels = [(4, 1, 0), (5, 1, 1), (6, 0, 1), (6, 1, 0), (7, None, 1), (12, 1, None), (99, 1, 1), (None, 1, 1), (9, 1, 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").select(
        "*", *[F.lit("clash").alias(c) for c in ("part", "bits", "rows", "n", "_id", "_text", "_hash", "_salt", "quality", "toxic", "kept")])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS)
           for r in filter_audit.audit(df.repartition(3), marks).collect()}
    assert got == plain_audit(docs, labels) and len(got) == 3 * 600
    assert filter_audit.audit(df.where("false"), marks).count() == 0
    assert filter_audit.audit(df, marks.where("false")).agg(F.sum("good_lost")).first()[0] == 0


def test_audit_of_a_hot_text(spark):
    """One text in a third of all rows: every row but the least id fails E, and no salt holds them all."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
                                  F.lit("s").alias("source"))
    sets = filter_audit.failure_sets(df)
    assert sets.where("bits >= 16").count() == 999 and sets.where("bits >= 16 and _id % 3 <> 0").count() == 0


def plain_nearest(rows, queries, k=10):
    out = {}
    for q, v in queries:
        v = np.array(v, dtype=np.float32).astype(float)
        d = sorted((float(np.sqrt(((np.array(w, dtype=np.float32).astype(float) - v) ** 2).sum())), i) for i, w in rows if i != q)[:k]
        out[q] = [i for _, i in d], [s for s, _ in d]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        ids, scores = out.setdefault(r["query_id"], ([], []))
        ids.append(r["vec_id"])
        scores.append(r["score"])
        assert r["rank"] == len(ids)
    return out


def recall(got, want):
    return sum(len(set(got[q][0]) & set(want[q][0])) for q in want) / sum(len(w[0]) for w in want.values())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_nearest_neighbours_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    got = found(Q.QUERIES["op13_nearest_neighbours"](spark, path))
    rows = [(r["vec_id"], r["embedding"]) for r in load_table(spark, path, "embeddings").collect()]
    want = plain_nearest(rows, [r for r in rows if r[0] % 100 == 0])
    assert set(got) == set(want) and recall(got, want) >= 0.9
    vector = dict(rows)
    for q, (ids, scores) in got.items():
        exact = [float(np.sqrt(((np.array(vector[i], float) - np.array(vector[q], float)) ** 2).sum())) for i in ids]
        assert len(ids) == 10 and np.allclose(scores, exact, atol=1e-12) and scores == sorted(scores)


def test_nearest_neighbours_edges(spark):
    rng = np.random.default_rng(6)
    good = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 7)).astype(np.float32))]
    good += [(1000 + i, good[100][1]) for i in range(300)]  # ties: a hot vector
    bad = bad_vectors(7) + [(907, [0.0] * 7), (800, None)]
    df = vectors_of(spark, good + bad).repartition(4)
    index = multi_index.build(df, sample_rows=150)
    queries = df.where("vec_id % 100 = 0 or vec_id is null")
    got = found(multi_index.search(index, queries))
    want = plain_nearest(good, [g for g in good if g[0] % 100 == 0])
    assert set(got) == set(want) and recall(got, want) >= 0.9
    assert got[100][0] == list(range(1000, 1010)) and got[1000][0] == [100, *range(1001, 1010)]  # ties go to smaller ids
    assert index.rows == len(good) and index.distinct.sum() == 400  # every usable row is indexed
    everything = multi_index.build(df, target=1.0)
    everything.share = 1.0
    assert found(multi_index.search(everything, queries))[200][0] == want[200][0]
    few = vectors_of(spark, [(0, [1.0]), (1, [2.0]), (2, [4.0]), (2, [9.0])])
    assert found(multi_index.search(multi_index.build(few), few.where("vec_id = 0")))[0] == ([1, 2, 2], [1.0, 3.0, 8.0])
    for none in ([], bad_vectors(3)[:1], [(5, [0.0])]):
        df = vectors_of(spark, none)
        assert multi_index.search(multi_index.build(df), df).count() == 0
    twice = vectors_of(spark, [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [0.0, 1.0])])
    assert found(multi_index.search(multi_index.build(twice), twice.where("vec_id = 100")))[100] == ([7], [math.sqrt(2)])


def test_cells_are_passed_in_order_of_the_summed_distance():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random(6), rng.random(5)
        held = rng.integers(0, 3, 30)
        got = multi_index.traverse(a, b, held, math.inf)
        cost = (a[:, None] + b).ravel()
        assert got == [c for c in np.argsort(cost, kind="stable").tolist() if held[c]]
        part = multi_index.traverse(a, b, held, 10)
        assert part == got[:len(part)] and held[part].sum() >= 10 > held[part[:-1]].sum()
