"""Toxicity by weak supervision.

Many voters look at a text: lexicons and word-beginning patterns (the dealt-out
parts of the words and prefixes that stand out in labelled rows), a short list
of general insults, and patterns of writing. A generative label model, fitted
by expectation maximisation on the votes, estimates each voter's accuracy and
how far pairs of voters agree beyond what the label explains; correlated voters
share their weight. A linear classifier on the presence of words and prefixes
is then trained on the posterior labels in numpy, and a last one-dimensional
logistic step puts its scores on the scale of the labels.

Fitted on a sample of at most about ``max_rows`` labelled rows, chosen by a hash
of the id among all of them. Scoring reads whole texts and needs no exchange.

Edge cases: null and empty texts hold no evidence and get the score of a text
without any feature. Repeated rows get equal results. Labels that are null, or
of ids without a text, train nothing; if only one label value occurs,
its share is every text's score, and without any label the score is near 0. Other columns pass through; those
named like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SYMBOLS, Words, mix, slices

#: General insults of one English lexicon voter.
INSULTS = "idiot idiots moron morons stupid scum trash loser losers worthless pathetic disgusting imbecile vermin filth".split()

PREFIXES = (4, 5, 6)


def _tagged(h: np.ndarray, n: int) -> np.ndarray:
    return mix(h + np.uint64(n))


def text_features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, feature hash) of each word and of each word's first 4, 5 and 6 bytes, with repeats."""
    out = [(words.doc, _tagged(words.hashes(), 0))]
    size = words.end - words.start
    for n in PREFIXES:
        long = size > n
        cut = object.__new__(Words)
        cut.data, cut.start, cut.end = words.data, words.start[long], words.start[long] + n
        out.append((words.doc[long], _tagged(Words.hashes(cut), n)))
    return out


def writing(words: Words, texts: pa.Array) -> np.ndarray:
    """Patterns of writing, one row for each text: exclamation marks, capitals, second person."""
    rows = []
    for t in texts.to_pylist():
        t = t or ""
        upper = sum(len(w) > 2 and w.isupper() for w in t.split())
        rows.append((t.count("!") >= 3, upper >= 3, " you are " in t.lower()))
    return np.array(rows, dtype=bool).reshape(len(texts), 3)


@dataclass
class ToxicityModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        words = Words(texts, lower=True, breaks=SYMBOLS)
        total = np.full(len(texts), self.bias)
        if len(self.features):
            seen = np.zeros(1 << 16, dtype=bool)
            seen[(self.features & np.uint64(0xFFFF)).astype(np.int64)] = True
            pairs = []
            for doc, h in text_features(words):
                near = seen[(h & np.uint64(0xFFFF)).astype(np.int64)]
                doc, h = doc[near], h[near]
                at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
                ok = self.features[at] == h
                pairs.append(doc[ok] * len(self.features) + at[ok])
            pairs = np.unique(np.concatenate(pairs))
            np.add.at(total, pairs // len(self.features), self.weights[pairs % len(self.features)])
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def label_model(votes: np.ndarray, prior: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of label 1 and the voters' weights, from votes of 1, 0 (none) and -1.

    Expectation maximisation over one accuracy pair for each voter (how often it
    votes 1 under either label). Voters whose votes go together beyond what the
    posterior explains share their weight.
    """
    fired = np.stack([votes == 1, votes == -1]).astype(float)
    agree = np.clip(votes.sum(axis=1), -6, 6) + np.log(prior / (1 - prior))
    post = 1 / (1 + np.exp(-agree))
    weight = np.ones(votes.shape[1])
    for _ in range(rounds):
        p = np.stack([1 - post, post])
        rate = (np.einsum("vnj,yn->vyj", fired, p) + 0.5) / (p.sum(axis=1)[None, :, None] + 1.5)
        none = np.clip(1 - rate.sum(axis=0), 1e-6, 1)
        log = np.log(rate[:, 1] / rate[:, 0])
        log_none = np.log(none[1] / none[0])
        left = (votes == 1) - np.einsum("yn,yj->nj", p, rate[0])
        scale = np.sqrt((left**2).mean(axis=0)) + 1e-9
        corr = (left.T @ left) / len(votes) / np.outer(scale, scale)
        np.fill_diagonal(corr, 0)
        weight = 1 / (1 + np.clip(corr, 0, 1).sum(axis=0))
        z = np.log(prior / (1 - prior)) + (fired[0] * log[0] + fired[1] * log[1] + (votes == 0) * log_none) @ weight
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - post).max() < 1e-6
        post = new
        prior = float(np.clip(post.mean(), 1e-3, 1 - 1e-3))
        if done:
            break
    return post, weight


def train(doc: np.ndarray, feature: np.ndarray, patterns: np.ndarray, y: np.ndarray, voters: int = 12,
          lexicon: int = 4000, min_rows: int = 3, seed: int = 1) -> ToxicityModel:
    """``doc`` and ``feature`` are the distinct (row, feature hash) pairs of the sample."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 1e-3
    empty = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    if not 0 < y.sum() < len(y):
        return empty
    values, at = np.unique(feature, return_inverse=True)
    n1 = np.bincount(at, weights=y[doc], minlength=len(values))
    n0 = np.bincount(at, minlength=len(values)) - n1
    odds = np.log((n1 + 0.5) / (y.sum() + 1)) - np.log((n0 + 0.5) / ((1 - y).sum() + 1))
    good = np.flatnonzero((n1 >= min_rows) & (odds > 2.5) & (n1 > 2 * n0))
    good = np.sort(good[np.argsort(-n1[good], kind="stable")[:lexicon]])
    if not len(good):
        return empty
    column = np.full(len(values), -1)
    column[good] = np.arange(len(good))
    keep = column[at] >= 0
    doc, col = doc[keep], column[at][keep]
    rows = len(y)
    # voters: dealt-out parts of the lexicon, the insults, patterns of writing, and one that misses any evidence
    part = (mix(values[good]) % np.uint64(voters)).astype(np.int64)
    votes = np.zeros((rows, voters + 2 + patterns.shape[1]), dtype=int)
    votes[doc, part[col]] = 1
    insults = _tagged(Words(pa.array([" ".join(INSULTS)])).hashes(), 0)
    named = np.isin(values[good], insults)[col]
    votes[doc[named], voters] = 1
    votes[:, voters + 1] = -1
    votes[doc, voters + 1] = 0
    votes[:, voters + 2:] = patterns
    post, _ = label_model(votes, share)
    # logistic regression on the posterior labels, by stochastic gradient descent
    x = np.zeros((rows, len(good)), dtype=np.float32)
    x[doc, col] = 1
    rng, w, b = np.random.default_rng(seed), np.zeros(len(good), np.float32), np.float32(np.log(share / (1 - share)))
    for epoch in range(15):
        step = np.float32(1.0 * (1 - epoch / 15))
        for k in np.array_split(rng.permutation(rows), max(1, rows // 128)):
            g = 1 / (1 + np.exp(-np.clip(x[k] @ w + b, -30, 30))) - post[k]
            w -= step * (x[k].T @ g.astype(np.float32) / np.float32(len(k)) * 8 + np.float32(1e-4) * w)
            b -= step * np.float32(g.mean())
    z = (x @ w + b).astype(float)
    a, c = 1.0, 0.0
    for _ in range(200):  # scale and shift to the labels (Newton steps, slightly regularised)
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        g = np.array([((p - y) * z).mean() + 1e-3 * (a - 1), (p - y).mean()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).mean() + 1e-3, (v * z).mean()], [(v * z).mean(), v.mean() + 1e-6]])
        d = np.linalg.solve(h, g)
        a, c = a - np.clip(d[0], -0.5, 0.5), c - np.clip(d[1], -0.5, 0.5)
        if np.abs(d).max() < 1e-7:
            break
    return ToxicityModel(values[good], (a * w).astype(float), float(a * b + c))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_rows: int = 8000) -> ToxicityModel:
    """Fit on at most about ``max_rows`` of the rows of ``docs`` that ``labels`` marks.

    What reaches the driver are the distinct feature hashes of the sampled rows.
    """
    labels = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.max(label_col).cast("int").alias("_y")))
    known = docs.where(F.col(text_col).isNotNull()).select(id_col, text_col)
    n = labels.join(known.select(id_col), id_col, "left_semi").count()
    part = F.pmod(F.xxhash64(id_col, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    chance = min(1.0, max_rows / max(1, n))
    rows = known.where(part < chance).join(labels.where(part < chance), id_col)

    def features(batches):
        for b in batches:
            for s in slices(b, text_col):
                words = Words(s.column(text_col), lower=True, breaks=SYMBOLS)
                doc = np.concatenate([d for d, _ in text_features(words)])
                h = np.concatenate([h for _, h in text_features(words)])
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                doc, h = doc[new], h[new]
                cut = np.searchsorted(doc, np.arange(s.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [s.column("_y"), pa.array([h[cut[i]:cut[i + 1]].tobytes() for i in range(s.num_rows)], pa.binary()),
                     pa.array([r.tobytes() for r in writing(words, s.column(text_col))], pa.binary())],
                    names=["y", "features", "patterns"])

    got = rows.select("_y", text_col).mapInArrow(features, "y int, features binary, patterns binary").toArrow()
    got = got.take(pa.array(sorted(range(got.num_rows), key=got.column("features").to_pylist().__getitem__), pa.int64()))
    sets = [np.frombuffer(x, np.uint64) for x in got.column("features").to_pylist()]
    y = np.array([v > 0 for v in got.column("y").to_pylist()], dtype=float)
    if not len(y):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -3.0)
    patterns = np.array([list(x) for x in got.column("patterns").to_pylist()], dtype=bool).reshape(len(y), -1)
    doc = np.repeat(np.arange(len(y)), [len(x) for x in sets])
    return train(doc, np.concatenate(sets), patterns, y)


def score_texts(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` without the text, with score and predicted (1 from ``threshold`` on)."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "score", "predicted")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double, predicted int"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for b in batches:
            for s in slices(b, text_col):
                p = m.score(s.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [s.column(f.name) for f in kept] + [pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                    names=[f.name for f in kept] + ["score", "predicted"])

    return docs.select(*[f.name for f in kept], text_col).mapInArrow(score, schema)
