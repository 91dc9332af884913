"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean of the embeddings of its subwords, the hashed byte
trigrams of its words (with word ends); a linear layer and a softmax follow.
Embeddings and layer are trained together by stochastic gradient descent in
numpy on the driver, on a sample of at most about ``max_rows`` labelled rows
(chosen by a hash of the id among all labelled rows, by language); what reaches
the driver is one compressed count vector of ``buckets`` numbers for each sampled row. A
tenth of the sample calibrates a temperature and the score below which a
prediction is rejected. Scoring reads whole texts and needs no exchange.

Edge cases: a text that is null or has no letter is ``und`` with score 0 and is
rejected. Repeated rows get equal results. Rows without a label train nothing;
without any labelled row there is nothing to predict and every text is ``und``.
Other columns pass through; columns named like an output column are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .words import Words, mix, slices

OUTPUT = ("lang_pred", "score", "accepted")
_LETTER = regex.compile(r"\p{L}").search
_ASCII_LETTER = regex.compile(rb"[A-Za-z]").search


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER(text.encode()) or _LETTER(text))


def trigram_counts(texts: pa.Array, buckets: int) -> np.ndarray:
    """Counts of hashed byte trigrams, one row for each text."""
    words = Words(texts, lower=True)
    data = words.data.astype(np.uint64)
    if len(data) < 3:
        return np.zeros((len(texts), buckets), np.float32)
    bucket = mix(data[:-2] * np.uint64(65536) + data[1:-1] * np.uint64(256) + data[2:] + np.uint64(1)) >> np.uint64(40)
    size = np.diff(words.bounds)
    doc = np.repeat(np.arange(len(texts)), size)[:-2]
    ok = doc == np.repeat(np.arange(len(texts)), size)[2:]
    at = doc[ok] * buckets + (bucket[ok] % np.uint64(buckets)).astype(np.int64)
    return np.bincount(at, minlength=len(texts) * buckets).reshape(len(texts), buckets).astype(np.float32)


def _means(counts: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    return np.divide(counts, np.maximum(counts.sum(axis=1, keepdims=True), 1), out=out)


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, means: np.ndarray) -> np.ndarray:
        return means @ self.embedding @ self.weight + self.bias

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = self.logits(means).astype(np.float64) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(counts: np.ndarray, labels: list[str], dims: int = 16, epochs: int = 30, rate: float = 0.5,
          batch: int = 64, seed: int = 1, keep: float = 0.999) -> LanguageModel:
    """Fit on count vectors, which become means in place; ``keep`` of the right calibration rows are accepted."""
    languages = sorted(set(labels))
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = order[:len(y) // 10]
    rest = order[len(y) // 10:]
    x = _means(counts, out=counts)
    m = LanguageModel(languages, rng.normal(0, 0.1, (counts.shape[1], dims)).astype(np.float32),
                      rng.normal(0, 0.1, (dims, len(languages))).astype(np.float32),
                      np.zeros(len(languages), np.float32))
    scale = np.float32(np.sqrt(counts.shape[1]))  # rows of x are sparse means: their embeddings learn at a higher rate
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        for part in np.array_split(rng.permutation(rest), max(1, len(rest) // batch)):
            hidden = x[part] @ m.embedding
            z = hidden @ m.weight + m.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p /= np.float32(max(1, len(part)))
            back = p @ m.weight.T
            m.weight -= step * (hidden.T @ p)
            m.bias -= step * p.sum(axis=0)
            m.embedding -= step * scale * (x[part].T @ back)
    if len(held):
        z = m.logits(x[held]).astype(np.float64)

        def loss(t: float) -> float:
            a = z / t
            a = a - a.max(axis=1, keepdims=True)
            return float(-(a[np.arange(len(held)), y[held]] - np.log(np.exp(a).sum(axis=1))).mean())

        m.temperature = min(np.geomspace(0.05, 5, 60), key=loss)
        p = m.probabilities(x[held])
        right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
        m.reject_below = float(min(0.5, np.quantile(right, 1 - keep))) if len(right) else 0.0
    return m


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        max_rows: int = 4000, buckets: int = 2048) -> LanguageModel | None:
    """Train on a sample of at most about ``max_rows`` rows, shared evenly by the languages that occur."""
    labelled = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        id_col, text_col, F.col(label_col).cast("string").alias("_label"))
    sizes = {r["_label"]: r["count"] for r in labelled.groupBy("_label").count().collect()}
    if not sizes:
        return None
    share = max_rows / len(sizes)
    part = F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    chance = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, share / v))])
    sample = labelled.where(part < chance[F.col("_label")])

    def features(batches):
        for b in batches:
            for s in slices(b, text_col):
                c = trigram_counts(s.column(text_col), buckets).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [s.column("_label"), pa.array([zlib.compress(r.tobytes(), 1) for r in c], pa.binary())], names=["label", "counts"])

    rows = sample.select("_label", text_col).mapInArrow(features, "label string, counts binary").toArrow()
    if not rows.num_rows:
        return None
    labels, packed = (rows.column(c).to_pylist() for c in ("label", "counts"))
    del rows

    def unpacked(order) -> np.ndarray:
        out = np.empty((len(order), buckets), np.float32)
        for i, k in enumerate(order):
            out[i] = np.frombuffer(zlib.decompress(packed[k]), np.uint32)
        return out

    counts = unpacked(range(len(packed)))
    order = np.lexsort((counts[:, :64] @ np.arange(1, 65), counts.sum(axis=1), labels)).tolist()  # the same for any order of rows
    del counts  # one matrix at a time: the driver holds what a whole pipeline needs beside it
    return train(unpacked(order), [labels[i] for i in order])


def predict(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score and accepted (without the text unless ``keep_text``)."""
    docs = docs.drop(*OUTPUT)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema += ", lang_pred string, score double, accepted boolean"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        for b in batches:
            for s in slices(b, text_col):
                texts = s.column(text_col)
                letter = np.array([has_letter(t) for t in texts.to_pylist()], dtype=bool) & (m is not None)
                if m is None:
                    best, top = np.zeros(len(texts), np.int64), np.zeros(len(texts))
                    names = np.array(["und"], dtype=object)
                else:
                    p = m.probabilities(_means(trigram_counts(texts, len(m.embedding))))
                    best, top, names = p.argmax(axis=1), p.max(axis=1), np.array(m.languages, dtype=object)
                columns = [s.column(f.name) for f in kept]
                columns += [pa.array(np.where(letter, names[best], "und"), pa.string()),
                            pa.array(np.where(letter, top, 0.0)),
                            pa.array(letter & (top >= (m.reject_below if m else 0)))]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + list(OUTPUT))

    return docs.mapInArrow(score, schema)
