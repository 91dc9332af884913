"""Benchmark decontamination: n-gram seeds, rare ones first, then Smith-Waterman alignment.

1. Each item's words are cut into n-grams so short that no copy above
   ``min_score`` is without one. The score is M - E for M equal words and E
   others. Of an item of L words that must score c, E is at most L - c, and the
   M >= c + E equal words stand in at most E + 1 runs; so one run has at least
   L / (L - c + 1) words, and that, rounded up, is n (two or three words at 0.6).
2. The n-grams of all items are counted over all documents (one narrow
   aggregation of at most one row for each of these n-grams and task). Every
   one that some document holds is a seed, however many documents hold it.
3. A copy holds at least c - (n - 1) - (n - 2) * (L - c) of its item's seeds, and
   where these would have the item begin differs by at most L - c words. Hits
   without so many others near are left out.
4. Documents are aligned with the item around each group of hits left:
   Smith-Waterman over words with +1 for equal words, -1 for different ones and
   -1 for a gap. The score is the best alignment's share of the item's words. A
   window with only hits of seeds in more than ``rare_documents`` documents is
   aligned if it holds enough of the item's word pairs: an alignment of M equal
   words and E others has at least M - E - 1 pairs of neighbours, so fewer pairs
   cannot reach ``min_score``. Seeds in few documents are mostly copies and save
   that test. The result does not depend on ``rare_documents``.

An item is in a document when its score is at least ``min_score``; with an ``n``
given, only if ``n`` consecutive words of it stand unchanged as well. Items of
fewer than ``WHOLE_BELOW`` words (of ``n`` words) match only where they stand
whole.

Documents stay where they were read; texts are never exchanged. The benchmark is
a bounded table: its items go to the tasks in blocks of at most ``block_words``
words; more blocks mean more passes, never a larger broadcast.

Edge cases: null and empty texts or items match nothing. Repeated items count
each; repeated documents get equal results; a document's null id stays null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SYMBOLS, Words, grams, slices


WHOLE_BELOW = 4


def _words(texts: pa.Array) -> Words:
    return Words(texts, lower=True, breaks=SYMBOLS)


def least_words(size: int, min_score: float) -> int:
    """Smallest alignment score in words that is a share of at least ``min_score`` of an item of ``size`` words."""
    scores = np.arange(1, size + 1)
    return int(scores[scores / size >= min_score][0]) if min_score <= 1 else size + 1


def seed_rule(size: int, min_score: float) -> tuple[int, int]:
    """Words of a seed, and how many seeds every copy of an item of ``size`` words holds (points 1 and 3 above)."""
    if size < WHOLE_BELOW:
        return size, 1
    c = least_words(size, min_score)
    n = -(-size // max(1, size - c + 1))
    return n, max(1, c - (n - 1) - max(0, n - 2) * (size - c))


class Seeds:
    """The words of a block of items and their n-grams, sorted by hash; the length of these follows from ``min_score``
    for an ``n`` of None."""

    def __init__(self, items: list[tuple[int, str]], n: int | None, min_score: float = 0.6):
        self.ids = [i for i, _ in items]
        words = _words(pa.array([t for _, t in items], pa.string()))
        h = words.hashes()
        self.items = [h[words.first[k]:words.first[k + 1]] for k in range(len(items))]
        self.pairs = [np.unique(grams(item, 2), return_counts=True) for item in self.items]
        seeds = []
        self.need = np.ones(len(items), dtype=np.int64)
        self.drift = np.zeros(len(items), dtype=np.int64)  # an alignment through a hit has fewer gaps
        for k, item in enumerate(self.items):
            self.drift[k] = int(len(item) * (1 - min_score)) + 1
            m = min(n or 0, len(item))
            if n is None and len(item):
                m, self.need[k] = seed_rule(len(item), min_score)
            if m:
                seeds += [(int(g), k, p, m) for p, g in enumerate(grams(item, m))]
        self.hash = np.array([s[0] for s in seeds], dtype=np.uint64)
        self.item, self.place, self.n = (np.array([s[j] for s in seeds], dtype=np.int64) for j in (1, 2, 3))
        self._sort()

    def _sort(self) -> None:
        order = np.lexsort((self.place, self.item, self.n, self.hash))
        self.hash, self.item, self.place, self.n = (x[order] for x in (self.hash, self.item, self.place, self.n))

    def rate(self, documents: dict[int, int], rare_documents: int) -> None:
        """Leave out n-grams that no document holds, and say which of the others are rare."""
        df = np.array([documents.get(int(h), 0) for h in self.hash], dtype=np.int64)
        keep = df > 0
        self.rare = df[keep] <= rare_documents
        self.hash, self.item, self.place, self.n = (x[keep] for x in (self.hash, self.item, self.place, self.n))

    def hits(self, words: Words, h: np.ndarray):
        """(document, word place, seed) of each n-gram of the texts that is a seed."""
        out = []
        for m in np.unique(self.n).tolist():
            g = grams(h, m)
            own = np.flatnonzero(self.n == m)
            keys = self.hash[own]
            near = np.flatnonzero(_maybe(keys)[(g & np.uint64(0xFFFF)).astype(np.int64)])
            lo = np.searchsorted(keys, g[near])
            near, lo = near[lo < len(keys)], lo[lo < len(keys)]
            ok = (keys[lo] == g[near]) & (words.doc[near] == words.doc[near + m - 1])
            near, lo = near[ok], lo[ok]
            count = np.searchsorted(keys, g[near], side="right") - lo
            at = np.repeat(near, count)
            seed = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            out.append((words.doc[at], at, own[seed]))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def _crowded(doc: np.ndarray, item: np.ndarray, begin: np.ndarray, need: np.ndarray, drift: np.ndarray) -> np.ndarray:
    """Which of the hits, sorted by document, item and begin, have ``need`` hits of that pair, themselves
    included, within ``drift`` words."""
    i = np.arange(len(doc))
    last = i + need - 1
    to = np.minimum(last, len(doc) - 1)
    ok = (last < len(doc)) & (doc[to] == doc) & (item[to] == item) & (begin[to] - begin <= drift)
    step = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(step, i[ok], 1)
    np.add.at(step, last[ok] + 1, -1)
    return np.cumsum(step[:-1]) > 0


def _maybe(keys: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 16, dtype=bool)
    seen[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
    return seen


def smith_waterman(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and where it ends in ``b``."""
    j = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in a:
        step = np.maximum(row[:-1] + np.where(b == w, 1, -1), 0)
        new = np.maximum(np.concatenate([[0], step]), row - 1)
        row = np.maximum.accumulate(new + j) - j  # gaps in a: -1 for each word of b passed over
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _blocks(items: DataFrame, block_words: int, id_col: str, text_col: str):
    """The items in blocks of at most about ``block_words`` words."""
    items = items.where(F.col(text_col).isNotNull()).select(id_col, text_col)
    total = items.agg(F.sum(F.size(F.split(text_col, r"\s+")))).first()[0] or 0
    n = max(1, -(-total // block_words))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(n)) == k) if n > 1 else items
        rows = sorted(((r[0], r[1]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
        if rows:
            yield rows


def _block_seeds(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text_col: str, n: int | None,
                 rare_documents: int, min_score: float, block_words: int):
    """The broadcast seeds of each block of items that has any."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(items, block_words, item_col, item_text_col):
        counts = _seed_documents(docs.select(text_col), context.broadcast(Seeds(block, n, min_score)), text_col)
        seeds = Seeds(block, n, min_score)
        seeds.rate(counts, rare_documents)
        if len(seeds.hash):
            yield context.broadcast(seeds)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", n: int | None = None, rare_documents: int = 1000,
               min_score: float = 0.6, block_words: int = 1_000_000) -> DataFrame:
    """One row for each item found in a document: id, item id, score, first_word, words (of the aligned part)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, `{item_col}` {item_type}, score double, first_word bigint, words bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for seeds in _block_seeds(docs, items, text_col, item_col, item_text_col, n, rare_documents, min_score, block_words):
        out = out.unionByName(_align(docs.select(id_col, text_col), seeds, schema, id_col, text_col, item_col, min_score))
    return out


def _seed_documents(texts: DataFrame, shared, text_col: str) -> dict[int, int]:
    """In how many documents each n-gram of the items stands (one number for each n-gram of the benchmark)."""

    def count(batches):
        seeds = shared.value
        keys = np.unique(seeds.hash)
        total = np.zeros(len(keys), dtype=np.int64)
        for b in batches:
            for s in slices(b, text_col):
                words = _words(s.column(text_col))
                doc, _, seed = seeds.hits(words, words.hashes())
                pair = np.unique(doc * len(keys) + np.searchsorted(keys, seeds.hash[seed]))
                total += np.bincount(pair % max(1, len(keys)), minlength=len(keys))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[some])], names=["seed", "n"])

    rows = texts.mapInArrow(count, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).collect()
    return {r.seed % (1 << 64): r.n for r in rows}


def _aligned(texts: pa.Array, seeds: Seeds, min_score: float) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(text, item) found: score in words, first word, and words of the aligned part."""
    words = _words(texts)
    h = words.hashes()
    doc, at, seed = seeds.hits(words, h)
    pairs = grams(h, 2)
    # hits of an item in a document, by where the item would begin
    begin = at - seeds.place[seed]
    order = np.lexsort((begin, seeds.item[seed], doc))
    doc, item_of, begin, rare = (x[order] for x in (doc, seeds.item[seed], begin, seeds.rare[seed]))
    kept = _crowded(doc, item_of, begin, seeds.need[item_of], seeds.drift[item_of])
    doc, item_of, begin, rare = (x[kept].tolist() for x in (doc, item_of, begin, rare))
    rows: dict[tuple[int, int], tuple[int, int, int]] = {}
    i = 0
    while i < len(doc):
        d, k, first = doc[i], item_of[i], begin[i]
        item = seeds.items[k]
        size = len(item)
        drift = int(seeds.drift[k])
        slack = max(size // 2 + 4, drift)
        direct = False
        while i < len(doc) and doc[i] == d and item_of[i] == k and begin[i] - first <= slack - drift:
            direct = direct or rare[i]  # this window holds all alignments through these hits
            i += 1
        lo = max(int(words.first[d]), first - slack)
        hi = min(int(words.first[d + 1]), first + size + slack)
        if not direct:
            keys, count = seeds.pairs[k]
            if (count[np.isin(keys, pairs[lo:hi - 1])].sum() + 1) / size < min_score:
                continue
        best, end = smith_waterman(item, h[lo:hi])
        if best / size >= min_score and best > rows.get((d, k), (0,))[0]:
            start = smith_waterman(item[::-1], h[lo:lo + end][::-1])[1]
            rows[d, k] = (best, lo + end - start - int(words.first[d]), start)
    return rows


def _align(docs: DataFrame, shared, schema: str, id_col: str, text_col: str, item_col: str, min_score: float) -> DataFrame:
    item_type = docs.sparkSession.createDataFrame([], schema).schema[item_col].dataType

    def align(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        seeds = shared.value
        for b in batches:
            for s in slices(b, text_col):
                rows = _aligned(s.column(text_col), seeds, min_score)
                keys = list(rows)
                yield pa.RecordBatch.from_arrays(
                    [s.column(0).take(pa.array([d for d, _ in keys], pa.int64())),
                     pa.array([seeds.ids[k] for _, k in keys], to_arrow_type(item_type)),
                     pa.array([rows[x][0] / len(seeds.items[x[1]]) for x in keys], pa.float64()),
                     *(pa.array([rows[x][j] for x in keys], pa.int64()) for j in (1, 2))],
                    names=[id_col, item_col, "score", "first_word", "words"])

    return docs.mapInArrow(align, schema)


def _without(docs: DataFrame, shared, text_col: str, min_score: float) -> DataFrame:
    def clean(batches):
        seeds = shared.value
        for b in batches:
            for s in slices(b, text_col):
                keep = np.ones(s.num_rows, dtype=bool)
                keep[[d for d, _ in _aligned(s.column(text_col), seeds, min_score)]] = False
                yield s.filter(pa.array(keep))

    return docs.mapInArrow(clean, docs.schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", n: int | None = None, rare_documents: int = 1000, min_score: float = 0.6,
                      block_words: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that hold an item.

    Rows are filtered where they are read, with no exchange and whatever their
    ids (null and repeated ones too); each further block of items is a further filter.
    """
    out = docs
    for seeds in _block_seeds(docs, items, text_col, item_col, item_text_col, n, rare_documents, min_score, block_words):
        out = _without(out, seeds, text_col, min_score)
    return out
