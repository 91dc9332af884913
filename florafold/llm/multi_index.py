"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised by its own k-means centroids, so a
vector's cell is a pair of centroids. A query walks the pairs by rising summed
squared distance of its halves, with a heap, until the cells it has passed hold
enough different vectors; the entries of these cells are reranked by their
Euclidean distance in double precision.

* The codebooks are fitted on at most ``sample_rows`` vectors and ``sample_bytes``
  (chosen by a hash); every row is indexed. How many centroids a half has
  follows from the number of vectors, at most ``max_centroids``, so what is
  broadcast (codebooks, counts of max_centroids ** 2 cells) is bounded.
* How much a query must pass is measured on the sample: the share of entries,
  in cell order, that holds ``target`` of all the true neighbours of sample
  queries. No candidates are capped within the cells passed.
* Entries are dealt into buckets of equal size: cells in order, large cells split
  by a hash of the id over the buckets they reach into, so neither a hot cell nor
  a hot vector meets in one task. A query goes once to each bucket that holds some of its
  cells, with the list of them. A task keeps the entries of its bucket and
  streams the queries past them. Copies of a vector in a bucket are reduced to
  their k + 1 smallest ids, which loses nothing, as ties go to smaller ids.

Edge cases: rows take no part if the vector is null, empty, zero, holds a null or
non-finite entry, or is not of the commonest length, or if the id is null. Rows
that repeat an id are entries each; as queries, those with equal vectors are one,
and a query's candidates are the rows with another id. With fewer candidates than
k, all are returned. Vectors of one dimension have an empty second half. An empty
table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_dir
from .vectors import common_dimension, finite, matrix

BUCKET_BYTES = 1 << 26
CHUNK = 8192
QUERIES = 64


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids of at most ``k`` groups; a centroid that loses all its vectors stays where it is."""
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = squared(x, centre).argmin(1)
        count = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre[count > 0] = total[count > 0] / count[count > 0, None]
    return centre


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1), 0)


@dataclass
class Codebooks:
    """Centroids of the first and the second half."""

    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(x[:, :self.half], self.first), squared(x[:, self.half:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)


def traverse(a: np.ndarray, b: np.ndarray, held: np.ndarray, enough: float) -> list[int]:
    """Cells in rising order of a[i] + b[j], until ``held`` of them adds up to ``enough``; empty ones are left out.

    A pair is put on the heap when its left and upper neighbours have been taken.
    """
    by_a, by_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x, y = a[by_a].tolist(), b[by_b].tolist()
    row, count = held.reshape(len(a), len(b))[by_a][:, by_b].tolist(), len(b)
    i_of, j_of = by_a.tolist(), by_b.tolist()
    depth = [0] * len(x)  # so many pairs of each row are taken
    heap, out, seen = [(x[0] + y[0], 0, 0)], [], 0
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        depth[i] = j + 1
        if row[i][j]:
            out.append(i_of[i] * count + j_of[j])
            seen += row[i][j]
        if j + 1 < count and (i == 0 or depth[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(x) and depth[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    return out


def passed_share(sample: np.ndarray, books: Codebooks, k: int, target: float, rng: np.random.Generator, queries: int = 256) -> float:
    """Share of the sample that queries must pass, in cell order, for ``target`` of their true neighbours."""
    if len(sample) <= k + 1:
        return 1.0
    at = rng.choice(len(sample), min(queries, len(sample)), replace=False)
    a, b = books.distances(sample)
    cell = (a.argmin(1), b.argmin(1))
    depths = []
    for q in at.tolist():
        d = squared(sample[q:q + 1], sample)[0]
        d[q] = np.inf
        near = np.argpartition(d, k)[:k]
        cost = a[q][cell[0]] + b[q][cell[1]]
        depths.append((np.searchsorted(np.sort(cost), cost[near], side="right")) / len(sample))
    return float(np.quantile(np.concatenate(depths), target))


@dataclass
class MultiIndex:
    """Codebooks, and the entries (id, vector, _cell, _hash) written under the shared checkpoint folder."""

    books: Codebooks
    entries: DataFrame
    rows: int
    distinct: np.ndarray  # different vectors in each cell
    counts: np.ndarray  # rows in each cell
    share: float
    id_col: str
    vec_col: str
    dimension: int


def build(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, target: float = 0.97,
          sample_rows: int = 16_384, sample_bytes: int = 1 << 26, max_centroids: int = 256, seed: int = 11) -> MultiIndex | None:
    """Index of all usable rows; None if there are none."""
    spark = vectors.sparkSession
    rows = vectors.select(id_col, vec_col).where(F.col(id_col).isNotNull() & finite(vec_col)).where(F.exists(vec_col, lambda c: c != 0))
    d = common_dimension(rows, vec_col)
    if not d:
        return None
    rows = rows.where(F.size(vec_col) == d).withColumn("_hash", F.xxhash64(vec_col))
    different = rows.select("_hash").distinct().count()
    most = max(1, min(sample_rows, sample_bytes // (8 * d)))
    # hashes of different vectors are spread evenly: about ``most`` of them lie below the bound
    part = min(1.0, most / different)
    low = rows.where(F.col("_hash") < int((part - 0.5) * 2**64)) if part < 1 else rows
    got = low.groupBy("_hash").agg(F.min_by(vec_col, id_col).alias("v")).toArrow()
    sample = matrix(got.column("v"))[np.argsort(got.column("_hash").to_numpy())]
    rng = np.random.default_rng(seed)
    k_centroids = int(np.clip(round(different ** 0.5 / 4), 2, max_centroids))
    half = (d + 1) // 2
    books = Codebooks(kmeans(sample[:, :half], k_centroids, rng), kmeans(sample[:, half:], k_centroids, rng))
    share = passed_share(sample, books, k, target, rng)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(books.cells(matrix(batch.column(1))), pa.int32())],
                                                 [*batch.schema.names, "_cell"])

    path = scratch_dir(spark, "multiindex")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    rows.mapInArrow(assign, types + ", _cell int").write.parquet(path)
    entries = spark.read.parquet(path)
    counted = entries.groupBy("_cell", "_hash").agg(F.count(F.lit(1)).alias("n")).groupBy("_cell").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("different")).toArrow()  # max_centroids ** 2 rows at most
    distinct, counts = (np.zeros(len(books.first) * len(books.second), np.int64) for _ in range(2))
    cell = counted.column("_cell").to_numpy()
    distinct[cell], counts[cell] = counted.column("different").to_numpy(), counted.column("n").to_numpy()
    return MultiIndex(books, entries, int(counts.sum()), distinct, counts, share, id_col, vec_col, d)


def _reduced(ids: np.ndarray, vectors: np.ndarray, hashes: np.ndarray, cells: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The entries in cell order, with the k + 1 smallest ids of each vector."""
    order = np.lexsort((ids, hashes, cells))
    ids, vectors, hashes, cells = ids[order], vectors[order], hashes[order], cells[order]
    same = np.zeros(len(ids), dtype=bool)
    close = np.flatnonzero((hashes[1:] == hashes[:-1]) & (cells[1:] == cells[:-1])) + 1
    same[close] = (vectors[close] == vectors[close - 1]).all(1)
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
    keep = np.arange(len(ids)) - start <= k
    return ids[keep], vectors[keep], cells[keep]


def nearest(queries: list[tuple[int, np.ndarray, np.ndarray]], ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray,
            n_cells: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each (id, vector, cells): place, ids and distances of its k nearest entries in these cells, ties to smaller ids."""
    q = np.array([v for _, v, _ in queries])
    wanted = np.zeros((len(queries), n_cells), dtype=bool)
    for row, (_, _, list_) in enumerate(queries):
        wanted[row, list_] = True
    best_ids = [np.zeros(0, np.int64)] * len(queries)
    best = [np.zeros(0)] * len(queries)
    for start in range(0, len(ids), CHUNK):
        e, i, c = vectors[start:start + CHUNK].astype(np.float64), ids[start:start + CHUNK], cells[start:start + CHUNK]
        sizes = (e * e).sum(1)
        rough = (q * q).sum(1)[:, None] - 2 * (q @ e.T) + sizes
        slack = 1e-9 * ((q * q).sum(1) + sizes.max())
        inside = wanted[:, c]
        for row, (own, v, _) in enumerate(queries):
            at = np.flatnonzero(inside[row] & (i != own))
            if not len(at):
                continue
            near = rough[row, at]
            limit = np.partition(near, k - 1)[k - 1] if len(at) > k else np.inf
            if len(best[row]) == k:
                limit = min(limit, best[row][-1] ** 2)
            at = at[near <= limit + slack[row]]
            exact = np.sqrt(((e[at] - v) ** 2).sum(1))
            all_ids, all_d = np.concatenate([best_ids[row], i[at]]), np.concatenate([best[row], exact])
            order = np.lexsort((all_ids, all_d))[:k]
            best_ids[row], best[row] = all_ids[order], all_d[order]
    for row in range(len(queries)):
        yield row, best_ids[row], best[row]


def search(index: MultiIndex | None, queries: DataFrame, k: int = 10, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` nearest entries; ``queries`` has the index's id and vector columns."""
    spark = queries.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    id_col, vec_col, books, n_cells = index.id_col, index.vec_col, index.books, len(index.counts)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-index.rows * index.dimension * 4 // bucket_bytes))
    n = max(1, min(n, index.rows))
    # cells in order fill n buckets of equal size; cell c reaches from bucket first[c] to last[c]
    after = np.cumsum(index.counts)
    first, last = (after - index.counts) * n // index.rows, np.maximum(after - 1, 0) * n // index.rows
    enough = max(index.share * index.distinct.sum(), 10 * (k + 1))
    used = np.flatnonzero(index.counts).tolist()
    reach = spark.createDataFrame([(c, int(first[c]), int(last[c] - first[c] + 1)) for c in used], "_cell int, _first int, _reach int")
    vec_type = index.entries.schema[vec_col].dataType.simpleString()
    dealt = "bucket int, kind int, id bigint, v {}, cell int, hash bigint, cells array<int>".format(vec_type)
    # at most max_centroids ** 2 rows
    entries = index.entries.join(F.broadcast(reach), "_cell").select(
        (F.col("_first") + F.pmod(F.xxhash64(id_col), F.col("_reach"))).cast("int").alias("bucket"), F.lit(0).alias("kind"),
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), F.col("_cell").alias("cell"),
        F.col("_hash").alias("hash"), F.lit(None).cast("array<int>").alias("cells"))
    held = index.distinct

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = books.distances(matrix(batch.column(1)))
            for row in range(batch.num_rows):
                cells = np.array(traverse(a[row], b[row], held, enough), dtype=np.int32)
                size = last[cells] - first[cells] + 1
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                bucket, cell = np.repeat(first[cells], size) + step, np.repeat(cells, size)
                order = np.lexsort((cell, bucket))
                bucket, cell = bucket[order], cell[order]
                each, starts = np.unique(bucket, return_index=True)
                m = len(each)
                yield pa.RecordBatch.from_arrays([
                    pa.array(each.astype(np.int32)), pa.array(np.ones(m, np.int32)), batch.column(0).take(pa.array([row] * m, pa.int64())),
                    batch.column(1).take(pa.array([row] * m, pa.int64())), pa.nulls(m, pa.int32()),
                    batch.column(2).take(pa.array([row] * m, pa.int64())),
                    pa.ListArray.from_arrays(pa.array([*starts, len(cell)], pa.int32()), pa.array(cell, pa.int32()))],
                    ["bucket", "kind", "id", "v", "cell", "hash", "cells"])

    usable = queries.where(F.col(id_col).isNotNull() & finite(vec_col)).where(F.exists(vec_col, lambda c: c != 0))
    usable = (usable.where(F.size(vec_col) == index.dimension).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
              .distinct().withColumn("hash", F.xxhash64("v")))
    asked = usable.mapInArrow(probes, dealt)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        stock = None
        for batch in batches:
            kind = batch.column(1).to_numpy()
            split = int(np.searchsorted(kind, 1))
            if split:
                e = batch.slice(0, split)
                parts.append((e.column(2).to_numpy(), matrix(e.column(3), None), e.column(5).to_numpy(), e.column(4).to_numpy()))
            if split < len(kind) and parts:
                if stock is None:
                    stock = _reduced(*(np.concatenate(x) for x in zip(*parts)), k)
                for start in range(split, len(kind), QUERIES):
                    b = batch.slice(start, QUERIES)
                    ids, v, hashes, lists = b.column(2).to_numpy(), matrix(b.column(3)), b.column(5), b.column(6)
                    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
                    out = [[], [], []]
                    block = [(int(ids[r]), v[r], flat[offsets[r]:offsets[r + 1]]) for r in range(len(ids))]
                    for row, near, score in nearest(block, *stock, n_cells, k):
                        out[0].append(np.full(len(near), row))
                        out[1].append(near)
                        out[2].append(score)
                    at = pa.array(np.concatenate(out[0]), pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column(2).take(at), hashes.take(at), pa.array(np.concatenate(out[1]), pa.int64()),
                                                      pa.array(np.concatenate(out[2]))], ["query_id", "hash", "vec_id", "score"])

    found = (entries.unionByName(asked).repartitionById(n, F.col("bucket")).sortWithinPartitions("kind")
             .mapInArrow(rerank, "query_id bigint, hash bigint, vec_id bigint, score double"))
    order = Window.partitionBy("query_id", "hash").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
