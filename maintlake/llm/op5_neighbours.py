"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves; each half has its own centroids, fitted on a bounded sample. A pair of centroids is a cell,
and every vector is indexed in its cell. A query orders the centroids of either half by their inner product with its own
half and walks over the pairs by the sum of both with a heap, best first, until the cells passed hold the wanted
number of vectors. What they hold is ranked by the exact inner product.

Equal vectors are one entry with as many of their smallest ids as an answer can hold. Cells are packed into blocks of
bounded size (a larger cell is cut by hash); a query goes, with a bit for each of its cells, to the blocks that hold any.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from maintlake.llm.links import each_group
from maintlake.llm.shared import require, saved
from maintlake.llm.vectors import every, matrix, spread, usable


def centroids(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from a random choice of points; fewer points than ``k`` are repeated."""
    rng = np.random.default_rng(seed)
    at = points[rng.choice(len(points), k, replace=len(points) < k)].copy()
    for _ in range(rounds):
        own = nearest(points, at)
        sums = np.zeros_like(at)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=k)
        at = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], at)
    return at


def nearest(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.argmax(points @ at.T - (at**2).sum(axis=1) / 2, axis=1)


@dataclass(frozen=True)
class MultiIndex:
    first: np.ndarray
    second: np.ndarray

    @property
    def k(self) -> int:
        return len(self.first)

    def cells(self, points: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return nearest(points[:, :half], self.first) * self.k + nearest(points[:, half:], self.second)

    def walk(self, query: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Cells by summed inner products of their centroids with the query, until they hold ``wanted`` vectors."""
        half = self.first.shape[1]
        one, two = -(self.first @ query[:half]), -(self.second @ query[half:])
        a, b = np.argsort(one, kind="stable").tolist(), np.argsort(two, kind="stable").tolist()
        one, two = np.sort(one).tolist(), np.sort(two).tolist()
        k, held, out = self.k, 0, []
        heap = [(one[0] + two[0], 0, 0)]
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = a[i] * k + b[j]
            n = counts[cell]
            if n:
                out.append(cell)
                held += n
            # (i, j) is reached from its left neighbour, and row i is opened by its predecessor in column 0
            if j + 1 < k:
                heapq.heappush(heap, (one[i] + two[j + 1], i, j + 1))
            if j == 0 and i + 1 < k:
                heapq.heappush(heap, (one[i + 1] + two[0], i + 1, 0))
        return out


def block_best(cell, values, allowed, queries, first_ids, k: int):
    """For each query the entries of allowed cells that can be among its ``k`` best: (query, entry, score)."""
    score = queries @ values.T
    score[~allowed[:, cell]] = -np.inf
    if score.shape[1] > k:
        kth = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        query, entry = np.nonzero((score >= kth[:, None]) & np.isfinite(score))
    else:
        query, entry = np.nonzero(np.isfinite(score))
    found = score[query, entry]
    # equal scores at the edge: the entries with the smallest ids
    order = np.lexsort((first_ids[entry], -found, query))
    query, entry, found = query[order], entry[order], found[order]
    nth = np.arange(query.size) - np.searchsorted(query, query)
    return query[nth < k], entry[nth < k], found[nth < k]


def neighbours(
    vectors: DataFrame,
    every_nth: int = 20,
    k: int = 20,
    vector: str = "embedding",
    centroids_a_half: int = 64,
    share: float = 0.5,
    least: int = 4096,
    max_sample: int = 20_000,
    block_rows: int = 8192,
    query_rows: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` vectors of largest inner product that the index finds.

    Queries are rows whose vec_id is divisible by ``every_nth``; candidates are all rows with another id. A query's walk
    ends when its cells hold ``share`` of all vectors, and ``least`` at least; with ``share`` 1 the answer is exact.
    Centroids are fitted on at most ``max_sample`` distinct vectors, chosen by a hash; every vector is indexed. Equal
    scores go to smaller ids; fewer candidates than ``k`` are all returned. Vectors that are null, zero, of unusual length,
    or hold null or non-finite components take no part, nor do rows without id. Rows that are equal in id and vector are
    one; different vectors under one id are queries each. Other columns are ignored.
    """
    require(vectors, "vec_id", vector)
    rows = usable(vectors, vector, zero=False).select("vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector")).distinct()
    rows = saved(rows)
    order = Window.partitionBy("vector").orderBy("vec_id")
    # one more than an answer holds: the query's own id may be among them
    kept = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k + 1)
    entries = kept.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = saved(entries.withColumn("entry", F.monotonically_increasing_id()))
    total = entries.count()
    part = min(1.0, max_sample / max(total, 1))
    chosen = entries.filter(F.pmod(F.xxhash64("entry"), F.lit(1 << 30)) < int(part * (1 << 30))).select("vector").toPandas()
    if not len(chosen):
        chosen = entries.select("vector").limit(1).toPandas()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], empty)
    sample = np.stack(chosen["vector"].to_numpy())
    half = sample.shape[1] // 2
    index = MultiIndex(centroids(sample[:, :half], centroids_a_half), centroids(sample[:, half:], centroids_a_half))
    n_cells = index.k**2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("cell", pa.array(index.cells(matrix(batch.column(0))).astype(np.int32)))

    indexed = saved(entries.mapInArrow(place, "vector array<double>, ids array<long>, entry long, cell int"))
    # at most centroids_a_half ** 2 rows
    sizes = indexed.groupBy("cell").agg(F.count("*").alias("entries"), F.sum(F.size("ids")).alias("rows")).toPandas()
    counts, members = np.zeros(n_cells, np.int64), np.zeros(n_cells, np.int64)
    members[sizes["cell"]], counts[sizes["cell"]] = sizes["entries"], sizes["rows"]
    cuts = np.maximum(1, -(-members // block_rows))
    whole = np.where(cuts == 1, members, 0)
    # cells of one block lie side by side; a cell that is cut has blocks of its own
    packed = (np.cumsum(whole) - whole) // block_rows
    starts = np.where(cuts == 1, packed, packed.max() + 1 + np.cumsum(np.where(cuts > 1, cuts, 0)) - cuts)
    wanted = max(least, int(share * counts.sum()))
    held = counts.tolist()
    asked = rows.filter(F.col("vec_id") % every_nth == 0).join(entries.select("entry", "vector"), "vector")
    asked = saved(asked.select("vec_id", "entry"))
    searched = entries.join(asked.select("entry").distinct(), "entry").select("entry", "vector")
    parts = max(1, -(-asked.count() // query_rows))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, at, masks = [], [], []
            for i, q in enumerate(matrix(batch.column(1)) if batch.num_rows else ()):
                cells = np.array(index.walk(q, held, wanted))
                bits = np.zeros(n_cells, bool)
                bits[cells] = True
                mask = np.packbits(bits).tobytes()
                to = {b for c in cells for b in range(starts[c], starts[c] + cuts[c])}
                block += to
                at += [i] * len(to)
                masks += [mask] * len(to)
            if block:
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int32()), taken.column(0), taken.column(1), pa.array(masks, pa.binary())],
                    names=["block", "entry", "vector", "mask"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.asarray(batch.column(1))
            own = starts[cell] + np.asarray(batch.column(0)) % cuts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *batch.columns[1:]], names=["block", *batch.schema.names[1:]])

    columns = ["cell", "entry", "vector", "ids"]
    ddl = "block int, cell int, entry long, vector array<double>, ids array<long>"
    stored = indexed.select(F.pmod(F.xxhash64("entry"), F.lit(1 << 40)).alias("spread"), *columns).mapInArrow(pack, ddl)
    stored = stored.select(
        "block", every(parts).alias("part"), F.lit(0).alias("kind"), "entry", "vector", "cell", "ids",
        F.lit(None).cast("binary").alias("mask"),
    )
    walking = searched.mapInArrow(probes, "block int, entry long, vector array<double>, mask binary").select(
        "block", spread(F.col("entry"), parts).alias("part"), F.lit(1).alias("kind"), "entry", "vector",
        F.lit(0).alias("cell"), F.lit(None).cast("array<long>").alias("ids"), "mask",
    )

    def work(group: pa.Table) -> pa.RecordBatch | None:
        kind = np.asarray(group.column("kind"))
        if kind.min() == kind.max():
            return None
        mine, theirs = group.filter(pa.array(kind == 0)), group.filter(pa.array(kind == 1))
        ids = mine.column("ids").combine_chunks()
        offsets, flat = np.append(0, np.cumsum(np.asarray(ids.value_lengths()))), np.asarray(ids.flatten())
        masks = np.frombuffer(b"".join(theirs.column("mask").to_pylist()), np.uint8).reshape(theirs.num_rows, -1)
        allowed = np.unpackbits(masks, axis=1)[:, :n_cells].astype(bool)
        query, entry, score = block_best(
            np.asarray(mine.column("cell")), matrix(mine.column("vector")), allowed, matrix(theirs.column("vector")),
            flat[offsets[:-1]], k + 1,
        )
        sizes = offsets[entry + 1] - offsets[entry]
        at = np.repeat(offsets[entry] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        numbers = np.asarray(theirs.column("entry"))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(numbers[query], sizes)), pa.array(flat[at]), pa.array(np.repeat(score, sizes))],
            names=["entry", "vec_id", "score"],
        )

    near = each_group(stored.unionByName(walking), ["block", "part"], work, "entry long, vec_id long, score double")
    best = Window.partitionBy("entry").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    answers = asked.withColumnRenamed("vec_id", "query_id").join(near, "entry").filter("query_id <> vec_id")
    rank = Window.partitionBy("query_id", "entry").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
