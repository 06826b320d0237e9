"""Exact top-k by inner product without random access: sorted lists read in step, with bounds on every score.

Every block of rows has one list a dimension, sorted by component. A query reads the list of a dimension from its top
where its own component is positive, from its bottom where it is negative (where it is 0, not at all), all in step, one
slice after the other. A row's score is at least the sum of what was read of it plus, for each list where it wasn't met
yet, that list's far end, and at most the same with the last value read. Rows whose upper bound is under the least lower
bound of any k rows are outsiders. Reading stops when few others are left; their scores are then resolved from their rows.

Many queries read a block's lists together, so that a slice is read once for them: their bounds are matrix products of
their components with what is known of the rows.

One block is searched first: its k-th best score is a lower bound for all other blocks, so that most of their rows are
outsiders from the start. Sums are whole numbers, in doubles while all are sure to stay below 2^53, else in Python's integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from maintlake.llm.links import each_group
from maintlake.llm.shared import require, saved
from maintlake.llm.vectors import every, matrix, spread, usable

#: Slices a list is read in; bounds are compared after each.
SLICES = 16
#: Bounds that are held at once, of the queries that read a block's lists in step.
BOUNDS = 1 << 20


class SortedLists:
    """The lists of a block, one a dimension, and the reading of them for many queries in step."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, axis=0)
        #: Entries read so far, for all queries.
        self.entries = 0

    def met(self, known: np.ndarray, start: int, end: int, last: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read entries ``start`` to ``end`` of every list: marks them in ``known``, and gives each component's values next to
        and furthest from the list's beginning: its own if it was met, else the last one read and the list's other end."""
        known[self.order[start:end], np.arange(known.shape[1])] = True
        return np.where(known, self.rows, last), np.where(known, self.rows, far)

    def top(self, own: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query row numbers and scores of the ``k`` best rows with other ids that reach its ``least``, equal scores
        to smaller ids.

        What is known of the rows after a slice is the same for all queries that read a list from the same end: the
        bounds of all queries and rows are products of the weights with it.
        """
        n, dims = self.rows.shape
        falling, rising = np.where(queries > 0, queries, 0), np.where(queries < 0, queries, 0)
        bound = np.array(least, dtype=self.rows.dtype)
        inside: list[np.ndarray] = [np.flatnonzero(self.ids != i) for i in own]
        used = np.array([np.count_nonzero(q) for q in queries])
        reading = np.array([q for q in range(own.size) if used[q] and inside[q].size > 4 * k], int)
        own_rows = self.ids == own[:, None]
        above, below = np.zeros((n, dims), bool), np.zeros((n, dims), bool)
        edges = np.unique(np.linspace(0, n, SLICES + 1).astype(int))
        for start, end in zip(edges[:-1], edges[1:]):
            if not reading.size:
                break
            high, high_far = self.met(above, n - end, n - start, self.values[n - end], self.values[0])
            low, low_far = self.met(below, start, end, self.values[end - 1], self.values[-1])
            self.entries += int(used[reading].sum()) * int(end - start)
            down, up = falling[reading], rising[reading]
            upper = down @ high.T + up @ low.T
            upper[own_rows[reading]] = -np.inf
            # any k rows bound the k-th best score from below by their least lower bound
            chosen = np.argpartition(upper, n - k, axis=1)[:, n - k :]
            lower = (down[:, None, :] * high_far[chosen] + up[:, None, :] * low_far[chosen]).sum(axis=2)
            bound[reading] = np.maximum(bound[reading], lower.min(axis=1))
            left = upper >= bound[reading][:, None]
            left &= ~own_rows[reading]
            ended = (left.sum(axis=1) <= 4 * k) | (end == n)
            for i in np.flatnonzero(ended):
                inside[reading[i]] = np.flatnonzero(left[i])
            reading = reading[~ended]
        found = []
        for q, rows in enumerate(inside):
            score = self.rows[rows] @ queries[q]
            best = sorted(range(rows.size), key=lambda i: (-score[i], self.ids[rows[i]]))[:k]
            found.append((rows[best], score[best]))
        return found


def whole(score) -> int:
    if not -(1 << 63) <= int(score) < 1 << 63:
        raise OverflowError(f"the score {int(score)} does not fit a long")
    return int(score)


def block_top(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, least=None):
    """The ``k`` best rows of a block for each query, out of those that reach its ``least``: (query numbers, row numbers,
    scores, entries read)."""
    if float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1] >= 1 << 53:
        exactly = np.frompyfunc(int, 1, 1)
        rows, queries = exactly(rows), exactly(queries)
    lists = SortedLists(ids, rows)
    least = [-np.inf] * query_ids.size if least is None else least
    together = max(1, BOUNDS // max(ids.size, k * rows.shape[1]))
    asked, found, scores = [], [], []
    for start in range(0, query_ids.size, together):
        some = slice(start, start + together)
        for q, (best, score) in enumerate(lists.top(query_ids[some], queries[some], k, least[some]), start):
            asked += [q] * best.size
            found += best.tolist()
            scores += [whole(s) for s in score]
    return np.array(asked, int), np.array(found, int), np.array(scores, np.int64), lists.entries


def exact_top(
    vectors: DataFrame,
    every_nth: int = 100,
    k: int = 10,
    vector: str = "embedding",
    scale: float = 1024.0,
    block_rows: int = 4096,
    query_rows: int = 2048,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest integer inner product for each query.

    Components become floor(scale * x). Queries are rows whose vec_id is divisible by ``every_nth``; candidates are all
    rows with another id. Equal scores go to smaller ids; fewer candidates than ``k`` are all returned. Vectors that are
    null, empty, of unusual length, or hold null or non-finite components take no part, nor do rows without id; vectors of
    zeros do. A repeated row is a candidate each time. Rows with equal ids are queries each, and equal rows of the answer
    are returned for each of them. Query set and rows meet in blocks; each gives ``k`` rows a query at most. Components of any
    size give exact scores; one among a block's best that does not fit a long is an OverflowError.
    """
    require(vectors, "vec_id", vector)
    scaled = usable(vectors, vector, zero=True).withColumn("vector", F.transform("vector", lambda x: x * F.lit(scale)))
    # beyond 2^53 a double is a whole number already, and floor() ends at the largest long
    floor = F.transform("vector", lambda y: F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y))
    rows = saved(scaled.withColumn("vector", floor).withColumn("row", F.monotonically_increasing_id()))
    n = rows.count()
    asked = rows.filter(F.col("vec_id") % every_nth == 0)
    blocks, parts = max(1, -(-n // block_rows)), max(1, -(-asked.count() // query_rows))
    columns = ("block", "part", "kind", "row", "vec_id", "vector", "least")
    members = rows.select(
        "*", spread(F.col("row"), blocks).alias("block"), every(parts).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("least")
    ).select(*columns)
    probes = asked.select("*", spread(F.col("row"), parts).alias("part"), F.lit(1).alias("kind"))

    def work(table: pa.Table) -> pa.RecordBatch | None:
        kind = np.asarray(table.column("kind"))
        if kind.min() == kind.max():
            return None
        numbers, ids, values = np.asarray(table.column("row")), np.asarray(table.column("vec_id")), matrix(table.column("vector"))
        a, b = kind == 0, kind == 1
        least = [-np.inf if v is None else v for v in table.column("least").filter(pa.array(b)).to_pylist()]
        query, found, score, _ = block_top(ids[a], values[a], ids[b], values[b], k, least)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(numbers[b][query]), pa.array(ids[b][query]), pa.array(ids[a][found]),
                pa.array(score), pa.array(numbers[a][found]),
            ],
            names=["query", "query_id", "vec_id", "score", "row"],
        )

    def searched(members: DataFrame, probes: DataFrame) -> DataFrame:
        both = members.unionAll(probes.select(*columns))
        return each_group(both, ["block", "part"], work, "query long, query_id long, vec_id long, score long, row long")

    none = F.lit(None).cast("long")
    near = searched(members.filter("block = 0"), probes.withColumns({"block": F.lit(0), "least": none}))
    if blocks > 1:
        near = saved(near)
        reached = near.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k)
        known = probes.join(reached.select(F.col("query").alias("row"), "least"), "row", "left")
        rest = known.withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))))
        near = near.unionAll(searched(members.filter("block > 0"), rest))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
