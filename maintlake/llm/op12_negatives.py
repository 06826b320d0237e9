"""Hard-negative mining by an inverted multi-index whose walks stop with a certificate.

Vectors are cut in two halves; each half has a codebook, fitted on a bounded sample, and for every code the radius
that holds all vectors of that code. A pair of codes is a cell. By Cauchy and Schwarz an anchor's score in a cell is at
most its inner product with both centroids plus, for each half, its own length times the radius. A heap merges the two
lists of half bounds and so visits cells from the highest bound down, or stops before the first that lies under a score.

Two walks make a search. The first one, over the cells of the highest bounds, finds enough rows to say under which score
nothing can count any more; the second one visits every cell whose bound reaches that score (and, for windows, whose lower
bound isn't above them), so its answer is exact. Positives are searched first. Their scores fix the windows in which
negatives are searched in the same way.

Cells are packed into blocks of bounded size (a larger cell is cut by a hash), and anchors go, with a bit for each cell
of their walk, to the blocks that hold any. Blocks return a few rows for each anchor or window.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from maintlake.llm.links import each_group
from maintlake.llm.op5_neighbours import centroids, nearest
from maintlake.llm.shared import require, saved
from maintlake.llm.vectors import every, matrix, spread

#: Scores up to here are whole numbers that doubles add exactly.
_EXACT = float(1 << 53)


@dataclass(frozen=True)
class Codebooks:
    #: Centroids and radii of both halves, and how many rows each cell holds.
    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray

    @property
    def k(self) -> int:
        return len(self.centres[0])

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.centres[0].shape[1]
        return points[:, :half], points[:, half:]

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half the greatest and the least score that its part of the anchor can have with a vector of each code."""
        out = []
        for part, at, radius in zip(self.halves(anchor[None, :]), self.centres, self.radii):
            middle, reach = at @ part[0], np.linalg.norm(part[0]) * radius
            slack = 1e-9 * (np.abs(middle) + reach) + 1e-6  # the bounds are rounded, the scores aren't
            out.append((middle + reach + slack, middle - reach - slack))
        return out

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[int, float, float]]:
        """Cells that hold rows, with their upper and lower bounds, by falling upper bound."""
        (one, low_one), (two, low_two) = self.bounds(anchor)
        a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        up, across = one[a].tolist(), two[b].tolist()
        heap = [(-(up[0] + across[0]), 0, 0)]
        k = self.k
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = int(a[i]) * k + int(b[j])
            if self.sizes[cell]:
                yield cell, -bound, float(low_one[a[i]] + low_two[b[j]])
            # (i, j) is reached from its left neighbour, and row i is opened by its predecessor in column 0
            if j + 1 < k:
                heapq.heappush(heap, (-(up[i] + across[j + 1]), i, j + 1))
            if j == 0 and i + 1 < k:
                heapq.heappush(heap, (-(up[i + 1] + across[0]), i + 1, 0))

    def first_cells(self, anchor: np.ndarray, rows: int, top: float) -> np.ndarray:
        """Cells of the highest bounds that hold so many rows, without those that lie above ``top`` altogether."""
        out, held = [], 0
        for cell, _, low in self.walk(anchor):
            if low <= top:
                out.append(cell)
                held += int(self.sizes[cell])
                if held >= rows:
                    break
        return np.array(out, np.int64)

    def certified_cells(self, anchor: np.ndarray, least: float, top: float) -> np.ndarray:
        """All cells that can hold a score from ``least`` to ``top``."""
        out = []
        for cell, bound, low in self.walk(anchor):
            if bound < least:
                break
            if low <= top:
                out.append(cell)
        return np.array(out, np.int64)


@dataclass(frozen=True)
class Index:
    books: Codebooks
    #: row, vec_id, label, vector, cell.
    rows: DataFrame
    #: First block of each cell, and into how many it is cut.
    starts: np.ndarray
    cuts: np.ndarray


def scaled_rows(vectors: DataFrame, vector: str, scale: float, relabel_every: int, labels: int) -> DataFrame:
    """``row, vec_id, label, vector`` (whole numbers) of the rows that take part, each once."""
    x = F.col("vector")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    rows = rows.filter((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    largest = F.max(F.array_max(F.transform(x, lambda v: F.abs(v * F.lit(scale))))).alias("largest")
    lengths = rows.groupBy(F.size(x).alias("d")).agg(F.count("*").alias("n"), largest).orderBy(F.desc("n"), "d").limit(1).collect()
    d, top = (lengths[0]["d"], lengths[0]["largest"] + 1) if lengths else (0, 0.0)
    if top * top * d > _EXACT:
        raise ValueError("components are too large for exact scores")
    changed = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("double"))
    kept = rows.filter(F.size(x) == d).select("vec_id", changed.alias("label"), whole.alias("vector")).distinct()
    return saved(kept.withColumn("row", F.monotonically_increasing_id()))


def built(rows: DataFrame, n: int, codes_a_half: int | None, max_sample: int, block_rows: int) -> Index:
    """Index of all ``n`` rows; the codebooks grow with the fourth root of the table and are fitted on a bounded sample."""
    k = codes_a_half or min(256, max(1, round(2 * n**0.25)))
    part = min(1.0, max_sample / n)
    chosen = rows.filter(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(part * (1 << 30))).select("vector").toPandas()
    if not len(chosen):
        chosen = rows.select("vector").limit(1).toPandas()
    sample = np.stack(chosen["vector"].to_numpy())
    half = sample.shape[1] // 2
    centres = tuple(centroids(x, k) for x in (sample[:, :half], sample[:, half:]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column(3))
                parts = points[:, :half], points[:, half:]
                codes = [nearest(p, at) for p, at in zip(parts, centres)]
                away = [np.linalg.norm(p - at[c], axis=1) for p, at, c in zip(parts, centres, codes)]
                more = (codes[0] * k + codes[1]).astype(np.int32), *away
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *(pa.array(c) for c in more)], names=[*batch.schema.names, "cell", "one", "two"]
                )

    ddl = "row long, vec_id long, label long, vector array<double>, cell int, one double, two double"
    placed = saved(rows.select("row", "vec_id", "label", "vector").mapInArrow(place, ddl))
    # at most k * k rows
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("one").alias("one"), F.max("two").alias("two")).toPandas()
    sizes, radii = np.zeros(k * k, np.int64), (np.zeros(k), np.zeros(k))
    sizes[cells["cell"]] = cells["n"]
    np.maximum.at(radii[0], cells["cell"] // k, cells["one"])
    np.maximum.at(radii[1], cells["cell"] % k, cells["two"])
    cuts = np.maximum(1, -(-sizes // block_rows))
    whole = np.where(cuts == 1, sizes, 0)
    # cells of one block lie side by side; a cell that is cut has blocks of its own
    packed = (np.cumsum(whole) - whole) // block_rows
    starts = np.where(cuts == 1, packed, packed.max() + 1 + np.cumsum(np.where(cuts > 1, cuts, 0)) - cuts)
    return Index(Codebooks(centres, radii, sizes), placed.drop("one", "two"), starts, cuts)


def in_windows(score: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each window the places of the ``k`` highest scores in it, equal ones by id; NaN is no score."""
    inside = np.flatnonzero((score >= low.min()) & (score <= high.max()))
    order = inside[np.lexsort((ids[inside], -score[inside]))]
    falling = -score[order]
    for w, (a, b) in enumerate(zip(low, high)):
        first = int(np.searchsorted(falling, -b))
        yield w, order[first : min(first + k, int(np.searchsorted(falling, -a, "right")))]


def search(index: Index, anchors: DataFrame, n_anchors: int, k: int, same_label: bool, first_rows: int | None, anchor_rows: int) -> DataFrame:
    """``anchor, window, vec_id, score, nth``: the ``k`` best rows in each of an anchor's windows of scores.

    ``anchors`` has row, vec_id, label, vector, low and high (bounds of the windows). With ``first_rows`` the walk ends at
    the cells that hold so many rows; without, it passes all cells that can hold a score of a window, and the answer is
    exact. Candidates have another id, and the anchor's label or, if ``same_label`` is false, another.
    """
    books, starts, cuts = index.books, index.starts, index.cuts
    parts = max(1, -(-n_anchors // anchor_rows))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, at, cells = [], [], []
            low, high = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for i, anchor in enumerate(matrix(batch.column(3)) if batch.num_rows else ()):
                least, top = min(low[i]), max(high[i])
                mine = books.certified_cells(anchor, least, top) if first_rows is None else books.first_cells(anchor, first_rows, top)
                nth = np.arange(int(cuts[mine].sum())) - np.repeat(np.cumsum(cuts[mine]) - cuts[mine], cuts[mine])
                to, held = np.repeat(starts[mine], cuts[mine]) + nth, np.repeat(mine, cuts[mine])
                order = np.argsort(to, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if to.size else ():
                    block.append(int(to[part[0]]))
                    at.append(i)
                    cells.append(held[part])
            if block:
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int32()), *taken.columns, pa.array(cells, pa.list_(pa.int32()))],
                    names=["block", *batch.schema.names, "cells"],
                )

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.asarray(batch.column(5))
            own = starts[cell] + np.asarray(batch.column(0)) % cuts[cell]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *batch.columns[1:]], names=["block", *batch.schema.names[1:]])

    plain = "row long, vec_id long, label long, vector array<double>"
    stored = index.rows.select(F.pmod(F.xxhash64("row"), F.lit(1 << 40)).alias("spread"), "row", "vec_id", "label", "vector", "cell")
    stored = stored.mapInArrow(dealt, f"block int, {plain}, cell int").select(
        "*", every(parts).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("array<double>").alias("low"),
        F.lit(None).cast("array<double>").alias("high"), F.lit(None).cast("array<int>").alias("cells"),
    )
    asking = anchors.select("row", "vec_id", "label", "vector", "low", "high").mapInArrow(
        walked, f"block int, {plain}, low array<double>, high array<double>, cells array<int>"
    ).select("*", spread(F.col("row"), parts).alias("part"), F.lit(1).alias("kind"), F.lit(0).alias("cell"))

    def work(group: pa.Table) -> pa.RecordBatch | None:
        kind = np.asarray(group.column("kind"))
        if kind.min() == kind.max():
            return None
        theirs, mine = group.filter(pa.array(kind == 0)), group.filter(pa.array(kind == 1))
        ids, labels, cell = (np.asarray(theirs.column(c)) for c in ("vec_id", "label", "cell"))
        rows, own, own_labels = (np.asarray(mine.column(c)) for c in ("row", "vec_id", "label"))
        scores = matrix(mine.column("vector")) @ matrix(theirs.column("vector")).T
        low, high, cells = (mine.column(c).to_pylist() for c in ("low", "high", "cells"))
        out: list[tuple[np.ndarray, ...]] = []
        for i in range(mine.num_rows):
            able = np.isin(cell, cells[i]) & (ids != own[i]) & ((labels == own_labels[i]) == same_label)
            score = np.where(able, scores[i], np.nan)
            for w, at in in_windows(score, ids, np.array(low[i]), np.array(high[i]), k):
                if at.size:
                    out.append((np.full(at.size, rows[i]), np.full(at.size, w), ids[at], score[at]))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["anchor", "window", "vec_id", "score"])

    found = each_group(stored.unionByName(asking), ["block", "part"], work, "anchor long, window long, vec_id long, score double")
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k)


def raised(anchors: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``anchors`` with the low ends of their windows raised to the ``k``-th score found in them, where there are so many."""
    kth = found.filter(F.col("nth") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
    low = F.transform("low", lambda a, w: F.greatest(a, F.coalesce(F.col("kth")[w.cast("long")], a)))
    return anchors.join(kth.withColumnRenamed("anchor", "row"), "row", "left").withColumn("low", low).drop("kth")


def hard_negatives(
    vectors: DataFrame,
    anchor_every: int = 100,
    k: int = 5,
    share: tuple[int, int] = (80, 100),
    vector: str = "embedding",
    scale: float = 256.0,
    relabel_every: int = 7,
    labels: int = 10,
    codes_a_half: int | None = None,
    max_sample: int = 20_000,
    first_rows: int = 4096,
    block_rows: int = 2048,
    anchor_rows: int = 1024,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, exact.

    Components become floor(scale * x), scores are inner products. Where ``relabel_every`` divides vec_id, the label first
    becomes (label + 1) % ``labels``. Anchors are the rows whose vec_id ``anchor_every`` divides. An anchor's positives are
    its ``k`` best rows of the same label; for each, the negatives are the ``k`` best rows of other labels whose score is
    at most the positive's and at least ``share`` of it. Equal scores go to smaller ids; fewer rows than ``k`` are all
    returned; a negative positive score has no negatives.

    Rows without id, label or vector, with null or non-finite components, or of unusual length take no part. Rows
    equal in id, label and vector are one; different ones under one id are rows each, but not candidates of each other. An
    empty table gives no rows. Components so large that scores couldn't be exact are a ValueError. Other columns are
    ignored. ``first_rows`` (of the first walk), the codebooks and blocks change the work, never the answer.
    """
    require(vectors, "vec_id", "label", vector)
    rows = scaled_rows(vectors, vector, scale, relabel_every, labels)
    n = rows.count()
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return vectors.sparkSession.createDataFrame([], empty)
    index = built(rows, n, codes_a_half, max_sample, block_rows)
    own = rows.filter(F.col("vec_id") % anchor_every == 0)
    anywhere = [F.array(F.lit(v).cast("double")).alias(name) for name, v in (("low", -math.inf), ("high", math.inf))]
    anchors = saved(own.select("row", "vec_id", "label", "vector", *anywhere))
    n_anchors = anchors.count()

    def settled(asked: DataFrame, same_label: bool) -> DataFrame:
        first = search(index, asked, n_anchors, k, same_label, first_rows, anchor_rows)
        return saved(search(index, saved(raised(asked, first, k)), n_anchors, k, same_label, None, anchor_rows))

    positives = settled(anchors, True).select(
        F.col("anchor").alias("row"), "nth", F.col("vec_id").alias("positive_id"), F.col("score").cast("long").alias("positive_score")
    )
    part, whole = share
    least = F.col("positive_score") * part
    # the least whole number that is at least this share: (x + (-x mod whole)) / whole
    lowest = (F.col("least") + F.pmod(-F.col("least"), F.lit(whole))) / F.lit(whole)
    windows = positives.withColumn("least", least).withColumn("low", lowest.cast("double")).filter(F.col("low") <= F.col("positive_score"))
    windows = saved(windows.withColumn("window", F.row_number().over(Window.partitionBy("row").orderBy("nth")).cast("long") - 1))
    listed = windows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "low", F.col("positive_score").cast("double").alias("high")))).alias("w"))
    asked = anchors.drop("low", "high").join(listed, "row").select("*", F.col("w.low").alias("low"), F.col("w.high").alias("high")).drop("w")
    negatives = settled(saved(asked), False).withColumnRenamed("anchor", "row")
    return (
        windows.select("row", "window", "positive_id", "positive_score")
        .join(negatives, ["row", "window"])
        .join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select(
            "anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").cast("long").alias("negative_score"),
        )
    )


ORACLE = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT a, c, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, c) AS r FROM s WHERE same)
  WHERE r <= 5),
n AS (
  SELECT p.a AS anchor_id, p.c AS positive_id, s.c AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.c ORDER BY s.score DESC, s.c) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
