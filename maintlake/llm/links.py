"""Shared parts of the similarity joins: connected components, families of candidates, and their comparison in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.shared import dropped, saved


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b): the smallest node of its connected component.

    Alternates large-star and small-star steps until every node points at its component's smallest one; the number of
    rounds grows with the logarithm of the size. Minima are aggregated before they are joined back, so a node with very
    many neighbours is never gathered in one place.
    """
    now = saved(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = saved(large.filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        after = saved(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        dropped(now, large)
        now = after
        before, mark = mark, _mark(now)
        if mark == before:
            break
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = saved(ends.unionAll(ends.select("component", "component").distinct()))
    dropped(now)
    return found


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0)).alias("s")
    ).first()
    return row["n"], row["s"]


def families(postings: DataFrame) -> DataFrame:
    """``node, family``: nodes that share a ``token`` in ``postings`` (token, node) are in one family, through any number of steps.

    One star a token (each node and the token's smallest one) instead of its pairs.
    """
    hubs = postings.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub <> other")
    stars = postings.join(hubs.select("token", "hub"), "token").filter("node <> hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    return components(stars).withColumnRenamed("component", "family")


def in_blocks(members: DataFrame, weight: str, limit: int) -> DataFrame:
    """``members`` (family, node, ...) with ``left`` and ``right``: blocks of a family that are compared with each other.

    A family of up to ``limit`` total weight is one block. A larger one is cut by a hash of the node, and each member
    goes to every pair of blocks with its own, so that no task has to hold a whole family.
    """
    cut = members.groupBy("family").agg(F.ceil(F.sum(weight) / limit).cast("int").alias("__blocks")).filter("__blocks > 1")
    own = F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int")
    sized = members.join(cut, "family", "left").withColumn("__blocks", F.coalesce("__blocks", F.lit(1)))
    spread = sized.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return spread.withColumns(
        {"left": F.least("__own", "__other"), "right": F.greatest("__own", "__other"), "block": F.col("__own")}
    ).drop("__blocks", "__own", "__other")


def each_group(
    df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``work`` on the rows of every group of ``keys``, streamed over sorted partitions: small groups cost no call
    into Spark each, and a task holds one group at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in keys]
            change = np.zeros(batch.num_rows, bool)
            change[0] = True
            for n in names:
                change[1:] |= n[1:] != n[:-1]
            cuts = np.append(np.flatnonzero(change), batch.num_rows)
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                key = tuple(n[lo] for n in names)
                if held and key != now:
                    if (out := work(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                now = key
                held.append(batch.slice(lo, hi - lo))
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(rows, schema)


class Groups:
    """Disjoint sets of the numbers below ``n``."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j
