"""Vector columns: which rows take part in a search, and the blocks in which a query set meets all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vectors: DataFrame, vector: str, zero: bool) -> DataFrame:
    """``vec_id, vector`` (array<double>) of rows that take part: id not null, components all there and finite, of the
    most common length (equally common: the shorter), with ``zero`` false not all 0."""
    x = F.col(f"`{vector}`").cast("array<double>")
    whole = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    if not zero:
        whole = whole & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(F.when(x.isNotNull(), whole), F.lit(False))
    )
    length = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1)
    found = length.collect()
    return rows.filter(F.size("vector") == (found[0]["d"] if found else 0))


def spread(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=float).reshape(len(column), -1)
