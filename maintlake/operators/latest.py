"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__latest_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row of each key that is greatest by ``order``; nulls in the order lose.

    ``rank = 1`` lets Spark keep one row per key in every map task (the partial WindowGroupLimit)
    before the only shuffle, so a key holding a third of all rows reaches its reducer as one row per
    map task. ``order`` should be total, or the winner among equal rows is arbitrary.
    """
    newest_first = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(ranked)).filter(F.col(_RANK) == 1).drop(_RANK)
