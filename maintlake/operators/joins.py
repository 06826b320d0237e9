"""Join shapes shared by rollups and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from maintlake.session import shared_dir


def left_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, lookup_key: str, spread: str, only: Column | None = None
) -> DataFrame:
    """``facts`` with the columns of the matching ``lookup`` row, which is unique by ``lookup_key``.

    Facts without a key, or outside ``only``, match nothing. They are partitioned by ``spread``
    instead of meeting in the task of the null key; the extra conditions keep that substitute from
    matching by accident. A hot key that is not null is split by adaptive execution.
    """
    wanted = F.col(key).isNotNull() if only is None else F.col(key).isNotNull() & only
    on = (F.coalesce(key, spread) == F.col(lookup_key)) & wanted
    return facts.join(lookup, on, "left").drop(lookup_key)


def settle(few: DataFrame) -> DataFrame:
    """Compute a frame of a few rows once, for a query that reads it several times.

    The rows go to reliable checkpoint storage, so losing an executor does not lose them, and the
    plans built on the result start from them instead of repeating what led there.
    """
    context = few.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(few.sparkSession))
    return few.checkpoint()
