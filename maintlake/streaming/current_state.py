"""Continuously maintained current state of a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from maintlake.operators.cdc import EVENT_COLUMNS
from maintlake.sources.bucketed import BucketedTable, fold_events


def state_table(spark: SparkSession, path: str, tie: StructType | None = None, buckets: int = 64) -> BucketedTable:
    """Where a feed's state is kept: the latest event per key, deletes included, with its tie-break columns."""
    columns = [StructField(c, StringType()) for c in EVENT_COLUMNS]
    return BucketedTable(spark, path, StructType([*columns, *(tie.fields if tie else ())]), ("pk_id",), buckets)


def maintain_state(bronze: DataFrame, state: BucketedTable, checkpoint: str, tie: Sequence[str] = ()) -> None:
    """Process what the stream holds now: each micro-batch is folded into the buckets of the keys it changes.

    The state is a table of one row per key, so readers resolve nothing, a batch costs what it touches, and the stream keeps
    nothing of its own but its offsets. A batch that is repeated after a failure, and late events, change nothing that is
    newer. Deleted keys stay as their delete, which has to go on beating older events.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_events(state, batch.select(*state.schema.names), tie)

    query = (
        bronze.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
