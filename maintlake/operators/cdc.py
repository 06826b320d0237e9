"""CDC resolution: change events -> current state, in full and incrementally."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from maintlake.operators.envelope import required_columns
from maintlake.operators.latest import latest_per_key

EVENT_COLUMNS = ("pk_id", "op", "event_ts", "payload_json", "source_system")


def event_order(columns: Sequence[str], tie: Sequence[str] = (), normalise_ts: bool = False) -> list[Column]:
    """Total order of the events of one key, latest greatest.

    ``event_ts`` is compared as text, which is right while producers emit one UTC offset;
    ``normalise_ts`` compares instants instead. Ties are broken by ``tie``, else by the log
    ``offset`` if the feed carries it (one key is always in one log partition), then by operation
    (create < update < delete), payload and source.
    """
    ts = F.try_to_timestamp("event_ts") if normalise_ts else F.col("event_ts")
    rest = [F.col("payload_json"), F.col("source_system")]
    if tie:
        return [ts, *[F.col(t) for t in tie], *rest]
    op_rank = F.when(F.col("op") == "c", 0).when(F.col("op") == "u", 1).when(F.col("op") == "d", 2)
    log_order = [F.col("offset")] if "offset" in columns else []
    return [ts, *log_order, op_rank, *rest]


def latest_events(bronze: DataFrame, tie: Sequence[str] = (), normalise_ts: bool = False) -> DataFrame:
    """Latest event of each key, deletes included. Only the needed columns enter the shuffle."""
    required_columns(bronze, EVENT_COLUMNS)
    order_columns = list(tie) or (["offset"] if "offset" in bronze.columns else [])
    narrow = bronze.select(*EVENT_COLUMNS, *order_columns)
    return latest_per_key(narrow, ["pk_id"], event_order(narrow.columns, tie, normalise_ts))


def current_rows(latest: DataFrame, after: StructType) -> DataFrame:
    """Latest events -> current rows: deletes drop out, the ``after`` image becomes columns.

    JSON is parsed here, after the shuffle, so once per surviving key and not once per event. Fields
    that are missing, unreadable or of the wrong type are null; so is every field without ``after``.
    """
    parsed = F.from_json("payload_json", StructType([StructField("after", after)]))
    return (
        latest.filter(F.col("op") != "d")
        .withColumn("state", parsed)
        .select(
            *[F.col(f"state.after.{f.name}").alias(f.name) for f in after.fields],
            "source_system",
            F.col("pk_id").alias("source_id"),
            F.col("op").alias("last_op"),
            F.col("event_ts").alias("last_event_ts"),
        )
    )


def resolve_cdc(
    bronze: DataFrame,
    existing: DataFrame | None,
    after: StructType,
    tie: Sequence[str] = (),
    normalise_ts: bool = False,
) -> DataFrame:
    """Events, and optionally the table they change, -> the new current-state table.

    Keys with events take the state of their latest one (none after a delete); all other existing
    rows stay. A batch of deletes only therefore removes its rows, and an empty batch changes
    nothing. Existing rows without a key are not valid rows and drop out.

    Events without a key change nothing in a table. A key whose latest event has no operation keeps its existing row.
    The new rows and the changed keys come from one resolved batch, which is read and shuffled once. While
    the keys are few Spark broadcasts them by their measured size and the existing table is not
    shuffled; otherwise it is shuffled once.
    """
    if existing is None:
        return current_rows(latest_events(bronze, tie, normalise_ts), after)
    # without null keys both uses below ask for the same rows, so that Spark shares their shuffle
    latest = latest_events(bronze.filter(F.col("pk_id").isNotNull()), tie, normalise_ts)
    fresh = current_rows(latest, after)
    changed = latest.filter(F.col("op").isNotNull()).select(F.col("pk_id").alias("source_id"))
    untouched = existing.filter(F.col("source_id").isNotNull()).join(changed, "source_id", "left_anti")
    return untouched.unionByName(fresh, allowMissingColumns=True).select(
        *fresh.columns, *[c for c in existing.columns if c not in fresh.columns]
    )


def merge_state(state: DataFrame | None, batch: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """State table (latest event per key, deletes kept as tombstones) after a batch in any order.

    A batch event wins only if it is not older than the stored one, so late events cannot overwrite
    newer state or bring a deleted key back. State and batch go through one aggregation: one shuffle.
    """
    events = batch if state is None else state.unionByName(batch.select(*state.columns))
    return latest_events(events, tie)
