"""Micro-batch ingest of the CDC feed into the raw event log."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, functions as F

from maintlake.operators.envelope import parse_envelopes
from maintlake.sources.event_days import EVENTS
from maintlake.sources.tables import TableStore


def without_repeats(raw: DataFrame) -> DataFrame:
    """Drop documents that arrive again, however late.

    Identity is the digest of the whole document, so only true redeliveries go. There is no watermark, which would
    drop distinct late documents too: the digests seen stay in the state store for as long as the checkpoint lives.
    :func:`not_stored` asks the log instead and keeps nothing.
    """
    return raw.withColumn("digest", F.sha2(F.col("value").cast("string"), 256)).dropDuplicates(["digest"]).drop("digest")


def not_stored(store: TableStore, events: DataFrame, load_id: str) -> DataFrame:
    """Parsed events without those whose document another load has stored already, and each document once.

    A document that is delivered again has the event time it had before, so it can only lie in the same route and date of
    the log: only the dates of the batch are read there. Nothing has to be remembered, however late a redelivery comes,
    and a late document that differs stays.
    """
    digest = F.sha2(F.coalesce("payload_json", F.lit("")), 256)
    days = [r[0] for r in events.select("event_date").distinct().collect()]  # dates: see parse_envelopes
    day = F.col("event_date")
    here = day.isin(*[d for d in days if d is not None]) | (day.isNull() if None in days else F.lit(False))
    log = store.spark.table(EVENTS).filter(here & (F.col("load_id") != load_id))
    seen = log.select(F.col("route").alias("stored_route"), digest.alias("stored_digest")).distinct()
    fresh = events.withColumn("digest", digest).dropDuplicates(["route", "digest"])
    again = (F.col("route") == F.col("stored_route")) & (F.col("digest") == F.col("stored_digest"))
    return fresh.join(seen, again, "left_anti").drop("digest")


def ingest_available(
    store: TableStore, raw: DataFrame, feed: str = "cdc", *, checkpoint: str, drop_repeats: bool = False
) -> int:
    """Drain what the feed holds now into the log, then stop; returns the events stored.

    The checkpoint remembers the offsets, so the next call goes on where this one ended. Batches are
    stored under ``<feed>-<query>-<batch>``, which makes a batch repeated after a lost driver or executor
    replace its first attempt. The query's id is kept in its checkpoint: another checkpoint counts its batches
    from 0 again, but never replaces what this one stored. ``drop_repeats`` leaves out documents that the log holds
    already (see :func:`not_stored`).
    """
    store.create_event_log()
    stored = 0
    started = threading.Event()

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal stored
        started.wait()
        load_id, target = f"{feed}-{query.id}-{batch_id:012d}", TableStore(batch.sparkSession)
        events = parse_envelopes(batch, keep=_feed_columns(batch))
        stored += target.append_events(not_stored(target, events, load_id) if drop_repeats else events, load_id)

    query = (
        raw.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set()
    query.awaitTermination()
    store.spark.catalog.refreshTable("bronze.event_log")
    return stored


def ingest_batch(store: TableStore, raw: DataFrame, load_id: str) -> int:
    """The same for a bounded set of documents."""
    store.create_event_log()
    return store.append_events(parse_envelopes(raw, keep=_feed_columns(raw)), load_id)


def _feed_columns(raw: DataFrame) -> tuple[str, ...]:
    """What the feed says about the place of a message."""
    return tuple(c for c in ("topic", "partition", "offset") if c in raw.columns)
