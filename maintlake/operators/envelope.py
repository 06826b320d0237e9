"""CDC envelopes: parsing, routing, checking and building them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from maintlake.functions.timestamps import is_iso, iso_date
from maintlake.schemas import BRONZE, ENTITY_TABLES, ENTITY_TOPICS, ENVELOPE, OPS

QUARANTINE = "quarantine"
_CORRUPT = "_corrupt"
_PARSE_AS = StructType(ENVELOPE.fields + [StructField(_CORRUPT, StringType())])


def _choose(key: Column, choices: Mapping[str, str]) -> Column:
    """``choices[key]`` as a CASE expression; null where there is none."""
    picked = F.lit(None).cast("string")
    for name, value in choices.items():
        picked = F.when(key == name, F.lit(value)).otherwise(picked)
    return picked


def _parsed(raw: DataFrame, value: str, keep: Sequence[str] = ()) -> DataFrame:
    text = F.col(value).cast("string")
    event = F.from_json(text, _PARSE_AS, {"columnNameOfCorruptRecord": _CORRUPT})
    return raw.select(text.alias("payload_json"), event.alias("e"), *keep)


def parse_envelopes(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Raw JSON documents -> the Bronze columns, plus ``route``, ``reject_reason`` and ``keep``.

    ``route`` is the table an event belongs to, or ``quarantine`` for malformed JSON, a missing
    required field, an event time that is no ISO-8601 date or time, or an unknown entity; ``reject_reason`` says which.
    Such a time gives no ``event_date``, so the dates of the log are dates. The JSON text is kept as is.
    """
    required = ("e.entity", "e.op", "e.event_ts", "e.pk.id", "e.source.system")
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    table = _choose(F.col("e.entity"), ENTITY_TABLES)
    reason = (
        F.when(F.col("e").isNull() | F.col(f"e.{_CORRUPT}").isNotNull(), "malformed_json")
        .when(missing, "missing_field")
        .when(~is_iso("e.event_ts"), "bad_event_time")
        .when(table.isNull(), "unknown_entity")
    )
    return (
        _parsed(raw, value, keep)
        .select(
            F.col("e.entity").alias("entity"),
            F.col("e.op").alias("op"),
            F.col("e.event_ts").alias("event_ts"),
            F.col("e.pk.id").alias("pk_id"),
            "payload_json",
            F.when(is_iso("e.event_ts"), iso_date("e.event_ts")).alias("event_date"),
            F.col("e.source.system").alias("source_system"),
            table.alias("route"),
            reason.alias("reject_reason"),
            *keep,
        )
        .withColumn("route", F.when(F.col("reject_reason").isNull(), F.col("route")).otherwise(QUARANTINE))
    )


def bronze_columns(events: DataFrame) -> DataFrame:
    return events.select(*BRONZE.names)


def envelope_report(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row of structural violation counts over all documents (one pass, no shuffle of rows)."""
    bad = {
        "malformed": F.col("e").isNull() | F.col(f"e.{_CORRUPT}").isNotNull(),
        "missing_entity": F.col("e.entity").isNull(),
        "missing_event_ts": F.col("e.event_ts").isNull(),
        "missing_pk": F.col("e.pk.id").isNull(),
        "missing_source": F.col("e.source.system").isNull(),
        "bad_op": F.col("e.op").isNull() | ~F.col("e.op").isin(*OPS),
    }
    return _parsed(raw, value).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(condition).alias(name) for name, condition in bad.items()],
    )


def envelope_json(
    entity: Column | str,
    op: Column,
    event_ts: Column,
    pk_id: Column,
    after: Column,
    before: Column | None = None,
    system: Column | str = "driver",
    version: str = "1.0",
) -> Column:
    """JSON text of one envelope; ``before`` and ``after`` are structs, all-null ones print as ``{}``."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.to_json(
        F.struct(
            lit(entity).alias("entity"),
            op.alias("op"),
            event_ts.alias("event_ts"),
            F.struct(pk_id.alias("id")).alias("pk"),
            (before if before is not None else F.from_json(F.lit("{}"), "id string")).alias("before"),
            after.alias("after"),
            F.struct(lit(system).alias("system"), F.lit(version).alias("version")).alias("source"),
        )
    )


def snapshot_diff(
    prev: DataFrame,
    curr: DataFrame,
    key: str,
    entity: str,
    event_ts: str,
    system: str = "driver",
) -> DataFrame:
    """Change feed between two snapshots of one table, as Bronze rows.

    Keys only in ``curr`` are creates, only in ``prev`` deletes (empty ``after``), and keys whose
    columns differ are updates; equal rows give no event. One full outer join on the key.
    """
    columns = curr.columns
    images = [
        df.select(F.col(key).alias("pk_id"), F.struct(*columns).alias(side))
        for df, side in ((prev, "before"), (curr, "after"))
    ]
    op = (
        F.when(F.col("before").isNull(), "c")
        .when(F.col("after").isNull(), "d")
        .when(~F.col("before").eqNullSafe(F.col("after")), "u")
    )
    changes = (
        images[0].join(images[1], "pk_id", "full_outer").withColumn("op", op).filter(F.col("op").isNotNull())
    )

    def image(side: str) -> Column:
        # fields of a null struct are null, so a missing side prints as {}
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns])

    payload = envelope_json(
        entity, F.col("op"), F.lit(event_ts), F.col("pk_id").cast("string"), image("after"), image("before"), system
    )
    return changes.select(
        F.lit(entity).alias("entity"),
        "op",
        F.lit(event_ts).alias("event_ts"),
        F.col("pk_id").cast("string").alias("pk_id"),
        payload.alias("payload_json"),
        F.lit(event_ts[:10]).alias("event_date"),
        F.lit(system).alias("source_system"),
    )


def feed_messages(bronze: DataFrame) -> DataFrame:
    """Bronze rows -> (topic, key, value) messages keyed by primary key."""
    return bronze.select(
        _choose(F.col("entity"), ENTITY_TOPICS).alias("topic"),
        F.col("pk_id").alias("key"),
        F.col("payload_json").alias("value"),
    )


def required_columns(df: DataFrame, names: Sequence[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
