
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from maintlake.operators import gold, quality  # noqa: E402
from maintlake.operators.cdc import current_rows, merge_state, resolve_cdc  # noqa: E402
from maintlake.operators.envelope import (  # noqa: E402
    envelope_report,
    feed_messages,
    parse_envelopes,
    snapshot_diff,
)
from maintlake.plans.incremental import FrameLog, IncrementalRefresh  # noqa: E402
from maintlake.plans.lakehouse import Lakehouse, on_date  # noqa: E402
from maintlake.plans.named import NAMED  # noqa: E402
from maintlake.schemas import AFTER, ENVELOPE, TABLES, text_fields  # noqa: E402
from maintlake.session import apply_settings, shared_dir  # noqa: E402
from maintlake.sources import binding, replica  # noqa: E402
from maintlake.sources.bucketed import fold_events  # noqa: E402
from maintlake.sources.replica_changes import ReplicaTable  # noqa: E402
from maintlake.streaming.current_state import maintain_state, state_table  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
SMOKE_DIR = "/root/testdata/sf0.001"
SPLIT = "2024-01-16"


# --- change data ------------------------------------------------------------------------------------


def cdc_latest_state(t: binding.BoundTables) -> DataFrame:
    return resolve_cdc(t("bronze.asset"), None, binding.EVENT_AFTER, binding.ASSET_TIE)


def cdc_merge_incremental(t: binding.BoundTables) -> DataFrame:
    """The state before the split day, then the rest of the feed merged into it."""
    bronze = t("bronze.asset")
    early = resolve_cdc(bronze.filter(F.col("event_date") < SPLIT), None, binding.EVENT_AFTER, binding.ASSET_TIE)
    return resolve_cdc(bronze.filter(F.col("event_date") >= SPLIT), early, binding.EVENT_AFTER, binding.ASSET_TIE)


def cdc_merge_late(t: binding.BoundTables) -> DataFrame:
    """The feed since the split day first, then all older events arriving late, through the state table."""
    bronze = t("bronze.asset")
    older = F.col("event_date") < SPLIT
    state = merge_state(None, bronze.filter(~older), binding.ASSET_TIE)
    return current_rows(merge_state(state, bronze.filter(older), binding.ASSET_TIE), binding.EVENT_AFTER)


def cdc_action_state(t: binding.BoundTables) -> DataFrame:
    return resolve_cdc(
        t("bronze.maintenance_action"), None, AFTER["maintenance_action"], binding.ACTION_TIE
    )


def _entity_state(feed: str, entity_table: str) -> Callable[[binding.BoundTables], DataFrame]:
    return lambda t: resolve_cdc(t(f"bronze.{feed}"), None, AFTER[entity_table])


def backlog_from_feed(t: binding.BoundTables) -> DataFrame:
    """Raw order and request events -> current state -> backlog, in one plan."""
    orders = _entity_state("work_order", "work_order")(t)
    requests = _entity_state("work_request", "work_request")(t)
    return gold.work_order_backlog(orders, requests, t.stamp)


def stream_latest_state(t: binding.BoundTables) -> DataFrame:
    """The event log as a stream, kept as state by key, read back as the current rows."""
    work = f"{shared_dir(t.spark)}/stream_latest_state/{os.urandom(8).hex()}"
    # a stream reads folders or patterns; the pattern fits a single file and a folder of part files alike
    log = t.spark.readStream.schema(t.raw("events").schema).parquet(f"{t.sf_dir}/events.[p]arquet")
    feed = binding.asset_feed(log)
    state = state_table(t.spark, f"{work}/state", feed.select(*binding.ASSET_TIE).schema, buckets=16)
    maintain_state(feed, state, f"{work}/checkpoint", binding.ASSET_TIE)
    return current_rows(state.read(), binding.EVENT_AFTER)


def cdc_bucketed_state(t: binding.BoundTables) -> DataFrame:
    """The feed since the split day first, then the older events arriving late, folded into a bucketed state table."""
    bronze = t("bronze.asset")
    older = F.col("event_date") < SPLIT
    path = f"{shared_dir(t.spark)}/cdc_bucketed_state/{os.urandom(8).hex()}"
    state = state_table(t.spark, path, bronze.select(*binding.ASSET_TIE).schema, buckets=16)
    for batch in (bronze.filter(~older), bronze.filter(older)):
        fold_events(state, batch.select(*state.schema.names), binding.ASSET_TIE)
    return current_rows(state.read(), binding.EVENT_AFTER)


def refresh_incremental(t: binding.BoundTables) -> DataFrame:
    """Two rollups kept up to date load by load: the newer half of the feeds first, then the older half, arriving late."""
    load = F.when(F.col("event_date") < "1996-01-01", "older").otherwise("newer")
    feeds = {e: t(f"bronze.{e}").withColumn("load_id", load) for e in ("work_request", "work_order", "maintenance_action")}
    ties = {"maintenance_action": binding.ACTION_TIE}
    targets = ("gold.work_order_backlog", "gold.asset_maintenance_summary")
    root = f"{shared_dir(t.spark)}/refresh_incremental/{os.urandom(8).hex()}"
    for seen in ({e: f.filter("load_id = 'newer'") for e, f in feeds.items()}, feeds):
        lake = IncrementalRefresh(t.spark, root, FrameLog(seen, ties), buckets=4, targets=targets)
        lake.refresh(t.stamp)
    backlog, summary = (lake(name) for name in targets)
    none = F.lit(None)
    return backlog.select(
        F.lit("work_order_backlog").alias("rollup"), "asset_id", "priority", F.col("open_count").alias("orders"),
        none.cast("long").alias("completed_actions"), F.col("oldest_planned_start").alias("noted_at"),
    ).unionByName(
        summary.select(
            F.lit("asset_maintenance_summary").alias("rollup"), "asset_id", none.cast("string").alias("priority"),
            F.col("work_order_count").alias("orders"), F.col("completed_actions_count").alias("completed_actions"),
            F.col("last_maintenance_date").alias("noted_at"),
        )
    )


def bronze_parse(t: binding.BoundTables) -> DataFrame:
    messages = binding.event_messages(t.spread("events")).select("value", "event_id")
    return parse_envelopes(messages, keep=("event_id",)).select(
        "event_id", "entity", "op", "event_ts", "pk_id", "event_date", "source_system"
    )


def _mixed_documents(t: binding.BoundTables, with_actions: bool) -> DataFrame:
    """The event feed with one rejected document per order: unknown entity, no key, or cut-off JSON."""
    head = '{"entity":"Asset","op":"c","event_ts":"2024-01-01T00:00:00+00:00","source":{"system":"driver"}'
    pk = F.concat(F.lit(',"pk":{"id":"'), F.col("o_orderkey").cast("string"), F.lit('"}}'))
    status = F.col("o_orderstatus")
    rejected = (
        F.when(status == "F", F.concat(F.lit(head.replace("Asset", "Vehicle")), pk))
        .when(status == "P", F.lit(head + "}"))
        .otherwise(F.lit("{" + head))
    )
    documents = binding.event_messages(t.spread("events")).select("value")
    if with_actions:
        documents = documents.union(t("bronze.maintenance_action").select("payload_json"))
    return documents.union(t.raw("orders").select(rejected))


def bronze_route_counts(t: binding.BoundTables) -> DataFrame:
    return (
        parse_envelopes(_mixed_documents(t, with_actions=True))
        .groupBy("route", "reject_reason")
        .agg(F.count(F.lit(1)).alias("events"))
    )


def bronze_date_slice(t: binding.BoundTables) -> DataFrame:
    return on_date(t("bronze.asset"), "2024-01-05").select("event_id", "op", "event_ts", "pk_id", "event_date")


def snapshot_diff_cdc(t: binding.BoundTables) -> DataFrame:
    """Changes that lead from the actions known at the start of 1996 to the final ones."""
    events = binding.action_events(t.raw("lineitem"))
    prev = binding.action_snapshot(events.filter(F.col("event_ts") < "1996-01-01"))
    curr = binding.action_snapshot(events)
    feed = snapshot_diff(prev, curr, "id", "MaintenanceAction", t.stamp)
    return feed.select(
        "pk_id",
        "op",
        F.get_json_object("payload_json", "$.before.status").alias("status_before"),
        F.get_json_object("payload_json", "$.after.status").alias("status_after"),
    )


def feed_message_keys(t: binding.BoundTables) -> DataFrame:
    """Messages of the feed; the value is compared by the event it carries."""
    return feed_messages(t("bronze.asset")).select(
        "topic",
        "key",
        F.get_json_object("value", "$.op").alias("op"),
        F.get_json_object("value", "$.event_ts").alias("event_ts"),
    )


#: What is read back from a message's text, in one pass over it.
_READ_BACK = StructType(
    [
        *ENVELOPE.fields,
        StructField(
            "after",
            text_fields(
                "id", "status", "asset_id", "work_order_id", "description", "event_type", "planned_start"
            ),
        ),
    ]
)


def feed_messages_topics(t: binding.BoundTables) -> DataFrame:
    """Messages of all four topics; the values are compared by what is read back from their text."""
    messages = [feed_messages(t(f"bronze.{entity}")).select("topic", "key", "value") for entity in AFTER]
    parsed = F.from_json("value", _READ_BACK).alias("said")
    return reduce(DataFrame.unionByName, messages).select("topic", "key", parsed).select(
        "topic",
        "key",
        "said.entity",
        "said.op",
        "said.event_ts",
        F.col("said.pk.id").alias("pk_id"),
        F.col("said.source.system").alias("source_system"),
        F.col("said.after.id").alias("after_id"),
        F.col("said.after.status").alias("after_status"),
        F.coalesce("said.after.asset_id", "said.after.work_order_id").alias("parent_id"),
        F.coalesce("said.after.description", "said.after.event_type", "said.after.planned_start").alias("note"),
    )


# --- replica ----------------------------------------------------------------------------------------


def _stage(t: binding.BoundTables, table: str) -> DataFrame:
    return replica.staged(t(table), t.stamp)


def replica_stage(t: binding.BoundTables) -> DataFrame:
    version = replica.source_version(t("silver.work_order"), "last_event_ts")
    return _stage(t, "silver.work_order").withColumn("source_version", version.scalar())


def _replica_model(name: str, drop: tuple[str, ...] = ()) -> Callable[[binding.BoundTables], DataFrame]:
    return lambda t: replica.model(name, _stage(t, replica.MODELS[name][0])).drop(*drop)


def replica_gold_mtbf_metrics(t: binding.BoundTables) -> DataFrame:
    # the text of a double differs between engines, so it is compared as a number
    return _replica_model("gold_mtbf_metrics")(t).withColumn("mtbf_days", F.round(F.col("mtbf_days").cast("double"), 6))


def replica_changes(t: binding.BoundTables) -> DataFrame:
    """The actions known at the start of 1996 copied to a replica, then only what had changed by the end, deletes too."""
    events = binding.action_events(t.raw("lineitem"))
    versions = {"1996": binding.action_snapshot(events.filter(F.col("event_ts") < "1996-01-01"))}
    versions["end"] = binding.action_snapshot(events)
    path = f"{shared_dir(t.spark)}/replica_changes/{os.urandom(8).hex()}"
    for version, rows in versions.items():
        table = ReplicaTable(t.spark, path, rows.columns, ["id"], slices=16)
        table.load(rows, version, f"load of {version}", versions.get)
    return table.read()


# --- quality ----------------------------------------------------------------------------------------


def dq_lifecycle(t: binding.BoundTables) -> DataFrame:
    events = binding.action_events(t.raw("lineitem")).select(
        F.col("id").alias("pk_id"), "event_ts", *binding.ACTION_TIE, F.when(F.col("op") != "d", F.col("status")).alias("status")
    )
    return quality.transition_report(events, "maintenance_action", binding.ACTION_TIE)


def _lifecycle(entity_table: str, events: Callable[[binding.BoundTables], DataFrame]):
    return lambda t: quality.transition_report(events(t).withColumnRenamed("id", "pk_id"), entity_table)


def dq_freshness(t: binding.BoundTables) -> DataFrame:
    return quality.freshness_report(t, TABLES, t.stamp)


def dq_stale_sources(t: binding.BoundTables) -> DataFrame:
    return quality.stale_source_report(t.spark, dq_freshness(t))


def dq_offsets(t: binding.BoundTables) -> DataFrame:
    """Line items as the messages of one feed partition an order; their numbers have gaps and repeats."""
    place = [F.col("l_orderkey").alias("partition"), F.col("l_linenumber").alias("offset")]
    return quality.offset_report(t.raw("lineitem").select(F.lit("cdc.maintenance_action").alias("topic"), *place))


# --- facade -----------------------------------------------------------------------------------------


def _lake(t: binding.BoundTables) -> Lakehouse:
    return Lakehouse(t.spark, t, t.names)


def facade_sql_date(t: binding.BoundTables) -> DataFrame:
    sql = "SELECT op, COUNT(*) AS events, COUNT(DISTINCT pk_id) AS keys FROM bronze.asset GROUP BY op"
    return _lake(t).query(sql=sql, date_filter="2024-01-05")


def facade_top_assets(t: binding.BoundTables) -> DataFrame:
    sql = """SELECT asset_id, work_order_count FROM gold_asset_maintenance_summary
             ORDER BY work_order_count DESC, asset_id"""
    return _lake(t).query(sql=sql, limit=10)


def _rounded(table: str, *columns: str) -> Callable[[binding.BoundTables], DataFrame]:
    return lambda t: t(table).withColumns({c: F.round(c, 6) for c in columns})


def _table(name: str) -> Callable[[binding.BoundTables], DataFrame]:
    return lambda t: t(name)


def _builders() -> dict[str, Callable[[binding.BoundTables], DataFrame]]:
    built = {
        "cdc_latest_state": cdc_latest_state,
        "cdc_merge_incremental": cdc_merge_incremental,
        "cdc_merge_late": cdc_merge_late,
        "cdc_action_state": cdc_action_state,
        "cdc_asset_state": _entity_state("registered_asset", "asset"),
        "cdc_work_request_state": _entity_state("work_request", "work_request"),
        "cdc_work_order_state": _entity_state("work_order", "work_order"),
        "backlog_from_feed": backlog_from_feed,
        "stream_latest_state": stream_latest_state,
        "cdc_bucketed_state": cdc_bucketed_state,
        "refresh_incremental": refresh_incremental,
        "bronze_parse": bronze_parse,
        "bronze_route_counts": bronze_route_counts,
        "bronze_date_slice": bronze_date_slice,
        "snapshot_diff_cdc": snapshot_diff_cdc,
        "feed_messages": feed_message_keys,
        "feed_messages_topics": feed_messages_topics,
        "gold_asset_availability": _table("gold.asset_availability"),
        "gold_maintenance_history": _table("gold.maintenance_history"),
        "gold_work_order_backlog": _table("gold.work_order_backlog"),
        "gold_mtbf_metrics": _rounded("gold.mtbf_metrics", "failures_per_asset", "mtbf_proxy_hours"),
        "gold_asset_summary": _table("gold.asset_maintenance_summary"),
        "gold_asset_mtbf_days": _rounded("gold.asset_mtbf_days", "mtbf_days"),
        "gold_backlog_detail": _table("gold.backlog_detail"),
        "replica_stage": replica_stage,
        "replica_changes": replica_changes,
        "replica_bronze_asset": _replica_model("bronze_asset", ("payload_json",)),
        "replica_bronze_maintenance_action": _replica_model("bronze_maintenance_action", ("payload_json",)),
        "replica_bronze_work_request": _replica_model("bronze_work_request", ("payload_json",)),
        "replica_bronze_work_order": _replica_model("bronze_work_order", ("payload_json",)),
        "replica_gold_mtbf_metrics": replica_gold_mtbf_metrics,
        "replica_source_version": lambda t: replica.source_version(t("bronze.asset"), "event_ts"),
        "dq_keys": quality.key_report,
        "dq_duplicate_keys": lambda t: quality.key_report(t, {"bronze.maintenance_action": "pk_id"}),
        "dq_accepted": quality.accepted_values_report,
        "dq_unexpected_values": lambda t: quality.unexpected_values(t.raw("events"), "event_type", ("signup", "error")),
        "dq_relationships": quality.relationship_report,
        "dq_envelope": lambda t: envelope_report(_mixed_documents(t, with_actions=False)),
        "dq_creation": lambda t: quality.creation_report(t("bronze.asset"), "Asset", binding.ASSET_TIE),
        "dq_lifecycle": dq_lifecycle,
        "dq_order_lifecycle": _lifecycle("work_order", lambda t: binding.work_order_events(t.raw("orders"))),
        "dq_request_lifecycle": _lifecycle("work_request", lambda t: binding.work_request_events(t.raw("orders"))),
        "dq_asset_lifecycle": _lifecycle("asset", lambda t: binding.asset_events(t.raw("customer"), t.raw("nation"))),
        "dq_completed_actions": lambda t: quality.unfinished_actions(
            t("silver.work_order"), t("silver.maintenance_action")
        ),
        "dq_freshness": dq_freshness,
        "dq_stale_sources": dq_stale_sources,
        "dq_offsets": dq_offsets,
        "dq_rules": quality.rule_report,
        "dq_traceability": quality.traceability_report,
        "dq_foreign_ids": quality.foreign_id_report,
        "facade_sql_date": facade_sql_date,
        "facade_top_assets": facade_top_assets,
        **NAMED,
    }
    for concept in (
        "product_instance", "functional_failure", "maintenance_task", "maintenance_task_step", "maintenance_event"
    ):
        built[f"concept_{concept}"] = _table(f"silver_s5000f.{concept}")
    for name in replica.MODELS:
        if name.startswith(("silver_", "gold_")):
            built.setdefault(f"replica_{name.replace('silver_s5000f_', 's5000f_')}", _replica_model(name))
    return built


def _bound(build: Callable[[binding.BoundTables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(binding.BoundTables(apply_settings(spark), sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the work-order backlog by priority and asset."""
    return queries()["gold_work_order_backlog"](spark, SMOKE_DIR).orderBy("priority", "asset_id")


def _training_data():
    """The queries of the training-data subpackage; none where it (or the pipeline above it) is not installed."""
    try:
        from maintlake.llm import queries as registered
    except ModuleNotFoundError as e:
        if (e.name or "").startswith(("maintlake.llm", "corpus_pipeline")):
            return {}, {}
        raise
    return registered.QUERIES, registered.ORACLE_SQL


def queries() -> dict[str, Query]:
    return {name: _bound(build) for name, build in _builders().items()} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return oracle.statements() | _training_data()[1]
