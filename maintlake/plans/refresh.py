"""Refresh jobs: each publishes one table from the tables it really depends on."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame

from maintlake.functions.timestamps import utc_now_iso
from maintlake.operators import concepts, gold
from maintlake.operators.cdc import current_rows, merge_state, resolve_cdc
from maintlake.schemas import AFTER, LINEAGE
from maintlake.sources.tables import EVENT_LOG, ReadLog, TableStore

Build = Callable[[TableStore, str], DataFrame]

# Optional inputs are passed as None when they are missing or empty.
BUILDERS: dict[str, Build] = {
    "silver_s5000f.product_instance": lambda s, at: concepts.product_instance(s("silver.asset"), at),
    "silver_s5000f.functional_failure": lambda s, at: concepts.functional_failure(s("silver.work_request"), at),
    "silver_s5000f.maintenance_task": lambda s, at: concepts.maintenance_task(s("silver.work_order"), at),
    "silver_s5000f.maintenance_task_step": lambda s, at: concepts.maintenance_task_step(
        s("silver.maintenance_action"), at
    ),
    "silver_s5000f.maintenance_event": lambda s, at: concepts.maintenance_event(
        s("silver.work_order"), s.read_or_none("silver.maintenance_action"), at
    ),
    "gold.asset_availability": lambda s, at: gold.asset_availability(s("silver.asset"), at),
    "gold.maintenance_history": lambda s, at: gold.maintenance_history(s("silver_s5000f.maintenance_event"), at),
    "gold.work_order_backlog": lambda s, at: gold.work_order_backlog(
        s("silver.work_order"), s.read_or_none("silver.work_request"), at
    ),
    "gold.mtbf_metrics": lambda s, at: gold.mtbf_metrics(
        s("silver_s5000f.product_instance"), s.read_or_none("silver_s5000f.functional_failure"), at
    ),
    "gold.asset_maintenance_summary": lambda s, at: gold.asset_maintenance_summary(
        s("silver.work_order"), s("silver.maintenance_action"), at
    ),
    "gold.asset_mtbf_days": lambda s, at: gold.asset_mtbf_days(s("silver.asset"), s("silver.work_request"), at),
    "gold.backlog_detail": lambda s, at: gold.backlog_detail(
        s("silver.work_order"), s.read_or_none("silver.work_request"), at
    ),
}


def merge_entity(store: TableStore, entity_table: str, tie: Sequence[str] = ()) -> int:
    """Resolve all raw events of one entity into its current-state table; 0 if there is no log."""
    if not store.exists(EVENT_LOG):
        return 0
    name = f"silver.{entity_table}"
    existing = store.read(name) if store.exists(name) else None
    state = resolve_cdc(store.events_of(entity_table), existing, AFTER[entity_table], tie)
    return store.publish(name, state, {EVENT_LOG: store.log_version()})


def merge_entity_incremental(store: TableStore, entity_table: str, load_ids: Sequence[str]) -> int:
    """Fold the given loads into the state table of one entity, then publish its current rows.

    Only the partitions of those loads are read from the log. Loads may come in any order or again.
    """
    state_name = f"silver.{entity_table}_state"
    events = store.events_of(entity_table)
    batch = events.filter(events.load_id.isin(*load_ids)).select(
        "pk_id", "op", "event_ts", "payload_json", "source_system", "offset"
    )
    state = store.spark.table(state_name) if store.exists(state_name) else None
    store.publish(state_name, merge_state(state, batch))
    return store.publish(f"silver.{entity_table}", current_rows(store.spark.table(state_name), AFTER[entity_table]))


def refresh_table(store: TableStore, name: str, stamp: str | None = None) -> int:
    """Rebuild one concept or rollup table. An empty result is published too, so nothing stale stays."""
    read = ReadLog(store)
    built = BUILDERS[name](read, stamp or utc_now_iso())
    return store.publish(name, built, read.versions)


# One job per table, each called with a store (and a run stamp).
merge_asset = partial(merge_entity, entity_table="asset")
merge_work_request = partial(merge_entity, entity_table="work_request")
merge_work_order = partial(merge_entity, entity_table="work_order")
merge_maintenance_action = partial(merge_entity, entity_table="maintenance_action")
transform_product_instance = partial(refresh_table, name="silver_s5000f.product_instance")
transform_functional_failure = partial(refresh_table, name="silver_s5000f.functional_failure")
transform_maintenance_task = partial(refresh_table, name="silver_s5000f.maintenance_task")
transform_maintenance_task_step = partial(refresh_table, name="silver_s5000f.maintenance_task_step")
transform_maintenance_event = partial(refresh_table, name="silver_s5000f.maintenance_event")
compute_asset_availability = partial(refresh_table, name="gold.asset_availability")
compute_maintenance_history = partial(refresh_table, name="gold.maintenance_history")
compute_work_order_backlog = partial(refresh_table, name="gold.work_order_backlog")
compute_mtbf_metrics = partial(refresh_table, name="gold.mtbf_metrics")


def refresh_order() -> list[str]:
    """Tables in dependency order, from the declared lineage."""
    done: list[str] = []

    def visit(name: str) -> None:
        for upstream in LINEAGE.get(name, ()):
            visit(upstream)
        if name in LINEAGE and name not in done:
            done.append(name)

    for name in LINEAGE:
        visit(name)
    return done


def refresh_all(store: TableStore, stamp: str | None = None) -> dict[str, int]:
    """Raw events -> current state -> maintenance model -> rollups; returns rows per table."""
    stamp = stamp or utc_now_iso()
    counts = {}
    for name in refresh_order():
        namespace, table = name.split(".")
        counts[name] = merge_entity(store, table) if namespace == "silver" else refresh_table(store, name, stamp)
    return counts
