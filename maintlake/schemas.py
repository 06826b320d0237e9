"""Schemas, keys, accepted values, status transitions and lineage of every dataset."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def text_fields(*names: str, **typed: DataType) -> StructType:
    """Nullable columns: plain names are strings, keyword arguments override the type in place."""
    return StructType([StructField(n, typed.get(n, StringType()), True) for n in names])


# --- CDC envelope -----------------------------------------------------------------------------------

ENVELOPE = StructType(
    [
        StructField("entity", StringType()),
        StructField("op", StringType()),
        StructField("event_ts", StringType()),
        StructField("pk", text_fields("id")),
        StructField("source", text_fields("system", "version")),
    ]
)

# Entity name -> table name within each layer, and CDC topic.
ENTITY_TABLES = {
    "Asset": "asset",
    "WorkRequest": "work_request",
    "WorkOrder": "work_order",
    "MaintenanceAction": "maintenance_action",
}
ENTITY_TOPICS = {
    "Asset": "cdc.asset",
    "WorkRequest": "cdc.work_request",
    "WorkOrder": "cdc.work_order",
    "MaintenanceAction": "cdc.maintenance_action",
}
OPS = ("c", "u", "d")

BRONZE = text_fields("entity", "op", "event_ts", "pk_id", "payload_json", "event_date", "source_system")

# --- current state ("after" images) -----------------------------------------------------------------

AFTER = {
    "asset": text_fields("id", "name", "asset_type", "location", "status", "install_date", "updated_at"),
    "work_request": text_fields("id", "asset_id", "description", "priority", "status", "reported_at", "updated_at"),
    "work_order": text_fields(
        "id", "work_request_id", "asset_id", "status", "planned_start", "planned_end", "actual_start",
        "actual_end", "updated_at",
    ),
    "maintenance_action": text_fields(
        "id", "work_order_id", "step_number", "description", "status", "started_at", "completed_at",
        step_number=LongType(),
    ),
}
CDC_COLUMNS = text_fields("source_system", "source_id", "last_op", "last_event_ts")


def silver_schema(after: StructType) -> StructType:
    return StructType(after.fields + CDC_COLUMNS.fields)


# --- standardised maintenance model -----------------------------------------------------------------

CONCEPTS = {
    "product_instance": text_fields(
        "product_instance_id", "name", "type", "location", "operational_status", "installation_date",
        "source_system", "source_id", "mapped_at",
    ),
    "functional_failure": text_fields(
        "functional_failure_id", "product_instance_id", "failure_description", "priority", "reported_at",
        "source_system", "source_id", "mapped_at",
    ),
    "maintenance_task": text_fields(
        "maintenance_task_id", "product_instance_id", "functional_failure_id", "status", "planned_start",
        "planned_end", "source_system", "source_id", "mapped_at",
    ),
    "maintenance_task_step": text_fields(
        "task_step_id", "maintenance_task_id", "step_number", "description", "status", "started_at",
        "completed_at", "source_system", "source_id", "mapped_at",
        step_number=LongType(),
    ),
    "maintenance_event": text_fields(
        "maintenance_event_id", "maintenance_task_id", "product_instance_id", "actual_start", "actual_end",
        "action_count", "source_system", "source_id", "mapped_at",
        action_count=LongType(),
    ),
}

# --- rollups ----------------------------------------------------------------------------------------

GOLD = {
    "asset_availability": text_fields(
        "asset_id", "name", "asset_type", "location", "status", "is_available", "availability_pct",
        "computed_at",
        is_available=BooleanType(), availability_pct=DoubleType(),
    ),
    "maintenance_history": text_fields(
        "product_instance_id", "asset_source_id", "event_count", "first_maintenance", "last_maintenance",
        "total_actions", "computed_at",
        event_count=LongType(), total_actions=LongType(),
    ),
    "work_order_backlog": text_fields(
        "priority", "asset_id", "open_count", "oldest_planned_start", "computed_at",
        open_count=LongType(),
    ),
    "mtbf_metrics": text_fields(
        "type", "asset_count", "failure_count", "failures_per_asset", "mtbf_proxy_hours", "computed_at",
        asset_count=LongType(), failure_count=LongType(), failures_per_asset=DoubleType(),
        mtbf_proxy_hours=DoubleType(),
    ),
    # The three shapes the relational replica declares beside the rollups above.
    "asset_maintenance_summary": text_fields(
        "asset_id", "work_order_count", "completed_actions_count", "last_maintenance_date", "computed_at",
        work_order_count=LongType(), completed_actions_count=LongType(),
    ),
    "asset_mtbf_days": text_fields(
        "asset_id", "asset_name", "total_failures", "observation_days", "mtbf_days", "computed_at",
        total_failures=LongType(), observation_days=LongType(), mtbf_days=DoubleType(),
    ),
    "backlog_detail": text_fields(
        "asset_id", "work_order_id", "priority", "status", "days_open", "computed_at",
        days_open=LongType(),
    ),
}

NAMESPACES = ("bronze", "silver", "silver_s5000f", "gold")
QUERY_NAMESPACES = ("silver", "silver_s5000f", "gold")

TABLES: dict[str, StructType] = {
    **{f"bronze.{t}": BRONZE for t in AFTER},
    **{f"silver.{t}": silver_schema(s) for t, s in AFTER.items()},
    **{f"silver_s5000f.{t}": s for t, s in CONCEPTS.items()},
    **{f"gold.{t}": s for t, s in GOLD.items()},
}

# --- contracts --------------------------------------------------------------------------------------

PRIMARY_KEYS = {
    "silver.asset": "id",
    "silver.work_request": "id",
    "silver.work_order": "id",
    "silver.maintenance_action": "id",
    "silver_s5000f.product_instance": "product_instance_id",
    "silver_s5000f.maintenance_task": "maintenance_task_id",
    "silver_s5000f.maintenance_event": "maintenance_event_id",
    "silver_s5000f.maintenance_task_step": "task_step_id",
}

# Enumerations of the source system.
ACCEPTED_VALUES = {
    ("bronze.asset", "op"): ("c", "u", "d"),
    ("bronze.work_request", "op"): ("c", "u", "d"),
    ("bronze.work_order", "op"): ("c", "u", "d"),
    ("bronze.maintenance_action", "op"): ("c", "u", "d"),
    ("silver.asset", "status"): ("operational", "degraded", "failed"),
    ("silver.work_request", "status"): ("open", "approved", "rejected", "closed"),
    ("silver.work_request", "priority"): ("low", "medium", "high", "critical"),
    ("silver.work_order", "status"): ("planned", "in_progress", "completed", "cancelled"),
    ("silver.maintenance_action", "status"): ("pending", "in_progress", "completed"),
}

# child table, child column, parent table, parent column
RELATIONSHIPS = (
    ("silver.work_request", "asset_id", "silver.asset", "id"),
    ("silver.work_order", "asset_id", "silver.asset", "id"),
    ("silver.work_order", "work_request_id", "silver.work_request", "id"),
    ("silver.maintenance_action", "work_order_id", "silver.work_order", "id"),
)

# Status changes the source system makes.
TRANSITIONS = {
    "asset": (
        ("operational", "degraded"), ("operational", "failed"), ("degraded", "operational"),
        ("failed", "operational"),
    ),
    "work_request": (("open", "approved"), ("open", "rejected"), ("approved", "closed")),
    "work_order": (
        ("planned", "in_progress"), ("planned", "cancelled"), ("in_progress", "completed"),
        ("in_progress", "cancelled"),
    ),
    "maintenance_action": (("pending", "in_progress"), ("in_progress", "completed")),
}

# dataset -> datasets it is computed from
LINEAGE = {
    "silver.asset": ("bronze.asset",),
    "silver.work_request": ("bronze.work_request",),
    "silver.work_order": ("bronze.work_order",),
    "silver.maintenance_action": ("bronze.maintenance_action",),
    "silver_s5000f.product_instance": ("silver.asset",),
    "silver_s5000f.functional_failure": ("silver.work_request",),
    "silver_s5000f.maintenance_task": ("silver.work_order",),
    "silver_s5000f.maintenance_task_step": ("silver.maintenance_action",),
    "silver_s5000f.maintenance_event": ("silver.work_order", "silver.maintenance_action"),
    "gold.asset_availability": ("silver.asset",),
    "gold.maintenance_history": ("silver_s5000f.maintenance_event",),
    "gold.work_order_backlog": ("silver.work_order", "silver.work_request"),
    "gold.mtbf_metrics": ("silver_s5000f.product_instance", "silver_s5000f.functional_failure"),
    "gold.asset_maintenance_summary": ("silver.work_order", "silver.maintenance_action"),
    "gold.asset_mtbf_days": ("silver.asset", "silver.work_request"),
    "gold.backlog_detail": ("silver.work_order", "silver.work_request"),
}

# Promised freshness per layer, as the largest age in hours ("near real-time" read as one hour).
FRESHNESS_HOURS = {"bronze": 1, "silver": 1, "silver_s5000f": 24, "gold": 24}
# Column that tells how new a row of a layer is.
FRESHNESS_COLUMNS = {"bronze": "event_ts", "silver": "last_event_ts", "silver_s5000f": "mapped_at", "gold": "computed_at"}

# Columns that hold ISO-8601 texts in whatever dataset they occur; the empty text is unset.
ISO_COLUMNS = (
    "event_ts", "updated_at", "reported_at", "planned_start", "planned_end", "actual_start", "actual_end", "started_at",
    "completed_at", "last_event_ts", "mapped_at", "computed_at", "first_maintenance", "last_maintenance",
    "oldest_planned_start", "install_date", "installation_date", "last_maintenance_date",
)
# Partition column of a layer and the column whose date it is.
PARTITION_KEYS = {"bronze": ("event_date", "event_ts")}
# Columns without which a row of a layer is no row.
REQUIRED_COLUMNS = {"bronze": ("op", "event_ts", "pk_id", "payload_json", "source_system"), "silver": ("source_id", "last_op")}

# concept table, its foreign identifier, concept that it names, source table, source column
FOREIGN_IDS = (
    ("functional_failure", "product_instance_id", "ProductInstance", "silver.work_request", "asset_id"),
    ("maintenance_task", "product_instance_id", "ProductInstance", "silver.work_order", "asset_id"),
    ("maintenance_task", "functional_failure_id", "FunctionalFailure", "silver.work_order", "work_request_id"),
    ("maintenance_task_step", "maintenance_task_id", "MaintenanceTask", "silver.maintenance_action", "work_order_id"),
    ("maintenance_event", "maintenance_task_id", "MaintenanceTask", "silver.work_order", "id"),
    ("maintenance_event", "product_instance_id", "ProductInstance", "silver.work_order", "asset_id"),
)
