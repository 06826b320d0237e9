"""Current-state tables -> the standardised maintenance model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from maintlake.functions.ids import concept_id
from maintlake.schemas import CONCEPTS


def _shape(df: DataFrame, concept_table: str) -> DataFrame:
    """Column order of the declared schema; a column the source lacks altogether is the empty text."""
    return df.select(*[df[c] if c in df.columns else F.lit("").alias(c) for c in CONCEPTS[concept_table].names])


def product_instance(asset: DataFrame, mapped_at: str, null_id: str = "hash") -> DataFrame:
    renamed = asset.withColumnsRenamed(
        {"asset_type": "type", "status": "operational_status", "install_date": "installation_date"}
    )
    return _shape(
        renamed.withColumns(
            {"product_instance_id": concept_id("ProductInstance", "id", null_id), "mapped_at": F.lit(mapped_at)}
        ),
        "product_instance",
    )


def functional_failure(work_request: DataFrame, mapped_at: str, null_id: str = "hash") -> DataFrame:
    return _shape(
        work_request.withColumnRenamed("description", "failure_description").withColumns(
            {
                "functional_failure_id": concept_id("FunctionalFailure", "id", null_id),
                "product_instance_id": concept_id("ProductInstance", "asset_id", null_id),
                "mapped_at": F.lit(mapped_at),
            }
        ),
        "functional_failure",
    )


def maintenance_task(work_order: DataFrame, mapped_at: str, null_id: str = "hash") -> DataFrame:
    return _shape(
        work_order.withColumns(
            {
                "maintenance_task_id": concept_id("MaintenanceTask", "id", null_id),
                "product_instance_id": concept_id("ProductInstance", "asset_id", null_id),
                "functional_failure_id": concept_id("FunctionalFailure", "work_request_id", null_id),
                "mapped_at": F.lit(mapped_at),
            }
        ),
        "maintenance_task",
    )


def maintenance_task_step(action: DataFrame, mapped_at: str, null_id: str = "hash") -> DataFrame:
    return _shape(
        action.withColumns(
            {
                "task_step_id": concept_id("MaintenanceTaskStep", "id", null_id),
                "maintenance_task_id": concept_id("MaintenanceTask", "work_order_id", null_id),
                "mapped_at": F.lit(mapped_at),
            }
        ),
        "maintenance_task_step",
    )


def executed_work(work_order: DataFrame) -> DataFrame:
    """Completed work orders that were really started; only these are maintenance events."""
    return work_order.filter(
        (F.col("status") == "completed") & F.col("actual_start").isNotNull() & (F.col("actual_start") != "")
    )


def maintenance_event(
    work_order: DataFrame, action: DataFrame | None, mapped_at: str, null_id: str = "hash"
) -> DataFrame:
    """Executed work orders with the number of their actions (0 without any).

    Actions are counted per work order first, so the join is one row to at most one row and a work
    order with very many actions is reduced before the shuffle.
    """
    executed = executed_work(work_order)
    if action is None:
        counted = executed.withColumn("action_count", F.lit(0).cast("long"))
    else:
        per_order = (
            action.groupBy(F.col("work_order_id").alias("counted_order"))
            .agg(F.count("id").alias("action_count"))
            .filter(F.col("counted_order").isNotNull())
        )
        counted = executed.join(per_order, F.col("id") == F.col("counted_order"), "left").withColumn(
            "action_count", F.coalesce("action_count", F.lit(0))
        )
    return _shape(
        counted.withColumns(
            {
                "maintenance_event_id": concept_id("MaintenanceEvent", "id", null_id),
                "maintenance_task_id": concept_id("MaintenanceTask", "id", null_id),
                "product_instance_id": concept_id("ProductInstance", "asset_id", null_id),
                "mapped_at": F.lit(mapped_at),
            }
        ),
        "maintenance_event",
    )
