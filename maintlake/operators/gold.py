"""Rollups over the current-state tables and the maintenance model.

Every function is lazy and unsorted: order belongs to the reader, not to the stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from maintlake.functions.measures import mtbf_proxy_hours, ratio, total
from maintlake.functions.timestamps import blank_to_null, days_between, iso_date
from maintlake.operators.joins import left_lookup
from maintlake.schemas import GOLD

OPEN_STATUSES = ("planned", "in_progress")


def _stamped(df: DataFrame, table: str, computed_at: str) -> DataFrame:
    return df.withColumn("computed_at", F.lit(computed_at)).select(*GOLD[table].names)


def asset_availability(asset: DataFrame, computed_at: str) -> DataFrame:
    """Available = operational; a null status is neither available nor unavailable and counts 0 %."""
    available = F.col("status") == "operational"
    return _stamped(
        asset.withColumns(
            {
                "asset_id": F.col("id"),
                "is_available": available,
                "availability_pct": F.when(available, F.lit(100.0)).otherwise(F.lit(0.0)),
            }
        ),
        "asset_availability",
        computed_at,
    )


def maintenance_history(event: DataFrame, computed_at: str) -> DataFrame:
    """Events per product instance; the source id is that of the earliest event."""
    first_come = F.struct("actual_start", "maintenance_event_id")
    return _stamped(
        event.groupBy("product_instance_id").agg(
            F.min_by("source_id", first_come).alias("asset_source_id"),
            F.count("maintenance_event_id").alias("event_count"),
            F.min("actual_start").alias("first_maintenance"),
            F.max("actual_start").alias("last_maintenance"),
            total("action_count").alias("total_actions"),
        ),
        "maintenance_history",
        computed_at,
    )


def open_orders(work_order: DataFrame) -> DataFrame:
    return work_order.filter(F.col("status").isin(*OPEN_STATUSES))


def with_priority(work_order: DataFrame, work_request: DataFrame | None) -> DataFrame:
    """Priority of the request behind each order: null if it dangles, 'unknown' without any requests table."""
    if work_request is None:
        return work_order.withColumn("priority", F.lit("unknown"))
    requests = work_request.select(F.col("id").alias("request_id"), "priority")
    return left_lookup(work_order, requests, "work_request_id", "request_id", spread="id")


def work_order_backlog(work_order: DataFrame, work_request: DataFrame | None, computed_at: str) -> DataFrame:
    """Open orders by priority and asset. An unset planned start is '' and so counts as the oldest."""
    needed = open_orders(work_order).select("id", "asset_id", "work_request_id", "planned_start")
    return backlog_groups(with_priority(needed, work_request), computed_at)


def backlog_groups(open_order: DataFrame, computed_at: str) -> DataFrame:
    """The backlog of open orders that have their priority already."""
    return _stamped(
        open_order.groupBy("priority", "asset_id").agg(
            F.count("id").alias("open_count"), F.min("planned_start").alias("oldest_planned_start")
        ),
        "work_order_backlog",
        computed_at,
    )


def mtbf_metrics(instance: DataFrame, failure: DataFrame | None, computed_at: str) -> DataFrame:
    """Failures per asset type and the MTBF proxy.

    Failures are counted per product instance before the join, so an instance with very many
    failures costs one row, and one aggregation by type gives both counts. Assets without a type
    count no failures, as nothing equals a null type.
    """
    if failure is None:
        joined = instance.withColumn("failures", F.lit(0).cast("long"))
    else:
        joined = instance_failures(instance, failure)
    return mtbf_of_totals(type_totals(joined), computed_at)


def instance_failures(instance: DataFrame, failure: DataFrame) -> DataFrame:
    """Instances with the number of their failures, null without any."""
    per_instance = failure.groupBy("product_instance_id").agg(F.count("functional_failure_id").alias("failures"))
    return instance.join(per_instance, "product_instance_id", "left")


def type_totals(counted: DataFrame) -> DataFrame:
    return counted.groupBy("type").agg(
        F.count("product_instance_id").alias("asset_count"),
        total(F.when(F.col("type").isNotNull(), F.col("failures"))).alias("failure_count"),
    )


def mtbf_of_totals(totals: DataFrame, computed_at: str) -> DataFrame:
    return _stamped(
        totals.withColumns(
            {
                "failures_per_asset": ratio(F.col("failure_count"), F.col("asset_count")),
                "mtbf_proxy_hours": mtbf_proxy_hours(F.col("asset_count"), F.col("failure_count")),
            }
        ),
        "mtbf_metrics",
        computed_at,
    )


def asset_maintenance_summary(work_order: DataFrame, action: DataFrame, computed_at: str) -> DataFrame:
    """Orders, completed actions and last finish per asset."""
    return summary_of_orders(order_facts(work_order, action), computed_at)


def order_facts(work_order: DataFrame, action: DataFrame) -> DataFrame:
    """Orders with their finish and the number of their completed actions, null without any."""
    done = (
        action.filter(F.col("status") == "completed")
        .groupBy(F.col("work_order_id").alias("done_order"))
        .agg(F.count("id").alias("done_actions"))
    )
    orders = work_order.select("id", "asset_id", blank_to_null("actual_end").alias("finished"))
    return orders.join(done, F.col("id") == F.col("done_order"), "left").drop("done_order")


def summary_of_orders(facts: DataFrame, computed_at: str) -> DataFrame:
    return _stamped(
        facts.groupBy("asset_id").agg(
            F.count("id").alias("work_order_count"),
            total("done_actions").alias("completed_actions_count"),
            F.max(iso_date("finished")).alias("last_maintenance_date"),
        ),
        "asset_maintenance_summary",
        computed_at,
    )


def asset_mtbf_days(asset: DataFrame, work_request: DataFrame, computed_at: str) -> DataFrame:
    """Days under observation per reported failure, for every asset; null without failures."""
    failures = work_request.groupBy(F.col("asset_id").alias("failed_asset")).agg(F.count("id").alias("failures"))
    observed = days_between(blank_to_null("install_date"), F.lit(computed_at)).cast("long")
    return _stamped(
        asset.join(failures, F.col("id") == F.col("failed_asset"), "left").select(
            F.col("id").alias("asset_id"),
            F.col("name").alias("asset_name"),
            F.coalesce("failures", F.lit(0)).alias("total_failures"),
            observed.alias("observation_days"),
            ratio(observed, F.coalesce("failures", F.lit(0))).alias("mtbf_days"),
        ),
        "asset_mtbf_days",
        computed_at,
    )


def backlog_detail(work_order: DataFrame, work_request: DataFrame | None, computed_at: str) -> DataFrame:
    """Every open order with its priority and its age in days."""
    needed = open_orders(work_order).select("id", "asset_id", "work_request_id", "status", "planned_start")
    return detail_of_open(with_priority(needed, work_request), computed_at)


def detail_of_open(open_order: DataFrame, computed_at: str) -> DataFrame:
    return _stamped(
        open_order.withColumns(
            {
                "work_order_id": F.col("id"),
                "days_open": days_between(blank_to_null("planned_start"), F.lit(computed_at)).cast("long"),
            }
        ),
        "backlog_detail",
        computed_at,
    )
