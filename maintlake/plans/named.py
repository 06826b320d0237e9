"""Named analytical queries over the layer tables.

Each takes ``tables`` (a table name -> DataFrame) and returns a lazy result. Facts are aggregated by
their own key before they are joined, so that no join multiplies rows and a hot asset or work order
enters it once; keys of the layer tables are unique, which makes the counts equal to distinct counts
over the joined rows. Where only the first rows are asked for, the ranking is decided first, from the
columns it needs; its few rows are settled, and the large tables are filtered by their keys while
they are scanned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from maintlake.functions.measures import completeness, percent, ratio, total
from maintlake.functions.timestamps import blank_to_null, days_between, minutes_between
from maintlake.operators.gold import OPEN_STATUSES, open_orders
from maintlake.operators.joins import left_lookup, settle
from maintlake.plans.lakehouse import EXAMPLES, Lakehouse
from maintlake.schemas import TABLES

Tables = Callable[[str], DataFrame]

SYSTEM = "driver"
AS_OF = "2002-01-01"


# --- shared pieces ----------------------------------------------------------------------------------


def _catalogue(name: str, tables: Tables) -> DataFrame:
    spark = tables.spark
    return Lakehouse(spark, tables, TABLES).query(sql=EXAMPLES[name])


def _first_rows(table: str, key: str, tables: Tables) -> DataFrame:
    """Table scan of the facade, made repeatable by an order. The date filter finds no date column."""
    lake = Lakehouse(tables.spark, tables, TABLES)
    return lake.query(table=table, date_filter="2024-01-01").orderBy(key).limit(10)


def _duration() -> Column:
    return minutes_between("started_at", "completed_at")


def _counted(work: DataFrame, order_key: str, key: str, name: str) -> DataFrame:
    """Rows, total minutes and rows with a duration per order; the times are parsed once per row."""
    return (
        work.select(F.col(order_key).alias("counted_key"), key, _duration().alias("duration"))
        .groupBy("counted_key")
        .agg(F.count(key).alias(name), F.sum("duration").alias("minutes"), F.count("duration").alias("timed"))
    )


def _actions_per_order(action: DataFrame) -> DataFrame:
    return _counted(action, "work_order_id", "id", "actions").withColumnRenamed("counted_key", "action_order")


def _orders_with_actions(orders: DataFrame, action: DataFrame) -> DataFrame:
    return orders.join(_actions_per_order(action), F.col("id") == F.col("action_order"), "left").drop("action_order")


def _assets_with_availability(tables: Tables) -> DataFrame:
    a = tables("silver.asset")
    ga = tables("gold.asset_availability").select("asset_id", "is_available", "availability_pct", "computed_at")
    return a.join(ga, F.col("id") == F.col("asset_id"), "left").withColumn("asset_id", F.col("id"))


def _steps_per_task(step: DataFrame) -> DataFrame:
    return _counted(step, "maintenance_task_id", "task_step_id", "steps").withColumnRenamed("counted_key", "step_task")


def _failure_text(tables: Tables) -> DataFrame:
    return tables("silver_s5000f.functional_failure").select(
        "functional_failure_id", "failure_description", F.col("priority").alias("failure_priority")
    )


def _requests(tables: Tables, *columns: str) -> DataFrame:
    return tables("silver.work_request").select(F.col("id").alias("request_id"), *columns)


def _asset_names(tables: Tables) -> DataFrame:
    return tables("silver.asset").select(F.col("id").alias("asset_id"), F.col("name").alias("asset_name"), "asset_type")


def _matching(table: DataFrame, key: str, few: DataFrame, few_key: str) -> DataFrame:
    """Rows of a table that a few settled rows refer to."""
    return table.join(few.select(F.col(few_key).alias(key)), key, "left_semi")


def _round(c: Column) -> Column:
    return F.round(c, 6)


# --- availability -----------------------------------------------------------------------------------


def n06(tables: Tables) -> DataFrame:
    """Assets with their availability, first 5."""
    return (
        _assets_with_availability(tables)
        .select(
            "asset_id",
            F.col("name").alias("asset_name"),
            "asset_type",
            F.col("status").alias("asset_status"),
            "availability_pct",
            "is_available",
            "computed_at",
        )
        .orderBy("asset_id")
        .limit(5)
    )


def n07(tables: Tables) -> DataFrame:
    """Availability summary by asset type."""
    up = F.coalesce("is_available", F.lit(False))
    return (
        _assets_with_availability(tables)
        .groupBy("asset_type")
        .agg(
            F.count(F.lit(1)).alias("total_assets"),
            _round(percent(F.count_if(up), F.count(F.lit(1)))).alias("avg_availability_pct"),
            F.count_if(F.col("is_available")).alias("available_count"),
            F.count_if(~F.col("is_available")).alias("unavailable_count"),
        )
        .orderBy(F.desc("total_assets"), "asset_type")
    )


def n08(tables: Tables) -> DataFrame:
    """Assets needing attention, first 10."""
    return (
        _assets_with_availability(tables)
        .filter(~F.col("is_available") | F.col("is_available").isNull())
        .select(
            "asset_id",
            F.col("name").alias("asset_name"),
            "asset_type",
            "location",
            "status",
            "availability_pct",
            "is_available",
            F.when(F.col("is_available"), "HEALTHY").otherwise("NEEDS_ATTENTION").alias("health_status"),
        )
        .orderBy("asset_type", "asset_name", "asset_id")
        .limit(10)
    )


# --- maintenance history ----------------------------------------------------------------------------


def _latest_finished(tables: Tables, n: int) -> DataFrame:
    """The ``n`` most recently finished orders of known assets, with the asset."""
    done = (
        tables("silver.work_order")
        .filter(F.col("status") == "completed")
        .select("id", "asset_id", "work_request_id", "status", "actual_end")
    )
    return settle(done.join(_asset_names(tables), "asset_id").orderBy(F.desc("actual_end"), "id").limit(n))


def _described_orders(few: DataFrame, tables: Tables) -> DataFrame:
    """Request text, priority and action totals of a few orders."""
    requests = _matching(_requests(tables, "description", "priority", "reported_at"), "request_id", few, "work_request_id")
    actions = _matching(tables("silver.maintenance_action"), "work_order_id", few, "id")
    return _orders_with_actions(left_lookup(few, requests, "work_request_id", "request_id", spread="id"), actions)


def n10(tables: Tables) -> DataFrame:
    """The ten latest finished orders with their actions."""
    return (
        _described_orders(_latest_finished(tables, 10), tables)
        .select(
            "asset_id",
            "asset_name",
            "asset_type",
            F.col("id").alias("work_order_id"),
            F.col("description").alias("work_description"),
            F.col("status").alias("work_order_status"),
            "priority",
            F.col("reported_at").alias("wo_created"),
            F.col("actual_end").alias("wo_completed"),
            F.coalesce("actions", F.lit(0)).alias("maintenance_action_count"),
            _round(F.col("minutes")).alias("total_duration_minutes"),
        )
        .orderBy(F.desc("wo_completed"), "work_order_id")
    )


def n11(tables: Tables) -> DataFrame:
    """Maintenance frequency by asset type."""
    done = tables("silver.work_order").filter(F.col("status") == "completed")
    linked = left_lookup(
        done.select("id", "asset_id", "work_request_id", "actual_end"),
        _requests(tables, "reported_at"), "work_request_id", "request_id", spread="id",
    )
    per_asset = (
        _orders_with_actions(linked, tables("silver.maintenance_action"))
        .groupBy("asset_id")
        .agg(
            F.count("id").alias("orders"),
            F.sum("actions").alias("actions"),
            F.sum("minutes").alias("minutes"),
            F.sum("timed").alias("timed"),
            F.min("reported_at").alias("first_date"),
            F.max("actual_end").alias("last_date"),
        )
    )
    a = tables("silver.asset").select(F.col("id").alias("asset_id"), "asset_type")
    return (
        per_asset.join(a, "asset_id")
        .groupBy("asset_type")
        .agg(
            F.sum("orders").alias("total_work_orders"),
            total("actions").alias("total_maintenance_actions"),
            _round(ratio(F.sum("minutes"), F.sum("timed"))).alias("avg_action_duration"),
            _round(F.sum("minutes")).alias("total_duration_minutes"),
            F.min("first_date").alias("first_maintenance_date"),
            F.max("last_date").alias("last_maintenance_date"),
        )
        .orderBy(F.desc("total_work_orders"), "asset_type")
    )


def n12(tables: Tables) -> DataFrame:
    """Status of maintenance per asset, the ten with most open orders.

    The ranking needs orders only; actions are then read for the orders of these ten assets.
    """
    state = F.col("status")
    orders = tables("silver.work_order").select("id", "asset_id", "status")
    ranked = settle(
        orders.groupBy("asset_id")
        .agg(
            F.count("id").alias("orders"),
            F.count_if(state == "planned").alias("open_work_orders"),
            F.count_if(state == "in_progress").alias("in_progress_work_orders"),
            F.count_if(state == "completed").alias("completed_work_orders"),
        )
        .filter(F.col("orders") > 0)
        .join(_asset_names(tables), "asset_id")
        .orderBy(F.desc("open_work_orders"), F.desc("completed_work_orders"), "asset_id")
        .limit(10)
    )
    ranked_orders = _matching(orders, "asset_id", ranked, "asset_id")
    actions = (
        _orders_with_actions(
            ranked_orders, _matching(tables("silver.maintenance_action"), "work_order_id", ranked_orders, "id")
        )
        .groupBy("asset_id")
        .agg(
            total("actions").alias("total_maintenance_actions"),
            total(F.when(state == "completed", F.col("minutes"))).cast("double").alias("completed_minutes"),
        )
    )
    return (
        ranked.join(actions, "asset_id", "left")
        .select(
            "asset_id",
            "asset_name",
            "asset_type",
            "open_work_orders",
            "in_progress_work_orders",
            "completed_work_orders",
            "total_maintenance_actions",
            _round(F.col("completed_minutes")).alias("completed_duration_minutes"),
        )
        .orderBy(F.desc("open_work_orders"), F.desc("completed_work_orders"), "asset_id")
    )


def n13(tables: Tables, as_of: str = AS_OF) -> DataFrame:
    """Backlog by asset type: size, age since the request and split by priority."""
    age = days_between("reported_at", F.lit(as_of))
    waiting = open_orders(tables("silver.work_order")).select("id", "asset_id", "work_request_id")
    per_asset = (
        left_lookup(waiting, _requests(tables, "priority", "reported_at"), "work_request_id", "request_id", spread="id")
        .groupBy("asset_id")
        .agg(
            F.count("id").alias("orders"),
            F.sum(age).alias("days"),
            F.count(age).alias("dated"),
            F.max(age).alias("oldest"),
            *[F.count_if(F.col("priority") == p).alias(p) for p in ("high", "medium", "low")],
        )
    )
    a = tables("silver.asset").select(F.col("id").alias("asset_id"), "asset_type")
    return (
        per_asset.join(a, "asset_id")
        .groupBy("asset_type")
        .agg(
            F.sum("orders").alias("backlog_count"),
            _round(ratio(F.sum("days"), F.sum("dated"))).alias("avg_backlog_age_days"),
            F.max("oldest").cast("long").alias("max_backlog_age_days"),
            *[F.sum(p).alias(f"{p}_priority_backlog") for p in ("high", "medium", "low")],
        )
        .orderBy(F.desc("backlog_count"), "asset_type")
    )


# --- standardised model -----------------------------------------------------------------------------


def execution_status(start: Column, end: Column) -> Column:
    return (
        F.when(blank_to_null(end).isNotNull(), "COMPLETED")
        .when(blank_to_null(start).isNotNull(), "IN_PROGRESS")
        .otherwise("PLANNED")
    )


def n15(tables: Tables) -> DataFrame:
    """Lifecycle view: instance, task, event, step; first 15 rows.

    Left joins keep every row on their left, so the first 15 rows belong to the first 15 instances,
    and of their tasks to the first 15.
    """
    first_instances = settle(
        tables("silver_s5000f.product_instance")
        .select("product_instance_id", "name", "type", "location", "operational_status")
        .orderBy("product_instance_id")
        .limit(15)
    )
    tasks = _matching(
        tables("silver_s5000f.maintenance_task").select(
            "maintenance_task_id", "product_instance_id", "functional_failure_id", "planned_start", "planned_end"
        ),
        "product_instance_id", first_instances, "product_instance_id",
    )
    few = settle(
        first_instances.join(tasks, "product_instance_id", "left")
        .orderBy("product_instance_id", "planned_start", "maintenance_task_id")
        .limit(15)
    )
    failures = _matching(_failure_text(tables), "functional_failure_id", few, "functional_failure_id")
    events = _matching(
        tables("silver_s5000f.maintenance_event").select(
            "maintenance_event_id", "maintenance_task_id", "actual_start", "actual_end"
        ),
        "maintenance_task_id", few, "maintenance_task_id",
    )
    steps = _matching(
        tables("silver_s5000f.maintenance_task_step"), "maintenance_task_id", few, "maintenance_task_id"
    ).select(
        F.col("maintenance_task_id").alias("step_task"),
        "task_step_id",
        "step_number",
        F.col("description").alias("step_description"),
        _round(_duration()).alias("actual_duration_minutes"),
    )
    executed = F.col("maintenance_event_id").isNotNull()
    return (
        few.join(failures, "functional_failure_id", "left")
        .join(events, "maintenance_task_id", "left")
        .join(steps, (F.col("maintenance_task_id") == F.col("step_task")) & executed, "left")
        .select(
            "product_instance_id",
            "name",
            "type",
            "location",
            "operational_status",
            "maintenance_task_id",
            "failure_description",
            F.col("failure_priority").alias("priority"),
            "planned_start",
            "planned_end",
            "maintenance_event_id",
            "actual_start",
            blank_to_null("actual_end").alias("actual_end"),
            F.when(executed, execution_status(F.col("actual_start"), F.col("actual_end"))).alias("execution_status"),
            "task_step_id",
            "step_description",
            "step_number",
            "actual_duration_minutes",
        )
        .orderBy(
            "product_instance_id", "planned_start", "maintenance_task_id", "actual_start", "step_number", "task_step_id"
        )
        .limit(15)
    )


def n16(tables: Tables) -> DataFrame:
    """Row, identifier and missing-value counts of three concept tables."""

    def counts(df: DataFrame, table: str, key: str, *required: Column | str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.countDistinct(key).alias("unique_ids"),
            *[
                F.count_if((F.col(c) if isinstance(c, str) else c).isNull()).alias(f"missing_field_{i}")
                for i, c in enumerate(required, start=1)
            ],
        ).select(F.lit(table).alias("table_name"), "*")

    tasks = tables("silver_s5000f.maintenance_task").join(_failure_text(tables), "functional_failure_id", "left")
    event = tables("silver_s5000f.maintenance_event")
    return (
        counts(
            tables("silver_s5000f.product_instance"),
            "ProductInstance", "product_instance_id", "name", "type", "operational_status",
        )
        .union(
            counts(
                tasks, "MaintenanceTask", "maintenance_task_id", "failure_description", "planned_start", "planned_end"
            )
        )
        .union(
            counts(
                event, "MaintenanceEvent", "maintenance_event_id", blank_to_null("actual_start"),
                blank_to_null("actual_end"), execution_status(F.col("actual_start"), F.col("actual_end")),
            )
        )
        .orderBy("table_name")
    )


def n17(tables: Tables) -> DataFrame:
    """Task execution by product type.

    Averages of delays weigh each task by its steps, as a join of task, event and step would; the
    weight is the number of rows the task has in that join, so the steps need not be joined one by one.
    """
    events = tables("silver_s5000f.maintenance_event").select(
        "maintenance_event_id", F.col("maintenance_task_id").alias("event_task"), "actual_start", "actual_end"
    )
    tasks = tables("silver_s5000f.maintenance_task").select(
        "maintenance_task_id", "product_instance_id", "planned_start", "planned_end"
    )
    instances = tables("silver_s5000f.product_instance").select("product_instance_id", "type")
    executed = tasks.join(events, F.col("maintenance_task_id") == F.col("event_task"), "left")
    # joined on the task, which both sides are already partitioned by
    stepped = executed.join(
        _steps_per_task(tables("silver_s5000f.maintenance_task_step")),
        (F.col("maintenance_task_id") == F.col("step_task")) & F.col("event_task").isNotNull(),
        "left",
    )
    rows = F.greatest(F.coalesce("steps", F.lit(0)), F.lit(1))
    start_delay = days_between("planned_start", "actual_start")
    end_delay = days_between("planned_end", "actual_end")
    status = F.when(F.col("event_task").isNotNull(), execution_status(F.col("actual_start"), F.col("actual_end")))
    per_instance = stepped.groupBy("product_instance_id").agg(
        F.sum(rows).alias("joined_rows"),
        F.count(F.lit(1)).alias("tasks"),
        F.count("maintenance_event_id").alias("executed"),
        *[F.count_if(status == s).alias(s) for s in ("COMPLETED", "IN_PROGRESS", "PLANNED")],
        F.sum(start_delay * rows).alias("start_days"),
        F.sum(F.when(start_delay.isNotNull(), rows)).alias("start_rows"),
        F.sum(end_delay * rows).alias("end_days"),
        F.sum(F.when(end_delay.isNotNull(), rows)).alias("end_rows"),
        F.sum("minutes").alias("minutes"),
        F.sum("timed").alias("timed"),
    )
    return (
        per_instance.join(instances, "product_instance_id", "left")
        .groupBy(F.col("type").alias("task_type"))
        .agg(
            F.sum("joined_rows").alias("joined_rows"),
            F.sum("tasks").alias("total_tasks"),
            F.sum("executed").alias("executed_tasks"),
            F.sum("COMPLETED").alias("completed_tasks"),
            F.sum("IN_PROGRESS").alias("in_progress_tasks"),
            F.sum("PLANNED").alias("planned_tasks"),
            _round(ratio(F.sum("start_days"), F.sum("start_rows"))).alias("avg_start_delay_days"),
            _round(ratio(F.sum("end_days"), F.sum("end_rows"))).alias("avg_completion_delay_days"),
            _round(ratio(F.sum("minutes"), F.sum("timed"))).alias("avg_step_duration_minutes"),
        )
        .orderBy(F.desc("joined_rows"), "task_type")
    )


def n18(tables: Tables, system: str = SYSTEM) -> DataFrame:
    """How many application rows have a counterpart in the maintenance model."""

    def coverage(name: str, source: str, concept: str, key: str) -> DataFrame:
        mapped = (
            tables(concept).filter(F.col("source_system") == system).select("source_id", F.col(key).alias("concept_key"))
        )
        # one row per id, the one with a counterpart if there is any, stands for the id
        by_id = Window.partitionBy("id").orderBy(F.col("concept_key").desc_nulls_last())
        found = F.count_if(F.col("first") & F.col("concept_key").isNotNull())
        return (
            tables(source)
            .select("id")
            .filter(F.col("id").isNotNull())
            .join(mapped, F.col("id") == F.col("source_id"), "left")
            .withColumn("first", F.row_number().over(by_id) == 1)
            .agg(
                F.count_if("first").alias("source_records"),
                F.countDistinct("concept_key").alias("mapped_records"),
                found.alias("successfully_mapped"),
                F.round(percent(found, F.count_if("first")), 2).alias("mapping_percentage"),
            )
            .select(F.lit(name).alias("mapping"), "*")
        )

    return (
        coverage("Asset → ProductInstance", "silver.asset", "silver_s5000f.product_instance", "product_instance_id")
        .union(
            coverage(
                "WorkOrder → MaintenanceTask", "silver.work_order", "silver_s5000f.maintenance_task",
                "maintenance_task_id",
            )
        )
        .orderBy("mapping")
    )


# --- across layers ----------------------------------------------------------------------------------


def n19(tables: Tables) -> DataFrame:
    """Entities of both representations side by side, first 20."""
    asset = tables("silver.asset").select(
        F.lit("Silver (Application)").alias("data_layer"),
        F.col("id").alias("entity_id"),
        F.col("name").alias("entity_name"),
        "asset_type", "status", "location", "install_date",
    )
    instance = tables("silver_s5000f.product_instance").select(
        F.lit("Silver-S5000F (Standardised)").alias("data_layer"),
        F.col("product_instance_id").alias("entity_id"),
        F.col("name").alias("entity_name"),
        F.col("operational_status").alias("status"),
        F.col("type").alias("instance_type"),
        F.col("location").alias("instance_location"),
    )
    return (
        asset.unionByName(instance, allowMissingColumns=True).orderBy("data_layer", "entity_id").limit(20)
    )


def n20(tables: Tables) -> DataFrame:
    """Finished maintenance in both representations, latest first, 15 rows.

    Each side is cut to its own 15 rows before its texts and totals are looked up.
    """
    application = _described_orders(_latest_finished(tables, 15), tables).select(
        F.lit("Application Maintenance").alias("source"),
        F.col("id").alias("maintenance_id"),
        "description",
        "status",
        "priority",
        F.col("reported_at").alias("planned_date"),
        F.col("actual_end").alias("completed_date"),
        "asset_name",
        F.coalesce("actions", F.lit(0)).alias("action_count"),
        _round(F.col("minutes")).alias("total_duration"),
    )
    events = (
        tables("silver_s5000f.maintenance_event")
        .select("maintenance_task_id", "actual_start", blank_to_null("actual_end").alias("actual_end"))
        .filter(execution_status(F.col("actual_start"), F.col("actual_end")) == "COMPLETED")
    )
    tasks = tables("silver_s5000f.maintenance_task").select(
        "maintenance_task_id", "product_instance_id", "functional_failure_id", "planned_start"
    )
    instances = tables("silver_s5000f.product_instance").select(
        "product_instance_id", F.col("name").alias("asset_name")
    )
    few = settle(
        events.join(tasks, "maintenance_task_id")
        .join(instances, "product_instance_id")
        .withColumnRenamed("maintenance_task_id", "maintenance_id")
        .orderBy(F.desc("actual_end"), "maintenance_id")
        .limit(15)
    )
    failures = _matching(_failure_text(tables), "functional_failure_id", few, "functional_failure_id")
    steps = _steps_per_task(
        _matching(tables("silver_s5000f.maintenance_task_step"), "maintenance_task_id", few, "maintenance_id")
    )
    standard = (
        few.join(failures, "functional_failure_id", "left")
        .join(steps, F.col("maintenance_id") == F.col("step_task"), "left")
        .select(
            F.lit("S5000F Maintenance").alias("source"),
            "maintenance_id",
            F.col("failure_description").alias("description"),
            F.lit("COMPLETED").alias("status"),
            F.col("failure_priority").alias("priority"),
            F.col("planned_start").alias("planned_date"),
            F.col("actual_end").alias("completed_date"),
            "asset_name",
            F.coalesce("steps", F.lit(0)).alias("action_count"),
            _round(F.col("minutes")).alias("total_duration"),
        )
    )
    return (
        application.unionByName(standard)
        .orderBy("source", F.desc("completed_date"), "maintenance_id")
        .limit(15)
    )


def n21(tables: Tables) -> DataFrame:
    """Share of rows with a value, per layer."""

    def filled(table: str, layer: str, entity: str, *columns: str) -> DataFrame:
        return (
            tables(table)
            .agg(
                F.count(F.lit(1)).alias("total_records"),
                *[_round(completeness(c)).alias(f"field_{i}_pct") for i, c in enumerate(columns, start=1)],
            )
            .select(F.lit(layer).alias("layer"), F.lit(entity).alias("entity_type"), "*")
        )

    return (
        filled("silver.asset", "Silver", "Asset", "name", "asset_type", "status", "location")
        .union(
            filled(
                "silver_s5000f.product_instance", "Silver-S5000F", "ProductInstance", "name", "type", "location",
                "operational_status",
            )
        )
        .union(
            filled(
                "gold.asset_availability", "Gold", "AssetAvailability", "asset_id", "is_available", "availability_pct",
                "computed_at",
            )
        )
        .orderBy("layer", "entity_type")
    )


def n22(tables: Tables) -> DataFrame:
    """Timeline of maintenance in both representations, latest 20.

    The ranking carries times and keys only; texts, names and durations are looked up for the 20 events left.
    """
    narrow = ("event_type", "event_id", "event_time", "parent_key")
    orders = tables("silver.work_order").select(F.col("id").alias("parent_key"), "asset_id", "work_request_id")
    action = tables("silver.maintenance_action")
    application = (
        action.filter(F.col("started_at").isNotNull())
        .select(
            F.lit("Application Event").alias("event_type"),
            F.col("id").alias("event_id"),
            F.col("started_at").alias("event_time"),
            F.col("work_order_id").alias("parent_key"),
        )
        .join(orders.join(_asset_names(tables).select("asset_id"), "asset_id", "left_semi"), "parent_key", "left_semi")
        .select(*narrow)
    )
    instances = tables("silver_s5000f.product_instance").select("product_instance_id", F.col("name").alias("asset_name"))
    tasks = tables("silver_s5000f.maintenance_task").select(
        F.col("maintenance_task_id").alias("parent_key"), "product_instance_id", "functional_failure_id"
    )
    step = tables("silver_s5000f.maintenance_task_step")
    step_keys = step.select(F.col("maintenance_task_id").alias("parent_key"), F.col("task_step_id").alias("event_id"))
    executed = (
        tables("silver_s5000f.maintenance_event")
        .filter(F.col("actual_start").isNotNull())
        .select(F.col("maintenance_task_id").alias("parent_key"), F.col("actual_start").alias("event_time"))
        .join(tasks.join(instances, "product_instance_id", "left_semi"), "parent_key", "left_semi")
    )
    # 20 events with a step give 20 rows or more, so no event before the last of them can take part
    last = (
        executed.join(step_keys, "parent_key", "left_semi").orderBy(F.desc("event_time")).limit(20)
        .agg(F.min("event_time").alias("event_time"))
    )
    standard = (
        executed.filter(F.col("event_time") >= last.scalar())
        .join(step_keys, "parent_key")
        .withColumn("event_type", F.lit("S5000F Event"))
        .select(*narrow)
    )
    latest = (F.desc("event_time"), F.col("event_type"), F.col("event_id"))
    few = settle(application.union(standard).orderBy(*latest).limit(20))
    ours = few.filter(F.col("event_type") == "Application Event")
    theirs = few.filter(F.col("event_type") == "S5000F Event")
    shown = ("event_type", "event_id", "description", "event_time", "asset_name", "work_description", "minutes")

    few_orders = _matching(orders, "parent_key", ours, "parent_key")
    few_actions = _matching(action, "id", ours, "event_id")
    requests = _matching(_requests(tables, "description"), "request_id", few_orders, "work_request_id")
    application = (
        ours.join(few_actions.select(F.col("id").alias("event_id"), "description", _duration().alias("minutes")), "event_id")
        .join(few_orders, "parent_key")
        .join(_matching(_asset_names(tables), "asset_id", few_orders, "asset_id"), "asset_id")
        .join(
            requests.select(F.col("request_id").alias("work_request_id"), F.col("description").alias("work_description")),
            "work_request_id", "left",
        )
        .select(*shown)
    )
    few_tasks = _matching(tasks, "parent_key", theirs, "parent_key")
    few_steps = _matching(step, "task_step_id", theirs, "event_id")
    failures = _matching(_failure_text(tables), "functional_failure_id", few_tasks, "functional_failure_id")
    standard = (
        theirs.join(
            few_steps.select(F.col("task_step_id").alias("event_id"), "description", _duration().alias("minutes")), "event_id"
        )
        .join(few_tasks, "parent_key")
        .join(_matching(instances, "product_instance_id", few_tasks, "product_instance_id"), "product_instance_id")
        .join(
            failures.select("functional_failure_id", F.col("failure_description").alias("work_description")),
            "functional_failure_id", "left",
        )
        .select(*shown)
    )
    return (
        application.union(standard)
        .withColumn("duration_minutes", _round(F.col("minutes")))
        .drop("minutes")
        .orderBy(*latest)
    )


def n23(tables: Tables, system: str = SYSTEM) -> DataFrame:
    """Dashboard of all layers for the 15 best available assets."""
    ranking = (F.col("availability_pct").desc_nulls_last(), F.col("asset_name"), F.col("asset_id"))
    few = settle(
        _assets_with_availability(tables)
        .select(
            "asset_id",
            F.col("name").alias("asset_name"),
            "asset_type",
            F.col("status").alias("asset_status"),
            "location",
            "availability_pct",
        )
        .orderBy(*ranking)
        .limit(15)
    )
    state = F.col("status")
    orders = (
        _matching(tables("silver.work_order").select("id", "asset_id", "status"), "asset_id", few, "asset_id")
        .groupBy("asset_id")
        .agg(
            F.count("id").alias("total_work_orders"),
            F.count_if(state == "completed").alias("completed_work_orders"),
            F.count_if(state.isin(*OPEN_STATUSES)).alias("pending_work_orders"),
        )
    )
    # one instance per asset, so at most 15 rows
    instances = settle(
        _matching(
            tables("silver_s5000f.product_instance")
            .filter(F.col("source_system") == system)
            .select(F.col("source_id").alias("asset_id"), "product_instance_id", F.col("type").alias("instance_type")),
            "asset_id", few, "asset_id",
        )
    )
    keys = instances.select("asset_id", "product_instance_id")
    tasks = (
        tables("silver_s5000f.maintenance_task")
        .select("maintenance_task_id", "product_instance_id")
        .join(keys, "product_instance_id")
    )
    # an event belongs to the instance of its task
    events = (
        tables("silver_s5000f.maintenance_event")
        .select("maintenance_event_id", F.col("maintenance_task_id").alias("event_task"), "product_instance_id")
        .join(keys, "product_instance_id", "left_semi")
        .drop("product_instance_id")
    )
    steps = _matching(
        tables("silver_s5000f.maintenance_task_step"), "maintenance_task_id", tasks, "maintenance_task_id"
    )
    stepped = tasks.join(events, F.col("maintenance_task_id") == F.col("event_task"), "left").join(
        _steps_per_task(steps),
        (F.col("maintenance_task_id") == F.col("step_task")) & F.col("event_task").isNotNull(),
        "left",
    )
    model = stepped.groupBy("asset_id").agg(
        F.count("maintenance_task_id").alias("s5000f_maintenance_tasks"),
        F.count("maintenance_event_id").alias("s5000f_maintenance_events"),
        total("steps").alias("s5000f_maintenance_steps"),
        _round(ratio(F.sum("minutes"), F.sum("timed"))).alias("avg_s5000f_step_duration"),
    )
    pct = F.col("availability_pct")
    health = F.when(pct >= 95, "EXCELLENT").when(pct >= 90, "GOOD").when(pct >= 80, "FAIR").otherwise("POOR")
    counts = [
        "total_work_orders", "completed_work_orders", "pending_work_orders", "s5000f_maintenance_tasks",
        "s5000f_maintenance_events", "s5000f_maintenance_steps",
    ]
    return (
        few.join(instances.drop("product_instance_id"), "asset_id", "left")
        .join(orders, "asset_id", "left")
        .join(model, "asset_id", "left")
        .fillna(0, counts)
        .withColumn("health_status", health)
        .orderBy(*ranking)
        .limit(15)
    )


NAMED: dict[str, Callable[[Tables], DataFrame]] = {
    "n01": partial(_catalogue, "asset_availability"),
    "n02": partial(_catalogue, "maintenance_history"),
    "n03": partial(_catalogue, "s5000f_compliance"),
    "n04": partial(_catalogue, "cross_layer_comparison"),
    "n05": partial(_first_rows, "gold.asset_availability", "asset_id"),
    "n06": n06,
    "n07": n07,
    "n08": n08,
    "n09": partial(_first_rows, "gold.maintenance_history", "product_instance_id"),
    "n10": n10,
    "n11": n11,
    "n12": n12,
    "n13": n13,
    "n14": partial(_first_rows, "silver_s5000f.product_instance", "product_instance_id"),
    "n15": n15,
    "n16": n16,
    "n17": n17,
    "n18": n18,
    "n19": n19,
    "n20": n20,
    "n21": n21,
    "n22": n22,
    "n23": n23,
}
