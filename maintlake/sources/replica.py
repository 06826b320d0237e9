"""Relational replica: staged text copies of the layer tables and the models over them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from maintlake.schemas import BRONZE, GOLD, AFTER, CDC_COLUMNS
from maintlake.sources.tables import TableStore

AUDIT = ("dbt_created_at", "dbt_updated_at")
_SRC = ("source_system", "source_id", "mapped_at")

# model -> (staged table, columns); a pair renames (staged column, model column)
MODELS: dict[str, tuple[str, tuple]] = {
    **{
        f"bronze_{t}": (f"bronze.{t}", (*BRONZE.names, ("dbt_created_at", "dbt_loaded_at")))
        for t in AFTER
    },
    **{f"silver_{t}": (f"silver.{t}", (*s.names, *CDC_COLUMNS.names, *AUDIT)) for t, s in AFTER.items()},
    "silver_s5000f_product_instance": (
        "silver_s5000f.product_instance",
        ("product_instance_id", "name", "type", "location", "operational_status", "installation_date", *_SRC, *AUDIT),
    ),
    "silver_s5000f_maintenance_task": (
        "silver_s5000f.maintenance_task",
        (
            "maintenance_task_id", "product_instance_id", "status", ("planned_start", "planned_start_date"),
            ("planned_end", "planned_end_date"), *_SRC, *AUDIT,
        ),
    ),
    "silver_s5000f_maintenance_event": (
        "silver_s5000f.maintenance_event",
        (
            "maintenance_event_id", "product_instance_id", "maintenance_task_id",
            ("actual_start", "actual_start_date"), ("actual_end", "actual_end_date"), *_SRC, *AUDIT,
        ),
    ),
    "silver_s5000f_maintenance_task_step": (
        "silver_s5000f.maintenance_task_step",
        (
            ("task_step_id", "maintenance_task_step_id"), "maintenance_task_id", ("step_number", "step_sequence"),
            "description", "status", *_SRC, *AUDIT,
        ),
    ),
    "gold_asset_availability": ("gold.asset_availability", (*GOLD["asset_availability"].names, *AUDIT)),
    "gold_maintenance_history": (
        "gold.asset_maintenance_summary", (*GOLD["asset_maintenance_summary"].names, *AUDIT),
    ),
    "gold_mtbf_metrics": ("gold.asset_mtbf_days", (*GOLD["asset_mtbf_days"].names, *AUDIT)),
    "gold_work_order_backlog": ("gold.backlog_detail", (*GOLD["backlog_detail"].names, *AUDIT)),
}


def with_audit(df: DataFrame, load_ts: str) -> DataFrame:
    return df.withColumns({name: F.lit(load_ts) for name in AUDIT})


def staged(df: DataFrame, load_ts: str) -> DataFrame:
    """Every column as text plus the audit columns; all rows, there is no cap."""
    return with_audit(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), load_ts)


def stamp_version(df: DataFrame, version: str | None) -> DataFrame:
    """Add the version of the source table a copy was taken from."""
    return df.withColumn("source_version", F.lit(version or "unknown"))


def source_version(df: DataFrame, column: str) -> DataFrame:
    """Newest version among the rows of a versioned copy; 'unknown' for no rows."""
    return df.agg(F.coalesce(F.max(F.col(column).cast("string")), F.lit("unknown")).alias("source_version"))


def model(name: str, stage: DataFrame) -> DataFrame:
    """One replica model over its staged table."""
    _, columns = MODELS[name]
    pairs = [c if isinstance(c, tuple) else (c, c) for c in columns]
    return stage.select(*[F.col(source).alias(target) for source, target in pairs])


def jdbc_sink(url: str, properties: dict[str, str], partitions: int = 8, batch_size: int = 10_000):
    """Sink that truncates and reloads a database table over ``partitions`` connections."""

    def write(df: DataFrame, table: str) -> None:
        (
            df.write.format("jdbc")
            .options(**properties)
            .option("url", url)
            .option("dbtable", table)
            .option("truncate", True)
            .option("numPartitions", partitions)
            .option("batchsize", batch_size)
            .mode("overwrite")
            .save()
        )

    return write


def parquet_sink(root: str) -> Callable[[DataFrame, str], None]:
    def write(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{table}")

    return write


def load_staging(
    store: TableStore,
    layer: str,
    table: str,
    sink: Callable[[DataFrame, str], None],
    load_ts: str,
    limit: int | None = None,
) -> str:
    """Copy one layer table into ``staging_<layer>.<table>``; returns load statistics as JSON.

    Each row carries the version it was copied from. ``limit`` copies at most that many rows, on request only. Errors are raised, not reported as text.
    Each load also adds its statistics to the table ``replica.load_audit``.
    """
    name = f"{layer}.{table}"
    source = stamp_version(store(name), store.version(name))
    if limit:
        source = source.limit(limit)
    written = Observation()
    sink(staged(source, load_ts).observe(written, F.count(F.lit(1)).alias("rows")), f"staging_{layer}.{table}")
    statistics = {
        "status": "success",
        "layer": layer,
        "table": table,
        "rows_loaded": written.get["rows"],
        "timestamp": load_ts,
    }
    record_load(store, statistics)
    return json.dumps(statistics)


def record_load(store: TableStore, statistics: dict) -> None:
    store.ensure_namespaces(["replica"])
    row = store.spark.createDataFrame(
        [tuple(statistics.values())], "status string, layer string, table string, rows_loaded long, timestamp string"
    )
    row.coalesce(1).write.mode("append").saveAsTable("replica.load_audit")


def build_models(store: TableStore, stage: Callable[[str], DataFrame], materialise: str = "table") -> dict[str, int]:
    """Build every model whose staged table is available; staging stays a view, models become tables."""
    counts = {}
    for name, (source, _) in MODELS.items():
        df = model(name, stage(source))
        if materialise == "view":
            df.createOrReplaceTempView(name)
        else:
            counts[name] = store.publish(f"replica.{name}", df)
    return counts
