"""The driver's order/line-item/event tables seen as maintenance data.

Customers act as assets, orders as requests and work orders, line items as the change feed of
maintenance actions and the event log as a change feed of assets, so that every operator can run
over whole tables of any scale.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from maintlake.functions.timestamps import iso_date, iso_utc
from maintlake.operators import concepts, gold
from maintlake.operators.envelope import envelope_json
from maintlake.operators.latest import latest_per_key
from maintlake.schemas import AFTER

SYSTEM = "driver"
RUN_STAMP = "2002-01-01T00:00:00+00:00"
ACTION_TIE = ("l_partkey", "l_suppkey")
ASSET_TIE = ("event_id",)

# "after" image of the event feed
EVENT_AFTER = StructType(
    [
        StructField("id", StringType()),
        StructField("k", LongType()),
        StructField("value", DoubleType()),
        StructField("event_type", StringType()),
    ]
)


#: Rows of a source that one task turns into change events: with their JSON some hundred megabytes.
ROWS_PER_TASK = 200_000


def spread(df: DataFrame, rows: int = 0) -> DataFrame:
    """Deal rows evenly to every core, or to as many tasks as ``rows`` of them need, so that no task grows with the input.

    The splits of a scan say nothing about that: a row group is read by one task however many splits its file has, and
    building and sorting JSON behind such a scan would run on few cores, with all their rows in memory. What is
    dealt here are the narrow rows before they become JSON.
    """
    if df.isStreaming:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK)))


def _text(prefix: str, *parts: str) -> Column:
    pieces = [F.lit(prefix), F.col(parts[0]).cast("string")]
    for p in parts[1:]:
        pieces += [F.lit("-"), F.col(p).cast("string")]
    return F.concat(*pieces)


def _after_days(c: str, days: int) -> Column:
    return iso_utc(F.col(c) + F.make_dt_interval(F.lit(days)))


def _with_cdc(df: DataFrame, main_ts: str) -> DataFrame:
    return df.withColumns(
        {
            "source_system": F.lit(SYSTEM),
            "source_id": F.col("id"),
            "last_op": F.lit("c"),
            "last_event_ts": F.col(main_ts),
        }
    )


def _case(key: str, choices: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in choices.items():
        out = F.when(F.col(key) == k, v).otherwise(out)
    return out


def asset(customer: DataFrame, nation: DataFrame) -> DataFrame:
    balance = F.col("c_acctbal")
    return _with_cdc(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            _text("A", "c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lower("c_mktsegment").alias("asset_type"),
            F.col("n_name").alias("location"),
            F.when(balance < 0, "failed").when(balance < 1000, "degraded").otherwise("operational").alias("status"),
            F.lit("1995-01-01").alias("install_date"),
            F.lit("1995-01-01T00:00:00.000000+00:00").alias("updated_at"),
        ),
        "updated_at",
    )


def work_request(orders: DataFrame) -> DataFrame:
    priorities = {"1-URGENT": "critical", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}
    return _with_cdc(
        orders.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
            _text("WR", "o_orderkey").alias("id"),
            _text("A", "o_custkey").alias("asset_id"),
            _text("order ", "o_orderkey").alias("description"),
            _case("o_orderpriority", priorities).alias("priority"),
            _case("o_orderstatus", {"F": "closed", "P": "approved", "O": "open"}).alias("status"),
            iso_utc("o_orderdate").alias("reported_at"),
            iso_utc("o_orderdate").alias("updated_at"),
        ),
        "reported_at",
    )


def work_order(orders: DataFrame) -> DataFrame:
    finished = F.col("o_orderstatus") == "F"
    last_digit = F.col("o_orderkey") % 10
    started = (
        F.when(F.col("o_orderstatus") == "O", "")
        .when(finished & (last_digit == 0), "")
        .when(finished & (last_digit == 1), F.lit(None).cast("string"))
        .otherwise(_after_days("o_orderdate", 2))
    )
    return _with_cdc(
        orders.select(
            _text("WO", "o_orderkey").alias("id"),
            _text("WR", "o_orderkey").alias("work_request_id"),
            _text("A", "o_custkey").alias("asset_id"),
            _case("o_orderstatus", {"F": "completed", "P": "in_progress", "O": "planned"}).alias("status"),
            _after_days("o_orderdate", 1).alias("planned_start"),
            _after_days("o_orderdate", 4).alias("planned_end"),
            started.alias("actual_start"),
            F.when(finished, _after_days("o_orderdate", 5)).otherwise("").alias("actual_end"),
            iso_utc("o_orderdate").alias("updated_at"),
        ),
        "updated_at",
    )


def _action_columns() -> list[Column]:
    done = F.col("l_linestatus") == "F"
    finish = iso_utc(F.col("l_shipdate") + F.make_dt_interval(mins=F.col("l_quantity").cast("int")))
    return [
        _text("MA", "l_orderkey", "l_linenumber").alias("id"),
        _text("WO", "l_orderkey").alias("work_order_id"),
        F.col("l_linenumber").cast("long").alias("step_number"),
        _case("l_returnflag", {"A": "Inspect", "N": "Replace", "R": "Test"}).alias("description"),
        F.when(done, "completed").otherwise("pending").alias("status"),
        iso_utc("l_shipdate").alias("started_at"),
        F.when(done, finish).otherwise("").alias("completed_at"),
    ]


def maintenance_action(lineitem: DataFrame) -> DataFrame:
    """Latest line item per (order, line), deletes ignored."""
    latest = latest_per_key(
        lineitem.select(
            "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
            "l_linestatus",
        ),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    )
    return _with_cdc(latest.select(*_action_columns()), "started_at")


def action_events(lineitem: DataFrame) -> DataFrame:
    """Line items as change events: the return flag says create, update or delete."""
    return lineitem.select(
        _case("l_returnflag", {"A": "c", "N": "u", "R": "d"}).alias("op"),
        iso_utc("l_shipdate").alias("event_ts"),
        *ACTION_TIE,
        *_action_columns(),
    )


def _live(op: Column, c: str) -> Column:
    return F.when(op != "d", F.col(c)).alias(c)


def _feed(events: DataFrame, entity: str, columns: list[str], tie: tuple[str, ...] = ()) -> DataFrame:
    """Change events (id, op, event_ts, tie and the columns of the after image) -> Bronze rows and tie."""
    after = F.struct(*[_live(F.col("op"), n) for n in columns])
    return events.select(
        F.lit(entity).alias("entity"),
        "op",
        "event_ts",
        F.col("id").alias("pk_id"),
        envelope_json(entity, F.col("op"), F.col("event_ts"), F.col("id"), after).alias("payload_json"),
        iso_date("event_ts").alias("event_date"),
        F.lit(SYSTEM).alias("source_system"),
        *tie,
    )


def action_feed(lineitem: DataFrame) -> DataFrame:
    """``action_events`` as Bronze rows plus the tie-break columns."""
    return _feed(action_events(lineitem), "MaintenanceAction", AFTER["maintenance_action"].names, ACTION_TIE)


def _lifecycle(final: DataFrame, path: dict[str, tuple[str, ...]]) -> DataFrame:
    """Final rows -> one event per status on the way there, a minute apart."""
    steps = F.lit(None).cast("array<string>")
    for status, way in path.items():
        steps = F.when(F.col("status") == status, F.array(*[F.lit(s) for s in way])).otherwise(steps)
    minute = F.concat(F.substring("updated_at", 1, 14), F.lpad(F.col("step").cast("string"), 2, "0"))
    return (
        final.select("*", F.posexplode(steps).alias("step", "reached"))
        .withColumns(
            {
                "op": F.when(F.col("step") == 0, "c").otherwise("u"),
                "event_ts": F.concat(minute, F.substring("updated_at", 17, 16)),
                "status": F.col("reached"),
            }
        )
        .withColumn("updated_at", F.col("event_ts"))
    )


def asset_events(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return _lifecycle(
        asset(customer, nation),
        {
            "operational": ("operational",),
            "degraded": ("operational", "degraded"),
            "failed": ("operational", "failed"),
        },
    )


def work_request_events(orders: DataFrame) -> DataFrame:
    return _lifecycle(
        work_request(orders),
        {"open": ("open",), "approved": ("open", "approved"), "closed": ("open", "approved", "closed")},
    )


def work_order_events(orders: DataFrame) -> DataFrame:
    return _lifecycle(
        work_order(orders),
        {
            "planned": ("planned",),
            "in_progress": ("planned", "in_progress"),
            "completed": ("planned", "in_progress", "completed"),
        },
    )


def event_messages(events: DataFrame) -> DataFrame:
    """The event log as raw CDC documents: (value, event_id)."""
    shaped = events.select(
        _text("U", "user_id").alias("id"),
        F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u").alias("op"),
        iso_utc("ts").alias("event_ts"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        "value",
        "event_type",
        "event_id",
    )
    after = F.struct(*[_live(F.col("op"), n) for n in EVENT_AFTER.names])
    return shaped.select(
        envelope_json("Asset", F.col("op"), F.col("event_ts"), F.col("id"), after).alias("value"), "event_id",
        "op", "event_ts", "id",
    )


def asset_feed(events: DataFrame) -> DataFrame:
    """The event log as Bronze rows plus ``event_id``."""
    return event_messages(events).select(
        F.lit("Asset").alias("entity"),
        "op",
        "event_ts",
        F.col("id").alias("pk_id"),
        F.col("value").alias("payload_json"),
        iso_date("event_ts").alias("event_date"),
        F.lit(SYSTEM).alias("source_system"),
        "event_id",
    )


def action_snapshot(events: DataFrame) -> DataFrame:
    """State of the maintenance actions after the given change events."""
    columns = ["id", "op", "event_ts", "status", *ACTION_TIE]
    latest = latest_per_key(events.select(*columns), ["id"], ["event_ts", *ACTION_TIE])
    return latest.filter(F.col("op") != "d").select("id", "status", F.col("event_ts").alias("started_at"))


class BoundTables:
    """Every layer table, derived lazily from one folder of driver tables; call it with a table name."""

    # by path and its last change, so that a process reads each file's footer once and a replaced file's again
    _schemas: dict[tuple[str, int], StructType] = {}
    _counts: dict[tuple[str, int], int] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, stamp: str = RUN_STAMP):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.stamp = stamp
        self._read: dict[str, DataFrame] = {}

    def _changed(self, path: str) -> int:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.getFileStatus(jpath).getModificationTime()

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            path = f"{self.sf_dir}/{name}.parquet"
            known = path, self._changed(path)
            if known not in self._schemas:
                self._schemas[known] = self.spark.read.parquet(path).schema
            self._read[name] = self.spark.read.schema(self._schemas[known]).parquet(path)
        return self._read[name]

    def spread(self, name: str) -> DataFrame:
        """A driver table dealt evenly to tasks; its rows are counted from the footers, once a process and file."""
        path = f"{self.sf_dir}/{name}.parquet"
        known = path, self._changed(path)
        if known not in self._counts:
            self._counts[known] = self.raw(name).count()
        return spread(self.raw(name), self._counts[known])

    def __call__(self, name: str) -> DataFrame:
        if name not in self._read:
            namespace, table = name.split(".")
            self._read[name] = getattr(self, f"_{namespace}")[table]()
        return self._read[name]

    @property
    def names(self) -> list[str]:
        layers = ("bronze", "silver", "silver_s5000f", "gold")
        return [f"{layer}.{table}" for layer in layers for table in getattr(self, f"_{layer}")]

    @cached_property
    def _bronze(self):
        return {
            "asset": lambda: asset_feed(self.spread("events")),
            "maintenance_action": lambda: action_feed(self.spread("lineitem")),
            "work_request": lambda: _feed(
                work_request_events(self.spread("orders")), "WorkRequest", AFTER["work_request"].names
            ),
            "work_order": lambda: _feed(
                work_order_events(self.spread("orders")), "WorkOrder", AFTER["work_order"].names
            ),
            "registered_asset": lambda: _feed(
                asset_events(self.spread("customer"), self.raw("nation")), "Asset", AFTER["asset"].names
            ),
        }

    @cached_property
    def _silver(self):
        return {
            "asset": lambda: asset(self.raw("customer"), self.raw("nation")),
            "work_request": lambda: work_request(self.raw("orders")),
            "work_order": lambda: work_order(self.raw("orders")),
            "maintenance_action": lambda: maintenance_action(self.raw("lineitem")),
        }

    @cached_property
    def _silver_s5000f(self):
        at = self.stamp
        return {
            "product_instance": lambda: concepts.product_instance(self("silver.asset"), at),
            "functional_failure": lambda: concepts.functional_failure(self("silver.work_request"), at),
            "maintenance_task": lambda: concepts.maintenance_task(self("silver.work_order"), at),
            "maintenance_task_step": lambda: concepts.maintenance_task_step(self("silver.maintenance_action"), at),
            "maintenance_event": lambda: concepts.maintenance_event(
                self("silver.work_order"), self("silver.maintenance_action"), at
            ),
        }

    @cached_property
    def _gold(self):
        at = self.stamp
        return {
            "asset_availability": lambda: gold.asset_availability(self("silver.asset"), at),
            "maintenance_history": lambda: gold.maintenance_history(self("silver_s5000f.maintenance_event"), at),
            "work_order_backlog": lambda: gold.work_order_backlog(
                self("silver.work_order"), self("silver.work_request"), at
            ),
            "mtbf_metrics": lambda: gold.mtbf_metrics(
                self("silver_s5000f.product_instance"), self("silver_s5000f.functional_failure"), at
            ),
            "asset_maintenance_summary": lambda: gold.asset_maintenance_summary(
                self("silver.work_order"), self("silver.maintenance_action"), at
            ),
            "asset_mtbf_days": lambda: gold.asset_mtbf_days(self("silver.asset"), self("silver.work_request"), at),
            "backlog_detail": lambda: gold.backlog_detail(self("silver.work_order"), self("silver.work_request"), at),
        }
