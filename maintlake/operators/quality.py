"""Data-quality, contract, lifecycle and lineage checks; each returns a small report frame."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from maintlake import schemas
from maintlake.functions.ids import concept_id
from maintlake.functions.timestamps import is_iso, iso_date, parse_iso

Tables = Callable[[str], DataFrame]


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- contracts --------------------------------------------------------------------------------------


def contract_violations(spark: SparkSession, actual: dict[str, StructType]) -> DataFrame:
    """Declared against actual schemas: missing, mistyped and undeclared columns of each dataset."""
    rows = []
    for table, declared in schemas.TABLES.items():
        if table not in actual:
            rows.append((table, None, "missing_table", None, None))
            continue
        found = {f.name: f.dataType.simpleString() for f in actual[table].fields}
        for field in declared.fields:
            wanted = field.dataType.simpleString()
            if field.name not in found:
                rows.append((table, field.name, "missing_column", wanted, None))
            elif found[field.name] != wanted:
                rows.append((table, field.name, "wrong_type", wanted, found[field.name]))
        for name in found:
            if name not in declared.names:
                rows.append((table, name, "undeclared_column", None, found[name]))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, violation string, declared string, actual string"
    )


def declared_rules(table: str) -> list[tuple[str, str, Column]]:
    """(rule, column, whether a row breaks it) for everything that is declared about a dataset's values."""
    layer, name = table.split(".")
    columns = schemas.TABLES[table].names
    key = schemas.PRIMARY_KEYS.get(table)
    rules = [("required", c, F.col(c).isNull()) for c in (*schemas.REQUIRED_COLUMNS.get(layer, ()), *([key] if key else []))]
    for c in columns:
        if c in schemas.ISO_COLUMNS:
            rules.append(("format", c, (F.col(c) != "") & ~is_iso(c)))
        if (table, c) in schemas.ACCEPTED_VALUES:
            rules.append(("accepted", c, ~F.col(c).isin(*schemas.ACCEPTED_VALUES[(table, c)])))
    if layer in schemas.PARTITION_KEYS:
        partition, source = schemas.PARTITION_KEYS[layer]
        rules.append(("partition", partition, ~F.col(partition).eqNullSafe(iso_date(source))))
        entity = next(e for e, t in schemas.ENTITY_TABLES.items() if t == name)
        rules.append(("constant", "entity", ~F.col("entity").eqNullSafe(F.lit(entity))))
    return rules


def rule_report(tables: Tables, names: Iterable[str] = tuple(schemas.TABLES)) -> DataFrame:
    """Rows that break each declared rule. All rules of a dataset are one aggregation, so each is scanned once."""
    reports = []
    for table in names:
        rules = declared_rules(table)
        counts = [
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), F.count_if(broken).alias("violations"))
            for rule, c, broken in rules
        ]
        found = tables(table).agg(F.count(F.lit(1)).alias("checked_rows"), F.array(*counts).alias("rules"))
        reports.append(found.select(F.lit(table).alias("table_name"), "checked_rows", F.inline("rules")))
    return _stack(reports)


def offset_islands(messages: DataFrame) -> DataFrame:
    """``topic, partition, first_offset, last_offset``: the unbroken runs of offsets of each feed partition.

    An offset begins a run if the one before it is missing, and the next missing one ends it. Both show where
    each offset meets the successor of its predecessor, in one aggregation by offset: a partition is never sorted as a whole.
    Only the ends of runs are then put in order.
    """
    place = ["topic", "partition"]
    own = messages.select(*place, F.col("offset").alias("x"), F.lit(True).alias("own"))
    after = messages.select(*place, (F.col("offset") + 1).alias("x"), F.lit(False).alias("own"))
    met = own.unionByName(after).groupBy(*place, "x").agg(F.bool_or("own").alias("is"), F.bool_and("own").alias("begins"))
    ends = met.filter(F.col("begins") | ~F.col("is"))
    order = Window.partitionBy(*place).orderBy("x")
    return (
        ends.withColumn("next", F.lead("x").over(order))
        .filter("begins")
        .select(*place, F.col("x").alias("first_offset"), (F.col("next") - 1).alias("last_offset"))
    )


def offset_report(messages: DataFrame) -> DataFrame:
    """Whether a feed arrived whole, by topic and partition: messages, repeated ones, and offsets missing between the first
    and the last. Messages without an offset are none of a feed's."""
    known = messages.filter(F.col("offset").isNotNull()).select(F.col("topic"), "partition", F.col("offset").cast("long").alias("offset"))
    distinct = F.col("last_offset") - F.col("first_offset") + 1
    islands = offset_islands(known).groupBy("topic", "partition").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"),
        F.sum(distinct).alias("offsets"), (F.count(F.lit(1)) - 1).alias("gaps"),
    )
    arrived = known.groupBy(F.col("topic").alias("t"), F.col("partition").alias("p")).agg(F.count(F.lit(1)).alias("messages"))
    same = F.col("topic").eqNullSafe(F.col("t")) & F.col("partition").eqNullSafe(F.col("p"))
    return islands.join(arrived, same).select(
        "topic", "partition", "first_offset", "last_offset", "messages", (F.col("messages") - F.col("offsets")).alias("repeated"), "gaps",
        (distinct - F.col("offsets")).alias("missing"),
    )


def key_report(tables: Tables, keys: dict[str, str] | None = None) -> DataFrame:
    """not_null and unique of every primary key, each table in one aggregation by its key."""
    return _stack(
        tables(table)
        .groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
        )
        .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"), "*")
        for table, key in (keys or schemas.PRIMARY_KEYS).items()
    )


def unexpected_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted set with their row counts; null is not a value."""
    return df.filter(~F.col(column).isin(*accepted)).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def accepted_values_report(tables: Tables) -> DataFrame:
    """Checked and violating rows per enumerated column; the columns of one table share one scan."""
    by_table: dict[str, dict[str, Sequence[str]]] = {}
    for (table, column), accepted in schemas.ACCEPTED_VALUES.items():
        by_table.setdefault(table, {})[column] = accepted
    reports = []
    for table, columns in by_table.items():
        counts = tables(table).agg(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.count(c).alias("checked_rows"),
                        F.count_if(~F.col(c).isin(*accepted)).alias("violations"),
                    )
                    for c, accepted in columns.items()
                ]
            ).alias("checks")
        )
        reports.append(counts.select(F.lit(table).alias("table_name"), F.inline("checks")))
    return _stack(reports)


def relationship_report(tables: Tables, relationships: Sequence[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """Orphans per foreign key. References are counted per key first, so a hot key is one row in the join."""
    reports = []
    for child, column, parent, parent_key in relationships or schemas.RELATIONSHIPS:
        references = (
            tables(child)
            .filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("ref"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        parents = tables(parent).select(F.col(parent_key).alias("ref")).distinct().withColumn("found", F.lit(True))
        reports.append(
            references.join(parents, "ref", "left")
            .agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"),
                F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
                F.count_if(F.col("found").isNull()).alias("orphan_keys"),
            )
            .select(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                "*",
            )
        )
    return _stack(reports)


# --- lifecycle --------------------------------------------------------------------------------------


def creation_report(events: DataFrame, entity: str, tie: Sequence[str] = ()) -> DataFrame:
    """Keys whose first event is not a create."""
    first = F.min_by(F.coalesce("op", F.lit("")), F.struct("event_ts", *tie))
    return (
        events.groupBy("pk_id")
        .agg(first.alias("first_op"))
        .agg(
            F.count(F.lit(1)).alias("key_count"),
            F.count_if(F.col("first_op") != "c").alias("not_created_first"),
        )
        .select(F.lit(entity).alias("entity"), "*")
    )


def with_previous(events: DataFrame, key: str, ts: str, value: str, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``previous``: ``value`` of the preceding event of the same key, in (ts, tie) order.

    A plain ``lag`` would put all events of a key into one task. The window therefore takes one key and
    hour (of the ISO text), whatever the size of the key. The first event of an hour then lacks its predecessor,
    which is the last event of the key's hour before: one row per key and hour, so a key has at most as
    many as there are hours. Both read the same shuffled rows, and their join needs no further
    shuffle of the events. An event without a key has no predecessor.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    hour = F.coalesce(F.substring(ts, 1, 13), F.lit(""))
    rows = events.withColumns({"key_group": group, "key_hour": hour}).repartition("key_group", "key_hour")
    inside = Window.partitionBy("key_group", "key_hour").orderBy(ts, *tie)
    local = rows.withColumns(
        {"previous": F.lag(value).over(inside), "first_in_hour": F.row_number().over(inside) == 1}
    )
    carried = (
        rows.groupBy(F.col("key_group").alias("g"), F.col("key_hour").alias("h"))
        .agg(F.max_by(value, F.struct(ts, *tie)).alias("last_value"))
        .withColumn("carried", F.lag("last_value").over(Window.partitionBy("g").orderBy("h")))
        .drop("last_value")
    )
    before = F.when(F.col("first_in_hour"), F.col("carried")).otherwise(F.col("previous"))
    return (
        local.join(carried, (F.col("key_group") == F.col("g")) & (F.col("key_hour") == F.col("h")), "left")
        .withColumn("previous", F.when(F.col("key_group") != "", before))
        .drop("key_group", "key_hour", "first_in_hour", "g", "h", "carried")
    )


def transition_report(
    events: DataFrame, entity_table: str, tie: Sequence[str] = (), status: str = "status"
) -> DataFrame:
    """Status changes between consecutive events of a key, counted, with whether each is allowed.

    ``events`` carries pk_id, event_ts, the tie columns and the status after the event (null after a
    delete, so a re-created key starts afresh).
    """
    narrow = events.select("pk_id", "event_ts", *tie, F.col(status).alias("to_status"))
    allowed = F.lit(False)
    for before, after in schemas.TRANSITIONS[entity_table]:
        allowed = allowed | ((F.col("from_status") == before) & (F.col("to_status") == after))
    return (
        with_previous(narrow, "pk_id", "event_ts", "to_status", tie)
        .withColumnRenamed("previous", "from_status")
        .filter(F.col("from_status") != F.col("to_status"))
        .groupBy("from_status", "to_status")
        .agg(F.count(F.lit(1)).alias("changes"))
        .withColumn("allowed", allowed)
    )


def unfinished_actions(work_order: DataFrame, action: DataFrame) -> DataFrame:
    """Completed orders, and those of them that still have an action which is not completed."""
    pending = (
        action.filter(F.col("status").isNull() | (F.col("status") != "completed"))
        .groupBy(F.col("work_order_id").alias("pending_order"))
        .agg(F.count(F.lit(1)).alias("pending_actions"))
    )
    return (
        work_order.filter(F.col("status") == "completed")
        .select("id")
        .join(pending, F.col("id") == F.col("pending_order"), "left")
        .agg(
            F.count(F.lit(1)).alias("completed_orders"),
            F.count("pending_order").alias("with_unfinished_actions"),
            F.coalesce(F.sum("pending_actions"), F.lit(0)).alias("unfinished_actions"),
        )
    )


# --- lineage, freshness, traceability ---------------------------------------------------------------


def lineage_edges(spark: SparkSession) -> DataFrame:
    rows = [(dataset, upstream) for dataset, sources in schemas.LINEAGE.items() for upstream in sources]
    return spark.createDataFrame(rows, "dataset string, upstream string")


def freshness_report(tables: Tables, names: Iterable[str], as_of: str) -> DataFrame:
    """Age of each dataset's newest row at or before ``as_of`` against the freshness its layer promises.

    Rows dated later are counted in ``future_rows``; they don't make a dataset fresh.
    """
    reports = []
    end = parse_iso(F.lit(as_of))
    age = (F.unix_micros(end) - F.unix_micros(parse_iso("latest"))) / F.lit(3_600_000_000.0)
    for table in names:
        layer = table.split(".")[0]
        limit, column = schemas.FRESHNESS_HOURS[layer], schemas.FRESHNESS_COLUMNS[layer]
        at = parse_iso(column)
        reports.append(
            tables(table)
            .agg(F.max(F.when(at <= end, F.col(column))).alias("latest"), F.count_if(at > end).alias("future_rows"))
            .select(
                F.lit(table).alias("table_name"),
                "latest",
                "future_rows",
                F.round(age, 6).alias("age_hours"),
                F.lit(limit).cast("long").alias("limit_hours"),
                F.coalesce(age <= limit, F.lit(False)).alias("is_fresh"),
            )
        )
    return _stack(reports)


def source_reach(spark: SparkSession) -> DataFrame:
    """``table_name, source``: every dataset that a dataset is computed from, through any number of steps, and itself."""
    return spark.sql(
        """WITH RECURSIVE reach(table_name, source) AS (
               SELECT table_name, table_name FROM {datasets}
               UNION ALL
               SELECT reach.table_name, edges.upstream FROM reach JOIN {edges} edges ON edges.dataset = reach.source)
           SELECT DISTINCT table_name, source FROM reach""",
        datasets=spark.createDataFrame([(t,) for t in schemas.TABLES], "table_name string"),
        edges=lineage_edges(spark),
    )


def stale_source_report(spark: SparkSession, freshness: DataFrame) -> DataFrame:
    """For each dataset of a :func:`freshness_report` its stalest source: staleness flows down the lineage.

    A source is as stale as it is older than its own limit; one without rows is the stalest of all. Ties go to the
    smaller name. ``is_fresh`` says whether the dataset and all that it is computed from are fresh.
    """
    source = freshness.select(
        F.col("table_name").alias("source"), (F.col("age_hours") - F.col("limit_hours")).alias("overdue"), F.col("is_fresh").alias("fresh")
    )
    # the greatest, nulls first; then the smallest name: the least of (has an age, -overdue, name)
    order = F.struct(F.col("overdue").isNotNull().alias("known"), (-F.col("overdue")).alias("less"), "source")
    stalest = F.min(order).alias("stalest")
    return (
        source_reach(spark)
        .join(source, "source")
        .groupBy("table_name")
        .agg(
            stalest, F.count(F.lit(1)).alias("sources"), F.count_if(~F.col("fresh")).alias("stale_sources"),
            F.bool_and("fresh").alias("is_fresh"),
        )
        .select(
            "table_name", "sources", "stale_sources", F.col("stalest.source").alias("stalest_source"),
            F.round(-F.col("stalest.less"), 6).alias("overdue_hours"), "is_fresh",
        )
    )


def foreign_id_report(tables: Tables) -> DataFrame:
    """Concept rows whose foreign identifiers aren't the hash of what their source row refers to, or that have no source row."""
    reports = []
    for table, column, concept, source, referred in schemas.FOREIGN_IDS:
        wanted = tables(source).select(
            F.col("source_id").alias("origin"), concept_id(concept, referred).alias("wanted"), F.lit(True).alias("found")
        )
        rows = tables(f"silver_s5000f.{table}").select("source_id", F.col(column).alias("actual"))
        reports.append(
            rows.join(wanted, F.col("source_id") == F.col("origin"), "left")
            .agg(
                F.count(F.lit(1)).alias("checked_rows"),
                F.count_if(F.col("found").isNull()).alias("without_source"),
                F.count_if(F.col("found") & ~F.col("actual").eqNullSafe(F.col("wanted"))).alias("untraceable"),
            )
            .select(F.lit(table).alias("concept_table"), F.lit(column).alias("foreign_id"), "*")
        )
    return _stack(reports)


def traceability_report(tables: Tables) -> DataFrame:
    """Concept rows whose identifier is not the hash of their source key."""
    origin = {
        "product_instance": ("product_instance_id", "ProductInstance"),
        "functional_failure": ("functional_failure_id", "FunctionalFailure"),
        "maintenance_task": ("maintenance_task_id", "MaintenanceTask"),
        "maintenance_task_step": ("task_step_id", "MaintenanceTaskStep"),
        "maintenance_event": ("maintenance_event_id", "MaintenanceEvent"),
    }

    def mismatch(key: str, concept: str) -> Column:
        return F.count_if(~F.col(key).eqNullSafe(concept_id(concept, "source_id")))

    return _stack(
        tables(f"silver_s5000f.{table}")
        .agg(F.count(F.lit(1)).alias("checked_rows"), mismatch(key, concept).alias("untraceable"))
        .select(F.lit(table).alias("concept_table"), "*")
        for table, (key, concept) in origin.items()
    )
