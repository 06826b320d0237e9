"""One entry point for queries over all layers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from maintlake.schemas import NAMESPACES, QUERY_NAMESPACES, TABLES
from maintlake.sources.tables import TableStore

Tables = Callable[[str], DataFrame]
DATE_COLUMNS = ("event_date", "date")


def flat_name(table: str) -> str:
    """``silver.asset`` -> ``silver_asset``."""
    return table.replace(".", "_")


def on_date(df: DataFrame, day: str | date | datetime | None) -> DataFrame:
    """Rows of one day, by the table's date column; tables without one are unchanged."""
    column = next((c for c in DATE_COLUMNS if c in df.columns), None)
    if not day or column is None:
        return df
    text = day.strftime("%Y-%m-%d") if isinstance(day, date) else str(day)
    return df.filter(F.col(column) == text)


class Lakehouse:
    """Queries tables by name or by SQL; Spark's parser and catalog do the rest.

    In SQL, ``namespace.table`` and ``namespace_table`` both name a table.
    """

    def __init__(self, spark: SparkSession, tables: Tables, names: Iterable[str] = tuple(TABLES)):
        self.spark = spark
        self.tables = tables
        self.names = list(names)

    def query(
        self,
        table: str | None = None,
        sql: str | None = None,
        date_filter: str | date | datetime | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        """Lazy result of ``sql``, or of the whole ``table``; ``sql`` wins if both are given.

        ``date_filter`` restricts every table that has a date column, ``limit`` the result (0 and
        None mean all rows).
        """
        if sql:
            result = self._run(sql, date_filter)
        elif table:
            result = on_date(self.tables(self._resolve(table)), date_filter)
        else:
            raise ValueError("either table or sql must be given")
        return result.limit(limit) if limit else result

    def available_tables(self) -> dict[str, list[str]]:
        """Tables per queryable namespace."""
        if isinstance(self.tables, TableStore):
            return {ns: self.tables.list_tables(ns) for ns in QUERY_NAMESPACES}
        return {ns: sorted(n for n in self.names if n.startswith(f"{ns}.")) for ns in QUERY_NAMESPACES}

    def _resolve(self, name: str) -> str:
        if name in self.names or "." in name:
            return name
        return next((n for n in self.names if flat_name(n) == name), name)

    def _run(self, sql: str, date_filter: str | date | datetime | None) -> DataFrame:
        """Views live only while the query is analysed; the result holds their plans.

        Their names are this call's own, so that neither views of the user nor other threads are met.
        """
        suffix = f"_{uuid.uuid4().hex}"
        used: set[str] = set()
        spellings = {s.lower(): n for n in self.names for s in (n, flat_name(n))}

        def view_for(match: re.Match) -> str:
            if not match["table"]:
                return match[0]
            name = spellings[match["table"].lower()]
            used.add(name)
            return flat_name(name) + suffix

        text = self._table_pattern().sub(view_for, sql)
        try:
            for name in used:
                on_date(self.tables(name), date_filter).createOrReplaceTempView(flat_name(name) + suffix)
            return self.spark.sql(text)
        finally:
            for name in used:
                self.spark.catalog.dropTempView(flat_name(name) + suffix)

    def _table_pattern(self) -> re.Pattern:
        """Known table names in either spelling; quoted text and comments match first and stay as they are."""
        spellings = sorted({s for n in self.names for s in (n, flat_name(n))}, key=len, reverse=True)
        known = "|".join(map(re.escape, spellings))
        skipped = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|--[^\n]*|/\*.*?\*/"""
        return re.compile(rf"{skipped}|(?<![\w.])(?P<table>{known})(?!\w)", re.IGNORECASE | re.DOTALL)


def open_store(spark: SparkSession) -> Lakehouse:
    """The lakehouse over the session catalog."""
    store = TableStore(spark)
    published = [n for ns in NAMESPACES for n in store.list_tables(ns)]
    return Lakehouse(spark, store, dict.fromkeys([*TABLES, *published]))


# Named SQL. Work orders have no text or priority of their own: those come from the request.
EXAMPLES = {
    "asset_availability": """
        SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, a.status AS asset_status,
               av.availability_pct, h.last_maintenance
        FROM silver.asset a
        LEFT JOIN gold.asset_availability av ON av.asset_id = a.id
        LEFT JOIN silver_s5000f.product_instance p ON p.source_id = a.id
        LEFT JOIN gold.maintenance_history h ON h.product_instance_id = p.product_instance_id
        ORDER BY av.availability_pct DESC NULLS LAST, a.id
    """,
    "maintenance_history": """
        WITH counted AS (
            SELECT work_order_id, COUNT(id) AS action_count FROM silver.maintenance_action GROUP BY 1
        )
        SELECT a.id AS asset_id, a.name AS asset_name, w.id AS work_order_id, r.description,
               w.status AS wo_status, r.reported_at AS wo_created, w.actual_end AS wo_completed,
               COALESCE(c.action_count, 0) AS action_count
        FROM silver.work_order w
        JOIN silver.asset a ON a.id = w.asset_id
        LEFT JOIN silver.work_request r ON r.id = w.work_request_id
        LEFT JOIN counted c ON c.work_order_id = w.id
        WHERE w.status = 'completed'
        ORDER BY w.actual_end DESC, w.id
    """,
    "s5000f_compliance": """
        SELECT p.product_instance_id, p.name, p.type, t.maintenance_task_id, f.failure_description,
               t.planned_start, t.planned_end, e.actual_start, NULLIF(e.actual_end, '') AS actual_end,
               CASE WHEN NULLIF(e.actual_end, '') IS NOT NULL THEN 'COMPLETED'
                    WHEN NULLIF(e.actual_start, '') IS NOT NULL THEN 'IN_PROGRESS'
                    ELSE 'PLANNED' END AS execution_status
        FROM silver_s5000f.maintenance_task t
        JOIN silver_s5000f.product_instance p ON p.product_instance_id = t.product_instance_id
        LEFT JOIN silver_s5000f.functional_failure f ON f.functional_failure_id = t.functional_failure_id
        LEFT JOIN silver_s5000f.maintenance_event e ON e.maintenance_task_id = t.maintenance_task_id
        ORDER BY t.planned_start, t.maintenance_task_id
    """,
    "cross_layer_comparison": """
        SELECT 'Application' AS source_layer, id AS entity_id, name AS entity_name, status, updated_at
        FROM silver.asset
        UNION ALL
        SELECT 'S5000F', product_instance_id, name, operational_status, mapped_at
        FROM silver_s5000f.product_instance
        ORDER BY source_layer, entity_id
    """,
}


def example_queries() -> dict[str, str]:
    """Named SQL for common analytical patterns."""
    return dict(EXAMPLES)
