"""DuckDB SQL for every query of ``__spark_entry__``, written directly over the driver's tables.

The statements share common table expressions that bind the driver's tables to the layer tables;
``_sql`` prepends the ones a statement names, with those they need themselves.
"""

from __future__ import annotations

import re

STAMP = "2002-01-01T00:00:00+00:00"


def _iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


def _cid(prefix: str, concept: str, key: str) -> str:
    return f"'{prefix}-' || substr(sha256('{concept}:' || coalesce({key}, 'None')), 1, 12)"


_CDC = "'driver' AS source_system, id AS source_id, 'c' AS last_op"

CTES = {
    "asset0": """SELECT 'A' || c_custkey AS id, c_name AS name, lower(c_mktsegment) AS asset_type, n_name AS location,
        CASE WHEN c_acctbal < 0 THEN 'failed' WHEN c_acctbal < 1000 THEN 'degraded' ELSE 'operational' END AS status,
        '1995-01-01' AS install_date, '1995-01-01T00:00:00.000000+00:00' AS updated_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "asset": f"SELECT *, {_CDC}, updated_at AS last_event_ts FROM asset0",
    "wr": f"""SELECT 'WR' || o_orderkey AS id, 'A' || o_custkey AS asset_id, 'order ' || o_orderkey AS description,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
             WHEN '5-LOW' THEN 'low' END AS priority,
        CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'P' THEN 'approved' WHEN 'O' THEN 'open' END AS status,
        {_iso('o_orderdate')} AS reported_at, {_iso('o_orderdate')} AS updated_at,
        'driver' AS source_system, 'WR' || o_orderkey AS source_id, 'c' AS last_op,
        {_iso('o_orderdate')} AS last_event_ts
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "wo": f"""SELECT 'WO' || o_orderkey AS id, 'WR' || o_orderkey AS work_request_id, 'A' || o_custkey AS asset_id,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'in_progress' WHEN 'O' THEN 'planned' END AS status,
        {_iso('o_orderdate + INTERVAL 1 DAY')} AS planned_start, {_iso('o_orderdate + INTERVAL 4 DAY')} AS planned_end,
        CASE WHEN o_orderstatus = 'O' THEN '' WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 0 THEN ''
             WHEN o_orderstatus = 'F' AND o_orderkey % 10 = 1 THEN NULL
             ELSE {_iso('o_orderdate + INTERVAL 2 DAY')} END AS actual_start,
        CASE WHEN o_orderstatus = 'F' THEN {_iso('o_orderdate + INTERVAL 5 DAY')} ELSE '' END AS actual_end,
        {_iso('o_orderdate')} AS updated_at, 'driver' AS source_system, 'WO' || o_orderkey AS source_id,
        'c' AS last_op, {_iso('o_orderdate')} AS last_event_ts, o_orderdate
        FROM orders""",
    "feed": f"""SELECT *, 'MA' || l_orderkey || '-' || l_linenumber AS pk_id, {_iso('l_shipdate')} AS event_ts,
        CASE l_returnflag WHEN 'A' THEN 'c' WHEN 'N' THEN 'u' WHEN 'R' THEN 'd' END AS op,
        CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END AS status,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS age
        FROM lineitem""",
    "ma": f"""SELECT pk_id AS id, 'WO' || l_orderkey AS work_order_id, l_linenumber::BIGINT AS step_number,
        CASE l_returnflag WHEN 'A' THEN 'Inspect' WHEN 'N' THEN 'Replace' WHEN 'R' THEN 'Test' END AS description,
        status, event_ts AS started_at,
        CASE WHEN l_linestatus = 'F' THEN {_iso('l_shipdate + to_minutes(l_quantity::INT)')} ELSE '' END AS completed_at,
        'driver' AS source_system, pk_id AS source_id, 'c' AS last_op, event_ts AS last_event_ts,
        CASE WHEN l_linestatus = 'F' THEN l_quantity::DOUBLE END AS dur
        FROM feed WHERE age = 1""",
    "pi": f"""SELECT {_cid('PI', 'ProductInstance', 'id')} AS product_instance_id, name, asset_type AS type, location,
        status AS operational_status, install_date AS installation_date, source_system, source_id,
        '{STAMP}' AS mapped_at FROM asset""",
    "ff": f"""SELECT {_cid('FF', 'FunctionalFailure', 'id')} AS functional_failure_id,
        {_cid('PI', 'ProductInstance', 'asset_id')} AS product_instance_id, description AS failure_description,
        priority, reported_at, source_system, source_id, '{STAMP}' AS mapped_at FROM wr""",
    "mt": f"""SELECT {_cid('MT', 'MaintenanceTask', 'id')} AS maintenance_task_id,
        {_cid('PI', 'ProductInstance', 'asset_id')} AS product_instance_id,
        {_cid('FF', 'FunctionalFailure', 'work_request_id')} AS functional_failure_id,
        status, planned_start, planned_end, source_system, source_id, '{STAMP}' AS mapped_at FROM wo""",
    "mts": f"""SELECT {_cid('MTS', 'MaintenanceTaskStep', 'id')} AS task_step_id,
        {_cid('MT', 'MaintenanceTask', 'work_order_id')} AS maintenance_task_id, step_number, description, status,
        started_at, completed_at, source_system, source_id, '{STAMP}' AS mapped_at, dur FROM ma""",
    "me": f"""SELECT {_cid('ME', 'MaintenanceEvent', 'id')} AS maintenance_event_id,
        {_cid('MT', 'MaintenanceTask', 'id')} AS maintenance_task_id,
        {_cid('PI', 'ProductInstance', 'asset_id')} AS product_instance_id, actual_start, actual_end,
        (SELECT count(*) FROM ma WHERE ma.work_order_id = wo.id)::BIGINT AS action_count,
        source_system, source_id, '{STAMP}' AS mapped_at
        FROM wo WHERE status = 'completed' AND actual_start <> ''""",
    "ga": f"""SELECT id AS asset_id, name, asset_type, location, status, status = 'operational' AS is_available,
        CASE WHEN status = 'operational' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS availability_pct,
        '{STAMP}' AS computed_at FROM asset""",
    "mh": f"""SELECT product_instance_id, arg_min(source_id, (actual_start, maintenance_event_id)) AS asset_source_id,
        count(*) AS event_count, min(actual_start) AS first_maintenance, max(actual_start) AS last_maintenance,
        sum(action_count)::BIGINT AS total_actions, '{STAMP}' AS computed_at FROM me GROUP BY product_instance_id""",
    "backlog": f"""SELECT priority, wo.asset_id, count(*) AS open_count, min(planned_start) AS oldest_planned_start,
        '{STAMP}' AS computed_at
        FROM wo LEFT JOIN wr ON wr.id = wo.work_request_id
        WHERE wo.status IN ('planned', 'in_progress') GROUP BY priority, wo.asset_id""",
    "mtbf": f"""SELECT a.type, a.n AS asset_count, coalesce(f.n, 0) AS failure_count,
        coalesce(f.n, 0)::DOUBLE / a.n AS failures_per_asset,
        CASE WHEN f.n > 0 THEN 8760.0::DOUBLE * a.n / f.n END AS mtbf_proxy_hours, '{STAMP}' AS computed_at
        FROM (SELECT type, count(*) AS n FROM pi GROUP BY type) a
        LEFT JOIN (SELECT type, count(*) AS n FROM ff JOIN pi USING (product_instance_id) GROUP BY type) f
        ON a.type = f.type""",
    "summary": f"""SELECT asset_id, count(DISTINCT wo.id) AS work_order_count,
        count(DISTINCT CASE WHEN ma.status = 'completed' THEN ma.id END) AS completed_actions_count,
        max(substr(nullif(actual_end, ''), 1, 10)) AS last_maintenance_date, '{STAMP}' AS computed_at
        FROM wo LEFT JOIN ma ON ma.work_order_id = wo.id GROUP BY asset_id""",
    "mtbfdays": f"""SELECT a.id AS asset_id, a.name AS asset_name, count(wr.id) AS total_failures,
        date_diff('day', DATE '1995-01-01', DATE '2002-01-01')::BIGINT AS observation_days,
        date_diff('day', DATE '1995-01-01', DATE '2002-01-01')::DOUBLE / nullif(count(wr.id), 0) AS mtbf_days,
        '{STAMP}' AS computed_at FROM asset a LEFT JOIN wr ON wr.asset_id = a.id GROUP BY a.id, a.name""",
    "detail": f"""SELECT wo.asset_id, wo.id AS work_order_id, priority, wo.status,
        date_diff('day', o_orderdate::DATE + 1, DATE '2002-01-01')::BIGINT AS days_open, '{STAMP}' AS computed_at
        FROM wo LEFT JOIN wr ON wr.id = wo.work_request_id WHERE wo.status IN ('planned', 'in_progress')""",
    "ev": f"""SELECT 'U' || user_id AS pk_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
        {_iso('ts')} AS event_ts, event_id, (props->>'$.k')::BIGINT AS k, value, event_type FROM events""",
    "evlast": """SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY event_ts DESC, event_id DESC) AS age FROM ev""",
    "exec": """SELECT me.*, CASE WHEN nullif(actual_end, '') IS NOT NULL THEN 'COMPLETED'
        WHEN nullif(actual_start, '') IS NOT NULL THEN 'IN_PROGRESS' ELSE 'PLANNED' END AS execution_status FROM me""",
}


def _needs(text: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b(FROM|JOIN)\s+{n}\b", text)]


def _sql(body: str) -> str:
    """Prepend the CTEs the statement uses, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in order:
                visit(CTES[name])
                order.append(name)

    visit(body)
    ctes = [f"{n} AS ({CTES[n]})" for n in order]
    if ctes and body.lstrip().startswith("WITH "):
        return "WITH " + ", ".join(ctes) + ", " + body.lstrip()[5:]
    return ("WITH " + ", ".join(ctes) + " " if ctes else "") + body


_STATE = """SELECT pk_id AS id, k, value, event_type, 'driver' AS source_system, pk_id AS source_id, op AS last_op,
    event_ts AS last_event_ts FROM evlast WHERE age = 1 AND op <> 'd'"""


def _text(cols: str) -> str:
    return ", ".join(f"{c}::VARCHAR AS {c}" for c in cols.split())


_AUDIT = f"'{STAMP}' AS dbt_created_at, '{STAMP}' AS dbt_updated_at"
_B = "entity op event_ts pk_id payload_json event_date source_system"
_S = "source_system source_id last_op last_event_ts"
_M = "source_system source_id mapped_at"


def _model(table: str, cols: str, renames: str = "") -> str:
    return f"SELECT {_text(cols)}{', ' + renames if renames else ''}, {_AUDIT} FROM {table}"


def _keys(table: str, cte: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS total_rows,
        count(*) FILTER ({key} IS NULL) AS null_keys,
        (SELECT count(*) FROM (SELECT {key} FROM {cte} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1))
        AS duplicate_keys FROM {cte}"""


def _accepted(table: str, cte: str, column: str, values: str) -> str:
    accepted = ", ".join(f"'{v}'" for v in values.split())
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count({column}) AS checked_rows,
        count(*) FILTER ({column} NOT IN ({accepted})) AS violations FROM {cte}"""


def _relation(child: str, ccte: str, column: str, parent: str, pcte: str) -> str:
    missing = f"NOT EXISTS (SELECT 1 FROM {pcte} p WHERE p.id = c.{column})"
    return f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
        count(*) AS checked_rows, count(*) FILTER ({missing}) AS orphan_rows,
        count(DISTINCT CASE WHEN {missing} THEN c.{column} END) AS orphan_keys
        FROM {ccte} c WHERE c.{column} IS NOT NULL"""


def _trace(table: str, cte: str, key: str, prefix: str, concept: str) -> str:
    return f"""SELECT '{table}' AS concept_table, count(*) AS checked_rows,
        count(*) FILTER ({key} IS DISTINCT FROM {_cid(prefix, concept, 'source_id')}) AS untraceable FROM {cte}"""


def _fresh(table: str, cte: str, column: str, hours: int) -> str:
    at = "replace({0}, '+00:00', '')::TIMESTAMP"
    age = f"date_diff('microsecond', {at.format('latest')}, TIMESTAMP '2002-01-01') / 3600000000.0"
    return f"""SELECT '{table}' AS table_name, latest, future_rows, round({age}, 6) AS age_hours, {hours}::BIGINT AS limit_hours,
        coalesce(({age}) <= {hours}, false) AS is_fresh
        FROM (SELECT max(x) FILTER ({at.format('x')} <= TIMESTAMP '2002-01-01') AS latest,
              count(*) FILTER ({at.format('x')} > TIMESTAMP '2002-01-01') AS future_rows FROM (SELECT {column} AS x FROM {cte}))"""


def _changes(cte: str, allowed: str, *ways: str) -> str:
    """Status changes on the way to each row's last status."""
    paths = ", ".join(f"('{w.split()[-1]}', {w.split()})" for w in ways)
    pairs = ", ".join(f"'{pair}'" for pair in allowed.split())
    return f"""SELECT from_status, to_status, count(*) AS changes, from_status || '>' || to_status IN ({pairs}) AS allowed
        FROM (SELECT lag(reached) OVER (PARTITION BY id ORDER BY step) AS from_status, reached AS to_status
              FROM (SELECT id, unnest(way) AS reached, unnest(range(len(way))) AS step
                    FROM {cte} JOIN (VALUES {paths}) w(last_status, way) ON status = last_status))
        WHERE from_status <> to_status GROUP BY from_status, to_status"""


_ISO_TEXT = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"


def _rules(table: str, cte: str, required: str, iso: str, accepted: dict[str, str], entity: str = "") -> str:
    """Violations of one dataset's rules, a row a rule."""
    rules = [("required", c, f"{c} IS NULL") for c in required.split()]
    rules += [
        ("format", c, f"{c} <> '' AND NOT (regexp_matches({c}, '{_ISO_TEXT}') AND TRY_CAST({c} AS TIMESTAMPTZ) IS NOT NULL)")
        for c in iso.split()
    ]
    rules += [("accepted", c, f"{c} NOT IN ({values})") for c, values in accepted.items()]
    if entity:
        rules.append(("partition", "event_date", "event_date IS DISTINCT FROM substr(event_ts, 1, 10)"))
        rules.append(("constant", "entity", f"entity IS DISTINCT FROM '{entity}'"))
    return _union(
        *(
            f"""SELECT '{table}' AS table_name, count(*) AS checked_rows, '{rule}' AS rule, '{c}' AS column_name,
            count(*) FILTER ({broken}) AS violations FROM {cte}"""
            for rule, c, broken in rules
        )
    )


def _bronze_rules(table: str, rows: str, entity: str) -> str:
    columns = "op, event_ts, pk_id, '{}' AS payload_json, 'driver' AS source_system, substr(event_ts, 1, 10) AS event_date"
    return _rules(
        f"bronze.{table}", f"(SELECT '{entity}' AS entity, {columns} FROM {rows})", "op event_ts pk_id payload_json source_system",
        "event_ts", {"op": "'c', 'u', 'd'"}, entity,
    )


def _lineage() -> str:
    """The declared lineage as rows of (dataset, upstream)."""
    edges = {f"silver.{t}": [f"bronze.{t}"] for t in ("asset", "work_request", "work_order", "maintenance_action")}
    model = {
        "product_instance": "asset", "functional_failure": "work_request", "maintenance_task": "work_order",
        "maintenance_task_step": "maintenance_action", "maintenance_event": "work_order maintenance_action",
    }
    edges |= {f"silver_s5000f.{c}": [f"silver.{t}" for t in ts.split()] for c, ts in model.items()}
    rollups = {
        "asset_availability": "silver.asset", "maintenance_history": "silver_s5000f.maintenance_event",
        "work_order_backlog": "silver.work_order silver.work_request",
        "mtbf_metrics": "silver_s5000f.product_instance silver_s5000f.functional_failure",
        "asset_maintenance_summary": "silver.work_order silver.maintenance_action",
        "asset_mtbf_days": "silver.asset silver.work_request", "backlog_detail": "silver.work_order silver.work_request",
    }
    edges |= {f"gold.{g}": sources.split() for g, sources in rollups.items()}
    return ", ".join(f"('{d}', '{u}')" for d, sources in edges.items() for u in sources)


def _foreign(table: str, cte: str, column: str, prefix: str, concept: str, source: str, referred: str) -> str:
    return f"""SELECT '{table}' AS concept_table, '{column}' AS foreign_id, count(*) AS checked_rows,
        count(*) FILTER (s.source_id IS NULL) AS without_source,
        count(*) FILTER (s.source_id IS NOT NULL AND c.{column} IS DISTINCT FROM {_cid(prefix, concept, f's.{referred}')}) AS untraceable
        FROM {cte} c LEFT JOIN {source} s ON s.source_id = c.source_id"""


_FILLED = "round(100.0 * count({0}) / count(*), 6)::DOUBLE AS field_{1}_pct"


def _filled(layer: str, entity: str, cte: str, cols: str) -> str:
    parts = ", ".join(_FILLED.format(c, i) for i, c in enumerate(cols.split(), start=1))
    return f"SELECT '{layer}' AS layer, '{entity}' AS entity_type, count(*) AS total_records, {parts} FROM {cte}"


# time of the last lifecycle event of an order: one minute per status reached
_LAST_STEP = """strftime(updated_at[1:26]::TIMESTAMP + to_minutes(CASE status WHEN 'planned' THEN 0 WHEN 'open' THEN 0
    WHEN 'in_progress' THEN 1 WHEN 'approved' THEN 1 ELSE 2 END), '%Y-%m-%dT%H:%M:%S.%f+00:00')"""


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_GA_JOIN = "FROM asset a LEFT JOIN ga ON ga.asset_id = a.id"

_ORDER_STEP = """CASE step WHEN 0 THEN 'c' ELSE 'u' END,
            strftime(updated_at[1:26]::TIMESTAMP + to_minutes(step), '%Y-%m-%dT%H:%M:%S.%f+00:00')"""


def _order_feed(cte: str, entity: str, first: str, second: str) -> str:
    return f"""SELECT '{entity}' AS entity, CASE step WHEN 0 THEN 'c' ELSE 'u' END AS op,
        strftime(updated_at[1:26]::TIMESTAMP + to_minutes(step), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS event_ts, id AS pk_id,
        substr(updated_at, 1, 10) AS event_date, 'driver' AS source_system, '{STAMP}' AS dbt_loaded_at
        FROM {cte}, (VALUES (0), (1), (2)) s(step)
        WHERE step <= CASE status WHEN '{first}' THEN 0 WHEN '{second}' THEN 1 ELSE 2 END"""


QUERIES: dict[str, str] = {
    # --- change data ------------------------------------------------------------------------------
    "cdc_latest_state": _STATE,
    "cdc_merge_incremental": _STATE,
    "cdc_merge_late": _STATE,
    "stream_latest_state": _STATE,
    "cdc_bucketed_state": _STATE,
    "refresh_incremental": """SELECT 'work_order_backlog' AS rollup, asset_id, priority, open_count AS orders,
        NULL::BIGINT AS completed_actions, oldest_planned_start AS noted_at FROM backlog
        UNION ALL SELECT 'asset_maintenance_summary', asset_id, NULL, count(*), coalesce(sum(done), 0)::BIGINT,
        max(substr(nullif(actual_end, ''), 1, 10))
        FROM wo LEFT JOIN (SELECT 'WO' || l_orderkey AS done_order, count(*) AS done FROM feed
            WHERE age = 1 AND op <> 'd' AND status = 'completed' GROUP BY 1) d ON d.done_order = wo.id
        GROUP BY asset_id""",
    "cdc_action_state": f"""SELECT pk_id AS id, 'WO' || l_orderkey AS work_order_id, l_linenumber::BIGINT AS step_number,
        CASE l_returnflag WHEN 'A' THEN 'Inspect' WHEN 'N' THEN 'Replace' WHEN 'R' THEN 'Test' END AS description,
        status, event_ts AS started_at,
        CASE WHEN l_linestatus = 'F' THEN {_iso('l_shipdate + to_minutes(l_quantity::INT)')} ELSE '' END AS completed_at,
        'driver' AS source_system, pk_id AS source_id, op AS last_op, event_ts AS last_event_ts
        FROM feed WHERE age = 1 AND op <> 'd'""",
    "cdc_asset_state": """SELECT * REPLACE (CASE WHEN status = 'operational' THEN updated_at
            ELSE '1995-01-01T00:01:00.000000+00:00' END AS updated_at,
        CASE WHEN status = 'operational' THEN 'c' ELSE 'u' END AS last_op,
        CASE WHEN status = 'operational' THEN updated_at ELSE '1995-01-01T00:01:00.000000+00:00' END AS last_event_ts)
        FROM asset""",
    "cdc_work_request_state": f"""SELECT * REPLACE ({_LAST_STEP} AS updated_at, {_LAST_STEP} AS last_event_ts,
        CASE status WHEN 'open' THEN 'c' ELSE 'u' END AS last_op) FROM wr""",
    "cdc_work_order_state": f"""SELECT * EXCLUDE (o_orderdate) REPLACE ({_LAST_STEP} AS updated_at,
        {_LAST_STEP} AS last_event_ts, CASE status WHEN 'planned' THEN 'c' ELSE 'u' END AS last_op) FROM wo""",
    "backlog_from_feed": "SELECT * FROM backlog",
    "bronze_parse": """SELECT event_id, 'Asset' AS entity, op, event_ts, pk_id, substr(event_ts, 1, 10) AS event_date,
        'driver' AS source_system FROM ev""",
    "bronze_route_counts": """SELECT route, reject_reason, count(*) AS events FROM (
        SELECT 'asset' AS route, NULL::VARCHAR AS reject_reason FROM ev
        UNION ALL SELECT 'maintenance_action', NULL FROM lineitem
        UNION ALL SELECT 'quarantine', CASE o_orderstatus WHEN 'F' THEN 'unknown_entity' WHEN 'P' THEN 'missing_field'
                  ELSE 'malformed_json' END FROM orders) GROUP BY route, reject_reason""",
    "bronze_date_slice": """SELECT event_id, op, event_ts, pk_id, substr(event_ts, 1, 10) AS event_date FROM ev
        WHERE substr(event_ts, 1, 10) = '2024-01-05'""",
    "snapshot_diff_cdc": """WITH p AS (SELECT pk_id, op, status, event_ts, row_number() OVER (PARTITION BY pk_id
            ORDER BY event_ts DESC, l_partkey DESC, l_suppkey DESC) AS n FROM feed WHERE event_ts < '1996-01-01'),
        c AS (SELECT pk_id, op, status, event_ts FROM feed WHERE age = 1)
        SELECT * FROM (SELECT coalesce(c.pk_id, p.pk_id) AS pk_id,
            CASE WHEN p.pk_id IS NULL THEN 'c' WHEN c.pk_id IS NULL THEN 'd'
                 WHEN c.event_ts <> p.event_ts OR c.status <> p.status THEN 'u' END AS op,
            p.status AS status_before, c.status AS status_after
            FROM (SELECT * FROM p WHERE n = 1 AND op <> 'd') p
            FULL JOIN (SELECT * FROM c WHERE op <> 'd') c ON p.pk_id = c.pk_id) WHERE op IS NOT NULL""",
    "feed_messages": "SELECT 'cdc.asset' AS topic, pk_id AS key, op, event_ts FROM ev",
    "feed_messages_topics": f"""SELECT 'cdc.' || CASE entity WHEN 'Asset' THEN 'asset' WHEN 'WorkRequest' THEN 'work_request'
            WHEN 'WorkOrder' THEN 'work_order' ELSE 'maintenance_action' END AS topic,
        pk_id AS key, entity, op, event_ts, pk_id, 'driver' AS source_system, CASE WHEN op <> 'd' THEN pk_id END AS after_id,
        CASE WHEN op <> 'd' THEN status END AS after_status, CASE WHEN op <> 'd' THEN parent END AS parent_id,
        CASE WHEN op <> 'd' THEN note END AS note
        FROM (SELECT 'Asset' AS entity, op, event_ts, pk_id, NULL AS status, NULL AS parent, event_type AS note FROM ev
        UNION ALL SELECT 'MaintenanceAction', op, event_ts, pk_id, status, 'WO' || l_orderkey,
            CASE l_returnflag WHEN 'A' THEN 'Inspect' WHEN 'N' THEN 'Replace' END FROM feed
        UNION ALL SELECT 'WorkRequest', {_ORDER_STEP}, id, ['open', 'approved', 'closed'][step + 1], asset_id, description
            FROM wr, (VALUES (0), (1), (2)) s(step) WHERE step <= CASE status WHEN 'open' THEN 0 WHEN 'approved' THEN 1 ELSE 2 END
        UNION ALL SELECT 'WorkOrder', {_ORDER_STEP}, id, ['planned', 'in_progress', 'completed'][step + 1], asset_id,
            planned_start
            FROM wo, (VALUES (0), (1), (2)) s(step)
            WHERE step <= CASE status WHEN 'planned' THEN 0 WHEN 'in_progress' THEN 1 ELSE 2 END)""",
    # --- maintenance model ------------------------------------------------------------------------
    "concept_product_instance": "SELECT * FROM pi",
    "concept_functional_failure": "SELECT * FROM ff",
    "concept_maintenance_task": "SELECT * FROM mt",
    "concept_maintenance_task_step": "SELECT * EXCLUDE (dur) FROM mts",
    "concept_maintenance_event": "SELECT * FROM me",
    # --- rollups ----------------------------------------------------------------------------------
    "gold_asset_availability": "SELECT * FROM ga",
    "gold_maintenance_history": "SELECT * FROM mh",
    "gold_work_order_backlog": "SELECT * FROM backlog",
    "gold_mtbf_metrics": """SELECT * REPLACE (round(failures_per_asset, 6) AS failures_per_asset,
        round(mtbf_proxy_hours, 6) AS mtbf_proxy_hours) FROM mtbf""",
    "gold_asset_summary": "SELECT * FROM summary",
    "gold_asset_mtbf_days": "SELECT * REPLACE (round(mtbf_days, 6) AS mtbf_days) FROM mtbfdays",
    "gold_backlog_detail": "SELECT * FROM detail",
    # --- named queries ----------------------------------------------------------------------------
    "n01": """SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, a.status AS asset_status, availability_pct,
        last_maintenance FROM asset a LEFT JOIN ga ON ga.asset_id = a.id
        LEFT JOIN pi ON pi.source_id = a.id LEFT JOIN mh ON mh.product_instance_id = pi.product_instance_id""",
    "n02": """SELECT a.id AS asset_id, a.name AS asset_name, wo.id AS work_order_id, wr.description,
        wo.status AS wo_status, wr.reported_at AS wo_created, wo.actual_end AS wo_completed, count(ma.id) AS action_count
        FROM asset a JOIN wo ON wo.asset_id = a.id LEFT JOIN wr ON wr.id = wo.work_request_id
        LEFT JOIN ma ON ma.work_order_id = wo.id WHERE wo.status = 'completed' GROUP BY ALL""",
    "n03": """SELECT pi.product_instance_id, pi.name, pi.type, mt.maintenance_task_id, failure_description,
        planned_start, planned_end, actual_start, nullif(actual_end, '') AS actual_end,
        coalesce(execution_status, 'PLANNED') AS execution_status
        FROM pi JOIN mt ON mt.product_instance_id = pi.product_instance_id
        LEFT JOIN ff ON ff.functional_failure_id = mt.functional_failure_id
        LEFT JOIN exec ON exec.maintenance_task_id = mt.maintenance_task_id""",
    "n04": """SELECT 'Application' AS source_layer, id AS entity_id, name AS entity_name, status, updated_at FROM asset
        UNION ALL SELECT 'S5000F', product_instance_id, name, operational_status, mapped_at FROM pi""",
    "n05": "SELECT * FROM ga ORDER BY asset_id LIMIT 10",
    "n06": f"""SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, a.status AS asset_status, availability_pct,
        is_available, computed_at {_GA_JOIN} ORDER BY a.id LIMIT 5""",
    "n07": f"""SELECT a.asset_type, count(*) AS total_assets,
        round(avg(CASE WHEN is_available THEN 100.0::DOUBLE ELSE 0 END), 6) AS avg_availability_pct,
        sum(CASE WHEN is_available THEN 1 ELSE 0 END)::BIGINT AS available_count,
        sum(CASE WHEN NOT is_available THEN 1 ELSE 0 END)::BIGINT AS unavailable_count {_GA_JOIN} GROUP BY a.asset_type""",
    "n08": f"""SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, a.location, a.status, availability_pct,
        is_available, CASE WHEN is_available THEN 'HEALTHY' ELSE 'NEEDS_ATTENTION' END AS health_status {_GA_JOIN}
        WHERE NOT is_available OR is_available IS NULL ORDER BY a.asset_type, a.name, a.id LIMIT 10""",
    "n09": "SELECT * FROM mh ORDER BY product_instance_id LIMIT 10",
    "n10": """SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, wo.id AS work_order_id,
        wr.description AS work_description, wo.status AS work_order_status, wr.priority, wr.reported_at AS wo_created,
        wo.actual_end AS wo_completed, count(ma.id) AS maintenance_action_count,
        round(sum(dur), 6) AS total_duration_minutes
        FROM asset a JOIN wo ON wo.asset_id = a.id LEFT JOIN wr ON wr.id = wo.work_request_id
        LEFT JOIN ma ON ma.work_order_id = wo.id WHERE wo.status = 'completed' GROUP BY ALL
        ORDER BY wo_completed DESC, work_order_id LIMIT 10""",
    "n11": """SELECT a.asset_type, count(DISTINCT wo.id) AS total_work_orders,
        count(DISTINCT ma.id) AS total_maintenance_actions, round(avg(dur), 6) AS avg_action_duration,
        round(sum(dur), 6) AS total_duration_minutes, min(wr.reported_at) AS first_maintenance_date,
        max(wo.actual_end) AS last_maintenance_date
        FROM asset a JOIN wo ON wo.asset_id = a.id LEFT JOIN wr ON wr.id = wo.work_request_id
        LEFT JOIN ma ON ma.work_order_id = wo.id WHERE wo.status = 'completed' GROUP BY a.asset_type""",
    "n12": """SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type,
        count(DISTINCT CASE WHEN wo.status = 'planned' THEN wo.id END) AS open_work_orders,
        count(DISTINCT CASE WHEN wo.status = 'in_progress' THEN wo.id END) AS in_progress_work_orders,
        count(DISTINCT CASE WHEN wo.status = 'completed' THEN wo.id END) AS completed_work_orders,
        count(DISTINCT ma.id) AS total_maintenance_actions,
        round(coalesce(sum(CASE WHEN wo.status = 'completed' THEN dur ELSE 0 END), 0), 6)::DOUBLE
            AS completed_duration_minutes
        FROM asset a LEFT JOIN wo ON wo.asset_id = a.id LEFT JOIN ma ON ma.work_order_id = wo.id
        GROUP BY a.id, a.name, a.asset_type HAVING count(DISTINCT wo.id) > 0
        ORDER BY open_work_orders DESC, completed_work_orders DESC, asset_id LIMIT 10""",
    "n13": """SELECT a.asset_type, count(DISTINCT wo.id) AS backlog_count,
        round(avg(date_diff('day', substr(wr.reported_at, 1, 10)::DATE, DATE '2002-01-01')), 6) AS avg_backlog_age_days,
        max(date_diff('day', substr(wr.reported_at, 1, 10)::DATE, DATE '2002-01-01'))::BIGINT AS max_backlog_age_days,
        sum(CASE WHEN priority = 'high' THEN 1 ELSE 0 END)::BIGINT AS high_priority_backlog,
        sum(CASE WHEN priority = 'medium' THEN 1 ELSE 0 END)::BIGINT AS medium_priority_backlog,
        sum(CASE WHEN priority = 'low' THEN 1 ELSE 0 END)::BIGINT AS low_priority_backlog
        FROM asset a JOIN wo ON wo.asset_id = a.id LEFT JOIN wr ON wr.id = wo.work_request_id
        WHERE wo.status IN ('planned', 'in_progress') GROUP BY a.asset_type""",
    "n14": "SELECT * FROM pi ORDER BY product_instance_id LIMIT 10",
    "n15": """SELECT pi.product_instance_id, pi.name, pi.type, pi.location, operational_status, mt.maintenance_task_id,
        failure_description, ff.priority, planned_start, planned_end, maintenance_event_id, actual_start,
        nullif(actual_end, '') AS actual_end, execution_status, task_step_id, mts.description AS step_description,
        step_number, round(dur, 6) AS actual_duration_minutes
        FROM pi LEFT JOIN mt ON mt.product_instance_id = pi.product_instance_id
        LEFT JOIN ff ON ff.functional_failure_id = mt.functional_failure_id
        LEFT JOIN exec ON exec.maintenance_task_id = mt.maintenance_task_id
        LEFT JOIN mts ON mts.maintenance_task_id = exec.maintenance_task_id
        ORDER BY pi.product_instance_id, planned_start NULLS FIRST, mt.maintenance_task_id NULLS FIRST,
        actual_start NULLS FIRST, step_number NULLS FIRST, task_step_id NULLS FIRST LIMIT 15""",
    "n16": """SELECT 'ProductInstance' AS table_name, count(*) AS total_records,
        count(DISTINCT product_instance_id) AS unique_ids, count(*) FILTER (name IS NULL) AS missing_field_1,
        count(*) FILTER (type IS NULL) AS missing_field_2, count(*) FILTER (operational_status IS NULL) AS missing_field_3
        FROM pi
        UNION ALL SELECT 'MaintenanceTask', count(*), count(DISTINCT maintenance_task_id),
        count(*) FILTER (failure_description IS NULL), count(*) FILTER (planned_start IS NULL),
        count(*) FILTER (planned_end IS NULL)
        FROM mt LEFT JOIN ff ON ff.functional_failure_id = mt.functional_failure_id
        UNION ALL SELECT 'MaintenanceEvent', count(*), count(DISTINCT maintenance_event_id),
        count(*) FILTER (nullif(actual_start, '') IS NULL), count(*) FILTER (nullif(actual_end, '') IS NULL),
        count(*) FILTER (execution_status IS NULL) FROM exec""",
    "n17": """SELECT pi.type AS task_type, count(*) AS joined_rows, count(DISTINCT mt.maintenance_task_id) AS total_tasks,
        count(DISTINCT maintenance_event_id) AS executed_tasks,
        count(DISTINCT CASE WHEN execution_status = 'COMPLETED' THEN maintenance_event_id END) AS completed_tasks,
        count(DISTINCT CASE WHEN execution_status = 'IN_PROGRESS' THEN maintenance_event_id END) AS in_progress_tasks,
        count(DISTINCT CASE WHEN execution_status = 'PLANNED' THEN maintenance_event_id END) AS planned_tasks,
        round(avg(date_diff('day', substr(planned_start, 1, 10)::DATE, substr(nullif(actual_start, ''), 1, 10)::DATE)), 6)
            AS avg_start_delay_days,
        round(avg(date_diff('day', substr(planned_end, 1, 10)::DATE, substr(nullif(actual_end, ''), 1, 10)::DATE)), 6)
            AS avg_completion_delay_days,
        round(avg(dur), 6) AS avg_step_duration_minutes
        FROM mt LEFT JOIN pi ON pi.product_instance_id = mt.product_instance_id
        LEFT JOIN exec ON exec.maintenance_task_id = mt.maintenance_task_id
        LEFT JOIN mts ON mts.maintenance_task_id = exec.maintenance_task_id GROUP BY pi.type""",
    "n18": """SELECT 'Asset → ProductInstance' AS mapping, count(DISTINCT a.id) AS source_records,
        count(DISTINCT product_instance_id) AS mapped_records,
        count(DISTINCT CASE WHEN product_instance_id IS NOT NULL THEN a.id END) AS successfully_mapped,
        round(count(DISTINCT CASE WHEN product_instance_id IS NOT NULL THEN a.id END) * 100.0
            / nullif(count(DISTINCT a.id), 0), 2)::DOUBLE AS mapping_percentage
        FROM asset a LEFT JOIN pi ON pi.source_id = a.id AND pi.source_system = 'driver'
        UNION ALL SELECT 'WorkOrder → MaintenanceTask', count(DISTINCT wo.id), count(DISTINCT maintenance_task_id),
        count(DISTINCT CASE WHEN maintenance_task_id IS NOT NULL THEN wo.id END),
        round(count(DISTINCT CASE WHEN maintenance_task_id IS NOT NULL THEN wo.id END) * 100.0
            / nullif(count(DISTINCT wo.id), 0), 2)::DOUBLE
        FROM wo LEFT JOIN mt ON mt.source_id = wo.id AND mt.source_system = 'driver'""",
    "n19": """SELECT * FROM (SELECT 'Silver (Application)' AS data_layer, id AS entity_id, name AS entity_name, asset_type,
        status, location, install_date, NULL::VARCHAR AS instance_type, NULL::VARCHAR AS instance_location FROM asset
        UNION ALL SELECT 'Silver-S5000F (Standardised)', product_instance_id, name, NULL, operational_status, NULL, NULL,
        type, location FROM pi) ORDER BY data_layer, entity_id LIMIT 20""",
    "n20": """SELECT * FROM (SELECT 'Application Maintenance' AS source, wo.id AS maintenance_id, wr.description, wo.status,
        wr.priority, wr.reported_at AS planned_date, wo.actual_end AS completed_date, a.name AS asset_name,
        count(ma.id) AS action_count, round(sum(dur), 6) AS total_duration
        FROM wo JOIN asset a ON a.id = wo.asset_id LEFT JOIN wr ON wr.id = wo.work_request_id
        LEFT JOIN ma ON ma.work_order_id = wo.id WHERE wo.status = 'completed' GROUP BY ALL
        UNION ALL SELECT 'S5000F Maintenance', mt.maintenance_task_id, failure_description, execution_status, ff.priority,
        planned_start, actual_end, pi.name, count(task_step_id), round(sum(dur), 6)
        FROM mt JOIN pi ON pi.product_instance_id = mt.product_instance_id
        LEFT JOIN ff ON ff.functional_failure_id = mt.functional_failure_id
        JOIN exec ON exec.maintenance_task_id = mt.maintenance_task_id
        LEFT JOIN mts ON mts.maintenance_task_id = exec.maintenance_task_id
        WHERE execution_status = 'COMPLETED' GROUP BY ALL)
        ORDER BY source, completed_date DESC, maintenance_id LIMIT 15""",
    "n21": _union(
        _filled("Silver", "Asset", "asset", "name asset_type status location"),
        _filled("Silver-S5000F", "ProductInstance", "pi", "name type location operational_status"),
        _filled("Gold", "AssetAvailability", "ga", "asset_id is_available availability_pct computed_at"),
    ),
    "n22": """SELECT * FROM (SELECT 'Application Event' AS event_type, ma.id AS event_id, ma.description,
        ma.started_at AS event_time, a.name AS asset_name, wr.description AS work_description,
        round(dur, 6) AS duration_minutes
        FROM ma JOIN wo ON wo.id = ma.work_order_id JOIN asset a ON a.id = wo.asset_id
        LEFT JOIN wr ON wr.id = wo.work_request_id WHERE ma.started_at IS NOT NULL
        UNION ALL SELECT 'S5000F Event', task_step_id, mts.description, actual_start, pi.name, failure_description,
        round(dur, 6)
        FROM mts JOIN me ON me.maintenance_task_id = mts.maintenance_task_id
        JOIN mt ON mt.maintenance_task_id = me.maintenance_task_id
        JOIN pi ON pi.product_instance_id = mt.product_instance_id
        LEFT JOIN ff ON ff.functional_failure_id = mt.functional_failure_id WHERE actual_start IS NOT NULL)
        ORDER BY event_time DESC, event_type, event_id LIMIT 20""",
    "n23": """WITH orders_of AS (SELECT a.id AS asset_id, a.name AS asset_name, a.asset_type, a.status AS asset_status,
            a.location, pi.type AS instance_type, availability_pct, count(DISTINCT wo.id) AS total_work_orders,
            count(DISTINCT CASE WHEN wo.status = 'completed' THEN wo.id END) AS completed_work_orders,
            count(DISTINCT CASE WHEN wo.status IN ('planned', 'in_progress') THEN wo.id END) AS pending_work_orders
            FROM asset a LEFT JOIN pi ON pi.source_id = a.id AND pi.source_system = 'driver'
            LEFT JOIN ga ON ga.asset_id = a.id LEFT JOIN wo ON wo.asset_id = a.id GROUP BY ALL),
        model_of AS (SELECT a.id AS asset_id, count(DISTINCT mt.maintenance_task_id) AS s5000f_maintenance_tasks,
            count(DISTINCT maintenance_event_id) AS s5000f_maintenance_events,
            count(DISTINCT task_step_id) AS s5000f_maintenance_steps, round(avg(dur), 6) AS avg_s5000f_step_duration
            FROM asset a LEFT JOIN pi ON pi.source_id = a.id AND pi.source_system = 'driver'
            LEFT JOIN mt ON mt.product_instance_id = pi.product_instance_id
            LEFT JOIN me ON me.maintenance_task_id = mt.maintenance_task_id
            LEFT JOIN mts ON mts.maintenance_task_id = me.maintenance_task_id GROUP BY a.id)
        SELECT o.*, m.* EXCLUDE (asset_id), CASE WHEN availability_pct >= 95 THEN 'EXCELLENT'
            WHEN availability_pct >= 90 THEN 'GOOD' WHEN availability_pct >= 80 THEN 'FAIR' ELSE 'POOR' END AS health_status
        FROM orders_of o LEFT JOIN model_of m ON m.asset_id = o.asset_id
        ORDER BY availability_pct DESC NULLS LAST, asset_name, o.asset_id LIMIT 15""",
    # --- relational replica -----------------------------------------------------------------------
    "replica_stage": _model("wo", f"id work_request_id asset_id status planned_start planned_end actual_start actual_end "
                            f"updated_at {_S}", "(SELECT max(last_event_ts) FROM wo) AS source_version"),
    "replica_bronze_asset": f"""SELECT 'Asset' AS entity, op, event_ts, pk_id, substr(event_ts, 1, 10) AS event_date,
        'driver' AS source_system, '{STAMP}' AS dbt_loaded_at FROM ev""",
    "replica_bronze_maintenance_action": f"""SELECT 'MaintenanceAction' AS entity, op, event_ts, pk_id,
        substr(event_ts, 1, 10) AS event_date, 'driver' AS source_system, '{STAMP}' AS dbt_loaded_at FROM feed""",
    "replica_bronze_work_request": _order_feed("wr", "WorkRequest", "open", "approved"),
    "replica_bronze_work_order": _order_feed("wo", "WorkOrder", "planned", "in_progress"),
    "replica_silver_asset": _model("asset", f"id name asset_type location status install_date updated_at {_S}"),
    "replica_silver_work_request": _model(
        "wr", f"id asset_id description priority status reported_at updated_at {_S}"),
    "replica_silver_work_order": _model(
        "wo", f"id work_request_id asset_id status planned_start planned_end actual_start actual_end updated_at {_S}"),
    "replica_silver_maintenance_action": _model(
        "ma", f"id work_order_id step_number description status started_at completed_at {_S}"),
    "replica_s5000f_product_instance": _model(
        "pi", f"product_instance_id name type location operational_status installation_date {_M}"),
    "replica_s5000f_maintenance_task": _model(
        "mt", f"maintenance_task_id product_instance_id status {_M}",
        "planned_start AS planned_start_date, planned_end AS planned_end_date"),
    "replica_s5000f_maintenance_event": _model(
        "me", f"maintenance_event_id product_instance_id maintenance_task_id {_M}",
        "actual_start AS actual_start_date, actual_end AS actual_end_date"),
    "replica_s5000f_maintenance_task_step": _model(
        "mts", f"maintenance_task_id description status {_M}",
        "task_step_id AS maintenance_task_step_id, step_number::VARCHAR AS step_sequence"),
    "replica_gold_asset_availability": _model(
        "ga", "asset_id name asset_type location status is_available availability_pct computed_at"),
    "replica_gold_maintenance_history": _model(
        "summary", "asset_id work_order_count completed_actions_count last_maintenance_date computed_at"),
    "replica_gold_mtbf_metrics": f"""SELECT asset_id, asset_name, total_failures::VARCHAR AS total_failures,
        observation_days::VARCHAR AS observation_days, round(mtbf_days, 6) AS mtbf_days, computed_at, {_AUDIT}
        FROM mtbfdays""",
    "replica_gold_work_order_backlog": _model(
        "detail", "asset_id work_order_id priority status days_open computed_at"),
    "replica_changes": """WITH p AS (SELECT *, row_number() OVER (PARTITION BY pk_id
            ORDER BY event_ts DESC, l_partkey DESC, l_suppkey DESC) AS n FROM feed WHERE event_ts < '1996-01-01'),
        old AS (SELECT pk_id, status, event_ts FROM p WHERE n = 1 AND op <> 'd')
        SELECT c.pk_id AS id, c.status, c.event_ts AS started_at,
            CASE WHEN same.pk_id IS NULL THEN 'end' ELSE '1996' END AS source_version,
            CASE WHEN old.pk_id IS NULL THEN 'load of end' ELSE 'load of 1996' END AS dbt_created_at,
            CASE WHEN same.pk_id IS NULL THEN 'load of end' ELSE 'load of 1996' END AS dbt_updated_at
        FROM feed c LEFT JOIN old ON old.pk_id = c.pk_id LEFT JOIN old same ON same.pk_id = c.pk_id
            AND same.status = c.status AND same.event_ts = c.event_ts
        WHERE c.age = 1 AND c.op <> 'd'""",
    "replica_source_version": "SELECT coalesce(max(event_ts), 'unknown') AS source_version FROM ev",
    # --- quality ----------------------------------------------------------------------------------
    "dq_keys": _union(
        _keys("silver.asset", "asset", "id"), _keys("silver.work_request", "wr", "id"),
        _keys("silver.work_order", "wo", "id"), _keys("silver.maintenance_action", "ma", "id"),
        _keys("silver_s5000f.product_instance", "pi", "product_instance_id"),
        _keys("silver_s5000f.maintenance_task", "mt", "maintenance_task_id"),
        _keys("silver_s5000f.maintenance_event", "me", "maintenance_event_id"),
        _keys("silver_s5000f.maintenance_task_step", "mts", "task_step_id"),
    ),
    "dq_duplicate_keys": _keys("bronze.maintenance_action", "feed", "pk_id"),
    "dq_accepted": _union(
        _accepted("bronze.asset", "ev", "op", "c u d"), _accepted("bronze.maintenance_action", "feed", "op", "c u d"),
        _accepted("bronze.work_request", f"({_order_feed('wr', 'WorkRequest', 'open', 'approved')})", "op", "c u d"),
        _accepted("bronze.work_order", f"({_order_feed('wo', 'WorkOrder', 'planned', 'in_progress')})", "op", "c u d"),
        _accepted("silver.asset", "asset", "status", "operational degraded failed"),
        _accepted("silver.work_request", "wr", "status", "open approved rejected closed"),
        _accepted("silver.work_request", "wr", "priority", "low medium high critical"),
        _accepted("silver.work_order", "wo", "status", "planned in_progress completed cancelled"),
        _accepted("silver.maintenance_action", "ma", "status", "pending in_progress completed"),
    ),
    "dq_unexpected_values": "SELECT event_type AS value, count(*) AS rows FROM events WHERE event_type NOT IN ('signup', 'error') GROUP BY event_type",
    "dq_relationships": _union(
        _relation("silver.work_request", "wr", "asset_id", "silver.asset", "asset"),
        _relation("silver.work_order", "wo", "asset_id", "silver.asset", "asset"),
        _relation("silver.work_order", "wo", "work_request_id", "silver.work_request", "wr"),
        _relation("silver.maintenance_action", "ma", "work_order_id", "silver.work_order", "wo"),
    ),
    "dq_envelope": """SELECT (SELECT count(*) FROM events) + count(*) AS events,
        count(*) FILTER (o_orderstatus = 'O') AS malformed,
        count(*) FILTER (o_orderstatus = 'O') AS missing_entity, count(*) FILTER (o_orderstatus = 'O') AS missing_event_ts,
        count(*) FILTER (o_orderstatus <> 'F') AS missing_pk, count(*) FILTER (o_orderstatus = 'O') AS missing_source,
        count(*) FILTER (o_orderstatus = 'O') AS bad_op FROM orders""",
    "dq_creation": """SELECT 'Asset' AS entity, count(*) AS key_count, count(*) FILTER (op <> 'c') AS not_created_first
        FROM (SELECT op, row_number() OVER (PARTITION BY pk_id ORDER BY event_ts, event_id) AS n FROM ev) WHERE n = 1""",
    "dq_lifecycle": """SELECT from_status, to_status, count(*) AS changes,
        (from_status = 'pending' AND to_status = 'in_progress') OR (from_status = 'in_progress' AND to_status = 'completed')
            AS allowed
        FROM (SELECT lag(live) OVER (PARTITION BY pk_id ORDER BY event_ts, l_partkey, l_suppkey) AS from_status,
              live AS to_status FROM (SELECT *, CASE WHEN op <> 'd' THEN status END AS live FROM feed))
        WHERE from_status <> to_status GROUP BY from_status, to_status""",
    "dq_order_lifecycle": _changes(
        "wo", "planned>in_progress planned>cancelled in_progress>completed in_progress>cancelled",
        "planned", "planned in_progress", "planned in_progress completed",
    ),
    "dq_request_lifecycle": _changes(
        "wr", "open>approved open>rejected approved>closed", "open", "open approved", "open approved closed"
    ),
    "dq_asset_lifecycle": _changes(
        "asset", "operational>degraded operational>failed degraded>operational failed>operational",
        "operational", "operational degraded", "operational failed",
    ),
    "dq_completed_actions": """SELECT count(DISTINCT wo.id) AS completed_orders,
        count(DISTINCT CASE WHEN ma.status <> 'completed' THEN wo.id END) AS with_unfinished_actions,
        count(*) FILTER (ma.status <> 'completed') AS unfinished_actions
        FROM wo LEFT JOIN ma ON ma.work_order_id = wo.id WHERE wo.status = 'completed'""",
    "dq_freshness": _union(
        _fresh("bronze.asset", "ev", "event_ts", 1), _fresh("bronze.maintenance_action", "feed", "event_ts", 1),
        _fresh("bronze.work_request", f"({_order_feed('wr', 'WorkRequest', 'open', 'approved')})", "event_ts", 1),
        _fresh("bronze.work_order", f"({_order_feed('wo', 'WorkOrder', 'planned', 'in_progress')})", "event_ts", 1),
        *(_fresh(f"silver.{t}", c, "last_event_ts", 1) for t, c in (
            ("asset", "asset"), ("work_request", "wr"), ("work_order", "wo"), ("maintenance_action", "ma"))),
        *(_fresh(f"silver_s5000f.{t}", c, "mapped_at", 24) for t, c in (
            ("product_instance", "pi"), ("functional_failure", "ff"), ("maintenance_task", "mt"),
            ("maintenance_task_step", "mts"), ("maintenance_event", "me"))),
        *(_fresh(f"gold.{t}", c, "computed_at", 24) for t, c in (
            ("asset_availability", "ga"), ("maintenance_history", "mh"), ("work_order_backlog", "backlog"),
            ("mtbf_metrics", "mtbf"), ("asset_maintenance_summary", "summary"), ("asset_mtbf_days", "mtbfdays"),
            ("backlog_detail", "detail"))),
    ),
    "dq_traceability": _union(
        _trace("product_instance", "pi", "product_instance_id", "PI", "ProductInstance"),
        _trace("functional_failure", "ff", "functional_failure_id", "FF", "FunctionalFailure"),
        _trace("maintenance_task", "mt", "maintenance_task_id", "MT", "MaintenanceTask"),
        _trace("maintenance_task_step", "mts", "task_step_id", "MTS", "MaintenanceTaskStep"),
        _trace("maintenance_event", "me", "maintenance_event_id", "ME", "MaintenanceEvent"),
    ),
    # --- query facade -----------------------------------------------------------------------------
    "facade_sql_date": """SELECT op, count(*) AS events, count(DISTINCT pk_id) AS keys FROM ev
        WHERE substr(event_ts, 1, 10) = '2024-01-05' GROUP BY op""",
    "facade_top_assets": """SELECT asset_id, work_order_count FROM summary
        ORDER BY work_order_count DESC, asset_id LIMIT 10""",
}

QUERIES["dq_stale_sources"] = f"""SELECT table_name, count(*) AS sources, count(*) FILTER (NOT fresh) AS stale_sources,
    arg_min(source, (overdue IS NOT NULL, -overdue, source)) AS stalest_source,
    round(CASE WHEN count(*) = count(overdue) THEN max(overdue) END, 6) AS overdue_hours, bool_and(fresh) AS is_fresh
    FROM (WITH RECURSIVE edges(dataset, upstream) AS (VALUES {_lineage()}),
          reach(table_name, source) AS (
              SELECT DISTINCT d, d FROM (SELECT dataset AS d FROM edges UNION SELECT upstream FROM edges)
              UNION SELECT reach.table_name, edges.upstream FROM reach JOIN edges ON edges.dataset = reach.source)
          SELECT * FROM reach) r
    JOIN (SELECT table_name AS source, age_hours - limit_hours AS overdue, is_fresh AS fresh FROM ({QUERIES['dq_freshness']})) f
    USING (source) GROUP BY table_name"""
QUERIES["dq_offsets"] = """SELECT 'cdc.maintenance_action' AS topic, l_orderkey AS "partition", min(l_linenumber)::BIGINT AS first_offset,
    max(l_linenumber)::BIGINT AS last_offset, count(*) AS messages, count(*) - count(DISTINCT l_linenumber) AS repeated,
    count(*) FILTER (l_linenumber > before + 1) AS gaps,
    (max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber))::BIGINT AS missing
    FROM (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM lineitem)
    GROUP BY l_orderkey"""
QUERIES["dq_foreign_ids"] = _union(
    _foreign("functional_failure", "ff", "product_instance_id", "PI", "ProductInstance", "wr", "asset_id"),
    _foreign("maintenance_task", "mt", "product_instance_id", "PI", "ProductInstance", "wo", "asset_id"),
    _foreign("maintenance_task", "mt", "functional_failure_id", "FF", "FunctionalFailure", "wo", "work_request_id"),
    _foreign("maintenance_task_step", "mts", "maintenance_task_id", "MT", "MaintenanceTask", "ma", "work_order_id"),
    _foreign("maintenance_event", "me", "maintenance_task_id", "MT", "MaintenanceTask", "wo", "id"),
    _foreign("maintenance_event", "me", "product_instance_id", "PI", "ProductInstance", "wo", "asset_id"),
)
_WORK_STATUS = "'planned', 'in_progress', 'completed', 'cancelled'"
QUERIES["dq_rules"] = _union(
    _bronze_rules("asset", "ev", "Asset"),
    _bronze_rules("work_request", f"({_order_feed('wr', 'WorkRequest', 'open', 'approved')})", "WorkRequest"),
    _bronze_rules("work_order", f"({_order_feed('wo', 'WorkOrder', 'planned', 'in_progress')})", "WorkOrder"),
    _bronze_rules("maintenance_action", "feed", "MaintenanceAction"),
    _rules("silver.asset", "asset", "source_id last_op id", "install_date updated_at last_event_ts",
           {"status": "'operational', 'degraded', 'failed'"}),
    _rules("silver.work_request", "wr", "source_id last_op id", "reported_at updated_at last_event_ts",
           {"priority": "'low', 'medium', 'high', 'critical'", "status": "'open', 'approved', 'rejected', 'closed'"}),
    _rules("silver.work_order", "wo", "source_id last_op id",
           "planned_start planned_end actual_start actual_end updated_at last_event_ts", {"status": _WORK_STATUS}),
    _rules("silver.maintenance_action", "ma", "source_id last_op id", "started_at completed_at last_event_ts",
           {"status": "'pending', 'in_progress', 'completed'"}),
    _rules("silver_s5000f.product_instance", "pi", "product_instance_id", "installation_date mapped_at", {}),
    _rules("silver_s5000f.functional_failure", "ff", "", "reported_at mapped_at", {}),
    _rules("silver_s5000f.maintenance_task", "mt", "maintenance_task_id", "planned_start planned_end mapped_at", {}),
    _rules("silver_s5000f.maintenance_task_step", "mts", "task_step_id", "started_at completed_at mapped_at", {}),
    _rules("silver_s5000f.maintenance_event", "me", "maintenance_event_id", "actual_start actual_end mapped_at", {}),
    _rules("gold.asset_availability", "ga", "", "computed_at", {}),
    _rules("gold.maintenance_history", "mh", "", "first_maintenance last_maintenance computed_at", {}),
    _rules("gold.work_order_backlog", "backlog", "", "oldest_planned_start computed_at", {}),
    _rules("gold.mtbf_metrics", "mtbf", "", "computed_at", {}),
    _rules("gold.asset_maintenance_summary", "summary", "", "last_maintenance_date computed_at", {}),
    _rules("gold.asset_mtbf_days", "mtbfdays", "", "computed_at", {}),
    _rules("gold.backlog_detail", "detail", "", "computed_at", {}),
)


def statements() -> dict[str, str]:
    return {name: _sql(body) for name, body in QUERIES.items()}
