import pytest

from conftest import as_dicts
from maintlake.operators import gold
from maintlake.schemas import CONCEPTS, GOLD
from test_concepts import table

AT = "2024-03-01T00:00:00+00:00"


def concept(spark, name, *rows):
    schema = CONCEPTS[name]
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


def test_availability_of_each_status(spark):
    asset = table(spark, "asset", {"id": "1", "status": "operational"}, {"id": "2", "status": "failed"}, {"id": "3"})
    found = {r["asset_id"]: (r["is_available"], r["availability_pct"]) for r in as_dicts(gold.asset_availability(asset, AT))}
    assert found == {"1": (True, 100.0), "2": (False, 0.0), "3": (None, 0.0)}


def test_history_takes_the_earliest_source(spark):
    event = concept(
        spark, "maintenance_event",
        {"maintenance_event_id": "e2", "product_instance_id": "p", "actual_start": "2024-02", "action_count": 2, "source_id": "b"},
        {"maintenance_event_id": "e1", "product_instance_id": "p", "actual_start": "2024-01", "action_count": 3, "source_id": "a"},
    )
    (row,) = as_dicts(gold.maintenance_history(event, AT))
    assert row == {
        "product_instance_id": "p", "asset_source_id": "a", "event_count": 2, "first_maintenance": "2024-01",
        "last_maintenance": "2024-02", "total_actions": 5, "computed_at": AT,
    }


ORDERS = [
    {"id": "o1", "asset_id": "a", "work_request_id": "r1", "status": "planned", "planned_start": "2024-02-01"},
    {"id": "o2", "asset_id": "a", "work_request_id": "r1", "status": "in_progress", "planned_start": ""},
    {"id": "o3", "asset_id": "a", "work_request_id": "gone", "status": "planned", "planned_start": "2024-01-01"},
    {"id": "r9", "asset_id": "b", "work_request_id": None, "status": "planned", "planned_start": "2024-01-05"},
    {"id": "o5", "asset_id": "b", "work_request_id": "r1", "status": "completed", "planned_start": "2023-01-01"},
]
REQUESTS = [{"id": "r1", "priority": "high"}, {"id": "r9", "priority": "low"}]


def test_backlog_groups_open_orders(spark):
    orders, requests = table(spark, "work_order", *ORDERS), table(spark, "work_request", *REQUESTS)
    found = {
        (r["priority"], r["asset_id"]): (r["open_count"], r["oldest_planned_start"])
        for r in as_dicts(gold.work_order_backlog(orders, requests, AT))
    }
    # the order called r9 has no request and must not meet the request of that id
    assert found == {("high", "a"): (2, ""), (None, "a"): (1, "2024-01-01"), (None, "b"): (1, "2024-01-05")}


def test_backlog_without_requests_is_unknown(spark):
    found = as_dicts(gold.work_order_backlog(table(spark, "work_order", *ORDERS), None, AT))
    assert {r["priority"] for r in found} == {"unknown"} and sum(r["open_count"] for r in found) == 4


def test_backlog_detail_ages(spark):
    orders, requests = table(spark, "work_order", *ORDERS), table(spark, "work_request", *REQUESTS)
    days = {r["work_order_id"]: r["days_open"] for r in as_dicts(gold.backlog_detail(orders, requests, AT))}
    assert days == {"o1": 29, "o2": None, "o3": 60, "r9": 56}


def test_mtbf_by_type(spark):
    instance = concept(
        spark, "product_instance",
        {"product_instance_id": "p1", "type": "pump"}, {"product_instance_id": "p2", "type": "pump"},
        {"product_instance_id": "p3", "type": "fan"}, {"product_instance_id": "p4", "type": None},
    )
    failure = concept(
        spark, "functional_failure",
        *[{"functional_failure_id": f"f{i}", "product_instance_id": p} for i, p in enumerate(["p1", "p1", "p1", "p2", "p4", "p0"])],
    )
    found = {
        r["type"]: (r["asset_count"], r["failure_count"], r["failures_per_asset"], r["mtbf_proxy_hours"])
        for r in as_dicts(gold.mtbf_metrics(instance, failure, AT))
    }
    assert found == {"pump": (2, 4, 2.0, 4380.0), "fan": (1, 0, 0.0, None), None: (1, 0, 0.0, None)}
    assert {r["failure_count"] for r in as_dicts(gold.mtbf_metrics(instance, None, AT))} == {0}


def test_summary_and_mtbf_days(spark):
    order = table(
        spark, "work_order",
        {"id": "o1", "asset_id": "a", "actual_end": "2024-01-03T00:00:00+00:00"}, {"id": "o2", "asset_id": "a", "actual_end": ""},
    )
    action = table(
        spark, "maintenance_action",
        {"id": "m1", "work_order_id": "o1", "status": "completed"}, {"id": "m2", "work_order_id": "o1", "status": "pending"},
        {"id": "m3", "work_order_id": "o2", "status": "completed"},
    )
    (row,) = as_dicts(gold.asset_maintenance_summary(order, action, AT))
    assert (row["work_order_count"], row["completed_actions_count"], row["last_maintenance_date"]) == (2, 2, "2024-01-03")
    asset = table(spark, "asset", {"id": "a", "install_date": "2024-01-01"}, {"id": "b", "install_date": ""})
    request = table(spark, "work_request", {"id": "r1", "asset_id": "a"}, {"id": "r2", "asset_id": "a"})
    found = {r["asset_id"]: (r["total_failures"], r["observation_days"], r["mtbf_days"]) for r in as_dicts(gold.asset_mtbf_days(asset, request, AT))}
    assert found == {"a": (2, 60, 30.0), "b": (0, None, None)}


@pytest.mark.parametrize("name", GOLD)
def test_empty_inputs_give_empty_results_of_the_declared_schema(spark, name):
    order, request, action, asset = (table(spark, n) for n in ("work_order", "work_request", "maintenance_action", "asset"))
    df = {
        "asset_availability": lambda: gold.asset_availability(asset, AT),
        "maintenance_history": lambda: gold.maintenance_history(concept(spark, "maintenance_event"), AT),
        "work_order_backlog": lambda: gold.work_order_backlog(order, request, AT),
        "mtbf_metrics": lambda: gold.mtbf_metrics(concept(spark, "product_instance"), concept(spark, "functional_failure"), AT),
        "asset_maintenance_summary": lambda: gold.asset_maintenance_summary(order, action, AT),
        "asset_mtbf_days": lambda: gold.asset_mtbf_days(asset, request, AT),
        "backlog_detail": lambda: gold.backlog_detail(order, request, AT),
    }[name]()
    assert df.isEmpty()
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD[name]]
