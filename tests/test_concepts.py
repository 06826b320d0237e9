import hashlib

import pytest

from conftest import as_dicts
from maintlake.functions.ids import CONCEPT_PREFIXES, concept_id
from maintlake.operators import concepts
from maintlake.schemas import AFTER, CONCEPTS, silver_schema

STAMP = "2024-03-01T00:00:00+00:00"


def expected_id(concept, key):
    prefix = CONCEPT_PREFIXES.get(concept, concept[:3].upper())
    return f"{prefix}-{hashlib.sha256(f'{concept}:{key}'.encode()).hexdigest()[:12]}"


def table(spark, name, *rows):
    schema = silver_schema(AFTER[name])
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)


@pytest.mark.parametrize("concept", [*CONCEPT_PREFIXES, "Widget"])
@pytest.mark.parametrize("key", ["a001", "", "ключ", None])
def test_identifier_is_prefix_and_hash(spark, concept, key):
    df = spark.createDataFrame([(key,)], "id string")
    assert df.select(concept_id(concept, "id")).first()[0] == expected_id(concept, key)


def test_missing_reference_can_stay_null(spark):
    df = spark.createDataFrame([(None,), ("a",)], "id string")
    ids = [r[0] for r in df.select(concept_id("ProductInstance", "id", null_id="null")).collect()]
    assert ids == [None, expected_id("ProductInstance", "a")]


def test_same_key_differs_between_concepts(spark):
    df = spark.createDataFrame([("x",)], "id string").select(*[concept_id(c, "id").alias(c) for c in CONCEPT_PREFIXES])
    values = df.first()
    assert len({v.split("-")[1] for v in values}) == len(CONCEPT_PREFIXES)
    assert all(len(v.split("-")[1]) == 12 for v in values)


def test_every_concept_has_its_declared_schema(spark):
    order, action = table(spark, "work_order"), table(spark, "maintenance_action")
    built = {
        "product_instance": concepts.product_instance(table(spark, "asset"), STAMP),
        "functional_failure": concepts.functional_failure(table(spark, "work_request"), STAMP),
        "maintenance_task": concepts.maintenance_task(order, STAMP),
        "maintenance_task_step": concepts.maintenance_task_step(action, STAMP),
        "maintenance_event": concepts.maintenance_event(order, action, STAMP),
    }
    for name, df in built.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CONCEPTS[name]], name
        assert df.isEmpty()


def test_references_of_the_model_fit_together(spark):
    asset = table(spark, "asset", {"id": "a1", "asset_type": "pump", "status": "failed", "source_id": "a1"})
    request = table(spark, "work_request", {"id": "r1", "asset_id": "a1", "description": "leak"})
    order = table(spark, "work_order", {"id": "o1", "asset_id": "a1", "work_request_id": "r1"})
    (pi,) = as_dicts(concepts.product_instance(asset, STAMP))
    (ff,) = as_dicts(concepts.functional_failure(request, STAMP))
    (mt,) = as_dicts(concepts.maintenance_task(order, STAMP))
    assert pi["type"] == "pump" and pi["operational_status"] == "failed" and pi["mapped_at"] == STAMP
    assert ff["failure_description"] == "leak"
    assert pi["product_instance_id"] == ff["product_instance_id"] == mt["product_instance_id"]
    assert ff["functional_failure_id"] == mt["functional_failure_id"]


def test_column_the_source_lacks_is_blank(spark):
    asset = table(spark, "asset", {"id": "a1"}).drop("install_date")
    assert as_dicts(concepts.product_instance(asset, STAMP))[0]["installation_date"] == ""


def test_events_are_executed_orders_with_action_counts(spark):
    started = "2024-01-02T00:00:00+00:00"
    order = table(
        spark, "work_order",
        {"id": "o1", "status": "completed", "actual_start": started, "asset_id": "a1", "source_id": "o1"},
        {"id": "o2", "status": "completed", "actual_start": started},
        {"id": "o3", "status": "completed", "actual_start": ""},
        {"id": "o4", "status": "completed", "actual_start": None},
        {"id": "o5", "status": "in_progress", "actual_start": started},
    )
    action = table(
        spark, "maintenance_action",
        {"id": "m1", "work_order_id": "o1", "status": "completed"},
        {"id": "m2", "work_order_id": "o1", "status": "pending"},
        {"id": "m3", "work_order_id": "o5"},
        {"id": "m4", "work_order_id": None},
    )
    counts = {r["maintenance_task_id"]: r["action_count"] for r in as_dicts(concepts.maintenance_event(order, action, STAMP))}
    assert counts == {expected_id("MaintenanceTask", "o1"): 2, expected_id("MaintenanceTask", "o2"): 0}
    without = concepts.maintenance_event(order, None, STAMP)
    assert {r["action_count"] for r in as_dicts(without)} == {0}
