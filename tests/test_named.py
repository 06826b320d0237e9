"""Named queries over published tables, as a deployment runs them."""

import pytest

from conftest import TESTDATA, as_dicts
from maintlake.plans.named import NAMED
from maintlake.schemas import GOLD, CONCEPTS, AFTER
from maintlake.sources.binding import RUN_STAMP, BoundTables
from maintlake.sources.tables import TableStore
from maintlake.plans.refresh import refresh_table


@pytest.fixture(scope="module")
def published(spark):
    for namespace in ("gold", "silver_s5000f", "silver", "bronze", "replica"):
        spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")
    store, bound = TableStore(spark), BoundTables(spark, TESTDATA)
    for table in AFTER:
        store.publish(f"silver.{table}", bound(f"silver.{table}"))
    for table in CONCEPTS:
        refresh_table(store, f"silver_s5000f.{table}", RUN_STAMP)
    for table in GOLD:
        refresh_table(store, f"gold.{table}", RUN_STAMP)
    return store


@pytest.mark.parametrize("name", sorted(NAMED))
def test_published_tables_give_the_same_answers(spark, published, name):
    over_store = NAMED[name](published)
    over_binding = NAMED[name](BoundTables(spark, TESTDATA))
    assert over_store.columns == over_binding.columns
    assert sorted(map(repr, as_dicts(over_store))) == sorted(map(repr, as_dicts(over_binding)))


ORDERED = {
    "n07": lambda r: (-r["total_assets"], r["asset_type"]),
    "n10": lambda r: (tuple(-ord(c) for c in r["wo_completed"]), r["work_order_id"]),
    "n12": lambda r: (-r["open_work_orders"], -r["completed_work_orders"], r["asset_id"]),
    "n19": lambda r: (r["data_layer"], r["entity_id"]),
    "n23": lambda r: (-r["availability_pct"], r["asset_name"], r["asset_id"]),
}


@pytest.mark.parametrize("name", ORDERED)
def test_results_come_in_the_asked_order(spark, name):
    rows = as_dicts(NAMED[name](BoundTables(spark, TESTDATA)))
    assert rows == sorted(rows, key=ORDERED[name]) and len(rows) > 1
