import datetime

import pytest

from conftest import TESTDATA, as_dicts
from maintlake.plans.lakehouse import Lakehouse, example_queries, open_store
from maintlake.schemas import QUERY_NAMESPACES
from maintlake.sources.binding import BoundTables


@pytest.fixture
def lake(spark):
    tables = BoundTables(spark, TESTDATA)
    return Lakehouse(spark, tables, tables.names)


def test_needs_a_table_or_sql(lake):
    with pytest.raises(ValueError):
        lake.query()


@pytest.mark.parametrize("name", ["silver.asset", "silver_asset"])
def test_table_mode(lake, name):
    assert lake.query(table=name).count() == 150
    assert lake.query(table=name, limit=7).count() == 7
    assert lake.query(table=name, limit=0).count() == 150


@pytest.mark.parametrize(
    "name", ["silver.asset", "silver_asset", "silver_s5000f.product_instance", "silver_s5000f_product_instance", "gold.mtbf_metrics"]
)
def test_both_spellings_resolve_in_sql(lake, name):
    assert lake.query(sql=f"SELECT COUNT(*) AS n FROM {name} -- counted").first()["n"] > 0


def test_sql_wins_and_limit_applies(lake):
    df = lake.query(table="gold.mtbf_metrics", sql="SELECT id FROM silver.asset", limit=3)
    assert df.columns == ["id"] and df.count() == 3


def test_quoted_text_is_left_alone(lake):
    row = lake.query(sql="SELECT 'from silver.asset' AS t, COUNT(*) AS n FROM silver.asset").first()
    assert row["t"] == "from silver.asset"


@pytest.mark.parametrize("day", ["2024-01-05", datetime.date(2024, 1, 5), datetime.datetime(2024, 1, 5, 12)])
def test_date_filter_restricts_tables_with_a_date(lake, day):
    by_table = lake.query(table="bronze.asset", date_filter=day)
    by_sql = lake.query(sql="SELECT * FROM bronze_asset", date_filter=day)
    assert 0 < by_table.count() == by_sql.count() < lake.query(table="bronze.asset").count()
    assert lake.query(table="silver.asset", date_filter=day).count() == 150
    assert {r["event_date"] for r in as_dicts(by_sql)} == {"2024-01-05"}


def test_query_leaves_no_views_behind(lake, spark):
    lake.query(sql="SELECT * FROM silver.asset").count()
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("silver_")]


def test_views_of_the_user_survive(lake, spark):
    spark.range(3).createOrReplaceTempView("silver_asset")
    try:
        assert lake.query(sql="SELECT * FROM silver_asset").count() == 150
        assert spark.table("silver_asset").count() == 3
    finally:
        spark.catalog.dropTempView("silver_asset")


def test_comments_and_qualified_columns(lake):
    sql = """-- the asset's table, not 'gold.mtbf_metrics'
        SELECT silver.asset.id, silver_work_order.status /* it's silver.asset */
        FROM silver.asset JOIN silver_work_order ON silver_asset.id = silver.work_order.asset_id
        WHERE silver.asset.status = 'failed'"""
    df = lake.query(sql=sql)
    assert df.columns == ["id", "status"] and df.count() > 0


def test_unknown_tables_are_an_error(lake):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        lake.query(sql="SELECT * FROM silver.nothing")


def test_grouping_by_position(lake):
    df = lake.query(sql="SELECT asset_type, status, COUNT(*) AS n FROM silver.asset GROUP BY 1, 2 HAVING COUNT(*) > 1 ORDER BY 3 DESC")
    assert df.count() > 0


def test_examples_run(lake):
    assert set(example_queries()) == {"asset_availability", "maintenance_history", "s5000f_compliance", "cross_layer_comparison"}
    for sql in example_queries().values():
        assert lake.query(sql=sql, limit=1).count() == 1


def test_published_tables_are_discovered_and_queried(store):
    store.publish("silver.asset", BoundTables(store.spark, TESTDATA)("silver.asset"))
    lake = open_store(store.spark)
    assert lake.available_tables() == {ns: ["silver.asset"] if ns == "silver" else [] for ns in QUERY_NAMESPACES}
    assert lake.query(sql="SELECT a.id FROM silver.asset a JOIN silver_asset b ON a.id = b.id").count() == 150
    assert lake.query(table="gold.mtbf_metrics").isEmpty()
