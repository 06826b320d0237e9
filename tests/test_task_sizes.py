"""Task sizes that do not follow the input, and messages whose text is read once."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import plan_of
from maintlake.sources import binding


def orders_file(path, rows):
    """Orders in one row group behind many splits, the way a single file holds them."""
    day = datetime.datetime(1996, 1, 1)
    pq.write_table(
        pa.table(
            {
                "o_orderkey": list(range(rows)), "o_custkey": [n % 7 for n in range(rows)],
                "o_orderstatus": ["FOP"[n % 3] for n in range(rows)], "o_totalprice": [1.0] * rows,
                "o_orderdate": pa.array([day] * rows, pa.timestamp("us")), "o_orderpriority": ["1-URGENT"] * rows,
            }
        ),
        path,
        row_group_size=rows,
    )


@pytest.mark.parametrize("feed, per_order", [("work_order", 2), ("work_request", 2)])
def test_no_task_gets_more_events_than_its_share(spark, tmp_path, monkeypatch, feed, per_order):
    monkeypatch.setattr(binding, "ROWS_PER_TASK", 50)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    orders_file(str(tmp_path / "orders.parquet"), 1200)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        events = binding.BoundTables(spark, str(tmp_path))(f"bronze.{feed}")
        counts = [r["count"] for r in events.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(counts) == 1200 * per_order
    assert len(counts) >= 20 and max(counts) <= 3 * 2 * 50


def test_messages_are_read_back_in_one_pass(spark):
    plan = plan_of(registered.queries()["feed_messages_topics"](spark, "/root/testdata/sf0.001"), "simple")
    assert plan.count("from_json") == 4 and "$.after" not in plan
