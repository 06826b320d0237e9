"""Plans and behaviour that must hold when the data is large or uneven."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA, as_dicts, plan_of
from maintlake.functions.ids import concept_id
from maintlake.operators import gold
from maintlake.operators.cdc import latest_events, resolve_cdc
from maintlake.operators.joins import settle
from maintlake.operators.latest import latest_per_key
from maintlake.schemas import AFTER

#: These run jobs of their own when they are built, and return a table that was written.
EAGER = {"stream_latest_state", "cdc_bucketed_state", "refresh_incremental"}
LAZY = sorted(set(registered._builders()) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_multiplies_rows_or_runs_python(spark, name):
    plan = plan_of(registered.queries()[name](spark, TESTDATA), "simple")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in plan


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def set_all(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_all
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_latest_row_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"], ["id"]), "simple")
    above, below = plan.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in below and "Partial" in below and "Final" in above


def test_a_hot_key_leaves_each_map_task_as_one_row(spark, tmp_path, conf):
    """A third of all events belongs to one key."""
    conf(spark__sql__adaptive__enabled="false")
    events = spark.range(30_000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("pk_id"),
        F.lit("u").alias("op"), F.lpad(F.col("id").cast("string"), 8, "0").alias("event_ts"),
        F.lit("{}").alias("payload_json"), F.lit("eam").alias("source_system"),
    )
    events.write.parquet(str(tmp_path / "events"))
    stored = spark.read.parquet(str(tmp_path / "events"))
    df = latest_events(stored)
    assert [r["event_ts"] for r in as_dicts(df.filter("pk_id = 'hot'"))] == ["00029997"]
    df.collect()
    (written,) = shuffled_records(df)
    assert 20_000 < written <= 20_000 + stored.rdd.getNumPartitions()


def shuffled_records(df):
    """Records each shuffle of a plan without adaptive stages wrote."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            found.append(metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_batch_is_read_and_shuffled_once_for_new_rows_and_changed_keys(spark, tmp_path, conf):
    conf(**{"spark.sql.maxMetadataStringLength": 10_000})  # or long paths are cut in the plan
    schema = "pk_id string, op string, event_ts string, payload_json string, source_system string"
    events = spark.createDataFrame([("a", "u", "2024", "{}", "s"), ("b", "c", "2024", "{}", "s")], schema)
    events.write.parquet(str(tmp_path / "events"))
    bronze = spark.read.parquet(str(tmp_path / "events"))
    resolve_cdc(bronze, None, AFTER["asset"]).write.parquet(str(tmp_path / "state"))
    merged = resolve_cdc(bronze, spark.read.parquet(str(tmp_path / "state")), AFTER["asset"])
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("/events]") == 1 and "ReusedExchange" in plan


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{TESTDATA}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"),
        F.lit("a").alias("asset_id"), F.lit("r").alias("work_request_id"), F.lit("").alias("planned_start"),
    )
    plan = plan_of(gold.work_order_backlog(orders, None, "now"), "formatted")
    assert "PushedFilters: [In(o_orderstatus, [in_progress,planned])]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def skewed_orders(spark, folder):
    """A third of all orders belongs to one request, another third has none."""
    third = F.col("id") % 3
    spark.range(90_000).repartition(9).select(
        F.concat(F.lit("o"), "id").alias("id"),
        F.concat(F.lit("a"), F.col("id") % 50).alias("asset_id"),
        F.when(third == 0, "r0").when(third == 1, F.concat(F.lit("r"), "id")).alias("work_request_id"),
        F.lit("planned").alias("status"),
        F.sha2(F.col("id").cast("string"), 256).alias("planned_start"),
    ).write.parquet(f"{folder}/orders")
    spark.range(90_000).select(
        F.concat(F.lit("r"), "id").alias("id"),
        F.when(F.col("id") % 2 == 0, "high").otherwise("low").alias("priority"),
    ).write.parquet(f"{folder}/requests")
    return spark.read.parquet(f"{folder}/orders"), spark.read.parquet(f"{folder}/requests")


def test_a_hot_request_is_split_and_the_result_is_whole(spark, tmp_path, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="256KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="1KB",
        spark__sql__shuffle__partitions="16",
    )
    orders, requests = skewed_orders(spark, str(tmp_path))
    df = gold.work_order_backlog(orders, requests, "now")
    assert "isSkew=true" in executed(df) or "skew=true" in executed(df)
    counts = {}
    for row in as_dicts(df):
        counts[row["priority"]] = counts.get(row["priority"], 0) + row["open_count"]
    assert counts == {"high": 30_000 + 15_000, "low": 15_000, None: 30_000}


def test_orders_without_a_request_do_not_meet_in_one_partition(spark, tmp_path, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    orders, requests = skewed_orders(spark, str(tmp_path))
    unlinked = orders.filter("work_request_id IS NULL")
    joined = gold.with_priority(unlinked, requests).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in as_dicts(joined.groupBy("p").count())]
    assert len(sizes) == 16 and max(sizes) < 2 * 30_000 / 16


def test_few_settled_rows_are_broadcast_to_the_scan(spark):
    few = settle(spark.range(1000).orderBy("id").limit(5))
    big = spark.range(1_000_000)
    plan = plan_of(big.join(few, "id", "left_semi"), "simple")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_identifiers_are_hashed_once_per_row(spark):
    left = spark.range(10).select(concept_id("Asset", F.col("id").cast("string")).alias("k"))
    right = spark.range(10).select(F.col("id").cast("string").alias("k"))
    plan = plan_of(left.join(right, "k"), "simple")
    assert plan.count("sha2(") == 1
