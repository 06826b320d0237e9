import pytest

from conftest import as_dicts, event
from maintlake import schemas
from maintlake.operators import quality
from maintlake.schemas import CONCEPTS, LINEAGE, PRIMARY_KEYS, TABLES
from pyspark.sql import Window, functions as F


def only(spark, **frames):
    """Tables given by keyword (``silver_asset``), all others empty."""

    def tables(name):
        df = frames.get(name.replace(".", "_"))
        return df if df is not None else spark.createDataFrame([], TABLES[name])

    return tables


def test_contract_violations(spark):
    actual = dict(TABLES)
    del actual["gold.mtbf_metrics"]
    actual["silver.asset"] = spark.createDataFrame([], "id bigint, extra string").schema
    found = {(r["table_name"], r["column_name"], r["violation"]) for r in as_dicts(quality.contract_violations(spark, actual))}
    assert ("gold.mtbf_metrics", None, "missing_table") in found
    assert ("silver.asset", "id", "wrong_type") in found
    assert ("silver.asset", "extra", "undeclared_column") in found
    assert ("silver.asset", "name", "missing_column") in found
    assert quality.contract_violations(spark, TABLES).isEmpty()


def test_key_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string")
    (row,) = as_dicts(quality.key_report(only(spark, silver_asset=df), {"silver.asset": "id"}))
    assert (row["total_rows"], row["null_keys"], row["duplicate_keys"]) == (5, 2, 1)
    assert quality.key_report(only(spark)).count() == len(PRIMARY_KEYS)


def test_accepted_values(spark):
    df = spark.createDataFrame([("failed",), ("broken",), ("broken",), (None,)], "status string")
    report = as_dicts(quality.accepted_values_report(only(spark, silver_asset=df)))
    (row,) = [r for r in report if r["table_name"] == "silver.asset"]
    assert (row["checked_rows"], row["violations"]) == (3, 2)
    assert as_dicts(quality.unexpected_values(df, "status", ["failed"])) == [{"value": "broken", "rows": 2}]


def test_relationships(spark):
    child = spark.createDataFrame([("a1",), ("gone",), ("gone",), (None,)], "asset_id string")
    parent = spark.createDataFrame([("a1",), ("a1",), ("a2",)], "id string")
    tables = only(spark, silver_work_order=child, silver_asset=parent)
    (row,) = as_dicts(quality.relationship_report(tables, [("silver.work_order", "asset_id", "silver.asset", "id")]))
    assert (row["checked_rows"], row["orphan_rows"], row["orphan_keys"]) == (3, 2, 1)


def test_creation_report(spark, bronze):
    T = "2024-01-15T{:02d}:00:00+00:00".format
    df = bronze(event(ts=T(1)), event(op="u", ts=T(2)), event(pk="b", op="u", ts=T(1)), event(pk="b", ts=T(2)))
    assert as_dicts(quality.creation_report(df, "Asset")) == [{"entity": "Asset", "key_count": 2, "not_created_first": 1}]


@pytest.mark.parametrize("seconds", [3_000, 200_000, 90_000_000])
def test_previous_value_equals_a_plain_lag(spark, seconds):
    """A key holds a third of all rows, within an hour or over years; its hours must not change the result."""
    events = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("pk_id"),
        F.date_format(
            F.timestamp_seconds(F.lit(1_700_000_000) + F.hash("id") % seconds), "yyyy-MM-dd'T'HH:mm:ss"
        ).alias("event_ts"),
        F.col("id").alias("n"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("status"),
    )
    plain = events.withColumn(
        "previous", F.lag("status").over(Window.partitionBy("pk_id").orderBy("event_ts", "n"))
    )
    split = quality.with_previous(events, "pk_id", "event_ts", "status", ["n"])
    assert sorted(map(repr, split.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_events_without_a_key_have_no_predecessor(spark):
    rows = [(None, "2024-01-15T01", "a"), (None, "2024-01-15T01", "b"), (None, "2024-01-15T02", "c"),
            ("", "2024-01-15T01", "d"), ("", None, "e"), ("", "2024-01-15T09", None)]
    df = spark.createDataFrame(rows, "pk_id string, event_ts string, status string")
    found = {r["status"]: r["previous"] for r in quality.with_previous(df, "pk_id", "event_ts", "status").collect()}
    assert found == {"a": None, "b": None, "c": None, "e": None, "d": "e", None: "d"}


def test_lifecycle_reads_its_events_once(spark, tmp_path):
    spark.range(50).selectExpr(
        "concat('k', id % 5) AS pk_id", "concat('2024-01-15T0', id % 9) AS event_ts", "if(id % 2 = 0, 'planned', 'completed') AS status"
    ).write.parquet(str(tmp_path / "events"))
    report = quality.transition_report(spark.read.parquet(str(tmp_path / "events")), "work_order")
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_transitions(spark):
    rows = [("o", 1, "planned"), ("o", 2, "in_progress"), ("o", 3, "in_progress"), ("o", 4, "completed"),
            ("p", 1, "planned"), ("p", 2, "completed"), ("q", 1, "completed"), ("q", 2, None), ("q", 3, "planned")]
    df = spark.createDataFrame([(k, f"2024-01-15T{h:02d}", s) for k, h, s in rows], "pk_id string, event_ts string, status string")
    found = {(r["from_status"], r["to_status"]): (r["changes"], r["allowed"]) for r in as_dicts(quality.transition_report(df, "work_order"))}
    assert found == {
        ("planned", "in_progress"): (1, True), ("in_progress", "completed"): (1, True), ("planned", "completed"): (1, False),
    }


def test_unfinished_actions(spark):
    order = spark.createDataFrame([("o1", "completed"), ("o2", "completed"), ("o3", "planned")], "id string, status string")
    action = spark.createDataFrame(
        [("o1", "completed"), ("o1", "pending"), ("o1", None), ("o3", "pending")], "work_order_id string, status string"
    )
    (row,) = as_dicts(quality.unfinished_actions(order, action))
    assert row == {"completed_orders": 2, "with_unfinished_actions": 1, "unfinished_actions": 2}


def test_lineage_and_freshness(spark):
    edges = {(r["dataset"], r["upstream"]) for r in as_dicts(quality.lineage_edges(spark))}
    assert len(edges) == sum(map(len, LINEAGE.values()))
    df = spark.createDataFrame([("2024-01-01T00:00:00+00:00",), ("2024-01-01T09:30:00+00:00",)], "last_event_ts string")
    tables = only(spark, silver_asset=df, silver_work_order=df.limit(0))
    names = ["silver.asset", "silver.work_order"]
    report = as_dicts(quality.freshness_report(tables, names, "2024-01-01T10:00:00+00:00"))
    assert [(r["age_hours"], r["future_rows"], r["is_fresh"]) for r in report] == [(0.5, 0, True), (None, 0, False)]
    assert not as_dicts(quality.freshness_report(tables, names, "2024-01-02T10:00:00+00:00"))[0]["is_fresh"]
    # a row of the future does not hide that the last known one is old
    early = as_dicts(quality.freshness_report(tables, names, "2024-01-01T09:00:00+00:00"))[0]
    assert (early["age_hours"], early["future_rows"], early["is_fresh"]) == (9.0, 1, False)


def test_traceability(spark):
    from test_concepts import expected_id

    names = CONCEPTS["product_instance"].names
    rows = [
        tuple({"product_instance_id": expected_id("ProductInstance", "a1"), "source_id": "a1"}.get(n) for n in names),
        tuple({"product_instance_id": "PI-forged", "source_id": "a2"}.get(n) for n in names),
    ]
    df = spark.createDataFrame(rows, CONCEPTS["product_instance"])
    report = {r["concept_table"]: r for r in as_dicts(quality.traceability_report(only(spark, silver_s5000f_product_instance=df)))}
    assert (report["product_instance"]["checked_rows"], report["product_instance"]["untraceable"]) == (2, 1)
    assert len(report) == len(CONCEPTS)


def test_offsets_with_planted_gaps_and_repeats(spark):
    rows = [("t", 0, o) for o in (5, 6, 7, 10, 10, 11, 20)] + [("t", 1, 3)] + [("u", None, o) for o in (1, 2, 2)] + [("t", 2, None)]
    messages = spark.createDataFrame(rows, "topic string, partition int, offset long")
    islands = {(r.topic, r.partition, r.first_offset, r.last_offset) for r in quality.offset_islands(messages.filter("offset IS NOT NULL")).collect()}
    assert islands == {("t", 0, 5, 7), ("t", 0, 10, 11), ("t", 0, 20, 20), ("t", 1, 3, 3), ("u", None, 1, 2)}
    report = {(r.topic, r.partition): tuple(r)[2:] for r in quality.offset_report(messages).collect()}
    assert report == {("t", 0): (5, 20, 7, 1, 2, 10), ("t", 1): (3, 3, 1, 0, 0, 0), ("u", None): (1, 2, 3, 1, 0, 0)}


def test_planted_breaches_of_the_rules_are_found_in_one_scan(spark):
    ok = ("Asset", "c", "2024-01-15T10:00:00+00:00", "a", "{}", "2024-01-15", "s")
    broken = [
        ("Vehicle", *ok[1:]), ("Asset", "x", *ok[2:]), ("Asset", "c", "soon", "a", "{}", "soon", "s"), (*ok[:3], None, *ok[4:]),
        (*ok[:5], "2024-01-16", "s"), (None,) * 7,
    ]
    bronze = spark.createDataFrame([ok, *broken], schemas.BRONZE)
    report = quality.rule_report(lambda name: bronze, ["bronze.asset"])
    found = {(r.rule, r.column_name): r.violations for r in report.collect()}
    assert found == {
        ("required", "op"): 1, ("required", "event_ts"): 1, ("required", "pk_id"): 2, ("required", "payload_json"): 1,
        ("required", "source_system"): 1, ("format", "event_ts"): 1, ("accepted", "op"): 1, ("partition", "event_date"): 1,
        ("constant", "entity"): 2,
    }
    assert report.select("checked_rows").distinct().collect()[0][0] == 7


def test_staleness_flows_down_the_lineage(spark):
    rows = [(t, 1.0, 24, True) for t in schemas.TABLES if t not in ("bronze.asset", "silver.work_order")]
    rows += [("bronze.asset", 30.5, 1, False), ("silver.work_order", None, 1, False)]
    ages = spark.createDataFrame(rows, "table_name string, age_hours double, limit_hours long, is_fresh boolean")
    report = {r.table_name: (r.sources, r.stale_sources, r.stalest_source, r.overdue_hours, r.is_fresh) for r in quality.stale_source_report(spark, ages).collect()}
    assert report["bronze.asset"] == (1, 1, "bronze.asset", 29.5, False)
    assert report["gold.asset_availability"] == (3, 1, "bronze.asset", 29.5, False)
    assert report["gold.maintenance_history"] == (6, 1, "silver.work_order", None, False)
    assert report["silver.work_request"] == (2, 0, "bronze.work_request", -23.0, True)
    assert set(report) == set(schemas.TABLES)
