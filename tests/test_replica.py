import json

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, as_dicts
from maintlake.sources import replica
from maintlake.sources.binding import BoundTables
from maintlake.sources.replica_changes import ReplicaTable, changed_keys, load_changes

AT = "2024-03-01T00:00:00+00:00"


def test_staging_is_text_with_audit_columns_and_every_row(store, tmp_path):
    store.publish("silver.work_order", BoundTables(store.spark, TESTDATA)("silver.work_order"))
    sink = replica.parquet_sink(str(tmp_path))
    stats = json.loads(replica.load_staging(store, "silver", "work_order", sink, AT))
    assert stats == {"status": "success", "layer": "silver", "table": "work_order", "rows_loaded": 1500, "timestamp": AT}
    staged = store.spark.read.parquet(str(tmp_path / "staging_silver.work_order"))
    assert {t for _, t in staged.dtypes} == {"string"} and staged.columns[-2:] == list(replica.AUDIT)
    again = json.loads(replica.load_staging(store, "silver", "work_order", sink, AT, limit=10))
    assert again["rows_loaded"] == 10
    assert store.spark.read.parquet(str(tmp_path / "staging_silver.work_order")).count() == 10
    assert sorted(r["rows_loaded"] for r in as_dicts(store("replica.load_audit"))) == [10, 1500]


def test_errors_are_raised(store, tmp_path):
    def broken(df, table):
        raise OSError("database is away")

    with pytest.raises(OSError):
        replica.load_staging(store, "silver", "asset", broken, AT)


def test_every_model_builds_over_its_staged_table(store):
    tables = BoundTables(store.spark, TESTDATA)
    for name, (source, columns) in replica.MODELS.items():
        model = replica.model(name, replica.staged(tables(source), AT))
        assert model.columns == [c[1] if isinstance(c, tuple) else c for c in columns]
    assert len(replica.MODELS) == 16
    assert "silver_s5000f_functional_failure" not in replica.MODELS


def test_models_materialise_as_tables_or_views(store, monkeypatch):
    tables = BoundTables(store.spark, TESTDATA)
    monkeypatch.setattr(replica, "MODELS", {k: v for k, v in replica.MODELS.items() if k.startswith("silver_asset")})
    stage = lambda source: replica.staged(tables(source), AT)
    assert replica.build_models(store, stage) == {"silver_asset": 150}
    assert store("replica.silver_asset").count() == 150
    assert replica.build_models(store, stage, materialise="view") == {}
    assert store.spark.table("silver_asset").count() == 150
    store.spark.catalog.dropTempView("silver_asset")


def test_source_version(store):
    df = store.spark.createDataFrame([("v1",), ("v2",), (None,)], "version string")
    assert as_dicts(replica.source_version(df, "version")) == [{"source_version": "v2"}]
    assert as_dicts(replica.source_version(df.limit(0), "version")) == [{"source_version": "unknown"}]
    assert as_dicts(replica.stamp_version(df.limit(1), None))[0]["source_version"] == "unknown"


def load(store, tmp_path, rows, at):
    store.publish("silver.work_order", rows)
    return load_changes(store, "silver", "work_order", str(tmp_path), at)


def content(store, tmp_path):
    table = store.spark.read.parquet(str(tmp_path / "staging_silver.work_order" / "table" / "rows")).filter("__live")
    return {(r["id"], r["status"], r["dbt_created_at"], r["dbt_updated_at"]) for r in table.collect()}


def test_a_second_load_moves_what_changed(store, tmp_path):
    orders = BoundTables(store.spark, TESTDATA)("silver.work_order")
    assert load(store, tmp_path, orders, "t1") == {"mode": "full", "keys": 1500, "slices": 1}
    assert load_changes(store, "silver", "work_order", str(tmp_path), "t2")["mode"] == "unchanged"
    first, gone, changed = (r["id"] for r in orders.select("id").orderBy("id").limit(3).collect())
    status = F.when(F.col("id") == changed, F.lit(None)).otherwise(F.col("status"))
    newer = orders.filter(F.col("id") != gone).withColumn("status", status)
    newer = newer.unionByName(orders.filter(F.col("id") == first).withColumn("id", F.lit("new")))
    assert load(store, tmp_path, newer, "t3") == {"mode": "changes", "keys": 3, "slices": 1}
    rows = content(store, tmp_path)
    assert {r[0] for r in rows} == {r["id"] for r in newer.select("id").collect()} and len(rows) == 1500
    assert {r for r in rows if r[3] == "t3"} == {(changed, None, "t1", "t3"), *(r for r in rows if r[0] == "new")}
    assert {r[2] for r in rows if r[0] == "new"} == {"t3"}
    assert [r["rows_loaded"] for r in as_dicts(store("replica.load_audit").orderBy("timestamp"))] == [1500, 0, 3]


def test_changes_after_a_load_that_died_and_after_a_version_that_went(store, tmp_path, monkeypatch):
    rows = lambda *pairs: store.spark.createDataFrame(pairs, "id string, status string")
    stamp = ReplicaTable._stamp
    load(store, tmp_path, rows(("a", "1"), ("b", "1"), (None, "1")), "t1")

    def dies(self, version, state):
        if state == "applied":
            raise OSError("executor lost")
        stamp(self, version, state)

    monkeypatch.setattr(ReplicaTable, "_stamp", dies)
    with pytest.raises(OSError):
        load(store, tmp_path, rows(("a", "2"), ("b", "1"), (None, "2")), "t2")
    monkeypatch.setattr(ReplicaTable, "_stamp", stamp)
    store.keep_versions = 3
    # a is as in the first version again: only a comparison with the one that was begun sees it
    assert load(store, tmp_path, rows(("a", "1"), ("b", "1"), ("c", "1"), ("c", "1")), "t3")["mode"] == "changes"
    assert {r[:2] for r in content(store, tmp_path)} == {("a", "1"), ("b", "1"), ("c", "1")}
    store.keep_versions = 1
    store.publish("silver.work_order", rows(("x", "1")))
    assert load(store, tmp_path, rows(("b", "1")), "t4")["mode"] == "full"
    assert content(store, tmp_path) == {("b", "1", "t1", "t4")}
    store.keep_versions = 2
    assert load(store, tmp_path, rows(("b", "1")).limit(0), "t5")["keys"] == 1
    assert content(store, tmp_path) == set()


def test_changed_keys_count_repeats_and_nulls(store):
    rows = lambda *pairs: store.spark.createDataFrame(pairs, "id string, v string")
    before = rows(("a", None), ("b", "1"), ("b", "1"), ("c", "1"), (None, "1"))
    after = rows(("a", None), ("b", "1"), ("c", None), (None, "2"), ("d", None))
    assert {r[0] for r in changed_keys(before, after, ["id"]).collect()} == {"b", "c", None, "d"}
    assert changed_keys(after, after, ["id"]).isEmpty()
