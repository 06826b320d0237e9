"""Bucketed tables and the incremental refresh: what a load doesn't touch is neither read nor written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import asset_image, document, plan_of
from maintlake.operators.cdc import latest_events
from maintlake.plans import incremental
from maintlake.plans.incremental import NODES, STAMPS, IncrementalRefresh, StoreLog, refresh_incremental
from maintlake.plans.lakehouse import Lakehouse
from maintlake.plans.refresh import refresh_all
from maintlake.schemas import LINEAGE, TABLES, text_fields
from maintlake.sources.bucketed import BucketedTable, fold_events
from maintlake.streaming.ingest import ingest_batch

T = "2024-01-{:02d}T{:02d}:{:02d}:00+00:00".format
STAMP = "2024-03-01T00:00:00+00:00"


def files(path):
    """Data files below a folder by name, with the time they were written."""
    found = {}
    for folder, _, names in os.walk(path):
        found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def rewritten(path, before):
    """Files below a folder that are new, gone or changed."""
    return {f for f, _ in set(files(path).items()) ^ set(before.items())}


def opened_files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def sorted_rows(df, without=STAMPS):
    return sorted(repr(r) for r in df.drop(*without).collect())


# --- bucketed tables --------------------------------------------------------------------------------


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v string")


def test_a_change_rewrites_its_buckets_only(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), text_fields("k", "v"), ("k",), 8)
    assert table.read().isEmpty() and table.read([]).isEmpty()
    rows = pairs(spark, *[(f"k{i}", str(i)) for i in range(40)], (None, "null"))
    table.overwrite(rows, table.touched(rows))
    before = files(tmp_path / "t" / "rows")
    new = pairs(spark, ("k3", "new"))
    table.replace(new.select("k"), new, table.touched(new))
    changed = {f.split("__bucket=")[1].split("/")[0] for f in rewritten(tmp_path / "t" / "rows", before)}
    assert changed == {str(table.touched(new)[0])}
    assert sorted_rows(table.read()) == sorted(repr(r) for r in [*pairs(spark, ("k3", "new")).collect(), *rows.filter("k <> 'k3' OR k IS NULL").collect()])
    assert table.read(table.touched(new)).filter("k = 'k3'").count() == 1
    some = table.read(table.touched(new))
    assert len(opened_files(some)) < len(opened_files(table.read()))
    partitions = plan_of(some).split("PartitionFilters:")[1].split("\n")[0]
    assert "__bucket" in partitions


def test_a_bucket_can_lose_all_its_rows(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), text_fields("k", "v"), ("k",), 3)
    rows = pairs(spark, *[(f"k{i}", str(i)) for i in range(9)], (None, "null"))
    table.overwrite(rows, [0, 1, 2])
    keys = rows.select("k")
    table.replace(keys, rows.limit(0), [0, 1, 2])
    assert table.read().isEmpty()
    again = BucketedTable(spark, str(tmp_path / "t"), text_fields("k", "v"), ("k",), 99)
    assert again.buckets == 3  # a table keeps its layout


def test_folding_batches_in_any_order_and_again(spark, tmp_path):
    rng = random.Random(5)
    ddl = "pk_id string, op string, event_ts string, payload_json string, source_system string, offset long"
    events = [(f"k{rng.randrange(30)}", rng.choice("cuud"), T(1 + rng.randrange(9), 0, 0), f"p{n}", "s", n) for n in range(300)]
    batches = [events[i::5] for i in range(5)]
    order = [*range(5), 2, 0]
    rng.shuffle(order)
    state = BucketedTable(spark, str(tmp_path / "s"), spark.createDataFrame([], ddl).schema, ("pk_id",), 4)
    for i in [*order, *range(5)]:
        fold_events(state, spark.createDataFrame(batches[i], ddl))
    assert sorted_rows(state.read()) == sorted_rows(latest_events(spark.createDataFrame(events, ddl)).select(*state.schema.names))
    before = files(tmp_path / "s")
    assert fold_events(state, spark.createDataFrame([("k1", "u", T(20, 0, 0), "new", "s", 1000)], ddl)) == 1
    assert len({f.split("__bucket=")[1][0] for f in rewritten(tmp_path / "s", before)}) == 1


# --- incremental refresh ------------------------------------------------------------------------------


def random_load(rng, day, n):
    """Documents of all entities: moved, re-prioritised, deleted and late rows among them."""
    out = []
    for _ in range(n):
        ts = T(max(1, day - rng.choice([0, 0, 0, 2])), rng.randrange(24), rng.randrange(60))
        a, r, o, m = (f"{x}{rng.randrange(k)}" for x, k in (("a", 6), ("r", 8), ("o", 10), ("m", 16)))
        entity, pk, after = rng.choice(
            [
                ("Asset", a, asset_image(a, rng.choice(["operational", "degraded", "failed"]), asset_type=rng.choice(["pump", "fan", None]))),
                ("WorkRequest", r, {"id": r, "asset_id": rng.choice([a, None]), "priority": rng.choice(["low", "high"]), "status": "open"}),
                ("WorkOrder", o, {
                    "id": o, "work_request_id": rng.choice([r, None, "gone"]), "asset_id": a,
                    "status": rng.choice(["planned", "in_progress", "completed"]), "planned_start": rng.choice(["", T(day, 1, 1)]),
                    "actual_start": rng.choice(["", T(day, 2, 2)]), "actual_end": rng.choice(["", T(day, 3, 3)]),
                }),
                ("MaintenanceAction", m, {"id": m, "work_order_id": rng.choice([o, None]), "status": rng.choice(["pending", "completed"])}),
            ]
        )
        out.append(document(entity, rng.choice(["c", "u", "u", "d"]) if rng.random() < 0.6 else "u", ts, pk, after))
    return out


def ingest(store, load, documents):
    ingest_batch(store, store.spark.createDataFrame([(d, n) for n, d in enumerate(documents)], "value string, n long").select("value"), load)


def assert_equals_rebuild(store, engine, stamp=STAMP):
    refresh_all(store, stamp)
    for name in LINEAGE:
        assert sorted_rows(engine(name)) == sorted_rows(store(name).select(*TABLES[name].names)), name


def test_loads_lead_where_a_full_rebuild_leads(store, tmp_path, monkeypatch):
    rng = random.Random(11)
    engine = IncrementalRefresh(store.spark, str(tmp_path), StoreLog(store), buckets=3)
    assert engine.refresh(STAMP) == {}
    ingest(store, "l1", random_load(rng, 5, 60))
    engine = IncrementalRefresh(store.spark, str(tmp_path), StoreLog(store), buckets=3)
    assert engine.refresh(STAMP)["silver.work_order"] > 0
    assert_equals_rebuild(store, engine)
    ingest(store, "l2", random_load(rng, 9, 12))
    # the second refresh dies in the middle; the third load comes before it is tried again
    calls = []
    replace = BucketedTable.replace

    def failing(self, *args):
        calls.append(self.path)
        if len(calls) == 9:
            raise RuntimeError("lost")
        replace(self, *args)

    monkeypatch.setattr(BucketedTable, "replace", failing)
    with pytest.raises(RuntimeError):
        engine.refresh(STAMP)
    monkeypatch.setattr(BucketedTable, "replace", replace)
    ingest(store, "l3", random_load(rng, 7, 8))
    refresh_incremental(store, str(tmp_path), "2024-03-02T00:00:00+00:00")
    assert_equals_rebuild(store, engine, "2024-03-02T00:00:00+00:00")
    noted = engine.ledger()
    assert {r.load_id for r in noted.filter("event = 'begun'").collect()} >= {"l1", "l2", "l3"}
    assert noted.filter("event = 'done'").count() == noted.select("run").distinct().count()
    lake = Lakehouse(store.spark, engine, engine.names)
    assert lake.query(table="gold.work_order_backlog", limit=3).count() > 0


def test_a_load_reads_itself_and_writes_what_it_touches(store, tmp_path, monkeypatch):
    spark, targets = store.spark, ["gold.asset_maintenance_summary"]
    orders = [document("WorkOrder", "c", T(3, 1, i % 60), f"o{i}", {"id": f"o{i}", "asset_id": f"a{i % 20}", "status": "planned"}) for i in range(60)]
    ingest(store, "l1", orders)
    IncrementalRefresh(spark, str(tmp_path), StoreLog(store), 8, targets).refresh(STAMP)
    ingest(store, "l2", [document("MaintenanceAction", "c", T(4, 1, 1), "m1", {"id": "m1", "work_order_id": "o7", "status": "completed"})])
    engine = IncrementalRefresh(spark, str(tmp_path), StoreLog(store), 8, targets)
    before = files(tmp_path / "tables")
    opened = []
    events = StoreLog.events
    monkeypatch.setattr(incremental.FrameLog, "events", lambda self, e, loads: opened.extend(opened_files(events(self, e, loads))) or events(self, e, loads))
    changed = engine.refresh(STAMP)
    assert opened and all("load_id=l2" in f for f in opened)
    assert {t: n for t, n in changed.items() if n} == {
        "state.maintenance_action": 1, "silver.maintenance_action": 1, "work.order_facts": 2, "work.order_facts_of_asset": 2,
        "gold.asset_maintenance_summary": 2,
    }
    written = {f.split("/tables/")[1].split("/rows/")[0] + f.split("__bucket=")[1].split("/")[0] for f in files(tmp_path / "tables") if f not in before and "/rows/" in f}
    assert len(written) == 5  # one bucket a table
    row = engine("gold.asset_maintenance_summary").filter("asset_id = 'a7'").first()
    assert (row.work_order_count, row.completed_actions_count) == (3, 1)
    assert engine.refresh(STAMP) == {}


def test_every_declared_table_has_its_node():
    assert set(LINEAGE) <= set(NODES)
    for name, node in NODES.items():
        place = list(NODES).index(name)
        assert all(list(NODES).index(s) < place for s in node.sources)
        assert name in TABLES or node.columns is not None
