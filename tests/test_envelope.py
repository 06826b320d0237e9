import json

import pytest

from conftest import as_dicts, asset_image, document
from maintlake.operators.envelope import bronze_columns, envelope_report, feed_messages, parse_envelopes, snapshot_diff
from maintlake.schemas import BRONZE, ENTITY_TABLES, ENTITY_TOPICS


def raw(spark, *documents):
    return spark.createDataFrame([(d,) for d in documents], "value string")


def test_envelope_becomes_the_bronze_columns_and_keeps_the_text(spark):
    text = document(after=asset_image())
    parsed = parse_envelopes(raw(spark, text))
    (row,) = as_dicts(bronze_columns(parsed))
    assert row == {
        "entity": "Asset", "op": "c", "event_ts": "2024-01-15T10:00:00+00:00", "pk_id": "a001", "payload_json": text,
        "event_date": "2024-01-15", "source_system": "eam",
    }
    assert bronze_columns(parsed).schema.names == BRONZE.names


def test_binary_messages_parse_as_text(spark):
    df = raw(spark, document()).selectExpr("CAST(value AS BINARY) AS value")
    assert as_dicts(parse_envelopes(df))[0]["payload_json"] == document()


@pytest.mark.parametrize("entity, table", ENTITY_TABLES.items())
def test_entities_are_routed(spark, entity, table):
    assert as_dicts(parse_envelopes(raw(spark, document(entity))))[0]["route"] == table


@pytest.mark.parametrize(
    "text, reason",
    [
        ("{not json", "malformed_json"),
        (document(ts="not a time"), "bad_event_time"),
        (document(ts="2024-02-30T00:00:00+00:00"), "bad_event_time"),
        (document(ts="12:00"), "bad_event_time"),
        ("[1, 2]", "malformed_json"),
        ("", "malformed_json"),
        (document(entity="Vehicle"), "unknown_entity"),
        (json.dumps({"entity": "Asset", "op": "c"}), "missing_field"),
        (document(pk=None), "missing_field"),
    ],
)
def test_bad_documents_are_quarantined_with_a_reason(spark, text, reason):
    (row,) = as_dicts(parse_envelopes(raw(spark, text)))
    assert (row["route"], row["reject_reason"], row["payload_json"]) == ("quarantine", reason, text)


def test_report_counts_structural_violations(spark):
    (row,) = as_dicts(envelope_report(raw(spark, document(), document(op="x"), document(pk=None), "{oops")))
    assert row == {
        "events": 4, "malformed": 1, "missing_entity": 1, "missing_event_ts": 1, "missing_pk": 2, "missing_source": 1,
        "bad_op": 2,
    }


def test_snapshot_diff_gives_create_update_delete(spark):
    prev = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", None)], "id string, status string")
    curr = spark.createDataFrame([("b", "x"), ("c", "y"), ("d", None), ("e", "x")], "id string, status string")
    feed = snapshot_diff(prev, curr, "id", "Asset", "2024-02-01T00:00:00+00:00")
    found = {r["pk_id"]: (r["op"], json.loads(r["payload_json"])) for r in as_dicts(feed)}
    assert {k: op for k, (op, _) in found.items()} == {"a": "d", "c": "u", "e": "c"}
    assert found["a"][1]["after"] == {} and found["a"][1]["before"] == {"id": "a", "status": "x"}
    assert found["e"][1]["before"] == {} and found["e"][1]["after"] == {"id": "e", "status": "x"}
    assert found["c"][1]["before"]["status"] == "x" and found["c"][1]["after"]["status"] == "y"
    assert set(found["c"][1]) == {"entity", "op", "event_ts", "pk", "before", "after", "source"}
    assert as_dicts(parse_envelopes(feed.selectExpr("payload_json AS value")))[0]["route"] == "asset"


def test_feed_messages_go_to_the_topic_of_the_entity(spark):
    bronze = parse_envelopes(raw(spark, document("WorkOrder", pk="w1", after={"id": "w1"})))
    assert as_dicts(feed_messages(bronze)) == [
        {"topic": ENTITY_TOPICS["WorkOrder"], "key": "w1", "value": document("WorkOrder", pk="w1", after={"id": "w1"})}
    ]
