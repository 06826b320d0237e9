from conftest import as_dicts, asset_image, document
from maintlake.operators.cdc import current_rows, latest_events, resolve_cdc
from maintlake.operators.envelope import parse_envelopes
from maintlake.schemas import AFTER
from maintlake.sources.feed import json_lines, json_lines_stream
from maintlake.streaming.current_state import maintain_state, state_table

T = "2024-01-15T{:02d}:00:00+00:00".format


def test_stream_equals_batch_over_late_and_deleted_keys(spark, tmp_path):
    feed, out, checkpoint = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "cp")
    feed.mkdir()
    batches = [
        [document(pk="a", op="u", after=asset_image("a", "failed"), ts=T(9)), document(pk="b", op="d", ts=T(9))],
        [document(pk="a", after=asset_image("a"), ts=T(8)), document(pk="b", op="u", after=asset_image("b"), ts=T(8))],
        [document(pk="c", after=asset_image("c"), ts=T(8)), document(pk="c", op="u", after=asset_image("c", "degraded"), ts=T(9))],
    ]
    for n, batch in enumerate(batches):
        (feed / f"{n}.json").write_text("\n".join(batch))
        stream = parse_envelopes(json_lines_stream(spark, str(feed), max_files_per_trigger=1))
        maintain_state(stream, state_table(spark, out, buckets=4), checkpoint)
    kept = state_table(spark, out).read()
    assert kept.count() == 3 and kept.select("pk_id").distinct().count() == 3
    found = as_dicts(current_rows(kept, AFTER["asset"]).orderBy("id"))
    assert [(r["id"], r["status"]) for r in found] == [("a", "failed"), ("c", "degraded")]
    whole = resolve_cdc(parse_envelopes(json_lines(spark, str(feed))), None, AFTER["asset"])
    assert as_dicts(whole.orderBy("id")) == found
    assert latest_events(parse_envelopes(json_lines(spark, str(feed)))).count() == 3


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    import __spark_entry__

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    run = __spark_entry__.queries()["stream_latest_state"]
    parts, single = (sorted(map(repr, run(spark, d).collect())) for d in (str(tmp_path), "/root/testdata/sf0.001"))
    assert parts and parts == single
