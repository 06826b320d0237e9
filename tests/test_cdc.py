from hypothesis import HealthCheck, given, settings, strategies as st

from conftest import as_dicts, asset_image, event
from maintlake.operators.cdc import current_rows, latest_events, merge_state, resolve_cdc
from maintlake.schemas import AFTER, silver_schema

ASSET = AFTER["asset"]
T = "2024-01-15T{:02d}:00:00+00:00".format


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_create(bronze):
    result = as_dicts(resolve_cdc(bronze(event(after=asset_image())), None, ASSET))
    assert len(result) == 1
    assert result[0]["id"] == "a001" and result[0]["status"] == "operational"
    assert result[0]["last_op"] == "c" and result[0]["source_id"] == "a001"


def test_columns_and_types_are_the_declared_ones(bronze):
    df = resolve_cdc(bronze(event(after=asset_image())), None, ASSET)
    assert df.schema.names == silver_schema(ASSET).names
    assert [f.dataType for f in df.schema] == [f.dataType for f in silver_schema(ASSET)]


def test_latest_update_wins(bronze):
    df = bronze(event(ts=T(10), after=asset_image()), event(op="u", ts=T(12), after=asset_image(status="degraded")))
    (row,) = as_dicts(resolve_cdc(df, None, ASSET))
    assert row["status"] == "degraded" and row["last_op"] == "u" and row["last_event_ts"] == T(12)


def test_delete_removes_the_row(bronze):
    assert resolve_cdc(bronze(event(ts=T(10), after=asset_image()), event(op="d", ts=T(14))), None, ASSET).isEmpty()


def test_rerun_over_its_own_result_changes_nothing(bronze):
    df = bronze(event(after=asset_image()), event(pk="a002", after=asset_image("a002")))
    once = resolve_cdc(df, None, ASSET)
    assert rows(resolve_cdc(df, once, ASSET)) == rows(once)


def test_keys_are_independent(bronze):
    df = bronze(event(after=asset_image()), event(pk="a002", after=asset_image("a002")))
    assert {r["id"] for r in as_dicts(resolve_cdc(df, None, ASSET))} == {"a001", "a002"}


def test_batch_replaces_only_its_own_keys(bronze):
    existing = resolve_cdc(bronze(event(after=asset_image()), event(pk="a002", after=asset_image("a002"))), None, ASSET)
    batch = bronze(event(op="u", ts=T(11), after=asset_image(status="failed")))
    result = {r["id"]: r["status"] for r in as_dicts(resolve_cdc(batch, existing, ASSET))}
    assert result == {"a001": "failed", "a002": "operational"}


def test_batch_of_deletes_only_removes_existing_rows(bronze):
    existing = resolve_cdc(bronze(event(after=asset_image()), event(pk="a002", after=asset_image("a002"))), None, ASSET)
    result = as_dicts(resolve_cdc(bronze(event(op="d", ts=T(14))), existing, ASSET))
    assert [r["id"] for r in result] == ["a002"]


def test_empty_batch_leaves_existing_rows(bronze, spark):
    existing = resolve_cdc(bronze(event(after=asset_image())), None, ASSET)
    assert rows(resolve_cdc(bronze(event()).limit(0), existing, ASSET)) == rows(existing)


def test_existing_rows_without_key_drop_out(bronze):
    existing = resolve_cdc(bronze(event(after=asset_image()), (None, *event(after=asset_image("x"))[1:])), None, ASSET)
    assert existing.count() == 2
    batch = bronze(event(pk="a009", after=asset_image("a009")))
    assert sorted(r["source_id"] for r in as_dicts(resolve_cdc(batch, existing, ASSET))) == ["a001", "a009"]


def test_existing_columns_the_batch_lacks_are_kept(bronze):
    existing = resolve_cdc(bronze(event(after=asset_image())), None, ASSET).selectExpr("*", "1 AS extra")
    result = resolve_cdc(bronze(event(pk="a002", after=asset_image("a002"))), existing, ASSET)
    assert {(r["id"], r["extra"]) for r in as_dicts(result)} == {("a001", 1), ("a002", None)}


def test_null_time_loses_and_null_operation_drops_out(bronze):
    late = event(op="u", ts=None, payload=event(after=asset_image(status="failed"))[3])
    df = bronze(event(ts=T(10), after=asset_image()), late, event(pk="a002", op=None, after=asset_image("a002")))
    (row,) = as_dicts(resolve_cdc(df, None, ASSET))
    assert row["id"] == "a001" and row["status"] == "operational"


def test_equal_times_are_decided_by_operation(bronze):
    df = bronze(event(op="u", after=asset_image(status="failed")), event(after=asset_image()))
    assert as_dicts(resolve_cdc(df, None, ASSET))[0]["status"] == "failed"
    assert resolve_cdc(bronze(event(op="d"), event(op="u", after=asset_image())), None, ASSET).isEmpty()


def test_equal_times_are_decided_by_the_log_offset_first(bronze, spark):
    first, second = event(op="u", after=asset_image(status="failed")), event(after=asset_image())
    df = bronze(first, second).selectExpr("*", "CASE op WHEN 'u' THEN 1 ELSE 2 END AS offset")
    assert as_dicts(resolve_cdc(df, None, ASSET))[0]["status"] == "operational"


def test_times_of_different_offsets_need_normalising(bronze):
    noon_utc = event(op="c", ts="2024-01-15T12:00:00+00:00", after=asset_image())
    later = event(op="u", ts="2024-01-15T11:30:00-05:00", after=asset_image(status="failed"))
    df = bronze(noon_utc, later)
    assert as_dicts(resolve_cdc(df, None, ASSET))[0]["status"] == "operational"
    assert as_dicts(resolve_cdc(df, None, ASSET, normalise_ts=True))[0]["status"] == "failed"


def test_missing_or_unreadable_images_give_null_columns(bronze):
    cases = {
        "a1": '{"after": null}', "a2": "{}", "a3": "not json", "a4": '{"after": {"id": "a4", "status": {"x": 1}}}'
    }
    df = bronze(*[event(pk=k, payload=p) for k, p in cases.items()])
    result = {r["source_id"]: (r["id"], r["name"]) for r in as_dicts(resolve_cdc(df, None, ASSET))}
    assert result == {"a1": (None, None), "a2": (None, None), "a3": (None, None), "a4": ("a4", None)}


def test_late_event_neither_overwrites_nor_revives(bronze):
    state = merge_state(
        None, bronze(event(op="u", ts=T(12), after=asset_image(status="failed")), event(pk="a002", op="d", ts=T(12)))
    )
    late = bronze(event(ts=T(10), after=asset_image()), event(pk="a002", op="u", ts=T(11), after=asset_image("a002")))
    result = as_dicts(current_rows(merge_state(state, late), ASSET))
    assert [(r["id"], r["status"]) for r in result] == [("a001", "failed")]


histories = st.lists(
    st.tuples(
        st.sampled_from(["k1", "k2", "k3"]),
        st.sampled_from(["c", "u", "d"]),
        st.integers(0, 20),
        st.sampled_from(["operational", "degraded", "failed"]),
    ),
    min_size=1,
    max_size=15,
    unique_by=lambda e: (e[0], e[2]),
)
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def to_events(history):
    return [event(k, op, T(h), after=asset_image(k, status)) for k, op, h, status in history]


def model(history):
    """Current state by a plain loop."""
    state = {}
    for key, op, hour, status in sorted(history, key=lambda e: e[2]):
        state[key] = None if op == "d" else (key, status, op, T(hour))
    return sorted(s for s in state.values() if s)


def found(df):
    return sorted((r["id"], r["status"], r["last_op"], r["last_event_ts"]) for r in as_dicts(df))


@few
@given(history=histories, data=st.data())
def test_resolution_equals_replaying_in_any_input_order(bronze, history, data):
    shuffled = data.draw(st.permutations(to_events(history)))
    assert found(resolve_cdc(bronze(*shuffled), None, ASSET)) == model(history)


@few
@given(history=histories, cut=st.integers(0, 20))
def test_two_batches_in_time_order_equal_one(bronze, history, cut):
    early, late = [e for e in history if e[2] < cut], [e for e in history if e[2] >= cut]
    first = resolve_cdc(bronze(*to_events(early)), None, ASSET)
    assert found(resolve_cdc(bronze(*to_events(late)), first, ASSET)) == model(history)


@few
@given(history=histories, data=st.data())
def test_state_table_takes_batches_in_any_order_and_again(bronze, history, data):
    events = data.draw(st.permutations(to_events(history)))
    cut = data.draw(st.integers(0, len(events)))
    state = merge_state(merge_state(None, bronze(*events[:cut])), bronze(*events[cut:]))
    state = merge_state(state, bronze(*events[:cut]))
    assert found(current_rows(state, ASSET)) == model(history)


def test_latest_events_keep_tombstones(bronze):
    assert [r["op"] for r in as_dicts(latest_events(bronze(event(ts=T(1)), event(op="d", ts=T(2)))))] == ["d"]


def test_key_whose_latest_event_has_no_operation_keeps_its_row(bronze):
    existing = resolve_cdc(bronze(event(ts=T(8), after=asset_image())), None, ASSET)
    batch = bronze(event(op="u", ts=T(9), after=asset_image(status="failed")), event(op=None, ts=T(10)))
    assert [r["id"] for r in as_dicts(resolve_cdc(batch, existing, ASSET))] == ["a001"]
