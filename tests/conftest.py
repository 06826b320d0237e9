import itertools
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from maintlake.session import local_session  # noqa: E402
from maintlake.sources.tables import TableStore  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"
_names = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "8",
        shuffle_partitions=4,
        app="tests",
        settings={
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    """A store over an emptied catalog."""
    for namespace in ("gold", "silver_s5000f", "silver", "bronze", "replica"):
        spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")
    return TableStore(spark)


def document(entity="Asset", op="c", ts="2024-01-15T10:00:00+00:00", pk="a001", after=None, before=None, system="eam"):
    """One CDC document as JSON text."""
    return json.dumps(
        {
            "entity": entity,
            "op": op,
            "event_ts": ts,
            "pk": {"id": pk},
            "before": before or {},
            "after": {} if op == "d" and after is None else (after if after is not None else {"id": pk}),
            "source": {"system": system, "version": "1.0"},
        }
    )


def asset_image(pk="a001", status="operational", **changes):
    image = {
        "id": pk,
        "name": "Pump-1",
        "asset_type": "pump",
        "location": "Plant A",
        "status": status,
        "install_date": "2024-01-01",
        "updated_at": "2024-01-15T10:00:00+00:00",
    }
    return {**image, **changes}


BRONZE_DDL = (
    "pk_id string, op string, event_ts string, payload_json string, source_system string, entity string, "
    "event_date string"
)


def event(pk="a001", op="c", ts="2024-01-15T10:00:00+00:00", after=None, payload=None):
    """One Bronze row."""
    if payload is None:
        payload = document(op=op, ts=ts, pk=pk, after=after)
    return (pk, op, ts, payload, "eam", "Asset", (ts or "")[:10])


@pytest.fixture
def bronze(spark):
    return lambda *events: spark.createDataFrame(list(events), BRONZE_DDL)


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def plan_of(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
