from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import as_dicts
from maintlake.functions import measures, timestamps
from maintlake.session import SQL_SETTINGS, apply_settings, shared_dir


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()], F.lit(1).alias("one"))
    return row.select(column.alias("v")).first()["v"]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    """Results must not depend on the session time zone."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_text_of_a_wall_clock(spark, zone):
    stamp = F.lit("2024-01-05 03:04:05.6").cast("timestamp_ntz")
    assert value(spark, timestamps.iso_utc(stamp)) == "2024-01-05T03:04:05.600000+00:00"


@pytest.mark.parametrize(
    "start, end, minutes",
    [
        ("2024-01-01T00:00:00+00:00", "2024-01-01T01:30:00+00:00", 90.0),
        ("2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00.500000+00:00", 0.5 / 60),
        ("2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00-05:00", 300.0),
        ("2024-01-01T00:00:00+00:00", "", None),
        ("", "2024-01-01T00:00:00+00:00", None),
        ("soon", "2024-01-01T00:00:00+00:00", None),
    ],
)
def test_minutes(spark, zone, start, end, minutes):
    found = value(spark, timestamps.minutes_between("a", "b"), a=start, b=end)
    assert found == (None if minutes is None else pytest.approx(minutes))


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2024-01-01T23:59:59+00:00", "2024-01-02T00:00:00+00:00", 1),
        ("2024-01-01", "2024-03-01", 60),
        ("2024-01-01T00:00:00+00:00", "2024-01-01T23:59:59+00:00", 0),
        ("", "2024-01-01", None),
        ("garbage", "2024-01-01", None),
    ],
)
def test_days(spark, zone, start, end, days):
    assert value(spark, timestamps.days_between("a", "b"), a=start, b=end) == days


def test_run_stamp_is_utc_iso():
    assert datetime.fromisoformat(timestamps.utc_now_iso()).tzinfo == timezone.utc


def test_measures_guard_their_divisions(spark):
    assert value(spark, measures.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, measures.ratio(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, measures.percent(F.lit(1), F.lit(8))) == 12.5
    assert value(spark, measures.mtbf_proxy_hours(F.lit(2), F.lit(4))) == 4380.0
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "c string")
    assert as_dicts(df.agg(measures.completeness("c").alias("p"), measures.total(F.lit(None).cast("long")).alias("t"))) == [
        {"p": 50.0, "t": 0}
    ]
    assert as_dicts(df.limit(0).agg(measures.completeness("c").alias("p"))) == [{"p": None}]


def test_settings_are_applied(spark):
    apply_settings(spark)
    assert all(spark.conf.get(k) == v for k, v in SQL_SETTINGS.items())


def test_scratch_data_goes_to_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def fake_session(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda folder: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_dir(fake_session("spark://host:7077"))
    assert shared_dir(fake_session("local[2]")).startswith("/")
