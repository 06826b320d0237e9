"""Session settings the jobs are designed for, and the folder they may write scratch data to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Only SQL settings: sizes of executors, shuffle partitions and the like belong to the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot asset or work order is split even when the aggregation above the join then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state keeps one row per key ever seen; RocksDB holds it outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL settings above on an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "maintlake", settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SQL_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one given to ``setCheckpointDir``.

    A temporary folder is made, and set for the session, only for local masters, where driver and executors are one
    process; a cluster without either is an error, because executors could not read what another one wrote.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="maintlake-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")
