"""Intermediate results that survive a lost executor, and small helpers on columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Stands in for a null id: null ids sort last and count as one id.
NULL_ID = (1 << 63) - 1
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; its own only where that is unset and one process holds all executors."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="maintlake-llm-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def saved(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back, so that its lineage ends there.

    With ``by``, the files are laid out by the values of that column, so that one value's rows are read alone. The shuffle
    files of the write go when it ends, not when the driver happens to collect its garbage; the rows when the session's JVM
    ends, or with :func:`dropped`.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        (df.hint("rebalance", by) if by else df).write.option("compression", "zstd").parquet(path, partitionBy=by)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    rows = spark.read.schema(df.schema).parquet(path)
    rows.saved_at = path
    return rows


def dropped(*tables: DataFrame) -> None:
    """Delete the files of ``tables``, each as :func:`saved` returned it, that nothing still to be computed reads."""
    for rows in tables:
        spark = rows.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(rows.saved_at)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def unsent(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles it, however small Spark takes it to be.

    Compressed files, exploded lists and rows made in Arrow batches are larger than they are taken for, and a table that is
    sent to all executors passes through the driver.
    """
    return df.hint("merge")


#: Bytes of rows that go to a Python worker, or come back, at once.
BATCH_BYTES = 8 << 20


def in_small_batches(spark: SparkSession) -> None:
    """From now on, this session's Arrow batches hold at most ``BATCH_BYTES``; a smaller limit of its own stays.

    The default of 10,000 rows holds a batch of whole texts several times over, in the JVM and in the worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require(df: DataFrame, *columns: str) -> None:
    if absent := missing_columns(df, columns):
        raise ValueError(f"columns missing: {', '.join(absent)}")


def known_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
