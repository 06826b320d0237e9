"""Replica tables kept up to date by changes: a load moves the rows of the keys that differ from the stamped version.

A replica table is text in hash slices of its key (see ``sources.bucketed``). It is stamped with the version of the source
it equals. A load compares that version with the current one in a single aggregation over whole rows, so equality is
exact, writes the differing keys down and replaces these keys' rows in the slices that hold them.

A load is begun, applied and stamped. If one dies in between, the next load also compares the version that was begun, as
its rows may be there in part. If a version it needs isn't kept any more, every slice is written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from maintlake.schemas import PRIMARY_KEYS
from maintlake.sources.bucketed import BucketedTable, folder_exists, matching
from maintlake.sources.replica import AUDIT, record_load, stamp_version, staged
from maintlake.sources.tables import TableStore

SLICE_BYTES = 256 << 20
_STAMPS = "number long, version string, state string"


def slices_for(df: DataFrame, slice_bytes: int = SLICE_BYTES) -> int:
    """Slices for a stored table, by the bytes of its files as the session measures them."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, -(-size // slice_bytes))


def changed_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys whose rows, repeated ones counted, aren't the same in both frames; null is a value like others."""
    sides = before.withColumn("__side", F.lit(-1)).unionByName(after.withColumn("__side", F.lit(1)))
    uneven = sides.groupBy(*after.columns).agg(F.sum("__side").alias("__net")).filter("__net <> 0")
    return uneven.select(*keys).distinct()


class ReplicaTable:
    """One replicated table under ``path``; ``slices`` counts for a table that doesn't exist yet."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str], keys: Sequence[str], slices: int):
        self.spark, self.path, self.columns, self.keys = spark, path.rstrip("/"), tuple(columns), tuple(keys)
        stored = (*columns, "source_version", *AUDIT)
        schema = StructType([StructField(c, StringType()) for c in stored])
        self.table = BucketedTable(spark, f"{self.path}/table", schema, self.keys, slices)

    def read(self) -> DataFrame:
        return self.table.read()

    def stamps(self) -> tuple[str | None, list[str]]:
        """The version the table equals (None: none yet) and those that loads have begun since."""
        if not folder_exists(self.spark, f"{self.path}/stamps"):
            return None, []
        # two rows a load
        rows = self.spark.read.schema(_STAMPS).parquet(f"{self.path}/stamps").orderBy("number").collect()
        applied, begun = None, []
        for row in rows:
            if row["state"] == "applied":
                applied, begun = row["version"], []
            elif row["version"] not in begun:
                begun.append(row["version"])
        return applied, begun

    def _stamp(self, version: str, state: str) -> None:
        folder = f"{self.path}/stamps"
        number = self.spark.read.schema(_STAMPS).parquet(folder).count() if folder_exists(self.spark, folder) else 0
        row = self.spark.createDataFrame([(number, version, state)], _STAMPS)
        row.coalesce(1).write.mode("append").parquet(folder)

    def load(self, after: DataFrame, version: str, load_ts: str, as_of: Callable[[str], DataFrame | None]) -> dict:
        """Make the table equal ``after``, which is ``version`` of the source; ``as_of`` reads kept versions, else None.

        Rows of keys that didn't change keep their stamps; changed ones keep the time their key was first loaded.
        Returns what was done: mode (unchanged, changes or full), keys moved and slices written.
        """
        applied, begun = self.stamps()
        if version == applied and not begun:
            return {"mode": "unchanged", "keys": 0, "slices": 0}
        after = self._text(after)
        known = [as_of(v) for v in ([applied] if applied else []) + begun]
        whole = applied is None or any(k is None for k in known)
        if whole:
            moved = None
            slices = list(range(self.table.buckets))
            keys = after.select(*self.keys).distinct().count()
            rows = after
        else:
            found = [changed_keys(self._text(k), after, self.keys) for k in known]
            # a version that was begun and given up may come back, so the place is the version's and is written anew
            place = f"{self.path}/moving/{sha256(version.encode()).hexdigest()}"
            reduce(DataFrame.unionByName, found).distinct().write.mode("overwrite").parquet(place)
            moved = self.spark.read.schema(after.select(*self.keys).schema).parquet(place)
            slices, keys = self.table.touched(moved), moved.count()
            rows = matching(after, moved)
        self._stamp(version, "begun")
        rows = self._with_first_load(staged(stamp_version(rows, version), load_ts), slices)
        if whole:
            self.table.overwrite(rows, slices)
        else:
            self.table.replace(moved, rows, slices)
        self._stamp(version, "applied")
        return {"mode": "full" if whole else "changes", "keys": keys, "slices": len(slices)}

    def _text(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) for c in self.columns])

    def _with_first_load(self, rows: DataFrame, slices: Sequence[int]) -> DataFrame:
        created, _ = AUDIT
        old = self.table.read(slices).groupBy(*self.keys).agg(F.min(created).alias("__first"))
        old = old.select(*[F.col(k).alias(f"__{k}") for k in self.keys], "__first")
        same = [rows[k].eqNullSafe(old[f"__{k}"]) for k in self.keys]
        joined = rows.join(old, reduce(lambda a, b: a & b, same), "left")
        return joined.withColumn(created, F.coalesce("__first", created)).select(*rows.columns)


def load_changes(
    store: TableStore, layer: str, table: str, root: str, load_ts: str, keys: Sequence[str] | None = None
) -> dict:
    """Bring the replica of a published table under ``root`` to the table's current version; noted in ``replica.load_audit``."""
    name = f"{layer}.{table}"
    keys = keys or [PRIMARY_KEYS[name]]
    version = store.version(name)
    source = store.read_as_of(name, version)
    kept = set(store.versions(name))
    target = ReplicaTable(store.spark, f"{root}/staging_{name}", source.columns, keys, slices_for(source))
    done = target.load(source, version, load_ts, lambda v: store.read_as_of(name, v) if v in kept else None)
    record_load(
        store,
        {"status": "success", "layer": layer, "table": table, "rows_loaded": done["keys"], "timestamp": load_ts},
    )
    return done
