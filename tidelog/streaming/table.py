"""A table of one row per key that micro-batches merge into.

Rows lie in buckets by a hash of their key.  A batch reads and rewrites only the buckets that its keys
fall into; the others stay as they are.  A version is a small file that says where each bucket lies, and
it appears by one rename: readers see the table before a batch or after it, and a batch that is repeated
after its version is there changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.streaming import commits
from tidelog.streaming.sinks import run_of

#: Versions whose files are kept for readers that still use them.
KEPT = 3


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path``: ``schema`` holds the keys and the rest, ``merge`` makes one row of several of a key.

    A bucket is written by one task, so take as many ``buckets`` as keep it small; the number stays with
    the table.  One writer at a time.
    """

    path: str
    keys: Sequence[str]
    schema: StructType
    merge: Sequence[Column]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _version(self, spark: SparkSession) -> dict:
        found = commits.names(spark, f"{self.path}/versions")
        return commits.get(spark, f"{self.path}/versions", found[-1]) if found else {"version": 0, "folders": {}, "batches": {}}

    def _rows(self, spark: SparkSession, folders: dict[str, str]) -> DataFrame:
        paths = [f"{self.path}/data/{folder}/bucket={b}" for b, folder in folders.items()]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest version."""
        return self._rows(spark, self._version(spark)["folders"])

    def upsert(self, rows: DataFrame, batch_id: int, keep: str | None = None) -> None:
        """Merge the rows of a batch, which may repeat keys; ``keep`` is SQL text for the merged rows that stay."""
        spark, run = rows.sparkSession, run_of(rows)
        now = self._version(spark)
        if now["batches"].get(run, -1) >= batch_id:
            return
        merged = rows.groupBy(*self.keys).agg(*self.merge).select(*self.schema.fieldNames()).persist()
        touched = [str(r[0]) for r in merged.select(self._bucket()).distinct().collect()]  # numbers of buckets
        old = self._rows(spark, {b: f for b, f in now["folders"].items() if b in touched})
        new = old.unionByName(merged).groupBy(*self.keys).agg(*self.merge)
        new = (new if keep is None else new.filter(keep)).select(*self.schema.fieldNames(), self._bucket().alias("bucket"))
        folder = f"{now['version'] + 1:010d}-{uuid.uuid4().hex}"
        new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}")
        filled = {n.removeprefix("bucket=") for n in commits.names(spark, f"{self.path}/data/{folder}")}
        folders = {b: f for b, f in now["folders"].items() if b not in touched} | {b: folder for b in touched if b in filled}
        entry = {"version": now["version"] + 1, "folders": folders, "batches": {**now["batches"], run: batch_id}}
        commits.put(spark, f"{self.path}/versions", f"{now['version'] + 1:010d}", entry)
        merged.unpersist()
        self._forget(spark)

    def _forget(self, spark: SparkSession) -> None:
        """Delete what only versions before the last KEPT used."""
        found = commits.names(spark, f"{self.path}/versions")
        if len(found) <= KEPT:
            return
        used = {f for n in found[-KEPT:] for f in commits.get(spark, f"{self.path}/versions", n)["folders"].values()}
        for name in found[:-KEPT]:
            for folder in set(commits.get(spark, f"{self.path}/versions", name)["folders"].values()) - used:
                commits.delete(spark, f"{self.path}/data/{folder}")
            commits.delete(spark, f"{self.path}/versions/{name}")
