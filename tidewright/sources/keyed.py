"""Tables that are replaced by key together: data and its status move in one step.

The rows of each table lie in buckets of their key's hash. A commit rewrites the
buckets that its keys fall into, for all tables, in a folder of its own, and
then writes the next manifest: which folders hold which bucket of which table.
The highest manifest is the state, so a reader sees all tables before or all
after a commit; one that fails before its manifest changes nothing, and of two
commits at once the later fails and can be tried again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class CommitConflict(RuntimeError):
    """Another commit came first."""


@dataclass(frozen=True)
class KeyedTables:
    """root: a folder that driver and executors share; schemas: of each table, all with the column `key`."""

    spark: SparkSession
    root: str
    key: str
    schemas: dict[str, StructType]
    buckets: int = 32

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, dict]:
        path, files = self._files()
        at = path(f"{self.root}/manifests")
        numbers = [int(s.getPath().getName()) for s in files.listStatus(at) if s.getPath().getName().isdigit()] if files.exists(at) else []
        if not numbers:
            return 0, {"tables": {t: {} for t in self.schemas}, "batches": {}}
        rows = self.spark.read.text(f"{self.root}/manifests/{max(numbers)}").collect()  # one line for each table and bucket
        return max(numbers), json.loads("".join(r["value"] for r in rows))

    def _put(self, number: int, state: dict) -> None:
        path, files = self._files()
        files.mkdirs(path(f"{self.root}/manifests"))
        draft = path(f"{self.root}/manifests/draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps(state, indent=0).encode()))
        out.close()
        if files.exists(path(f"{self.root}/manifests/{number}")) or not files.rename(draft, path(f"{self.root}/manifests/{number}")):
            files.delete(draft, False)
            raise CommitConflict(f"commit {number} of {self.root} was made by another")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, state: dict, name: str, only: set[str] | None = None) -> DataFrame:
        places = [f for b, f in state["tables"].get(name, {}).items() if only is None or b in only]
        schema = self.schemas[name]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def read(self, name: str) -> DataFrame:
        """A table as of the last commit; no rows before the first."""
        return self._rows(self._manifest()[1], name)

    def committed(self, stream: str) -> int:
        """The last batch of a stream that is in the tables; -1 before the first."""
        return self._manifest()[1]["batches"].get(stream, -1)

    def commit(self, changes: dict[str, DataFrame], keys: DataFrame | None = None, stream: str = "", batch: int | None = None) -> bool:
        """Replace all rows of the keys, in all tables, by those of changes; False if the batch is in already.

        keys: those the commit speaks for (default: those in changes). A key that
        has no rows in a table afterwards is gone from it. Rows with a null key
        are refused, as is a row of changes whose key is not among keys.
        """
        number, state = self._manifest()
        if batch is not None and state["batches"].get(stream, -1) >= batch:
            return False
        given = {t: df.select(*self.schemas[t].names).where(F.col(self.key).isNotNull()) for t, df in changes.items()}
        if keys is None:
            parts = [df.select(self.key) for df in given.values()]
            keys = parts[0]
            for p in parts[1:]:
                keys = keys.union(p)
        keys = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        touched = {str(r["b"]) for r in keys.select(self._bucket().alias("b")).distinct().collect()}  # `buckets` numbers at most
        folder = f"{self.root}/commits/{number + 1}-{uuid.uuid4().hex}"
        path, files = self._files()
        tables = {t: dict(places) for t, places in state["tables"].items()}
        for name in self.schemas:
            old = self._rows(state, name, touched).join(keys, self.key, "left_anti")
            new = given[name].join(keys, self.key, "left_semi") if name in given else self.spark.createDataFrame([], self.schemas[name])
            rows = old.select(*self.schemas[name].names).unionByName(new).withColumn("_bucket", self._bucket())
            rows.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.partitionBy("_bucket").parquet(f"{folder}/{name}")
            for b in touched:
                at = f"{folder}/{name}/_bucket={b}"
                tables.setdefault(name, {}).pop(b, None)
                if files.exists(path(at)):
                    tables[name][b] = at
        batches = state["batches"] | ({stream: batch} if batch is not None else {})
        self._put(number + 1, {"tables": tables, "batches": batches})
        return True


def fetch_status(batch: DataFrame, key: str, failed: str, at: Column) -> DataFrame:
    """(key, status, n, fetched_at) of a fetch: `error` where a row says that it failed, `empty` where it found nothing, else `ok`.

    batch: a row for each thing found; a key without any has one row whose other columns are null.
    """
    found = F.coalesce(*(F.col(c).cast("string") for c in batch.columns if c not in (key, failed))).isNotNull() & ~F.col(failed)
    sums = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or(failed).alias("_failed"), F.count(F.when(found, 1)).alias("_n"))
    status = F.when(F.col("_failed"), "error").when(F.col("_n") > 0, "ok").otherwise("empty")
    return sums.select(key, status.alias("status"), F.when(F.col("_failed"), 0).otherwise(F.col("_n")).cast("long").alias("n"), at.alias("fetched_at"))


def commit_fetch(tables: KeyedTables, batch: DataFrame, failed: str, at: Column, rows: str = "rows", status: str = "status", stream: str = "", number: int | None = None) -> bool:
    """Put a fetch into the table of rows and that of states: a key's old rows go, whether it came out ok, empty or failed."""
    key = tables.key
    states = fetch_status(batch, key, failed, at)
    good = batch.join(states.where("status = 'ok'").select(key), key, "left_semi")
    found = F.coalesce(*(F.col(c).cast("string") for c in batch.columns if c not in (key, failed))).isNotNull()
    return tables.commit({rows: good.where(found), status: states}, batch.select(key), stream, number)
