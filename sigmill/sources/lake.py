"""A versioned table on plain Parquet: data in commit and day folders, a log of manifests.

``_log/<version>.json`` holds version, timestamp_ms, operation, numOutputRows, the schema and the live
[day, path] entries. A commit is the exclusive creation of the next log file: of two writers one
fails and must write anew. Readers pass the manifest's schema, so that old files give nulls.
"""

from __future__ import annotations

import bisect
import datetime as dt
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fs import Store


class Conflict(Exception):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Commit:
    version: int
    timestamp_ms: int
    operation: str
    rows: int | None


class Lake:
    def __init__(self, spark: SparkSession, path: str, partition: str = "day"):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.store = Store(spark, path)

    # -- log
    def _versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.store.list("_log") if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, version: int) -> dict:
        return json.loads(self.store.read(f"_log/{version:012d}.json"))

    def _at(self, version: int | None, as_of: dt.datetime | None) -> dict | None:
        versions = self._versions()
        if version is not None:
            if version not in versions:
                raise ValueError(f"there is no version {version}")
            return self._manifest(version)
        if as_of is not None:
            at = int((as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)).timestamp() * 1000)
            # every commit is later than the one before, so a few manifests are read
            n = bisect.bisect_right(versions, at, key=lambda v: self._manifest(v)["timestamp_ms"])
            if n == 0:
                raise ValueError(f"no version is as old as {as_of}")
            return self._manifest(versions[n - 1])
        return self._manifest(versions[-1]) if versions else None

    # -- write
    def write(self, docs: DataFrame, mode: str = "append", merge_schema: bool = False, replace_where: str | None = None, batch: str | None = None) -> int:
        """Append, overwrite all, or replace one day; the number of rows, counted as they are written.

        ``batch`` (a stream's name, a dash and a growing number) is written once: the manifest keeps the
        last number of each stream, and what is not above it has been committed before.
        """
        last = self._at(None, None)
        batches = dict(last.get("batches", {})) if last else {}
        if batch is not None:
            stream, number = batch.rsplit("-", 1)
            if int(number) <= batches.get(stream, -1):
                return 0
            batches[stream] = int(number)
        schema = docs.schema
        if last:
            old = T.StructType.fromJson(last["schema"])
            known = {f.name: f.dataType for f in old}
            if any(f.name in known and known[f.name] != f.dataType for f in schema):
                raise ValueError("a column has another type than in the table")
            new = [f for f in schema if f.name not in known]
            if new and not merge_schema:
                raise ValueError(f"columns {[f.name for f in new]} are not in the table; pass merge_schema to widen it")
            schema = T.StructType([*old.fields, *new])
        version = last["version"] + 1 if last else 0
        folder = f"data/commit={version}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        counted = docs.observe(seen, F.count("*").alias("n"), F.sum(F.when(F.col(self.partition) == replace_where, 0).otherwise(1) if replace_where else F.lit(0)).alias("other"))
        # a day's rows are together up to the advisory partition size, and split beyond
        counted.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/{folder}")
        if replace_where and (seen.get["other"] or 0):
            self.store.delete(folder)
            raise ValueError(f"rows of other days than {replace_where}")
        added = [[n.split("=", 1)[1], f"{folder}/{n}"] for n in self.store.list(folder) if n.startswith(f"{self.partition}=")]
        live = last["live"] if last and mode == "append" else []
        if replace_where:
            live = [e for e in live if e[0] != replace_where]
        operation = "REPLACE" if replace_where else "WRITE" if mode == "append" else "OVERWRITE"
        stamp = max(int(time.time() * 1000), last["timestamp_ms"] + 1 if last else 0)
        manifest = {"version": version, "timestamp_ms": stamp, "operation": operation, "numOutputRows": seen.get["n"], "schema": schema.jsonValue(), "live": live + added, "batches": batches}
        if not self.store.create(f"_log/{version:012d}.json", json.dumps(manifest)):
            self.store.delete(folder)
            raise Conflict(f"version {version} exists")
        return seen.get["n"]

    def rewrite_day(self, docs: DataFrame, day: str) -> int:
        return self.write(docs, replace_where=day)

    # -- read
    def read(self, version: int | None = None, as_of: dt.datetime | None = None, day: str | None = None, newest_of: tuple[str, ...] = ()) -> DataFrame:
        """The latest table, a version (which wins) or the newest at an instant; of one day, whose folders alone are read.

        With ``newest_of`` each key has only the row that the last commit wrote: what a stream in update mode appends again.
        """
        m = self._at(version, as_of)
        if m is None:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(m["schema"])
        rest = T.StructType([f for f in schema if f.name != self.partition])
        by_commit: dict[str, list[str]] = {}
        for d, p in m["live"]:
            if day is None or d == day:
                by_commit.setdefault(p.rsplit("/", 1)[0], []).append(p)
        out = None
        full = T.StructType([*rest.fields, T.StructField(self.partition, T.StringType())])
        for base, paths in by_commit.items():
            part = self.spark.read.schema(full).option("basePath", f"{self.path}/{base}").parquet(*(f"{self.path}/{p}" for p in paths))
            part = part.withColumn("_commit", F.lit(int(base.rsplit("commit=", 1)[1].split("-")[0])))
            out = part if out is None else out.unionByName(part)
        if out is None:
            out = self.spark.createDataFrame([], full).withColumn("_commit", F.lit(0))
        if newest_of:
            kept = [n for n in schema.names if n not in newest_of]
            out = out.groupBy(*newest_of).agg(F.max_by(F.struct(*kept), "_commit").alias("_r")).select(*newest_of, "_r.*")
        return out.select(*schema.names)

    def history(self, limit: int = 20) -> DataFrame:
        """version, timestamp, operation and rows, newest first."""
        rows = [(c.version, c.timestamp_ms, c.operation, c.rows) for c in (self.commit(v) for v in reversed(self._versions()[-limit:]))]
        return self.spark.createDataFrame(rows, "version long, timestamp_ms long, operation string, num_output_rows long")

    def commit(self, version: int) -> Commit:
        m = self._manifest(version)
        return Commit(m["version"], m["timestamp_ms"], m["operation"], m["numOutputRows"])

    def latest(self) -> Commit | None:
        versions = self._versions()
        return self.commit(versions[-1]) if versions else None

    def register(self, name: str, permanent: bool = False) -> None:
        """The latest version as a temporary view, or as a view of the session's catalog over its folders, to be made anew after a commit."""
        if not permanent:
            self.read().createOrReplaceTempView(name)
            return
        m = self._at(None, None)
        if m is None:
            raise ValueError(f"no table at {self.path}")
        schema = T.StructType.fromJson(m["schema"])
        parts = [f"SELECT {', '.join(f'`{f.name}`' if f.name in self._columns(p) else f'CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`' for f in schema if f.name != self.partition)}, '{d}' AS `{self.partition}` FROM parquet.`{self.path}/{p}`" for d, p in m["live"]]
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {' UNION ALL '.join(parts)}" if parts else f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(f'CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`' for f in schema)} WHERE false")

    def _columns(self, folder: str) -> list[str]:
        return self.spark.read.parquet(f"{self.path}/{folder}").columns
