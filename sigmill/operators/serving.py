"""The serving table: appended versions of documents, read as the newest of each key.

Rows carry updated_at (ms) and batch_id; the key is (day, tenant, entity, window start). Writes only
append, keyed by batch, so that a batch that is run again replaces itself; a refresh rewrites one
day as its newest rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ISO
from ..model import DOCUMENT
from ..sources.fs import Store

KEY = ("day", "tenant_id", "entity_id", "window_start")
ROW = T.StructType([*DOCUMENT.fields, T.StructField("updated_at", T.LongType()), T.StructField("batch_id", T.LongType())])


def newest(rows: DataFrame) -> DataFrame:
    """The newest row of each key; of equally new ones that of the later batch. Partial aggregates, no sort of a key's rows."""
    rest = [c for c in rows.columns if c not in KEY]
    best = rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.struct("updated_at", "batch_id")).alias("r"))
    return best.select(*KEY, "r.*").select(*rows.columns)


def _dealt(rows: DataFrame) -> DataFrame:
    """For a write by day: files follow the bytes (a day's rows are together up to the advisory partition size, and split beyond), sorted by key within."""
    return rows.hint("rebalance", "day").sortWithinPartitions("day", "tenant_id", "entity_id")


class ServingTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path.rstrip("/"), Store(spark, path)
        #: Called with the documents of every write, such as a cache's eviction.
        self.listeners: list[Callable[[DataFrame], None]] = []

    def upsert(self, docs: DataFrame, updated_at: int, batch_id: int = 0) -> None:
        """Append ``docs`` as one batch; the same batch again replaces itself."""
        rows = docs.select(*DOCUMENT.names, F.lit(updated_at).cast("long").alias("updated_at"))
        _dealt(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.path}/batch_id={batch_id}")
        for keys in self.listeners:
            keys(docs)

    def raw(self, days: list[str] | None = None) -> DataFrame:
        if not self.store.exists("") or not self.store.list(""):
            return self.spark.createDataFrame([], ROW)
        rows = self.spark.read.schema(ROW).parquet(self.path)
        return rows.where(F.col("day").isin(days)) if days is not None else rows

    def read(self, days: list[str] | None = None) -> DataFrame:
        return newest(self.raw(days))

    def get(self, day: str, tenant: str, entity: str) -> DataFrame:
        """The key's rows are filtered before they are collapsed; day prunes folders, the sort order row groups."""
        return newest(self.raw([day]).where((F.col("tenant_id") == tenant) & (F.col("entity_id") == entity))).drop("updated_at", "batch_id")

    def mget(self, days: list[str], tenant: str, entity: str) -> DataFrame:
        return newest(self.raw(days).where((F.col("tenant_id") == tenant) & (F.col("entity_id") == entity))).drop("updated_at", "batch_id")

    def count(self, day: str) -> int:
        return self.read([day]).count()

    def partitions(self) -> DataFrame:
        """The days that have rows: the folders say it, no row is read."""
        days = {d.split("=", 1)[1] for b in self.store.list("") if b.startswith("batch_id=") for d in self.store.list(b) if d.startswith("day=")}
        return self.spark.createDataFrame([(d,) for d in sorted(days)], "day string")

    def refresh_day(self, day: str) -> None:
        """Rewrite a day as its newest rows, in a batch of their own; the older batches' folders of the day go last."""
        old = [b for b in self.store.list("") if b.startswith("batch_id=") and self.store.exists(f"{b}/day={day}")]
        if not old:
            return
        batch = max((int(b.split("=")[1]) for b in self.store.list("") if b.startswith("batch_id=")), default=0) + 1
        kept = self.read([day]).drop("batch_id")
        _dealt(kept).write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/batch_id={batch}")
        for b in old:
            self.store.delete(f"{b}/day={day}")

    def drop_day(self, day: str) -> None:
        for b in self.store.list(""):
            self.store.delete(f"{b}/day={day}")


def history_mean() -> Column:
    """The mean of daily means weighted by their events; null without any."""
    return F.round(F.sum(F.col("mean_score") * F.col("n")) / F.nullif(F.sum("n"), F.lit(0)), 4)


def to_row(docs: DataFrame) -> DataFrame:
    """Document strings to dates and timestamps."""
    return docs.withColumns(
        {"day": F.to_date("day"), "window_start": F.to_timestamp("window_start", ISO), "window_end": F.to_timestamp("window_end", ISO), "last_ts": F.timestamp_millis("last_ts")}
    )


def to_doc(rows: DataFrame) -> DataFrame:
    """The inverse of ``to_row``."""
    return rows.withColumns(
        {"day": F.date_format("day", "yyyy-MM-dd"), "window_start": F.date_format("window_start", ISO), "window_end": F.date_format("window_end", ISO), "last_ts": F.unix_millis("last_ts")}
    )
