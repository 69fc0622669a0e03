"""Routed documents: a folder for each index, written by batch and read as the newest of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DOCUMENT, METRICS
from ..operators.serving import newest
from ..operators.tenancy import Quota, Router, list_indices
from .fs import Store

ROW = T.StructType([*DOCUMENT.fields, T.StructField("routing", T.StringType()), T.StructField("updated_at", T.LongType()), T.StructField("batch_id", T.LongType())])


class IndexStore:
    """``index=<name>/batch=<k>`` folders: dedicated tenants have indices of their own, the pool shares those of its days."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.store = spark, path.rstrip("/"), Store(spark, path)

    def write(self, docs: DataFrame, router: Router, quota: Quota | None = None, updated_at: int = 0, batch_id: int = 0) -> dict[str, int]:
        """Admit, route and write the documents; those of each index. The same batch again replaces itself, index by index.

        A document's rows are dealt by index and routing, so a routing bucket's documents are together; large ones are split.
        """
        admitted = quota.admit(docs) if quota else docs
        routed = router.route(admitted).select("index", *DOCUMENT.names, "routing", F.lit(updated_at).cast("long").alias("updated_at"), F.lit(batch_id).cast("long").alias("batch"))
        dealt = routed.hint("rebalance", "index", "routing").sortWithinPartitions("index", "routing", "tenant_id", "entity_id")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("index", "batch").parquet(self.path)
        written = {r["index"]: r.n for r in routed.groupBy("index").agg(F.count("*").alias("n")).collect()}
        for index, n in written.items():
            METRICS.inc("sm_docs_upserted_total", n, index=index)
        return written

    def names(self, pattern: str = "*") -> list[str]:
        return list_indices([d.split("=", 1)[1] for d in self.store.list("") if d.startswith("index=")], pattern)

    def read(self, pattern: str = "*", routing: str | None = None) -> DataFrame:
        """The newest row of each document of the matching indices, whose folders alone are read; of one routing bucket, by the sorted row groups."""
        names = self.names(pattern)
        if not names:
            return self.spark.createDataFrame([], T.StructType([T.StructField("index", T.StringType()), *ROW.fields]))
        full = T.StructType([*(f for f in ROW.fields if f.name != "batch_id"), T.StructField("index", T.StringType()), T.StructField("batch", T.LongType())])
        rows = self.spark.read.schema(full).option("basePath", self.path).parquet(*(f"{self.path}/index={n}" for n in names)).withColumnRenamed("batch", "batch_id")
        rows = rows.where(F.col("routing") == routing) if routing is not None else rows
        return newest(rows).select("index", *ROW.names)

    def count(self, pattern: str = "*") -> int:
        """Documents of the matching indices; 0 if none is there."""
        return self.read(pattern).count()

    def drop(self, index: str) -> None:
        self.store.delete(f"index={index}")
