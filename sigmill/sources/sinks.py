"""Sinks by name: where rollups go, and where streams of messages go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import encode_events
from ..model import Settings
from ..operators.serving import ServingTable
from ..operators.tenancy import Router
from .indices import IndexStore


class Routed:
    """The index store behind the serving table's ``upsert``."""

    def __init__(self, store: IndexStore, router: Router):
        self.store, self.router, self.path = store, router, store.path

    def upsert(self, docs: DataFrame, updated_at: int, batch_id: int = 0) -> None:
        self.store.write(docs, self.router, updated_at=updated_at, batch_id=batch_id)


class Console:
    """Documents as lines of JSON on the driver's output, those of one batch at a time: for looking at small streams."""

    def __init__(self, spark: SparkSession, path: str, say: Callable[[str], None] = print):
        self.spark, self.path, self.say = spark, path, say

    def upsert(self, docs: DataFrame, updated_at: int, batch_id: int = 0) -> None:
        for row in docs.select(F.to_json(F.struct(*docs.columns)).alias("json")).toLocalIterator():
            self.say(row.json)


def router_of(cfg: Settings) -> Router:
    return Router(cfg.index_prefix, [t for t in cfg.dedicated_tenants.split(",") if t], cfg.routing_partitions)


# The names of the rollup sinks.
ROLLUPS: dict[str, Callable[[SparkSession, Settings], object]] = {
    "serving": lambda spark, cfg: ServingTable(spark, cfg.serving_path),
    "indices": lambda spark, cfg: Routed(IndexStore(spark, cfg.index_path), router_of(cfg)),
    "console": lambda spark, cfg: Console(spark, cfg.serving_path),
}


def open_sink(spark: SparkSession, cfg: Settings, kind: str | None = None):
    """The rollup sink of that name, or of the settings."""
    kind = kind or cfg.sink
    if kind not in ROLLUPS:
        raise ValueError(f"{kind} is none of {', '.join(ROLLUPS)}")
    return ROLLUPS[kind](spark, cfg)


def kafka_writer(cfg: Settings, topic: str) -> Callable[[DataFrame], object]:
    """A stream of (key, value) into a topic; needs the connector on the class path."""
    return lambda messages: messages.writeStream.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap).option("topic", topic)


def file_writer(path: str) -> Callable[[DataFrame], object]:
    """A stream of (key, value) into lines of JSON text."""
    return lambda messages: messages.select(F.col("value").cast("string").alias("value")).writeStream.format("text").option("path", path)


def console_writer(messages: DataFrame):
    return messages.select(F.col("value").cast("string").alias("value")).writeStream.format("console").option("truncate", False)


def produce(events: DataFrame, cfg: Settings, path: str | None = None) -> None:
    """Encoded events into the topic, or as Parquet of (key, value) where a path is given."""
    messages = encode_events(events)
    if path:
        messages.write.mode("append").parquet(path)
    else:
        messages.write.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap).option("topic", cfg.topic).save()
