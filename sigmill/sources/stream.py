"""Streaming sources: Kafka where its connector is on the class path, files otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.codec import decode_events
from ..model import EVENT, Settings


def kafka_events(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Decoded events of the topic from its beginning."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap).option("subscribe", cfg.topic).option("startingOffsets", "earliest").load()
    return decode_events(raw.select("value"))


def file_events(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Events that arrive as Parquet files."""
    reader = spark.readStream.schema(EVENT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
