"""Schemas, settings and the adapter from the generic events table."""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TENANT = "default"

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "array<string>": T.ArrayType(T.StringType())}


def schema(text: str) -> T.StructType:
    """``name type, ...`` to a schema, without a session: workers import this module too."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in text.split(","))])


EVENT = schema("event_id string, entity_id string, signal_type string, score double, source string, ts long, tenant_id string")
ARCHIVE = T.StructType([*EVENT.fields, T.StructField("day", T.StringType())])
DOCUMENT = schema(
    "tenant_id string, entity_id string, n long, mean_score double, min_score double, max_score double, stddev_score double, last_score double, "
    "last_ts long, signal_types array<string>, sources array<string>, window_start string, window_end string, day string"
)
WINDOW_STAT = schema(
    "tenant_id string, entity_id string, window_start long, window_end long, n long, sum_score double, min_score double, max_score double"
)


@dataclass
class Settings:
    """Configuration; environment variables SM_<NAME> override the defaults."""

    topic: str = "signal_events"
    anomaly_topic: str = "signal_anomalies"
    late_topic: str = "signal_late"
    sink: str = "serving"
    index_path: str = "data/indices"
    bootstrap: str = "localhost:9092"
    index_prefix: str = "signals"
    archive_dir: str = "data/archive"
    checkpoint_dir: str = "data/checkpoints"
    lake_path: str = "data/lake/signals_daily"
    serving_path: str = "data/serving"
    window: str = "1 day"
    watermark: str = "10 minutes"
    cache_ttl: int = 60
    dedicated_tenants: str = ""
    routing_partitions: int = 0
    tenant_quota: str = ""
    tenant_quota_default: int = 0
    retention_days: int = 30
    anomaly_window_ms: int = 60_000
    anomaly_lateness_ms: int = 5_000
    anomaly_mode: str = "zscore"
    anomaly_threshold: float = 3.0
    max_scan_bytes: int = 5 << 30
    max_concurrent: int = 3
    sla: str = "archive:3600:1,lake:3600:100,serving:3600"

    @classmethod
    def from_env(cls) -> Settings:
        out = cls()
        for name, value in vars(out).items():
            raw = os.environ.get(f"SM_{name.upper()}")
            if raw is not None:
                setattr(out, name, type(value)(raw))
        return out


# Upper bounds of the histograms' buckets, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30, 60, 300)


@dataclass
class Metrics:
    """Named counters, gauges and histograms of one process; threads may share it."""

    values: dict[str, float] = field(default_factory=dict)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False, compare=False)

    @staticmethod
    def _key(name: str, labels: dict[str, str]) -> str:
        return name + "".join(f",{k}={v}" for k, v in sorted(labels.items()))

    def inc(self, name: str, by: float = 1, **labels: str) -> None:
        key = self._key(name, labels)
        with self._lock:
            self.values[key] = self.values.get(key, 0) + by

    def set(self, name: str, value: float, **labels: str) -> None:
        with self._lock:
            self.values[self._key(name, labels)] = value

    def observe(self, name: str, value: float, **labels: str) -> None:
        """Count a value in its buckets (each holds those below it), the sum and the number."""
        for bound in (*BUCKETS, float("inf")):
            if value <= bound:
                self.inc(f"{name}_bucket", **labels, le="+Inf" if bound == float("inf") else f"{bound:g}")
        self.inc(f"{name}_sum", value, **labels)
        self.inc(f"{name}_count", **labels)

    @contextmanager
    def timed(self, name: str, **labels: str) -> Iterator[None]:
        began = time.time()
        try:
            yield
        finally:
            self.observe(name, time.time() - began, **labels)

    def exposition(self) -> str:
        """Text lines ``name{label="value"} number``."""
        lines = []
        for key, value in sorted(self.values.items()):
            name, *labels = key.split(",")
            quoted = ",".join('{}="{}"'.format(*x.split("=", 1)) for x in labels)
            lines.append(f"{name}{{{quoted}}} {value:g}" if labels else f"{name} {value:g}")
        return "\n".join(lines) + "\n"


METRICS = Metrics()


def build_spark(app: str = "sigmill", local: bool = True, configs: dict[str, str] | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; shuffle partitions are left to it."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if local:
        b = b.master("local[*]").config("spark.ui.enabled", "false")
    for k, v in (configs or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generic ``events`` table in the event schema."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int") % 3
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("event_type").alias("signal_type"),
        F.col("value").alias("score"),
        F.when(k == 0, "web").when(k == 1, "mobile").otherwise("partner").alias("source"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.concat(F.lit("t-"), (F.col("user_id") % 4).cast("string")).alias("tenant_id"),
    )


def redelivered(events: DataFrame) -> DataFrame:
    """Events with every twentieth delivered twice."""
    return events.union(events.where(F.col("event_id").cast("long") % 20 == 0))
