"""Synthetic events, generated where they are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import event_id
from ..model import EVENT

# The domains of the events.
SIGNAL_TYPES = ("review", "rating", "return", "click")
SOURCES = ("web", "mobile", "partner")


def synth_events(spark: SparkSession, n: int, entities: int = 200, tenants: int = 1, seed: int = 0, now_ms: int = 1_788_393_600_000, duplicates: float = 0.05) -> DataFrame:
    """n events of the six hours before ``now_ms``; a share is the one before it again."""
    base = spark.range(n).withColumn("k", F.when((F.rand(seed + 9) < duplicates) & (F.col("id") > 0), F.col("id") - 1).otherwise(F.col("id")))
    # every value is a function of k, so that a redelivery is equal to its event
    u = lambda salt: F.pmod(F.xxhash64("k", F.lit(seed * 31 + salt)), F.lit(1 << 40)) / float(1 << 40)
    normal = F.sqrt(-2 * F.log(u(1) + 1e-12)) * F.cos(2 * 3.141592653589793 * u(2))
    pick = lambda values, salt: F.element_at(F.array(*map(F.lit, values)), (F.floor(u(salt) * len(values)) + 1).cast("int"))
    rows = base.select(
        (F.concat(F.lit("t-"), F.lpad(F.floor(u(3) * tenants).cast("string"), 2, "0")) if tenants > 1 else F.lit("default")).alias("tenant_id"),
        F.concat(F.lit("ent-"), F.lpad(F.floor(u(4) * entities).cast("string"), 4, "0")).alias("entity_id"),
        pick(SIGNAL_TYPES, 5).alias("signal_type"),
        F.round(3.5 + normal, 3).alias("score"),
        pick(SOURCES, 6).alias("source"),
        (F.lit(now_ms) - F.floor(u(7) * 6 * 3600 * 1000)).cast("long").alias("ts"),
    )
    return rows.withColumn("event_id", event_id()).select(*EVENT.names)


def bench_events(spark: SparkSession, n: int = 1_000_000, entities: int = 50_000, tenants: int = 200, days: int = 3, seed: int = 0, start_ms: int = 1_788_393_600_000) -> DataFrame:
    """Events with Zipf(1.3) tenants and 5 % of the ids used again by other payloads."""
    u = lambda salt: F.pmod(F.xxhash64("id", F.lit(seed * 31 + salt)), F.lit(1 << 40)) / float(1 << 40)
    weights = [(i + 1) ** -1.3 for i in range(tenants)]
    total, acc, cdf = sum(weights), 0.0, []
    for w in weights:
        acc += w / total
        cdf.append(acc)
    tenant = F.least(F.lit(tenants - 1), F.size(F.filter(F.array(*map(F.lit, cdf)), lambda c: c < u(1))))
    normal = F.sqrt(-2 * F.log(u(2) + 1e-12)) * F.cos(2 * 3.141592653589793 * u(3))
    pick = lambda values, salt: F.element_at(F.array(*map(F.lit, values)), (F.floor(u(salt) * len(values)) + 1).cast("int"))
    return spark.range(n).select(
        F.when(u(8) < 0.05, F.floor(F.col("id") / 2)).otherwise(F.col("id")).cast("string").alias("event_id"),
        F.concat(F.lit("ent-"), F.floor(u(4) * entities).cast("string")).alias("entity_id"), pick(SIGNAL_TYPES, 5).alias("signal_type"),
        F.round(3.5 + normal, 3).alias("score"), pick(SOURCES, 6).alias("source"), (F.lit(start_ms) + F.floor(u(7) * days * 86_400_000)).cast("long").alias("ts"),
        F.concat(F.lit("t-"), F.lpad(tenant.cast("string"), 3, "0")).alias("tenant_id"),
    )
