"""Window statistics and the rolling z-score and EWMA detectors: as frames and folds in batch, as a pure step for streams."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import DEFAULT_TENANT


@dataclass(frozen=True)
class DetectorConfig:
    mode: str = "zscore"  # or ewma
    metric: str = "mean_score"  # or event_rate
    threshold: float = 3.0
    min_samples: int = 5
    history: int = 30
    alpha: float = 0.3
    min_stddev: float = 0.05

    def with_threshold(self, threshold: float) -> DetectorConfig:
        """The same detector at another threshold: state does not depend on it, so past windows can be scored again."""
        return replace(self, threshold=threshold)

    def __post_init__(self) -> None:
        if self.mode not in ("zscore", "ewma") or self.metric not in ("mean_score", "event_rate"):
            raise ValueError(f"unknown mode or metric: {self.mode}, {self.metric}")
        if self.threshold <= 0 or self.min_samples < 1 or self.history < 1 or not 0 < self.alpha <= 1 or self.min_stddev <= 0:
            raise ValueError("threshold, min_samples, history, alpha and min_stddev must be positive, alpha at most 1")


def tenant_or_default() -> Column:
    return F.coalesce(F.nullif(F.col("tenant_id"), F.lit("")), F.lit(DEFAULT_TENANT))


def window_stats(events: DataFrame, window_ms: int) -> DataFrame:
    """Count, sum, least and largest score of each tenant, entity and tumbling window; duplicates count."""
    start = (F.floor(F.col("ts") / window_ms) * window_ms).cast("long")
    return (
        events.groupBy(tenant_or_default().alias("tenant_id"), "entity_id", start.alias("window_start"))
        .agg(F.count("*").alias("n"), F.sum("score").alias("sum_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"))
        .select("tenant_id", "entity_id", "window_start", (F.col("window_start") + window_ms).alias("window_end"), "n", "sum_score", "min_score", "max_score")
    )


def merge_stats(stats: DataFrame, window_ms: int) -> DataFrame:
    """Partial statistics to those of wider windows: sums add, extremes nest."""
    start = (F.floor(F.col("window_start") / window_ms) * window_ms).cast("long")
    return (
        stats.groupBy("tenant_id", "entity_id", start.alias("window_start"))
        .agg(F.sum("n").alias("n"), F.sum("sum_score").alias("sum_score"), F.min("min_score").alias("min_score"), F.max("max_score").alias("max_score"))
        .withColumn("window_end", F.col("window_start") + window_ms)
    )


def metric(cfg: DetectorConfig) -> Column:
    if cfg.metric == "mean_score":
        return F.when(F.col("n") > 0, F.col("sum_score") / F.col("n")).otherwise(0.0)
    return F.col("n") / (F.greatest(F.lit(1), F.col("window_end") - F.col("window_start")) / 1000.0)


_OUT = ("tenant_id", "entity_id", "window_start", "window_end", "metric", "value", "baseline", "stddev", "score", "threshold", "detector", "n", "samples")


def _hits(scored: DataFrame, cfg: DetectorConfig) -> DataFrame:
    sd = F.greatest("sd", F.lit(cfg.min_stddev))
    return (
        scored.where(F.col("samples") >= cfg.min_samples)
        .withColumns({"stddev": sd, "score": (F.col("value") - F.col("baseline")) / sd})
        .where(F.abs("score") >= cfg.threshold)
        .withColumns({"metric": F.lit(cfg.metric), "threshold": F.lit(cfg.threshold), "detector": F.lit(cfg.mode)})
        .select(*_OUT)
    )


def detect_zscore(stats: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Against mean and population deviation of the last windows of the key, the window itself left out."""
    key = Window.partitionBy("tenant_id", "entity_id").orderBy("window_start")
    frame = key.rowsBetween(-cfg.history, -1)
    return _hits(
        stats.withColumn("value", metric(cfg)).withColumns(
            {"baseline": F.avg("value").over(frame), "sd": F.stddev_pop("value").over(frame), "samples": (F.row_number().over(key) - 1).cast("long")}
        ),
        cfg,
    )


def ewma_reach(alpha: float) -> int:
    """So many windows back, a window's weight is below the least digit of a double."""
    return 1 if alpha >= 1 else math.ceil(54 * math.log(2) / -math.log1p(-alpha))


def detect_ewma(stats: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Against an exponentially weighted mean and variance, folded in the JVM over the frame of a key's last windows.

    The frame ends where older windows no longer weigh anything in a double, so a task holds a bounded
    number of values for any length of history.
    """
    key = Window.partitionBy("tenant_id", "entity_id").orderBy("window_start")
    reach = ewma_reach(cfg.alpha)
    frame = F.collect_list("value").over(key.rowsBetween(-reach, -1))
    start = F.struct(F.get("_past", 0).alias("mean"), F.lit(0.0).alias("var"))

    def fold(state: Column, value: Column) -> Column:
        d = value - state["mean"]
        return F.struct((state["mean"] + cfg.alpha * d).alias("mean"), ((1 - cfg.alpha) * (state["var"] + cfg.alpha * d * d)).alias("var"))

    valued = stats.withColumn("value", metric(cfg)).withColumns({"_past": frame, "samples": (F.row_number().over(key) - 1).cast("long")})
    late = valued.where(F.col("samples") >= cfg.min_samples)  # only these can be hits: the others are not folded
    folded = late.withColumn("_s", F.aggregate(F.slice("_past", 2, reach), start, fold))
    return _hits(folded.withColumns({"baseline": F.col("_s.mean"), "sd": F.sqrt("_s.var")}), cfg)


def detect(stats: DataFrame, cfg: DetectorConfig) -> DataFrame:
    return detect_zscore(stats, cfg) if cfg.mode == "zscore" else detect_ewma(stats, cfg)


def anomaly_json() -> Column:
    """The anomaly with sorted keys, numbers to six places."""
    six = {"value", "baseline", "stddev", "score"}
    return F.to_json(F.struct(*((F.round(c, 6) if c in six else F.col(c)).alias(c) for c in sorted(_OUT))))


@dataclass
class State:
    samples: int = 0
    recent: tuple[float, ...] = ()
    mean: float = 0.0
    var: float = 0.0


def step(state: State, value: float, cfg: DetectorConfig) -> tuple[State, tuple[float, float, float] | None]:
    """One window: the new state, and (baseline, deviation, score) if it is an anomaly. Every window is folded in."""
    hit = None
    if state.samples >= cfg.min_samples:
        if cfg.mode == "zscore":
            base = sum(state.recent) / len(state.recent)
            sd = (sum((x - base) ** 2 for x in state.recent) / len(state.recent)) ** 0.5
        else:
            base, sd = state.mean, state.var**0.5
        sd = max(sd, cfg.min_stddev)
        z = (value - base) / sd
        hit = (base, sd, z) if abs(z) >= cfg.threshold else None
    if cfg.mode == "zscore":
        return State(state.samples + 1, (*state.recent, value)[-cfg.history :]), hit
    if state.samples == 0:
        return State(1, (), value, 0.0), hit
    d = value - state.mean
    return State(state.samples + 1, (), state.mean + cfg.alpha * d, (1 - cfg.alpha) * (state.var + cfg.alpha * d * d)), hit
