"""Command-line jobs: ``python -m sigmill.jobs roll|archive|anomalies|late|produce|daily|read-api|query-api``."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession

from .functions.codec import decode_events
from .functions.scalars import parse_pairs
from .model import Settings, build_spark
from .operators.anomaly import DetectorConfig
from .operators.serving import ServingTable
from .operators.tenancy import Quota
from .plans import http, ops
from .plans.guard import Audit, Guard, Policy
from .plans.service import Cache, QueryService, ReadApi
from .sources import sinks, synthetic
from .sources.lake import Lake
from .sources.stream import file_events, kafka_events
from .streaming import jobs


def source(spark: SparkSession, cfg: Settings, path: str | None) -> DataFrame:
    """The topic, or files of events that arrive in a folder."""
    return file_events(spark, path) if path else kafka_events(spark, cfg)


def quota_of(cfg: Settings) -> Quota | None:
    q = Quota(parse_pairs(cfg.tenant_quota), cfg.tenant_quota_default)
    return q if q.limits or q.default > 0 else None


def roll(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    lake = Lake(spark, a.lake) if a.lake else None
    if a.mode == "batch":
        sink = sinks.open_sink(spark, cfg, a.sink)
        return {"rows": ops.run_batch(spark, a.source or cfg.archive_dir, sink, a.day, quota_of(cfg), lake, batch_id=int((a.day or "0").replace("-", "")), window=cfg.window)}
    events = source(spark, cfg, a.source)
    return jobs.rollup_leg(events, sinks.open_sink(spark, cfg, a.sink), f"{cfg.checkpoint_dir}/rollup", cfg.window, cfg.watermark, quota_of(cfg), a.once, lake)


def archive(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    return jobs.archive_leg(source(spark, cfg, a.source), cfg.archive_dir, f"{cfg.checkpoint_dir}/archive", a.once)


def _messages(cfg: Settings, a: argparse.Namespace, topic: str):
    return sinks.console_writer if a.print else sinks.file_writer(a.out) if a.out else sinks.kafka_writer(cfg, topic)


def anomalies(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    detector = DetectorConfig(mode=a.mode or cfg.anomaly_mode, threshold=a.threshold or cfg.anomaly_threshold)
    window = a.window_ms or cfg.anomaly_window_ms
    return jobs.anomaly_leg(source(spark, cfg, a.source), detector, window, cfg.anomaly_lateness_ms, _messages(cfg, a, cfg.anomaly_topic), f"{cfg.checkpoint_dir}/anomalies", a.once)


def late(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    """Late events as files, with a batch column, or into their topic."""
    leg = jobs.LateLeg(spark, f"{cfg.checkpoint_dir}/late-events", a.window_ms or cfg.anomaly_window_ms, cfg.anomaly_lateness_ms)
    if not a.out and not a.print:
        leg.topic = (cfg.bootstrap, cfg.late_topic)
    return leg.start(source(spark, cfg, a.source), f"{cfg.checkpoint_dir}/late", a.once)


def produce(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    """Synthetic events; with a rate, so many of them each second."""
    sent, step = 0, a.n if a.rate <= 0 else max(1, int(a.rate))
    while sent < a.n:
        began = time.time()
        events = synthetic.synth_events(spark, min(step, a.n - sent), a.entities, a.tenants, a.seed + sent, int(began * 1000))
        sinks.produce(events, cfg, a.out)
        sent += step
        if a.rate > 0 and sent < a.n:
            time.sleep(max(0.0, 1 - (time.time() - began)))
    return {"events": min(sent, a.n)}


def decode(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    """Encoded messages in files to events in files."""
    decode_events(spark.read.parquet(a.source)).write.mode("append").parquet(a.out)
    return {"events": spark.read.parquet(a.out).count()}


def daily(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    return ops.run_daily(spark, cfg, a.day)


def read_api(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    return http.serve(http.read_routes(ReadApi(ServingTable(spark, cfg.serving_path), Cache(cfg.cache_ttl))), a.host, a.port)


def query_api(spark: SparkSession, cfg: Settings, a: argparse.Namespace) -> object:
    Lake(spark, cfg.lake_path).register("signals_daily")
    policy = Policy(max_scan_bytes=cfg.max_scan_bytes, max_concurrent_per_user=cfg.max_concurrent)
    return http.serve(http.query_routes(QueryService(Guard(spark, policy, Audit(a.out)))), a.host, a.port)


COMMANDS = {
    "roll": (roll, "source sink lake once mode day"), "archive": (archive, "source once"), "anomalies": (anomalies, "source once mode threshold window_ms out print"),
    "late": (late, "source once window_ms out print"), "produce": (produce, "n entities tenants rate seed out"), "decode": (decode, "source out"), "daily": (daily, "day"),
    "read-api": (read_api, "host port"), "query-api": (query_api, "host port out"),
}
OPTIONS = {
    "source": {"help": "folder of files in place of the topic"}, "sink": {"choices": sorted(sinks.ROLLUPS)}, "lake": {}, "once": {"action": "store_true", "help": "drain what is there and end"},
    "mode": {"help": "stream or batch; of anomalies zscore or ewma"}, "day": {}, "threshold": {"type": float}, "window_ms": {"type": int}, "out": {"help": "folder or file to write"},
    "print": {"action": "store_true"}, "n": {"type": int, "default": 1000}, "entities": {"type": int, "default": 200}, "tenants": {"type": int, "default": 4}, "rate": {"type": float, "default": 0.0},
    "seed": {"type": int, "default": 0}, "host": {"default": "127.0.0.1"}, "port": {"type": int, "default": 8000},
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        c = commands.add_parser(name)
        for o in options.split():
            c.add_argument("--" + o.replace("_", "-"), **OPTIONS[o])
    return p


def start(args: list[str], spark: SparkSession | None = None, cfg: Settings | None = None) -> object:
    """What the command starts: a report, a streaming query or a server."""
    a = parser().parse_args(args)
    return COMMANDS[a.command][0](spark or build_spark(f"sigmill-{a.command}", local=False), cfg or Settings.from_env(), a)


def main(args: list[str] | None = None) -> None:
    import sys

    got = start(sys.argv[1:] if args is None else args)
    if hasattr(got, "awaitTermination"):
        got.awaitTermination()
    elif hasattr(got, "serve_forever"):
        got.serve_forever()
    else:
        print(json.dumps(got, default=str))


if __name__ == "__main__":
    main()
