"""The streaming legs: archive, rollup, window statistics, anomalies, and late events."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery, StreamingQueryListener

from ..functions.scalars import shift_day
from ..model import EVENT, METRICS, WINDOW_STAT
from ..operators import anomaly as A
from ..operators.rollup import as_documents, dedup, roll_up, with_event_time
from ..operators.serving import ServingTable
from ..operators.tenancy import Quota
from ..sources.archive import append_batch
from ..sources.fs import Store

#: What a document in the lake is known by: ``Lake.read(newest_of=LAKE_KEY)`` has each as the last batch that touched it wrote it.
LAKE_KEY = ("day", "tenant_id", "entity_id", "window_start")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime="10 seconds").start()


def batch_name(checkpoint: str, batch_id: int) -> str:
    """The name of a stream's batch, the same whenever it is run again."""
    return f"b{zlib.crc32(checkpoint.encode()):08x}-{batch_id}"


def archive_leg(events: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Events as they are into day folders, each batch once; compaction and batch writes may share the folders."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_name(checkpoint, batch_id))

    return _start(events.writeStream.foreachBatch(write), checkpoint, once)


def rollup_leg(events: DataFrame, serving: ServingTable, checkpoint: str, window: str = "1 day", watermark: str = "10 minutes", quota: Quota | None = None, once: bool = False, lake=None, keep_days: int = 3) -> StreamingQuery:
    """Dedup and roll up, and upsert each touched key; writes are keyed by batch, so that a batch run again replaces itself.

    Entities that the quota has admitted are kept in a table beside the serving table for ``keep_days``.
    """
    admitted_path = f"{serving.path}-admitted"

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = as_documents(batch)
        spark = docs.sparkSession
        if quota:
            store = Store(spark, admitted_path)
            old = [b for b in store.list("") if b.startswith("batch=") and int(b[6:]) < batch_id]
            admitted = spark.read.parquet(f"{admitted_path}/{max(old, key=lambda b: int(b[6:]))}") if old else None
            docs = quota.admit(docs, admitted).persist()
            last = docs.agg(F.max("day")).first()[0]
            new = docs.select("tenant_id", "day", "entity_id")
            new = (new.union(admitted.select(*new.columns)) if admitted is not None else new).distinct()
            new = new.where(F.col("day") > shift_day(last, -keep_days)) if last else new
            new.write.mode("overwrite").parquet(f"{admitted_path}/batch={batch_id}")
        serving.upsert(docs, batch_id + 1, batch_id)
        if lake is not None:
            lake.write(docs, batch=batch_name(checkpoint, batch_id))
        docs.unpersist()

    rolled = roll_up(dedup(with_event_time(events), watermark), window)
    return _start(rolled.writeStream.outputMode("update").foreachBatch(write), checkpoint, once)


def dedup_leg(events: DataFrame, path: str, checkpoint: str, watermark: str = "10 minutes", once: bool = False) -> StreamingQuery:
    rows = dedup(with_event_time(events), watermark).select(*EVENT.names)
    return _start(rows.writeStream.format("parquet").option("path", path).outputMode("append"), checkpoint, once)


def stream_window_stats(events: DataFrame, window_ms: int, lateness_ms: int) -> DataFrame:
    """Closed tumbling windows, each once; no dedup."""
    w = F.window("event_time", f"{window_ms} milliseconds")
    rows = events.withColumns({"tenant_id": A.tenant_or_default(), "event_time": F.timestamp_millis("ts")}).withWatermark("event_time", f"{lateness_ms} milliseconds")
    stats = rows.groupBy("tenant_id", "entity_id", w.alias("w")).agg(
        F.count("*").alias("n"), F.sum("score").alias("sum_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )
    return stats.select(
        "tenant_id", "entity_id", F.unix_millis("w.start").alias("window_start"), F.unix_millis("w.end").alias("window_end"), "n", "sum_score", "min_score", "max_score"
    ).select(*WINDOW_STAT.names)


class Detector(StatefulProcessor):
    """One key's detector state; the windows of a call are taken in order of their start."""

    def __init__(self, cfg: A.DetectorConfig):
        self.cfg = cfg

    def init(self, handle) -> None:
        self.state = handle.getValueState("state", "samples long, recent array<double>, mean double, var double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        cfg = self.cfg
        state = A.State()
        if self.state.exists():
            s = self.state.get()
            state = A.State(s[0], tuple(s[1]), s[2], s[3])
        out = []
        frame = pd.concat(list(rows)).sort_values("window_start")
        for r in frame.itertuples():
            if cfg.metric == "mean_score":
                value = r.sum_score / r.n if r.n else 0.0
            else:
                value = r.n / (max(1, r.window_end - r.window_start) / 1000)
            samples = state.samples
            state, hit = A.step(state, value, cfg)
            if hit:
                out.append((key[0], key[1], r.window_start, r.window_end, cfg.metric, value, hit[0], hit[1], hit[2], cfg.threshold, cfg.mode, r.n, samples))
        self.state.update((state.samples, list(state.recent), state.mean, state.var))
        yield pd.DataFrame(out, columns=list(A._OUT))

    def close(self) -> None:
        pass


ANOMALY = (
    "tenant_id string, entity_id string, window_start long, window_end long, metric string, value double, baseline double, stddev double, "
    "score double, threshold double, detector string, n long, samples long"
)


def stream_anomalies(events: DataFrame, cfg: A.DetectorConfig, window_ms: int, lateness_ms: int) -> DataFrame:
    """Anomalies of closed windows, by keyed state. Needs the RocksDB state store."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    stats = stream_window_stats(events, window_ms, lateness_ms)
    return stats.groupBy("tenant_id", "entity_id").transformWithStateInPandas(Detector(cfg), ANOMALY, "Append", "None")


class LateLeg:
    """Events whose window had closed when they came.

    A batch's late filter uses the watermark of the batch before, that is the largest event time of
    the batches up to two before it less the delay. Each batch keeps the largest time up to itself in
    a file of its own, so that one file is read for a batch, and a batch that is run again finds the same.
    """

    def __init__(self, spark: SparkSession, path: str, window_ms: int, lateness_ms: int):
        self.store, self.window_ms, self.lateness_ms = Store(spark, path), window_ms, lateness_ms
        #: (servers, topic) to send late events to in place of files.
        self.topic: tuple[str, str] | None = None

    def _largest(self, batch_id: int) -> int | None:
        """The largest time of the batches up to this one."""
        while batch_id >= 0:
            if self.store.exists(f"max/{batch_id}.json"):
                return json.loads(self.store.read(f"max/{batch_id}.json"))["upto"]
            batch_id -= 1  # a number without a batch
        return None

    def watermark(self, batch_id: int) -> int | None:
        largest = self._largest(batch_id - 2)
        return None if largest is None else largest - self.lateness_ms

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = [x for x in (batch.agg(F.max("ts")).first()[0], self._largest(batch_id - 1)) if x is not None]
        self.store.create(f"max/{batch_id}.json", json.dumps({"upto": max(seen, default=None)}))
        mark = self.watermark(batch_id)
        end = (F.floor(F.col("ts") / self.window_ms) + 1) * self.window_ms
        late = batch.where(end <= mark) if mark is not None else batch.limit(0)
        late = late.select(A.tenant_or_default().alias("tenant_id"), "entity_id", "ts")
        if self.topic:
            late_messages(late).write.format("kafka").option("kafka.bootstrap.servers", self.topic[0]).option("topic", self.topic[1]).save()
        else:
            late.write.mode("overwrite").parquet(f"{self.store.root}/late/batch={batch_id}")

    def start(self, events: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return _start(events.writeStream.foreachBatch(self), checkpoint, once)


def late_replay(events: DataFrame, batch: str, window_ms: int, lateness_ms: int) -> DataFrame:
    """The late events of a replay whose batches are numbered in column ``batch``."""
    b = F.col(batch).cast("long")
    most = events.groupBy(b.alias("_now")).agg(F.max("ts").alias("_m"))
    # the running maximum over numbers of batches, not rows: one small row for each batch
    upto = Window.orderBy("_now").rangeBetween(Window.unboundedPreceding, -2)
    marks = most.select("_now", (F.max("_m").over(upto) - lateness_ms).alias("_mark"))
    end = (F.floor(F.col("ts") / window_ms) + 1) * window_ms
    return events.join(marks, b == F.col("_now")).where(end <= F.col("_mark")).drop("_now", "_mark")


def late_messages(late: DataFrame) -> DataFrame:
    """Late events as (key, value) messages."""
    return late.select(F.col("tenant_id").cast("binary").alias("key"), F.to_json(F.struct("tenant_id", "entity_id", "ts")).cast("binary").alias("value"))


def anomaly_messages(anomalies: DataFrame) -> DataFrame:
    """Anomalies as (key, value) messages."""
    return anomalies.select(F.col("tenant_id").cast("binary").alias("key"), A.anomaly_json().cast("binary").alias("value"))


def anomaly_leg(events: DataFrame, cfg: A.DetectorConfig, window_ms: int, lateness_ms: int, sink: Callable[[DataFrame], object], checkpoint: str, once: bool = False) -> StreamingQuery:
    """The detector's anomalies into ``sink``, a function that gives a message stream's writer."""
    anomalies = stream_anomalies(events, cfg, window_ms, lateness_ms)
    return _start(sink(anomaly_messages(anomalies)).outputMode("append").queryName("anomalies"), checkpoint, once)


class MetricsListener(StreamingQueryListener):
    """Rows, batch time and rows that the watermark dropped, of every query."""

    def onQueryStarted(self, event) -> None:
        METRICS.inc("sm_queries_started_total")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or "query"
        METRICS.set("sm_last_batch_rows", p.numInputRows, query=name)
        METRICS.observe("sm_batch_seconds", p.batchDuration / 1000, query=name)
        METRICS.inc("sm_rows_read_total", p.numInputRows, query=name)
        METRICS.inc("sm_windows_total", sum(s.numRowsRemoved for s in p.stateOperators), query=name)  # windows that closed and left the state
        if p.sink.numOutputRows > 0:
            METRICS.inc("sm_rows_written_total", p.sink.numOutputRows, query=name)  # of the query ``anomalies``: the anomalies
        METRICS.inc("sm_late_rows_total", sum(s.numRowsDroppedByWatermark for s in p.stateOperators), query=name)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        METRICS.inc("sm_queries_ended_total")
