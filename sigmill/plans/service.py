"""Reads and governed queries as functions that return (status, body, headers); any HTTP layer can call them."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import DAY_PATTERN, TENANT_PATTERN, shift_day
from ..model import DEFAULT_TENANT, METRICS
from ..operators.serving import ServingTable, history_mean
from .guard import ALLOW, THROTTLE, Guard, Outcome

Reply = tuple[int, object, dict]


@dataclass
class Cache:
    """Documents by key until their time is over."""

    ttl: float = 60
    clock: Callable[[], float] = time.time
    held: dict[str, tuple[float, dict]] = field(default_factory=dict)

    @staticmethod
    def key(tenant: str, entity: str, day: str) -> str:
        return f"entity:{tenant}:{entity}:{day}"

    def get(self, key: str) -> dict | None:
        until, doc = self.held.get(key, (0, None))
        hit = doc is not None and until > self.clock()
        METRICS.inc("sm_cache_lookups_total", result="hit" if hit else "miss")
        return doc if hit else None

    def put(self, key: str, doc: dict) -> None:
        self.held[key] = self.clock() + self.ttl, doc

    def evict(self, keys: list[str]) -> None:
        for k in keys:
            self.held.pop(k, None)


class ReadApi:
    """Summary of an entity on a day (through the cache) and its history (past it); misses are not cached."""

    def __init__(self, serving: ServingTable, cache: Cache | None = None, today: Callable[[], str] = lambda: dt.datetime.now(dt.timezone.utc).date().isoformat()):
        self.serving, self.cache, self.today = serving, cache or Cache(), today
        serving.listeners.append(self._written)

    def _written(self, docs: DataFrame) -> None:
        """Evict what a write touched; only the keys that the cache holds are looked up among the documents."""
        held = [tuple(k.split(":", 1)[1].rsplit(":", 1)) for k in self.cache.held]
        if held:
            keys = docs.sparkSession.createDataFrame(held, "id string, day string")
            found = docs.select(F.concat_ws(":", "tenant_id", "entity_id").alias("id"), "day").join(F.broadcast(keys), ["id", "day"], "left_semi").distinct()
            self.cache.evict([f"entity:{r.id}:{r.day}" for r in found.collect()])

    def upserted(self, keys: list[tuple[str, str, str]]) -> None:
        """Evict (tenant, entity, day) keys that were written."""
        self.cache.evict([Cache.key(*k) for k in keys])

    def summary(self, entity: str, tenant: str = DEFAULT_TENANT, day: str | None = None) -> Reply:
        day = day or self.today()
        if not re.fullmatch(TENANT_PATTERN, tenant) or not re.fullmatch(DAY_PATTERN, day):
            return 422, {"detail": "tenant or day is not valid"}, {}
        key = Cache.key(tenant, entity, day)
        doc = self.cache.get(key)
        if doc is None:
            row = self.serving.get(day, tenant, entity).orderBy(F.desc("window_start")).first()
            if row is None:
                return 404, {"detail": "no such entity on that day"}, {}
            doc = row.asDict()
            self.cache.put(key, doc)
        return 200, doc, {}

    def history(self, entity: str, tenant: str = DEFAULT_TENANT, days: int = 7) -> Reply:
        if not re.fullmatch(TENANT_PATTERN, tenant) or not 1 <= days <= 90:
            return 422, {"detail": "tenant or days is not valid"}, {}
        last = self.today()
        rows = self.serving.mget([shift_day(last, -i) for i in range(days)], tenant, entity)
        total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), history_mean().alias("mean")).first()
        return 200, {"entity_id": entity, "tenant_id": tenant, "days": [r.asDict() for r in rows.orderBy("day").collect()], "n": total.n, "mean_score": total["mean"]}, {}


def scanned(frame: DataFrame) -> int:
    """Bytes of the files that an executed query's scans read, by their own metrics."""
    jvm, total = frame.sparkSession._jvm, 0
    pending = [frame._jdf.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            pending.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            pending.append(node.plan())
        elif name == "FileSourceScanExec":
            metric = node.metrics().get("filesSize")
            total += metric.get().value() if metric.isDefined() else 0
        else:
            children = jvm.scala.jdk.javaapi.CollectionConverters.asJava(node.children())
            pending.extend(children[i] for i in range(children.size()))
    return int(total)


class QueryService:
    """SQL behind the guard: 403 refused, 429 throttled, 502 failed; the slot is given back in every case.

    A reply holds at most ``max_rows`` rows and says in ``truncated`` whether there are more.
    """

    def __init__(self, guard: Guard, max_rows: int = 10_000):
        self.guard, self.max_rows = guard, max_rows

    def submit(self, sql: str, user: str | None = None, headers: dict | None = None) -> Reply:
        user = user or (headers or {}).get("X-User") or "anonymous"
        began = time.time()
        decision = self.guard.admit(user, sql)
        if decision.verdict == THROTTLE:
            return 429, asdict(decision), {"Retry-After": str(decision.retry_after_seconds)}
        if decision.verdict != ALLOW:
            return 403, asdict(decision), {}
        try:
            frame = self.guard.spark.sql(sql).limit(self.max_rows + 1)
            found = [list(r) for r in frame.collect()]
            rows = found[: self.max_rows]
            outcome = Outcome(decision.query_hash, "FINISHED", len(rows), scanned(frame), int((time.time() - began) * 1000))
            body = {"columns": frame.columns, "rows": rows, "truncated": len(found) > len(rows), "processed_bytes": outcome.processed_bytes, "decision": asdict(decision)}
            reply = 200, body, {}
        except Exception as e:
            outcome = Outcome(decision.query_hash, "FAILED", error=str(e)[:500], wall_ms=int((time.time() - began) * 1000))
            reply = 502, {"detail": str(e)[:500]}, {}
        finally:
            self.guard.release(user)
        METRICS.observe("sm_query_seconds", time.time() - began)
        METRICS.inc("sm_query_bytes_total", outcome.processed_bytes or 0)
        if self.guard.audit:
            self.guard.audit.record(outcome)
        return reply

    def policy(self) -> Reply:
        return 200, asdict(self.guard.policy), {}

    def decisions(self, limit: int = 50) -> Reply:
        if not 1 <= limit <= 1000:
            return 422, {"detail": "limit must be from 1 to 1000"}, {}
        return 200, self.guard.audit.tail(limit) if self.guard.audit else [], {}

    def summary(self) -> Reply:
        return 200, self.guard.audit.summary() if self.guard.audit else {}, {}

    def health(self) -> Reply:
        return 200, {"status": "ok"}, {}

    def metrics(self) -> Reply:
        return 200, METRICS.exposition(), {"Content-Type": "text/plain"}
