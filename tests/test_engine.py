"""The engine on small hand-made inputs with exact expected values."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sigmill.functions import codec
from sigmill.functions import scalars as S
from sigmill.model import EVENT, Metrics, Settings
from sigmill.operators import anomaly as A
from sigmill.operators import rollup as R
from sigmill.operators.serving import ServingTable
from sigmill.operators.tenancy import Quota, Router, list_indices
from sigmill.plans import capacity, guard, ops, service, shape
from sigmill.sources import archive, synthetic
from sigmill.sources.lake import Conflict, Lake
from sigmill.sources.stream import file_events
from sigmill.streaming import jobs

T1, DAY_MS = 1_788_393_600_000, 86_400_000
CORE = [
    ("ent-1", "review", 4.0, "web", 1_000), ("ent-1", "rating", 2.0, "mobile", 3_600_000), ("ent-1", "review", 5.0, "web", 7_200_000), ("ent-2", "click", 1.0, "partner", 500),
    ("ent-1", "review", 3.0, "web", 86_460_000), ("ent-2", "return", 0.0, "web", 86_490_000), ("ent-1", "review", 4.0, "web", 1_000),
]
TENANTS = [
    ("acme", "ent-1", "review", 4.0, 1_000), ("acme", "ent-1", "rating", 2.0, 5_000), ("acme", "ent-2", "review", 5.0, 1_000), ("beta", "ent-1", "review", 1.0, 1_000),
    ("beta", "ent-2", "review", 3.0, 1_000), ("beta", "ent-3", "review", 3.0, 1_000), ("gamma", "ent-1", "click", 0.5, 1_000), ("gamma", "ent-1", "click", 0.5, DAY_MS),
]


def event(entity, kind, score, source, at, tenant=None):
    ts = T1 + at
    return (S.make_event_id(entity, kind, source, ts, tenant or "default"), entity, kind, score, source, ts, tenant)


@pytest.fixture(scope="module")
def core(spark):
    return spark.createDataFrame([event(*r) for r in CORE], EVENT)


@pytest.fixture(scope="module")
def tenants(spark):
    return spark.createDataFrame([event(e, k, s, "web", at, t) for t, e, k, s, at in TENANTS], EVENT)


def test_core_rollup(core):
    docs = {(r.entity_id, r.day): r for r in R.events_to_documents(core).collect()}
    assert len(docs) == 4
    one = docs["ent-1", "2026-09-03"]
    assert (one.n, one.mean_score, one.min_score, one.max_score, one.last_score) == (3, 3.6667, 2.0, 5.0, 5.0)
    assert one.signal_types == ["rating", "review"] and one.sources == ["mobile", "web"] and one.tenant_id == "default"
    assert one.window_start == "2026-09-03T00:00:00Z" and one.window_end == "2026-09-04T00:00:00Z"
    assert docs["ent-2", "2026-09-04"].n == 1 and docs["ent-2", "2026-09-04"].stddev_score == 0.0


def test_event_id_on_both_sides(core):
    rows = core.withColumn("tenant_id", F.lit("default")).select("event_id", S.event_id().alias("b")).collect()
    assert all(r.event_id == r.b and len(r.b) == 20 for r in rows)


def test_codec(spark):
    e = dict(zip(EVENT.names, event("ent-1", "review", 4.5, "web", 5, "acme")))
    assert codec.decode(codec.encode(e)) == e
    assert codec.decode(codec.encode({**e, "tenant_id": None}))["tenant_id"] == "default"
    for poison in (None, b"", b"garbage", b"\xff\xff\xff", codec.encode({**e, "entity_id": ""}), codec.encode({**e, "ts": 0})):
        assert codec.decode(poison) is None


def test_window_stats_do_not_dedup(core):
    stats = A.window_stats(core, 60_000).collect()
    assert len(stats) == 6 and max((r.n, r.sum_score) for r in stats) == (2, 8.0)


def run(cfg, values):
    state, hits = A.State(), []
    for v in values:
        samples = state.samples
        state, hit = A.step(state, v, cfg)
        if hit:
            hits.append((samples, hit))
    return hits


def test_detector_cases():
    spike = A.DetectorConfig(history=10, min_stddev=0.01)
    quiet = [3.4, 3.6] * 10
    assert run(spike, quiet) == [] and [s for s, _ in run(spike, [*quiet, 9.0])] == [20]
    after = [*quiet, *[9.0] * 13, 3.5]
    assert [s for s, _ in run(spike, after)][0] == 20 and [s for s, _ in run(spike, after)][-1] == 33
    drift = [3.5 + 0.02 * i for i in range(40)]
    assert run(A.DetectorConfig(mode="ewma"), drift) == [] and len(run(A.DetectorConfig(mode="ewma"), [*drift, drift[-1] + 5])) == 1
    flat = [3.5] * 10 + [3.8, 4.5]
    assert len(run(A.DetectorConfig(threshold=6, min_stddev=0.1), flat)) == 1 and len(run(A.DetectorConfig(threshold=2, min_stddev=0.1), flat)) == 2
    hit = run(A.DetectorConfig(metric="event_rate"), [10 / 60] * 10 + [10.0])[0][1]
    assert round(hit[0], 6) == round(10 / 60, 6)
    for bad in ({"mode": "x"}, {"threshold": 0}, {"alpha": 2}, {"history": 0}):
        with pytest.raises(ValueError):
            A.DetectorConfig(**bad)


@pytest.mark.parametrize("mode", ["zscore", "ewma"])
def test_batch_detectors_are_the_step(spark, mode):
    rng = random.Random(1)
    rows, expected = [], []
    cfg = A.DetectorConfig(mode=mode, history=7, threshold=1.5)
    for e in range(5):
        values = [round(rng.gauss(3, 1), 3) for _ in range(40)]
        rows += [("t", f"e{e}", i * 1000, (i + 1) * 1000, 2, 2 * v, v, v) for i, v in enumerate(values)]
        expected += [(f"e{e}", i, round(h[2], 6)) for i, h in run(cfg, values)]
    stats = spark.createDataFrame(rows, "tenant_id string, entity_id string, window_start long, window_end long, n long, sum_score double, min_score double, max_score double")
    got = [(r.entity_id, r.samples, round(r.score, 6)) for r in A.detect(stats, cfg).collect()]
    assert sorted(got) == sorted(expected) and got
    one = json.loads(A.detect(stats, cfg).select(A.anomaly_json().alias("j")).first().j)
    assert list(one) == sorted(one)


def test_routing_and_quota(tenants):
    docs = R.events_to_documents(tenants)
    router = Router("signals", ["acme"], 4)
    assert docs.count() == 7
    admitted = Quota({"beta": 2}).admit(docs)
    routed = router.route(admitted)
    by = {r["index"]: r["count"] for r in routed.groupBy("index").count().collect()}
    assert by == {"signals-acme-2026-09-03": 2, "signals-2026-09-03": 3, "signals-2026-09-04": 1}
    assert {r.routing for r in routed.where("tenant_id = 'acme'").collect()} == {None}
    assert router.parse_index("signals-acme-2026-09-03") == ("acme", "2026-09-03") and router.parse_index("signals-other-2026-09-03") is None
    assert list_indices(["signals-1", "x"], "signals-*") == ["signals-1"]
    known = docs.where("tenant_id = 'beta' AND entity_id = 'ent-3'")
    got = {r.entity_id for r in Quota({"beta": 2}).admit(docs, known).where("tenant_id = 'beta'").collect()}
    assert got == {"ent-1", "ent-3"}


def test_serving_replaces(spark, core, tmp_path):
    t = ServingTable(spark, str(tmp_path / "serving"))
    docs = R.events_to_documents(core)
    assert t.read().count() == 0
    t.upsert(docs, 1, 0)
    t.upsert(docs.where("day = '2026-09-03'"), 2, 1)
    t.upsert(docs.where("day = '2026-09-03'"), 2, 1)
    assert t.raw().count() == 6 and t.count("2026-09-03") == 2
    t.refresh_day("2026-09-03")
    assert t.raw().count() == 4
    api = service.ReadApi(t, today=lambda: "2026-09-04")
    assert api.summary("ent-1", day="2026-09-03")[1]["n"] == 3 and api.summary("nobody")[0] == 404 and api.summary("ent-1", "NO")[0] == 422
    status, body, _ = api.history("ent-1", days=2)
    assert status == 200 and body["n"] == 4 and body["mean_score"] == 3.5
    assert api.history("ent-1", days=91)[0] == 422
    t.drop_day("2026-09-03")
    assert [r.day for r in t.partitions().collect()] == ["2026-09-04"]


def test_cache_expires():
    now = [0.0]
    c = service.Cache(10, lambda: now[0])
    c.put("k", {"a": 1})
    assert c.get("k") == {"a": 1}
    now[0] = 10
    assert c.get("k") is None
    c.put("k", {"a": 1})
    c.evict(["k"])
    assert c.get("k") is None


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(ValueError):
        lake.read()
    v0 = spark.createDataFrame([("2026-09-03", "t-0", "ent-1", 3.5, 10)], "day string, tenant_id string, entity_id string, mean_score double, n long")
    v1 = spark.createDataFrame([("2026-09-04", "t-0", "ent-1", 4.0, 12, 0.25)], "day string, tenant_id string, entity_id string, mean_score double, n long, stddev_score double")
    assert lake.write(v0) == 1
    with pytest.raises(ValueError):
        lake.write(v1)
    lake.write(v1, merge_schema=True)
    rows = {r.day: r.stddev_score for r in lake.read().collect()}
    assert rows == {"2026-09-03": None, "2026-09-04": 0.25}
    assert "stddev_score" not in lake.read(version=0).columns and lake.read(version=0).count() == 1
    assert [r.version for r in lake.history().collect()] == [1, 0]
    at = dt.datetime.fromtimestamp(lake.commit(0).timestamp_ms / 1000, dt.timezone.utc)
    assert lake.read(as_of=at).count() == 1
    assert lake.rewrite_day(v0.withColumn("n", F.lit(99).cast("long")), "2026-09-03") == 1
    assert lake.read(day="2026-09-03").first().n == 99 and lake.read().count() == 2 and lake.latest().operation == "REPLACE"
    with pytest.raises(ValueError):
        lake.rewrite_day(v0, "2026-09-09")
    other = Lake(spark, lake.path)
    other.store.create("_log/000000000003.json", "{}")
    lake._at = lambda *a: lake._manifest(2)
    with pytest.raises(Conflict):
        lake.write(v0)


def test_archive_compacts(spark, core, tmp_path):
    path = str(tmp_path / "archive")
    for _ in range(3):
        archive.write_archive(core, path)
    n = archive.read_archive(spark, path, "2026-09-03").count()
    assert archive.compact_day(spark, path, "2026-09-03") >= 3 and archive.compact_day(spark, path, "2020-01-01") == 0
    assert archive.compact_day(spark, path, "2026-09-03") == 1 and archive.read_archive(spark, path, "2026-09-03").count() == n == 15
    plan = archive.read_archive(spark, path, "2026-09-03")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_stream_is_batch(spark, core, tmp_path):
    core.coalesce(1).write.parquet(str(tmp_path / "in"))
    t = ServingTable(spark, str(tmp_path / "serving"))
    jobs.rollup_leg(file_events(spark, str(tmp_path / "in")), t, str(tmp_path / "ck"), quota=Quota({}, 5), once=True).awaitTermination()
    columns = ["tenant_id", "entity_id", "day", "n", "mean_score", "last_score"]
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert key(t.read()) == key(R.events_to_documents(core))


def test_late_leg(spark, tmp_path):
    leg = jobs.LateLeg(spark, str(tmp_path / "late"), 60_000, 5_000)
    make = lambda *ts: spark.createDataFrame([(str(t), "e", "view", 1.0, "web", t, None) for t in ts], EVENT)
    batches = [make(30_000), make(100_000), make(59_000), make(5_000, 200_000)]
    for k, b in enumerate(batches):
        leg(b, k)
        leg(b, k)
    late = spark.read.parquet(str(tmp_path / "late/late")).collect()
    assert [(r.ts, r.batch) for r in late] == [(5_000, 3)]
    both = batches[0].withColumn("b", F.lit(0))
    for k, b in enumerate(batches[1:], 1):
        both = both.union(b.withColumn("b", F.lit(k)))
    assert [r.ts for r in jobs.late_replay(both, "b", 60_000, 5_000).collect()] == [5_000]


def guarded(spark, tmp_path, **policy):
    if not spark.catalog.tableExists("signals_daily"):
        spark.createDataFrame([("2026-09-03", "t-0", 1.0), ("2026-09-04", "t-1", 2.0)], "day string, tenant_id string, mean_score double").createOrReplaceTempView("signals_daily")
    return guard.Guard(spark, guard.Policy(**policy), guard.Audit(str(tmp_path / "audit.jsonl")))


CASES = [
    ("SELECT count(*) FROM signals_daily WHERE day = '2026-09-03'", "ok"),
    ("SELECT count(*) FROM lake.signals.signals_daily WHERE day >= '2026-09-03'", "ok"),
    ("SELECT count(*) FROM signals_daily WHERE day BETWEEN '2026-09-03' AND '2026-09-04'", "ok"),
    ("SELECT a.n FROM x a JOIN signals_daily b ON a.day = b.day", "ok"),
    ("SELECT * FROM signals_daily WHERE day = '2026-09-03'", "unbounded_select_star"),
    ("SELECT * FROM signals_daily WHERE day = '2026-09-03' LIMIT 3", "ok"),
    ("SELECT count(*) FROM signals_daily", "missing_partition_predicate"),
    ("SELECT count(*) FROM signals_daily WHERE day <> '2026-09-03'", "missing_partition_predicate"),
    ("SELECT count(*) FROM signals_daily WHERE upper(day) = '2026-09-03'", "missing_partition_predicate"),
    ("SELECT count(*) FROM signals_daily WHERE tenant_id IN (SELECT tenant_id FROM signals_daily)", "missing_partition_predicate"),
    ("SELECT 1 FROM x CROSS JOIN y", "cross_join"),
    ("SELECT 1 FROM x, y", "cross_join"),
    ("SELECT 1 FROM x JOIN y USING (k)", "ok"),
    ("DROP TABLE signals_daily", "statement_not_allowed"),
    ("INSERT INTO signals_daily SELECT 1", "statement_not_allowed"),
    ("SHOW TABLES", "statement_not_allowed"),
    ("SELECT 1; DROP TABLE x", "multi_statement"),
    ("SELECT ';' AS a", "ok"),
    ("SELEC 1", "unparsable"),
    ("", "unparsable"),
    ("EXPLAIN SELECT * FROM signals_daily", "ok"),
    ("SELECT 1 FROM a UNION SELECT 2 FROM b", "ok"),
    ("WITH c AS (SELECT day FROM signals_daily) SELECT count(*) FROM c", "missing_partition_predicate"),
]


@pytest.mark.parametrize("sql, rule", CASES)
def test_guard_rules(spark, tmp_path, sql, rule):
    assert guarded(spark, tmp_path).decide("u", sql).rule == rule


def test_guard_slots_and_audit(spark, tmp_path):
    g = guarded(spark, tmp_path, max_concurrent_per_user=1)
    ok = CASES[0][0]
    assert g.admit("u", ok).verdict == "allow" and g.admit("u", ok).verdict == "throttle" and g.admit("v", ok).verdict == "allow"
    g.release("u")
    assert g.admit("u", ok).verdict == "allow" and g.admit("u", "SHOW TABLES").verdict == "reject"
    with open(g.audit.path) as f:
        assert len(f.readlines()) == 5
    assert g.audit.summary()["by_verdict"] == {"allow": 3, "throttle": 1, "reject": 1}
    big = guard.Guard(spark, guard.Policy(max_scan_bytes=10), estimator=lambda sql: 11)
    assert big.decide("u", ok).rule == "scan_budget_exceeded"
    tight = guard.Policy.from_json('{"tables": {"signals_daily": {"partition_columns": ["day"], "max_scan_bytes": 7}}, "max_scan_bytes": 100}')
    assert tight.budget(shape.analyze(spark, ok)) == 7


def test_query_service(spark, tmp_path):
    s = service.QueryService(guarded(spark, tmp_path, max_concurrent_per_user=1))
    assert s.submit(CASES[0][0])[1]["rows"] == [[1]]
    assert s.submit("SELECT count(*) FROM signals_daily")[0] == 403
    assert s.submit("SELECT nope FROM nowhere")[0] == 502 and s.guard.admitted("anonymous") == 0
    s.guard.admit("u", "SELECT 1")
    status, _, headers = s.submit("SELECT 1", "u")
    assert status == 429 and headers["Retry-After"] == "5"
    assert s.decisions(0)[0] == 422 and len(s.decisions(2)[1]) == 2 and s.summary()[1]["total"] == 5 and s.health()[0] == 200 and "sm_guard" in s.metrics()[1]


def test_rollover():
    router, catalog = Router("signals", ["acme"]), ops.Catalog()
    days = [S.shift_day("2026-09-10", -i) for i in range(10)]
    catalog.indices = {router.index_for(t, d) for t in ("default", "acme") for d in days} | {"foreign", "signals-other-2026-09-01"}
    catalog.aliases = {"signals": {f"signals-{d}" for d in days}, "signals-acme": {f"signals-acme-{d}" for d in days}}
    done = ops.rollover(catalog, router, "2026-09-10", 7)
    assert sorted(done.created) == ["signals-2026-09-11", "signals-acme-2026-09-11"] and len(done.deleted) == 6
    assert catalog.aliases["signals"] == {f"signals-{S.shift_day('2026-09-10', i)}" for i in range(-6, 2)}
    assert {"foreign", "signals-other-2026-09-01"} <= catalog.indices
    assert ops.rollover(catalog, router, "2026-09-10", 7) == ops.Rollover()


def test_sla_and_healer():
    slos = ops.parse_slos("archive:3600:1,lake:7200:100:backfill,serving:3600:0:none")
    now = 100_000_000
    readings = [ops.Freshness("archive", "d", None), ops.Freshness("lake", "d", now - 10_000_000, 500), ops.Freshness("serving", "d", now - 60_000, 1), ops.Freshness("x", "d", None)]
    assert [b.kind for b in ops.check(readings, slos, now)] == ["missing", "stale"]
    assert [b.kind for b in ops.check([ops.Freshness("lake", "d", now + 5, 42)], slos, now)] == ["incomplete"]
    clock, done = [0.0], []
    healer = ops.Healer(slos, {"backfill": lambda b: done.append(b) or 5}, lambda: clock[0])
    bad = [ops.Freshness("lake", "d", None)]
    seen = []
    for step in (0, 30, 60, 60, 60):
        clock[0] += step
        seen.append(ops.sweep(bad, slos, healer, now)["actions"][0]["action"])
    assert seen == ["backfill", "deferred", "backfill", "escalate", "escalate"] and len(done) == 2
    ops.sweep([ops.Freshness("lake", "d", now, 500)], slos, healer, now)
    assert ops.sweep(bad, slos, healer, now)["healed"] == 1
    broken = ops.Healer(slos, {"backfill": lambda b: 1 / 0}, lambda: 0.0)
    assert not broken.heal(ops.Breach("lake", "d", "missing", None, 0)).ok
    assert ops.Healer(slos, {}).heal(ops.Breach("serving", "d", "missing", None, 0)).action == "none"


def test_daily_run(spark, core, tmp_path):
    cfg = Settings(archive_dir=str(tmp_path / "a"), serving_path=str(tmp_path / "s"), lake_path=str(tmp_path / "l"), sla="archive:999999999:1,lake:3600:1,serving:3600")
    archive.write_archive(core, cfg.archive_dir)
    report = ops.run_daily(spark, cfg, "2026-09-03", ops.Catalog(), Router())
    assert report["rows"] == 2 and report["sla"]["breaches"] == [] and report["rollover"]["created"] == ["signals-2026-09-03", "signals-2026-09-04"]
    again = ops.run_daily(spark, cfg, "2026-09-03", ops.Catalog(), Router())
    assert again["rows"] == 2 and Lake(spark, cfg.lake_path).read().count() == 2
    with pytest.raises(AssertionError):
        ops.verify_day(ServingTable(spark, cfg.serving_path), "2026-09-03", 3)


def test_capacity(spark):
    p = capacity.plan(capacity.Workload(20_000, 2_000_000, 30, 1, 337.0, 20, 0.4))
    assert p["total_shards"] == 21 * 31 * 2 == 1302 and p["bottleneck"] == "ingest" and p["data_nodes"] == p["nodes_by_ingest"]
    with pytest.raises(ValueError):
        capacity.plan(capacity.Workload(1, 0))
    assert capacity.plan(capacity.Workload(1, 1))["bottleneck"] == "replica floor"


def test_synthetic_events(spark):
    e = synthetic.synth_events(spark, 2000, tenants=4)
    assert e.count() == 2000 and 30 < 2000 - e.select("event_id").distinct().count() < 200
    assert e.exceptAll(synthetic.synth_events(spark, 2000, tenants=4)).count() == 0


def test_metrics_and_settings(monkeypatch):
    m = Metrics()
    m.inc("a", 2, k="v")
    m.set("b", 1)
    assert m.exposition() == 'a{k="v"} 2\nb 1\n'
    monkeypatch.setenv("SM_RETENTION_DAYS", "9")
    assert Settings.from_env().retention_days == 9
    assert S.human_bytes(None) == "unknown" and S.human_bytes(1536) == "1.5 KiB" and S.parse_pairs("a=1, b=2") == {"a": 1, "b": 2}


DUCK = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_queries_agree_with_sql(spark, sf):
    import duckdb

    from sigmill import queries

    con = duckdb.connect()
    for t in DUCK:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    wrong = []
    norm = lambda rows: sorted(repr([float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r]) for r in rows)
    for name, sql in queries.oracle_sql().items():
        got = queries.queries()[name](spark, sf)
        columns = sorted(got.columns)
        want = con.sql(sql)
        if sorted(want.columns) != columns or norm(map(tuple, got.select(*columns).collect())) != norm(want.select(*(f'"{c}"' for c in columns)).fetchall()):
            wrong.append(name)
    assert wrong == []


def test_entry_and_rows_only_queries(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    for name in ("anomaly_json", "archive_freshness", "doc_bytes", "guard_shapes", "route_documents", "routing_fanout", "routing_key", "scan_estimate", "synth_events"):
        assert e.queries()[name](spark, sf).count() > 0
    sizes = [r.bytes for r in e.queries()["scan_estimate"](spark, sf).orderBy("predicate").collect()]
    assert sizes[0] > sizes[1] > 0
    assert os.path.exists(sf)
