"""Writers, jobs and services end to end on small inputs."""

import json
import random
import threading
import urllib.error
import urllib.request

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigmill import jobs as J
from sigmill.functions import codec
from sigmill.functions import scalars as S
from sigmill.model import EVENT, Metrics, Settings
from sigmill.operators import anomaly as A
from sigmill.operators import rollup as R
from sigmill.operators.serving import ServingTable
from sigmill.operators.tenancy import Quota, Router
from sigmill.plans import guard, http, ops, service
from sigmill.sources import archive, sinks, synthetic
from sigmill.sources.fs import Store
from sigmill.sources.indices import IndexStore
from sigmill.sources.lake import Lake
from sigmill.sources.stream import file_events
from sigmill.streaming import jobs

T1 = 1_788_393_600_000


@pytest.fixture(scope="module")
def events(spark):
    rows = [(f"{t}-{k}", f"e{k % 5}", "click", float(k % 7), "web", T1 + k * 3_600_000, t) for t in ("acme", "beta", "gamma") for k in range(40)]
    return spark.createDataFrame(rows, EVENT)


@pytest.fixture
def cfg(tmp_path):
    p = lambda x: str(tmp_path / x)
    return Settings(archive_dir=p("archive"), checkpoint_dir=p("state"), lake_path=p("lake"), serving_path=p("serving"), index_path=p("indices"), dedicated_tenants="acme", routing_partitions=2)


def test_wire_parser_is_the_message_parser():
    rng, rows = random.Random(1), []
    for _ in range(3000):
        e = {
            "event_id": rng.choice([None, "", "abc"]), "entity_id": rng.choice(["", "e1", "ünï"]), "signal_type": rng.choice([None, "click"]), "score": rng.choice([None, 1.5, -2.0]),
            "source": "web", "ts": rng.choice([0, -5, 12345678901234, 1]), "tenant_id": rng.choice([None, "", "t"]),
        }
        m, k = codec.encode(e, derive=False), rng.random()
        if k < 0.1:
            m = m[: rng.randrange(len(m) + 1)]
        elif k < 0.2:
            m = bytes(rng.randrange(256) for _ in range(rng.randrange(30)))
        elif k < 0.25:
            m += b"\x58\x05\x65abcd\x61abcdefgh\x6a\x02zz"  # unknown fields of every kind
        elif k < 0.28:
            m += b"\x73\x74"  # a group
        elif k < 0.3:
            m += m  # the last value wins
        rows.append(None if k > 0.99 else m)
    key = lambda e: repr(sorted(e.items()))
    want = sorted(key(e) for e in map(codec.decode, rows) if e)
    assert sorted(key(codec.with_id(e)) for e in codec.parse(pa.array(rows, pa.binary())).to_pylist()) == want and len(want) > 500
    good = [r for r in rows if r and codec.decode(r)]  # without a row that needs the general parser, and without any row
    assert len(codec.parse(pa.array(good, pa.binary()))) == len(good) and len(codec.parse(pa.array([], pa.binary()))) == 0


def test_missing_ids_are_derived(spark):
    e = {"entity_id": "e", "signal_type": "click", "source": "web", "ts": 5, "score": 1.0}
    raw = spark.createDataFrame([(codec.encode(e | {"ts": t}, derive=False),) for t in (5, 6, 6)], "value binary")
    got = codec.decode_events(raw)
    assert {r.event_id for r in got.collect()} == {S.make_event_id("e", "click", "web", t) for t in (5, 6)}
    assert R.dedup(R.with_event_time(got)).count() == 2
    assert codec.decode(codec.encode(e))["event_id"] == S.make_event_id("e", "click", "web", 5)


def test_dedup_keeps_the_earliest(spark):
    rows = [("a", "e", "x", 2.0, "w", 10, "t"), ("a", "e", "x", 1.0, "w", 5, "t"), (None, "e", "x", 1.0, "w", 5, "t"), (None, "e", "x", 1.0, "w", 5, "t"), ("b", "e", "x", None, "w", 5, "t")]
    got = R.dedup(R.with_event_time(spark.createDataFrame(rows, EVENT))).select("event_id", "score").collect()
    assert sorted((r.event_id or "", r.score) for r in got if r.event_id != "b") == [("", 1.0), ("", 1.0), ("a", 1.0)] and len(got) == 4


def test_streamed_archive_survives_compaction(spark, events, tmp_path):
    here, path, state = (str(tmp_path / x) for x in ("in", "archive", "state"))
    key = lambda df: sorted(tuple(r) for r in df.select("event_id", "ts").collect())
    events.where("ts % 7200000 = 0").coalesce(1).write.mode("append").parquet(here)
    jobs.archive_leg(file_events(spark, here), path, state, once=True).awaitTermination()
    days = [d[4:] for d in Store(spark, path).list("") if d.startswith("day=")]
    before = key(archive.read_archive(spark, path))
    for day in days:
        assert archive.compact_day(spark, path, day) >= 1
    assert key(archive.read_archive(spark, path)) == before
    events.where("ts % 7200000 <> 0").coalesce(1).write.mode("append").parquet(here)
    jobs.archive_leg(file_events(spark, here), path, state, once=True).awaitTermination()
    for day in days:
        archive.compact_day(spark, path, day)
    assert key(archive.read_archive(spark, path)) == key(events)
    # the same batch again, whole or broken off, adds nothing
    archive.append_batch(events, path, "bx-0")
    once = archive.read_archive(spark, path).count()
    archive.append_batch(events, path, "bx-0")
    Store(spark, path).delete("_batches/bx-0")
    assert all(archive.compact_day(spark, path, d) for d in days)  # leaves the files of a batch that is not whole
    archive.append_batch(events, path, "bx-0")
    assert archive.read_archive(spark, path).count() == once == 2 * events.count()


def test_compaction_goes_on_where_it_broke_off(spark, events, tmp_path):
    path, day = str(tmp_path / "archive"), "2026-09-03"
    for _ in range(2):
        archive.write_archive(events, path)
    store, n = Store(spark, path), archive.read_archive(spark, path, day).count()
    old = [f for f in store.list(f"day={day}") if f.endswith(".parquet")]
    archive.read_archive(spark, path, day).coalesce(1).write.parquet(f"{path}/_new-{day}")
    store.create(f"_compact-{day}.json", json.dumps({"old": old, "new": [f for f in store.list(f"_new-{day}") if f.endswith(".parquet")]}))
    store.delete(f"day={day}/{old[0]}")  # broke off here
    assert archive.compact_day(spark, path, day) == 1 and archive.read_archive(spark, path, day).count() == n


def test_files_appear_whole(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.create("log/1.json", "one") and not store.create("log/1.json", "two")
    assert store.read("log/1.json") == "one" and [n for n in store.list("log") if not n.startswith(".")] == ["1.json"]


def test_lake_batches_and_newest(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = lambda n: spark.createDataFrame([("2026-09-03", "a", n), ("2026-09-04", "b", n)], "day string, entity_id string, n long")
    assert lake.write(rows(1), batch="s-0") == 2 and lake.write(rows(9), batch="s-0") == 0 and lake.write(rows(2), batch="s-1") == 2
    assert lake.read().count() == 4 and [r.n for r in lake.read(newest_of=("day", "entity_id")).collect()] == [2, 2]
    lake.register("lake_view_of_rows", permanent=True)
    assert spark.sql("SELECT sum(n) AS n FROM lake_view_of_rows").first().n == 6
    spark.sql("DROP VIEW lake_view_of_rows")


def test_routed_documents(spark, events, tmp_path):
    store, router = IndexStore(spark, str(tmp_path / "indices")), Router("signals", ["acme"], 2)
    docs = R.events_to_documents(events)
    written = store.write(docs, router, Quota({"beta": 2}), 1, 0)
    store.write(docs, router, Quota({"beta": 2}), 2, 1)
    assert written["signals-acme-2026-09-03"] == 5 and written["signals-2026-09-03"] == 7
    assert store.count("signals-2026-09-03") == 7 and store.count("signals-acme-*") == 10 and store.count("nothing") == 0
    assert {r.routing for r in store.read("signals-acme-2026-09-03").collect()} == {None}
    assert store.read("signals-2026-09-03", routing="gamma#0").count() + store.read("signals-2026-09-03", routing="gamma#1").count() == 5
    store.drop("signals-2026-09-03")
    assert store.names("signals-2026*") == ["signals-2026-09-04"]


def test_sinks_by_name(spark, events, cfg):
    docs = R.events_to_documents(events)
    for kind in ("serving", "indices"):
        sinks.open_sink(spark, cfg, kind).upsert(docs, 1, 0)
    assert ServingTable(spark, cfg.serving_path).read().count() == IndexStore(spark, cfg.index_path).count() == docs.count()
    said = []
    sinks.Console(spark, "", said.append).upsert(docs, 1)
    assert len(said) == docs.count() and json.loads(said[0])["tenant_id"]
    with pytest.raises(ValueError):
        sinks.open_sink(spark, cfg, "nowhere")


def test_jobs(spark, events, cfg, tmp_path):
    here, out = str(tmp_path / "in"), str(tmp_path / "out")
    events.coalesce(1).write.parquet(here)
    run = lambda *args: J.start(list(args), spark, cfg)
    run("archive", "--source", here, "--once").awaitTermination()
    assert archive.read_archive(spark, cfg.archive_dir).count() == 120
    assert run("roll", "--mode", "batch", "--day", "2026-09-03")["rows"] == 15
    run("roll", "--source", here, "--sink", "indices", "--lake", cfg.lake_path, "--once").awaitTermination()
    assert IndexStore(spark, cfg.index_path).count() == Lake(spark, cfg.lake_path).read(newest_of=jobs.LAKE_KEY).count() == 30
    assert run("produce", "--n", "50", "--out", out) == {"events": 50}
    assert run("decode", "--source", out, "--out", str(tmp_path / "decoded")) == {"events": 50}
    report = run("daily", "--day", "2026-09-03")
    again = run("daily", "--day", "2026-09-04")
    assert report["rows"] == 15 and set(report["rollover"]["created"]) >= {"signals-acme-2026-09-03"} and "signals-2026-09-04" not in again["rollover"]["created"]
    messages = jobs.late_messages(events).union(sinks.encode_events(events).select("key", "value"))
    assert messages.columns == ["key", "value"] and json.loads(bytes(messages.first()["value"]))["entity_id"].startswith("e")


def test_anomaly_job_writes_messages(spark, cfg, tmp_path):
    here, out = str(tmp_path / "in"), str(tmp_path / "out")
    value = lambda k: 12.0 if k == 14 else 3.5 + 0.1 * (k % 2)
    rows = [(str(k), "e", "x", value(k), "w", T1 + k * 60_000, "t") for k in range(15)] + [("f", "f", "x", 1.0, "w", T1 + 10**8, "t")]
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(here)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        J.start(["anomalies", "--source", here, "--out", out, "--once"], spark, cfg).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    hits = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert [h["value"] for h in hits] == [12.0] and hits[0]["samples"] == 14


def test_detectors_at_another_threshold(spark):
    assert A.ewma_reach(1.0) == 1 and 0.7 ** A.ewma_reach(0.3) < 2**-53
    cfg = A.DetectorConfig(mode="ewma", threshold=3.0, alpha=0.2)
    rows = [("t", "e", k * 10, k * 10 + 10, 1, float(v), float(v), float(v)) for k, v in enumerate([1, 1, 1, 1, 1, 1, 9, 1, 1, 1.4])]
    stats = spark.createDataFrame(rows, "tenant_id string, entity_id string, window_start long, window_end long, n long, sum_score double, min_score double, max_score double")
    strict, loose = (A.detect(stats, cfg.with_threshold(t)).count() for t in (100.0, 0.01))
    assert strict == 1 and loose > 1


def test_cache_is_evicted_by_writes(spark, events, tmp_path):
    t = ServingTable(spark, str(tmp_path / "serving"))
    docs = R.events_to_documents(events)
    t.upsert(docs, 1, 0)
    api = service.ReadApi(t)
    assert api.summary("e1", "acme", "2026-09-03")[1]["n"] == api.summary("e1", "acme", "2026-09-03")[1]["n"] and len(api.cache.held) == 1
    t.upsert(docs.where("tenant_id = 'beta'"), 2, 1)
    assert len(api.cache.held) == 1
    t.upsert(docs.withColumn("n", F.lit(99).cast("long")), 3, 2)
    assert not api.cache.held and api.summary("e1", "acme", "2026-09-03")[1]["n"] == 99


def test_governed_sql_is_measured(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.write(spark.range(1000).select(F.concat(F.lit("2026-09-0"), (F.col("id") % 2 + 3).cast("string")).alias("day"), F.col("id").alias("n")))
    lake.register("measured_daily")
    g = guard.Guard(spark, guard.Policy(tables={"measured_daily": guard.TablePolicy(("day",))}), guard.Audit())
    s = service.QueryService(g, max_rows=10)
    status, body, _ = s.submit("SELECT n FROM measured_daily WHERE day = '2026-09-03'")
    assert status == 200 and len(body["rows"]) == 10 and body["truncated"] and 0 < body["processed_bytes"] <= body["decision"]["estimated_bytes"]
    assert g.audit.summary()["actual_bytes_scanned"] == body["processed_bytes"]
    assert not s.submit("SELECT count(*) AS n FROM measured_daily WHERE day = '2026-09-03'")[1]["truncated"]


def test_http(spark, events, tmp_path):
    t = ServingTable(spark, str(tmp_path / "serving"))
    t.upsert(R.events_to_documents(events), 1, 0)
    service_of = service.QueryService(guard.Guard(spark, audit=guard.Audit()))
    for routes, calls in (
        (http.read_routes(service.ReadApi(t)), [("/healthz", 200), ("/tenants/acme/entities/e1?day=2026-09-03", 200), ("/entities/nobody", 404), ("/tenants/NO/entities/e", 422), ("/entities/e1/history?days=x", 422), ("/nowhere", 404), ("/metrics", 200)]),
        (http.query_routes(service_of), [("/v1/policy", 200), ("/v1/decisions?limit=0", 422), ("/v1/summary", 200)]),
    ):
        server = http.serve(routes)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        url = f"http://127.0.0.1:{server.server_address[1]}"

        def call(path, body=None, url=url):
            try:
                with urllib.request.urlopen(urllib.request.Request(url + path, body, method="GET" if body is None else "POST")) as r:
                    return r.status, r.read()
            except urllib.error.HTTPError as e:
                return e.code, e.read()

        try:
            assert [call(p)[0] for p, _ in calls] == [s for _, s in calls]
            if "POST /v1/queries" in routes:
                assert json.loads(call("/v1/queries", b'{"sql": "SELECT 1 AS a", "user": "u"}')[1])["rows"] == [[1]]
                assert call("/v1/queries", b'{"sql": "SHOW TABLES"}')[0] == 403 and call("/v1/queries", b"{")[0] == 422 and call("/v1/queries", b"{}")[0] == 422
        finally:
            server.shutdown()
            server.server_close()


def test_tries_outlive_the_process(spark, tmp_path):
    store, slos = Store(spark, str(tmp_path)), [ops.Slo("lake", 60, max_attempts=2, backoff_seconds=0)]
    bad = ops.Breach("lake", "d", ops.STALE, 99.0, 1)
    seen = [ops.Healer(slos, {"backfill": lambda b: 1}, lambda: 5.0, store).heal(bad).action for _ in range(3)]
    assert seen == ["backfill", "backfill", "escalate"]
    ops.Healer(slos, {}, store=store).settle([("lake", "d")])
    assert ops.Healer(slos, {"backfill": lambda b: 1}, lambda: 5.0, store).heal(bad).attempt == 1


def test_histograms():
    m = Metrics()
    with m.timed("t", k="v"):
        pass
    m.observe("h", 7)
    text = m.exposition()
    assert 'h_bucket{le="10"} 1' in text and 'h_bucket{le="5"}' not in text and "h_sum 7" in text and 't_count{k="v"} 1' in text


def test_synthetic_rates(spark):
    assert synthetic.synth_events(spark, 10).count() == 10
