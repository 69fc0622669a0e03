"""The named queries of the engine's operators, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import codec
from .functions import scalars as S
from .model import EVENT, events_of, redelivered
from .operators import anomaly as A
from .operators import rollup as R
from .operators.serving import ServingTable, history_mean, newest, to_doc, to_row
from .operators.tenancy import Quota, Router
from .plans import capacity, guard, ops, shape
from .sources import archive, synthetic
from .sources.fs import scratch
from .sources.indices import IndexStore
from .sources.lake import Lake
from .sources.stream import file_events
from .streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DAY_MS, WINDOW_MS = 86_400_000, 6 * 3_600_000
DAY = "2024-01-05"
QUOTA = Quota({"t-0": 20, "t-1": 0}, 10)
ROUTER = Router("signals", ["t-1"], 4)
ZSCORE = A.DetectorConfig(history=30, min_samples=5, threshold=3.0)
EWMA = A.DetectorConfig(mode="ewma")

# Common tables of the SQL side: events in the engine's schema, their documents, window statistics.
_EV = """ev AS (SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS entity_id, event_type AS signal_type, value AS score,
  CASE (json_extract_string(props, '$.k')::INT % 3) WHEN 0 THEN 'web' WHEN 1 THEN 'mobile' ELSE 'partner' END AS source,
  epoch_us(ts) // 1000 AS ts, 't-' || (user_id % 4) AS tenant_id, strftime(ts, '%Y-%m-%d') AS day FROM events)"""
_DOCS = f"""{_EV}, docs AS (SELECT tenant_id, entity_id, day, count(*) AS n, round(avg(score), 4) AS mean_score, min(score) AS min_score, max(score) AS max_score,
  round(coalesce(stddev_pop(score), 0), 4) AS stddev_score, arg_max(score, ts) AS last_score, max(ts) AS last_ts,
  array_to_string(list_sort(list(DISTINCT signal_type)), ',') AS signal_types, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
  day || 'T00:00:00Z' AS window_start, strftime(day::DATE + 1, '%Y-%m-%d') || 'T00:00:00Z' AS window_end FROM ev GROUP BY tenant_id, entity_id, day)"""
_STATS = f"""{_EV}, ws AS (SELECT tenant_id, entity_id, (ts // {WINDOW_MS}) * {WINDOW_MS} AS window_start, (ts // {WINDOW_MS} + 1) * {WINDOW_MS} AS window_end,
  count(*) AS n, sum(score) AS sum_score, min(score) AS min_score, max(score) AS max_score FROM ev GROUP BY ALL)"""
# crc32 of ASCII text, a byte at a time by the table of the reflected polynomial; the tenant's routing buckets by it.
_CRC = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
entities AS (SELECT entity_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(entity_id, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: xor(c // 256, crc.t[(xor(c, b) % 256) + 1]))) AS crc FROM (SELECT DISTINCT entity_id FROM ev), crc)"""
_ROUTED = """CASE WHEN tenant_id = 't-1' THEN 'signals-t-1-' || day ELSE 'signals-' || day END AS "index",
  CASE WHEN tenant_id <> 't-1' THEN tenant_id || '#' || (crc % 4) END AS routing"""
_DOC_COLUMNS = "tenant_id, entity_id, n, mean_score, min_score, max_score, stddev_score, last_score, last_ts, signal_types, sources, window_start, window_end, day"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.events_to_documents(redelivered(events_of(spark, sf_dir)))


def flat(docs: DataFrame) -> DataFrame:
    """Lists as joined text."""
    return docs.withColumns({c: F.array_join(c, ",") for c in ("signal_types", "sources") if c in docs.columns})


# -- projections, dedup, rollup


@query(f"WITH {_DOCS} SELECT {_DOC_COLUMNS} FROM docs")
def daily_rollup(spark, sf_dir):
    return flat(documents(spark, sf_dir))


@query(f"WITH {_EV} SELECT event_id, tenant_id, day, ts AS event_ms FROM ev")
def event_time_projection(spark, sf_dir):
    return R.with_event_time(events_of(spark, sf_dir)).select("event_id", "tenant_id", "day", F.unix_millis("event_time").alias("event_ms"))


@query(f"WITH {_EV} SELECT event_id, tenant_id, entity_id, score, ts FROM ev")
def dedup_events(spark, sf_dir):
    return R.dedup(R.with_event_time(redelivered(events_of(spark, sf_dir)))).select("event_id", "tenant_id", "entity_id", "score", "ts")


@query(f"WITH {_EV} SELECT substr(sha1(tenant_id || '|' || entity_id || '|' || signal_type || '|' || source || '|' || ts), 1, 20) AS event_id, count(*) AS n FROM ev GROUP BY ALL")
def decode_missing_ids(spark, sf_dir):
    """Messages without an id get one that they share with their redeliveries only."""
    raw = codec.encode_events(events_of(spark, sf_dir).withColumn("event_id", F.lit("")), derive=False)
    return codec.decode_events(raw).groupBy("event_id").agg(F.count("*").alias("n"))


@query()
def decode_events(spark, sf_dir):
    raw = codec.encode_events(events_of(spark, sf_dir))
    poison = spark.createDataFrame([(None, bytearray(b"garbage")), (None, bytearray(b"\xff\xff\xff")), (None, bytearray(b"")), (None, None)], "key binary, value binary")
    return codec.decode_events(raw.union(poison))


SQL["decode_events"] = f"WITH {_EV} SELECT event_id, entity_id, signal_type, score, source, ts, tenant_id FROM ev"


@query(f"WITH {_DOCS} SELECT {_DOC_COLUMNS} FROM docs")
def doc_row_roundtrip(spark, sf_dir):
    return flat(to_doc(to_row(documents(spark, sf_dir))))


@query(f"WITH {_EV} SELECT tag, count(*) AS n FROM (SELECT 'a' AS tag FROM ev WHERE signal_type = 'click' UNION ALL SELECT 'b' FROM ev WHERE signal_type = 'view') GROUP BY tag")
def tagged_union(spark, sf_dir):
    e = events_of(spark, sf_dir)
    both = e.where("signal_type = 'click'").withColumn("tag", F.lit("a")).unionByName(e.where("signal_type = 'view'").withColumn("tag", F.lit("b")))
    return both.groupBy("tag").agg(F.count("*").alias("n"))


@query()
def doc_bytes(spark, sf_dir):
    return (d := documents(spark, sf_dir)).agg(F.avg(R.json_bytes(d)).alias("mean_bytes"))


# -- scalars


@query(f"WITH {_EV} SELECT event_id AS id, substr(sha1(tenant_id || '|' || entity_id || '|' || signal_type || '|' || source || '|' || ts), 1, 20) AS event_hash FROM ev")
def event_id_hash(spark, sf_dir):
    return events_of(spark, sf_dir).select(F.col("event_id").alias("id"), S.event_id().alias("event_hash"))


@query("SELECT event_id, substr(sha1(trim(regexp_replace('SELECT  ' || event_type || '  FROM   t', '\\s+', ' ', 'g'))), 1, 16) AS query_hash FROM events")
def query_hash(spark, sf_dir):
    sql = F.concat(F.lit("SELECT  "), "event_type", F.lit("  FROM   t"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", S.query_hash(sql).alias("query_hash"))


@query(f"WITH {_EV}, {_CRC} SELECT event_id, {_ROUTED} FROM ev JOIN entities USING (entity_id)")
def routing_key(spark, sf_dir):
    return ROUTER.route(R.with_event_time(events_of(spark, sf_dir))).select("event_id", "index", "routing")


@query(f"WITH {_EV} SELECT event_id, tenant_id || ':' || entity_id || ':x' AS doc_id, tenant_id AS tenant, entity_id || ':x' AS entity FROM ev")
def doc_id_split(spark, sf_dir):
    d = events_of(spark, sf_dir).withColumn("doc_id", F.concat(S.doc_id(), F.lit(":x")))
    return d.select("event_id", "doc_id", S.doc_tenant(F.col("doc_id")).alias("tenant"), S.doc_entity(F.col("doc_id")).alias("entity"))


@query(
    f"""WITH {_EV} SELECT DISTINCT CASE WHEN tenant_id = 't-1' THEN 'signals-t-1-' || day ELSE 'signals-' || day END AS "index", day,
    CASE WHEN tenant_id = 't-1' THEN 't-1' END AS tenant FROM ev"""
)
def index_names(spark, sf_dir):
    i = ROUTER.route(R.with_event_time(events_of(spark, sf_dir))).select("index").distinct()
    return i.select("index", S.index_day(F.col("index")).alias("day"), S.index_tenant(F.col("index"), "signals").alias("tenant"))


@query(f"""WITH {_EV} SELECT DISTINCT 'signals-' || day AS "index" FROM ev WHERE day LIKE '2024-01-1%' AND tenant_id <> 't-1'""")
def index_list(spark, sf_dir):
    i = ROUTER.route(R.with_event_time(events_of(spark, sf_dir))).select("index").distinct()
    return i.where(F.col("index").rlike(r"^signals-2024-01-1\d$"))


@query(f"WITH {_EV}, t AS (SELECT DISTINCT tenant_id AS t FROM ev UNION ALL SELECT DISTINCT upper(signal_type) FROM ev) SELECT t AS tenant, regexp_full_match(t, '[a-z0-9][a-z0-9_-]{{0,31}}') AS valid FROM t")
def tenant_valid(spark, sf_dir):
    e = events_of(spark, sf_dir)
    t = e.select(F.col("tenant_id").alias("tenant")).distinct().union(e.select(F.upper("signal_type")).distinct())
    return t.select("tenant", S.tenant_valid(F.col("tenant")).alias("valid"))


# -- window statistics and anomalies


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.window_stats(events_of(spark, sf_dir), WINDOW_MS)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in names})


@query(f"WITH {_STATS} SELECT tenant_id, entity_id, window_start, window_end, n, round(sum_score, 6) AS sum_score, min_score, max_score FROM ws")
def window_stats(spark, sf_dir):
    return rounded(stats(spark, sf_dir), "sum_score")


@query(
    f"""WITH {_STATS} SELECT tenant_id, entity_id, (window_start // {DAY_MS}) * {DAY_MS} AS window_start, (window_start // {DAY_MS} + 1) * {DAY_MS} AS window_end,
    sum(n)::BIGINT AS n, round(sum(sum_score), 6) AS sum_score, min(min_score) AS min_score, max(max_score) AS max_score FROM ws GROUP BY ALL"""
)
def window_stats_remerge(spark, sf_dir):
    return rounded(A.merge_stats(stats(spark, sf_dir), DAY_MS), "sum_score")


@query(f"WITH {_STATS} SELECT tenant_id, entity_id, window_start, round(n / {WINDOW_MS / 1000}, 9) AS event_rate FROM ws")
def event_rate(spark, sf_dir):
    return stats(spark, sf_dir).select("tenant_id", "entity_id", "window_start", F.round(A.metric(A.DetectorConfig(metric="event_rate")), 9).alias("event_rate"))


_ANOMALY = "tenant_id, entity_id, window_start, window_end, n, samples, round(value, 6) AS value, round(baseline, 6) AS baseline, round(score, 6) AS score"
_ZSCORE_SQL = f"""WITH {_STATS}, v AS (SELECT *, sum_score / n AS value FROM ws),
b AS (SELECT *, avg(value) OVER f AS baseline, stddev_pop(value) OVER f AS sd, row_number() OVER (PARTITION BY tenant_id, entity_id ORDER BY window_start) - 1 AS samples FROM v
  WINDOW f AS (PARTITION BY tenant_id, entity_id ORDER BY window_start ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
z AS (SELECT *, (value - baseline) / greatest(sd, 0.05) AS score FROM b WHERE samples >= 5)
SELECT {_ANOMALY} FROM z WHERE abs(score) >= 3"""


def short(anomalies: DataFrame) -> DataFrame:
    return rounded(anomalies, "value", "baseline", "score").select("tenant_id", "entity_id", "window_start", "window_end", "n", "samples", "value", "baseline", "score")


@query(_ZSCORE_SQL)
def anomaly_zscore(spark, sf_dir):
    return short(A.detect(stats(spark, sf_dir), ZSCORE))


@query(
    f"""WITH RECURSIVE {_STATS}, v AS (SELECT *, sum_score / n AS value, row_number() OVER (PARTITION BY tenant_id, entity_id ORDER BY window_start) - 1 AS samples FROM ws),
r AS (SELECT tenant_id, entity_id, samples, value AS mean, 0::DOUBLE AS var, 0::DOUBLE AS baseline, 0::DOUBLE AS sd FROM v WHERE samples = 0 UNION ALL
  SELECT v.tenant_id, v.entity_id, v.samples, r.mean + 0.3 * (v.value - r.mean), 0.7 * (r.var + 0.3 * (v.value - r.mean) * (v.value - r.mean)), r.mean, sqrt(r.var)
  FROM r JOIN v ON v.tenant_id = r.tenant_id AND v.entity_id = r.entity_id AND v.samples = r.samples + 1),
z AS (SELECT v.*, r.baseline, (v.value - r.baseline) / greatest(r.sd, 0.05) AS score FROM v JOIN r USING (tenant_id, entity_id, samples) WHERE v.samples >= 5)
SELECT {_ANOMALY} FROM z WHERE abs(score) >= 3"""
)
def anomaly_ewma(spark, sf_dir):
    return short(A.detect(stats(spark, sf_dir), EWMA))


@query()
def anomaly_json(spark, sf_dir):
    return A.detect(stats(spark, sf_dir), ZSCORE).select(A.anomaly_json().alias("value"))


@query(_ZSCORE_SQL.replace(_ANOMALY, _ANOMALY + ", 'mean_score' AS metric, 3.0::DOUBLE AS threshold, 'zscore' AS detector, round(greatest(sd, 0.05), 6) AS stddev"))
def anomaly_json_fields(spark, sf_dir):
    """The messages, parsed again."""
    kinds = {"n": "long", "samples": "long", "window_start": "long", "window_end": "long", **dict.fromkeys(("value", "baseline", "stddev", "score", "threshold"), "double")}
    kind = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in A._OUT)
    return anomaly_json(spark, sf_dir).select(F.from_json("value", kind).alias("a")).select("a.*")


# -- tenancy


@query(
    f"""WITH {_DOCS}, r AS (SELECT *, dense_rank() OVER (PARTITION BY tenant_id, day ORDER BY entity_id) AS r, CASE tenant_id WHEN 't-0' THEN 20 WHEN 't-1' THEN 0 ELSE 10 END AS lim FROM docs)
SELECT tenant_id, day, entity_id, n FROM r WHERE lim <= 0 OR r <= lim"""
)
def quota_admit(spark, sf_dir):
    return QUOTA.admit(documents(spark, sf_dir)).select("tenant_id", "day", "entity_id", "n")


@query(f"WITH {_DOCS} SELECT tenant_id, day, count(*) AS entities FROM docs WHERE tenant_id <> 't-1' GROUP BY ALL HAVING count(*) >= CASE tenant_id WHEN 't-0' THEN 20 ELSE 10 END")
def quota_tenant_days(spark, sf_dir):
    d = documents(spark, sf_dir).groupBy("tenant_id", "day").agg(F.count_distinct("entity_id").alias("entities"))
    return d.where((QUOTA.limit() > 0) & (F.col("entities") >= QUOTA.limit()))


@query(f"WITH {_DOCS}, {_CRC} SELECT {_DOC_COLUMNS}, {_ROUTED} FROM docs JOIN entities USING (entity_id)")
def route_documents(spark, sf_dir):
    return flat(ROUTER.route(documents(spark, sf_dir)).repartition("index", "routing"))


@query(f'WITH {_DOCS}, {_CRC}, r AS (SELECT {_ROUTED} FROM docs JOIN entities USING (entity_id)) SELECT "index", count(*) AS docs, count(DISTINCT routing) AS routings FROM r GROUP BY "index"')
def routing_fanout(spark, sf_dir):
    return ROUTER.route(documents(spark, sf_dir)).groupBy("index").agg(F.count("*").alias("docs"), F.count_distinct("routing").alias("routings"))


@query(
    f"""WITH {_DOCS}, r AS (SELECT *, dense_rank() OVER (PARTITION BY tenant_id, day ORDER BY entity_id) AS r, CASE tenant_id WHEN 't-0' THEN 20 WHEN 't-1' THEN 0 ELSE 10 END AS lim FROM docs)
SELECT CASE WHEN tenant_id = 't-1' THEN 'signals-t-1-' || day ELSE 'signals-' || day END AS "index", count(*) AS docs, sum(n)::BIGINT AS events FROM r WHERE lim <= 0 OR r <= lim GROUP BY ALL"""
)
def routed_write(spark, sf_dir):
    """Documents under quota in the indices that they are routed to."""
    store = IndexStore(spark, scratch(spark, "indices"))
    d = documents(spark, sf_dir)
    store.write(d, ROUTER, QUOTA, updated_at=1, batch_id=0)
    store.write(d.where(F.col("day") == DAY), ROUTER, QUOTA, updated_at=2, batch_id=1)
    return store.read().groupBy("index").agg(F.count("*").alias("docs"), F.sum("n").alias("events"))


# -- archive


@query(f"WITH {_EV} SELECT event_id, entity_id, signal_type, score, source, ts, tenant_id FROM ev WHERE day = '{DAY}'")
def archive_scan_day(spark, sf_dir):
    archive.write_archive(events_of(spark, sf_dir), path := scratch(spark, "archive"))
    return archive.read_archive(spark, path, DAY)


@query(f"WITH {_EV} SELECT event_id, entity_id, signal_type, score, source, ts, tenant_id FROM ev WHERE day = '{DAY}'")
def compact_day(spark, sf_dir):
    archive.write_archive(events_of(spark, sf_dir), path := scratch(spark, "archive"))
    archive.compact_day(spark, path, DAY)
    return archive.read_archive(spark, path, DAY)


@query()
def archive_freshness(spark, sf_dir):
    archive.write_archive(events_of(spark, sf_dir), path := scratch(spark, "archive"))
    r = ops.archive_freshness(spark, path, DAY)
    return spark.createDataFrame([(r.dataset, r.day, r.rows, r.updated_at_ms)], "dataset string, day string, rows long, updated_at_ms long")


@query(f"WITH {_EV} SELECT 'archive' AS dataset, '{DAY}' AS day, (SELECT count(*) FROM ev WHERE day = '{DAY}') AS rows, true AS written")
def archive_freshness_rows(spark, sf_dir):
    """What the probe reports but for the instant, which no table has."""
    return archive_freshness(spark, sf_dir).select("dataset", "day", "rows", (F.col("updated_at_ms") > 0).alias("written"))


@query()
def synth_events(spark, sf_dir):
    return synthetic.synth_events(spark, 1000, tenants=4)


# -- serving


def served(spark: SparkSession, sf_dir: str) -> ServingTable:
    """All documents, then those of one day again with one event more."""
    t = ServingTable(spark, scratch(spark, "serving"))
    d = documents(spark, sf_dir)
    t.upsert(d, 1, 0)
    t.upsert(d.where(F.col("day") == DAY).withColumn("n", F.col("n") + 1), 2, 1)
    return t


def docs_of(rows: DataFrame) -> DataFrame:
    return flat(rows.drop("updated_at", "batch_id"))


_SERVED = f"{_DOCS}, served AS (SELECT * REPLACE (CASE WHEN day = '{DAY}' THEN n + 1 ELSE n END AS n) FROM docs)"


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served")
def serving_replacing_final(spark, sf_dir):
    return docs_of(served(spark, sf_dir).read())


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served UNION ALL SELECT {_DOC_COLUMNS} FROM docs WHERE day = '{DAY}'")
def serving_upsert(spark, sf_dir):
    return docs_of(served(spark, sf_dir).raw())


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served")
def serving_refresh_day(spark, sf_dir):
    t = served(spark, sf_dir)
    t.refresh_day(DAY)
    return docs_of(t.raw())


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served WHERE day = '{DAY}' AND tenant_id = 't-3' AND entity_id = '3'")
def serving_point_lookup(spark, sf_dir):
    return docs_of(served(spark, sf_dir).get(DAY, "t-3", "3"))


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served WHERE day IN ('{DAY}', '2024-01-06', '2024-01-07') AND tenant_id = 't-3' AND entity_id = '3'")
def serving_mget(spark, sf_dir):
    return docs_of(served(spark, sf_dir).mget([DAY, "2024-01-06", "2024-01-07"], "t-3", "3"))


@query(f"WITH {_SERVED} SELECT day, count(*) AS n FROM served GROUP BY day")
def serving_day_count(spark, sf_dir):
    return served(spark, sf_dir).read().groupBy("day").agg(F.count("*").alias("n"))


@query(f"WITH {_SERVED} SELECT DISTINCT day FROM served")
def serving_partitions(spark, sf_dir):
    return served(spark, sf_dir).partitions()


@query(f"WITH {_SERVED} SELECT {_DOC_COLUMNS} FROM served WHERE tenant_id = 't-1' AND entity_id = '1' AND day = '{DAY}'")
def serving_routed_get(spark, sf_dir):
    t = served(spark, sf_dir)
    routed = ROUTER.route(t.raw([DAY])).where((F.col("index") == ROUTER.index_for("t-1", DAY)) & (F.col("entity_id") == "1")).drop("index", "routing")
    return docs_of(newest(routed))


@query(f"WITH {_SERVED} SELECT tenant_id, entity_id, sum(n)::BIGINT AS n, round(sum(mean_score * n) / sum(n), 4) AS mean_score FROM served GROUP BY ALL")
def entity_history(spark, sf_dir):
    return served(spark, sf_dir).read().groupBy("tenant_id", "entity_id").agg(F.sum("n").alias("n"), history_mean().alias("mean_score"))


@query(f"WITH {_SERVED} SELECT day, count(*) AS documents, count(DISTINCT tenant_id = 't-1') AS indices FROM served GROUP BY day")
def verify_day(spark, sf_dir):
    by_index = ROUTER.route(served(spark, sf_dir).read()).groupBy("day", "index").agg(F.count("*").alias("n"))
    return by_index.groupBy("day").agg(F.sum("n").alias("documents"), F.count("*").alias("indices"))


# -- lake

_LAKE = f"{_DOCS}, lake AS (SELECT day, tenant_id, entity_id, mean_score, n FROM docs)"


def lake_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("day", "tenant_id", "entity_id", "mean_score", "n")


def a_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Version 0 has the days before DAY, version 1 the others as well."""
    lake, d = Lake(spark, scratch(spark, "lake")), lake_docs(spark, sf_dir)
    lake.write(d.where(F.col("day") < DAY))
    lake.write(d.where(F.col("day") >= DAY))
    return lake


_LAKE_COLUMNS = "day, tenant_id, entity_id, mean_score, n"


@query(f"WITH {_LAKE} SELECT {_LAKE_COLUMNS} FROM lake")
def lake_append(spark, sf_dir):
    return a_lake(spark, sf_dir).read()


@query(f"WITH {_LAKE} SELECT {_LAKE_COLUMNS} FROM lake")
def lake_read_latest(spark, sf_dir):
    return (lake := a_lake(spark, sf_dir)).read(version=lake.latest().version)


@query(f"WITH {_LAKE} SELECT {_LAKE_COLUMNS} FROM lake WHERE day < '{DAY}'")
def lake_time_travel_version(spark, sf_dir):
    return a_lake(spark, sf_dir).read(version=0)


@query(f"WITH {_LAKE} SELECT {_LAKE_COLUMNS} FROM lake WHERE day < '{DAY}'")
def lake_time_travel_timestamp(spark, sf_dir):
    import datetime as dt

    lake = a_lake(spark, sf_dir)
    return lake.read(as_of=dt.datetime.fromtimestamp((lake.commit(1).timestamp_ms - 1) / 1000, dt.timezone.utc))


@query(f"WITH {_LAKE} SELECT {_LAKE_COLUMNS} FROM lake WHERE day = '{DAY}'")
def lake_read_day(spark, sf_dir):
    return a_lake(spark, sf_dir).read(day=DAY)


@query(f"WITH {_LAKE} SELECT version, n FROM (SELECT 0::BIGINT AS version, count(*) AS n FROM lake WHERE day < '{DAY}' UNION ALL SELECT 1, count(*) FROM lake WHERE day >= '{DAY}')")
def lake_history(spark, sf_dir):
    return a_lake(spark, sf_dir).history().select("version", F.col("num_output_rows").alias("n"))


@query(f"WITH {_LAKE} SELECT * REPLACE (CASE WHEN day = '{DAY}' THEN n + 100 ELSE n END AS n) FROM lake")
def lake_replace_day(spark, sf_dir):
    lake = a_lake(spark, sf_dir)
    lake.rewrite_day(lake.read(day=DAY).withColumn("n", F.col("n") + 100), DAY)
    return lake.read()


@query(f"WITH {_DOCS} SELECT day, tenant_id, entity_id, mean_score, n, CASE WHEN day >= '{DAY}' THEN stddev_score END AS stddev_score FROM docs")
def lake_schema_evolution(spark, sf_dir):
    lake, d = Lake(spark, scratch(spark, "lake")), documents(spark, sf_dir)
    lake.write(d.where(F.col("day") < DAY).select("day", "tenant_id", "entity_id", "mean_score", "n"))
    lake.write(d.where(F.col("day") >= DAY).select("day", "tenant_id", "entity_id", "mean_score", "n", "stddev_score"), merge_schema=True)
    return lake.read()


@query(f"WITH {_LAKE} SELECT day, count(*) AS n FROM lake GROUP BY day")
def lake_rows_per_day(spark, sf_dir):
    return a_lake(spark, sf_dir).read().groupBy("day").agg(F.count("*").alias("n"))


# -- governed SQL


def governed(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    a_lake(spark, sf_dir).register("signals_daily")
    decision, out = guard.Guard(spark).run("analyst", sql)
    if out is None:
        raise PermissionError(f"{decision.rule}: {decision.reason}")
    return out


_TOPK = f"SELECT tenant_id, entity_id, mean_score FROM {{t}} WHERE day = '{DAY}' ORDER BY mean_score DESC, tenant_id, entity_id LIMIT 5"
_AVG = "SELECT tenant_id, round(avg(mean_score), 6) AS mean_score, count(*) AS n FROM {t} WHERE day BETWEEN '2024-01-03' AND '2024-01-09' GROUP BY tenant_id"
_COUNT = f"SELECT count(*) AS n FROM {{t}} WHERE day = '{DAY}'"


@query(f"WITH {_LAKE} {_TOPK.format(t='lake')}")
def guarded_sql_topk(spark, sf_dir):
    return governed(spark, sf_dir, _TOPK.format(t="signals_daily"))


@query(f"WITH {_LAKE} {_AVG.format(t='lake')}")
def guarded_sql_tenant_avg(spark, sf_dir):
    return governed(spark, sf_dir, _AVG.format(t="signals_daily"))


@query(f"WITH {_LAKE} {_COUNT.format(t='lake')}")
def guarded_sql_count(spark, sf_dir):
    return governed(spark, sf_dir, _COUNT.format(t="signals_daily"))


STATEMENTS = (
    "SELECT count(*) FROM signals_daily WHERE day = '2024-01-05'",
    "SELECT * FROM signals_daily WHERE day = '2024-01-05'",
    "SELECT * FROM signals_daily WHERE day IN ('2024-01-05') LIMIT 5",
    "SELECT count(*) FROM signals_daily",
    "SELECT count(*) FROM signals_daily WHERE day <> '2024-01-05'",
    "SELECT count(*) FROM signals_daily WHERE substr(day, 1, 7) = '2024-01'",
    "SELECT 1 FROM signals_daily a, signals_daily b WHERE a.day = '2024-01-05' AND b.day = '2024-01-05'",
    "DELETE FROM signals_daily WHERE day = '2024-01-05'",
    "SELECT 1; SELECT 2",
    "SELEC 1",
    "EXPLAIN SELECT * FROM signals_daily",
    "WITH x AS (SELECT * FROM signals_daily WHERE day = '2024-01-05' LIMIT 3) SELECT entity_id FROM x",
)


def decided(spark: SparkSession, sf_dir: str) -> list[guard.Decision]:
    a_lake(spark, sf_dir).register("signals_daily")
    g = guard.Guard(spark)
    return [g.decide("analyst", s) for s in STATEMENTS]


# What the rules say of each statement.
_RULED = ("ok", "unbounded_select_star", "ok", "missing_partition_predicate", "missing_partition_predicate", "missing_partition_predicate", "cross_join", "statement_not_allowed", "multi_statement", "unparsable", "ok", "unbounded_select_star")


@query(
    "SELECT * FROM (VALUES "
    + ", ".join("('{}', '{}', '{}')".format(q.replace("'", "''"), "allow" if r == "ok" else "reject", r) for q, r in zip(STATEMENTS, _RULED, strict=True))
    + ") v(sql, verdict, rule)"
)
def guard_shapes(spark, sf_dir):
    return spark.createDataFrame([(d.sql, d.verdict, d.rule) for d in decided(spark, sf_dir)], "sql string, verdict string, rule string")


@query()
def scan_estimate(spark, sf_dir):
    a_lake(spark, sf_dir).register("signals_daily")
    rows = [(s, shape.estimate(spark, f"SELECT * FROM signals_daily{s}")) for s in ("", f" WHERE day = '{DAY}'")]
    return spark.createDataFrame(rows, "predicate string, bytes long")


@query("SELECT true AS positive, true AS pruned")
def scan_estimate_pruned(spark, sf_dir):
    """That one day is estimated at some bytes, and fewer than all of them."""
    one, every = (F.max(F.when(F.col("predicate") == p, F.col("bytes"))) for p in (f" WHERE day = '{DAY}'", ""))
    return scan_estimate(spark, sf_dir).agg((one > 0).alias("positive"), (one < every).alias("pruned"))


# Decisions made of events, so that both sides can compute them.
_DECISIONS = """d AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'reject' WHEN event_id % 7 = 0 THEN 'throttle' ELSE 'allow' END AS verdict, event_type AS rule,
  CASE WHEN event_id % 5 > 0 THEN user_id * 1000 END AS estimated_bytes FROM events)"""


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    verdict = F.when(F.col("event_id") % 3 == 0, "reject").when(F.col("event_id") % 7 == 0, "throttle").otherwise("allow")
    return e.select("event_id", verdict.alias("verdict"), F.col("event_type").alias("rule"), F.when(F.col("event_id") % 5 > 0, F.col("user_id") * 1000).alias("estimated_bytes"))


@query(
    f"""WITH {_DECISIONS} SELECT verdict, rule, count(*) AS decisions, sum(CASE WHEN verdict = 'reject' THEN coalesce(estimated_bytes, 0) ELSE 0 END)::BIGINT AS bytes_blocked,
    sum(CASE WHEN verdict = 'allow' THEN coalesce(estimated_bytes, 0) ELSE 0 END)::BIGINT AS bytes_admitted FROM d GROUP BY ALL"""
)
def audit_summary(spark, sf_dir):
    path = scratch(spark, "audit")
    decisions(spark, sf_dir).write.json(path)
    return guard.audit_summary(spark.read.schema("event_id long, verdict string, rule string, estimated_bytes long").json(path))


@query(f"WITH {_DECISIONS} SELECT event_id, verdict, rule FROM d ORDER BY event_id DESC LIMIT 50")
def audit_tail(spark, sf_dir):
    return decisions(spark, sf_dir).orderBy(F.desc("event_id")).limit(50).select("event_id", "verdict", "rule").orderBy("event_id")


# -- operations


@query(f"""WITH {_EV} SELECT DISTINCT 'signals-' || day AS "index", day, CASE WHEN day < '2024-01-21' THEN 'delete' ELSE 'keep' END AS action FROM ev""")
def retention_plan(spark, sf_dir):
    i = R.with_event_time(events_of(spark, sf_dir)).select(F.concat(F.lit("signals-"), "day").alias("index")).distinct()
    return ops.retention_plan(i, "2024-01-30", 10)


@query(
    f"""WITH {_EV}, i AS (SELECT DISTINCT 'signals-' || day AS i, day FROM ev) SELECT 'signals' AS alias, i AS "index", CASE WHEN day < '2024-01-11' THEN 'remove' ELSE 'add' END AS action
    FROM i WHERE (day < '2024-01-11') <> (day >= '2024-01-21')"""
)
def alias_diff(spark, sf_dir):
    i = R.with_event_time(events_of(spark, sf_dir)).select("day", F.lit("signals").alias("alias"), F.concat(F.lit("signals-"), "day").alias("index")).distinct()
    return ops.alias_diff(i.where("day < '2024-01-21'").drop("day"), i.where("day >= '2024-01-11'").drop("day"))


SQL["alias_diff"] = f"""WITH {_EV}, i AS (SELECT DISTINCT 'signals-' || day AS i, day FROM ev)
SELECT 'signals' AS alias, i AS "index", CASE WHEN day < '2024-01-11' THEN 'remove' ELSE 'add' END AS action FROM i WHERE day < '2024-01-11' OR day >= '2024-01-21'"""

NOW_MS = 1_706_700_000_000
_SLOS = [("view", 600, 0), ("signup", 86_400 * 40, 100_000_000), ("error", 86_400 * 40, 1), ("never", 60, 0)]


@query(
    f"""WITH r AS (SELECT event_type AS dataset, '2024-01-30' AS day, CASE WHEN event_type <> 'error' THEN max(epoch_us(ts) // 1000) END AS wrote, count(*) AS rows FROM events GROUP BY event_type),
s AS (SELECT * FROM (VALUES {", ".join(map(str, _SLOS))}) v(dataset, lag, least)),
k AS (SELECT dataset, day, rows, CASE WHEN wrote IS NULL THEN 'missing' WHEN ({NOW_MS} - wrote) / 1000.0 > lag THEN 'stale' WHEN rows < least THEN 'incomplete' END AS kind,
  greatest(0, ({NOW_MS} - wrote) / 1000.0)::DOUBLE AS lag_seconds, wrote FROM r JOIN s USING (dataset))
SELECT dataset, day, kind, CASE WHEN wrote IS NOT NULL THEN lag_seconds END AS lag_seconds, rows FROM k WHERE kind IS NOT NULL"""
)
def sla_check(spark, sf_dir):
    e = events_of(spark, sf_dir).groupBy(F.col("signal_type").alias("dataset")).agg(F.max("ts").alias("at"), F.count("*").alias("rows"))
    readings = e.select("dataset", F.lit("2024-01-30").alias("day"), F.when(F.col("dataset") != "error", F.col("at")).alias("updated_at_ms"), "rows")
    return ops.sla_check(readings, spark.createDataFrame(_SLOS, "dataset string, max_lag_seconds long, min_rows long"), NOW_MS)




@query(
    """WITH w AS (SELECT n_nationkey AS id, (n_nationkey + 1) * 2000 AS events_per_sec, (n_nationkey + 1) * 1000000 AS entities_per_day, 30 + n_nationkey AS retention_days,
  n_nationkey % 2 AS replicas, 400.0::DOUBLE AS doc_bytes FROM nation),
g AS (SELECT *, entities_per_day * doc_bytes * 1.3 / 1073741824 AS gib, least(events_per_sec::DOUBLE, entities_per_day / 10.0) AS up, replicas + 1 AS copies, retention_days + 1 AS days FROM w),
s AS (SELECT *, (greatest(1, ceil(gib / 30.0)) * days * copies)::BIGINT AS total_shards FROM g),
n AS (SELECT *, ceil(gib * days * copies / 0.8 / 512)::BIGINT AS nodes_by_storage, ceil(total_shards / 200.0)::BIGINT AS nodes_by_shards, ceil(up * copies / 2000)::BIGINT AS nodes_by_ingest FROM s),
d AS (SELECT *, greatest(nodes_by_storage, nodes_by_shards, nodes_by_ingest, copies)::BIGINT AS data_nodes FROM n)
SELECT id, events_per_sec, entities_per_day, retention_days, replicas, doc_bytes, total_shards, nodes_by_storage, nodes_by_shards, nodes_by_ingest, data_nodes,
  CASE WHEN data_nodes = nodes_by_ingest THEN 'ingest' WHEN data_nodes = nodes_by_shards THEN 'shards' WHEN data_nodes = nodes_by_storage THEN 'storage' ELSE 'replica floor' END AS bottleneck FROM d"""
)
def capacity_grid(spark, sf_dir):
    k = F.col("n_nationkey").cast("long")
    w = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        k.alias("id"), ((k + 1) * 2000).alias("events_per_sec"), ((k + 1) * 1_000_000).alias("entities_per_day"), (k + 30).alias("retention_days"), (k % 2).alias("replicas"), F.lit(400.0).alias("doc_bytes")
    )
    return capacity.grid(w)


# -- streams


def arriving(spark: SparkSession, events: DataFrame, parts: int = 4) -> str:
    """Events as files that arrive in order of time, a redelivery with its event."""
    path = scratch(spark, "arriving")
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        lo = hi = 0
    step = (hi - lo) // parts + 1
    for k in range(parts):
        events.where((F.col("ts") >= lo + k * step) & (F.col("ts") < lo + (k + 1) * step)).coalesce(1).write.mode("append").parquet(path)
    return path


def flush_event(spark: SparkSession, events: DataFrame) -> DataFrame:
    """One event of another key, long after the rest: it closes their windows."""
    last = events.agg(F.max("ts")).first()[0] or 0
    return spark.createDataFrame([("flush", "~flush", "view", 0.0, "web", last + 10 * DAY_MS, "~flush")], EVENT)


def stream_of(spark: SparkSession, sf_dir: str, flush: bool, again: bool = True) -> DataFrame:
    e = events_of(spark, sf_dir).select(*EVENT.names)
    path = arriving(spark, redelivered(e) if again else e)
    if flush:
        flush_event(spark, e).write.mode("append").parquet(path)
    return file_events(spark, path, 1)


def few_partitions(f: Query) -> Query:
    """State is laid out by the number of shuffle partitions at the first start: keep it small here."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        try:
            return f(spark, sf_dir)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    run.__name__ = f.__name__
    return run


@query(f"WITH {_DOCS} SELECT {_DOC_COLUMNS} FROM docs")
@few_partitions
def stream_rollup_update(spark, sf_dir):
    t = ServingTable(spark, scratch(spark, "serving"))
    jobs.rollup_leg(stream_of(spark, sf_dir, False), t, scratch(spark, "state"), once=True).awaitTermination()
    return docs_of(t.read())


@query(f"WITH {_EV} SELECT event_id, entity_id, ts, day FROM ev UNION ALL SELECT event_id, entity_id, ts, day FROM ev WHERE event_id::BIGINT % 20 = 0")
@few_partitions
def stream_archive(spark, sf_dir):
    path = scratch(spark, "archive")
    jobs.archive_leg(stream_of(spark, sf_dir, False), path, scratch(spark, "state"), once=True).awaitTermination()
    return R.with_event_time(archive.read_archive(spark, path)).select("event_id", "entity_id", "ts", "day")


@query(f"WITH {_EV} SELECT event_id, entity_id, ts, day FROM ev UNION ALL SELECT event_id, entity_id, ts, day FROM ev WHERE event_id::BIGINT % 20 = 0")
@few_partitions
def stream_archive_compacted(spark, sf_dir):
    """The archive of a stream whose days are compacted between two runs of it."""
    path, state = scratch(spark, "archive"), scratch(spark, "state")
    e = redelivered(events_of(spark, sf_dir).select(*EVENT.names))
    here = arriving(spark, e.where("ts % 2 = 0"), 2)
    jobs.archive_leg(file_events(spark, here, 1), path, state, once=True).awaitTermination()
    archive.compact_day(spark, path, DAY)
    e.where("ts % 2 <> 0").coalesce(1).write.mode("append").parquet(here)
    jobs.archive_leg(file_events(spark, here, 1), path, state, once=True).awaitTermination()
    archive.compact_day(spark, path, DAY)
    return R.with_event_time(archive.read_archive(spark, path)).select("event_id", "entity_id", "ts", "day")


@query(f"WITH {_DOCS} SELECT day, tenant_id, entity_id, n, mean_score FROM docs")
@few_partitions
def stream_rollup_lake(spark, sf_dir):
    """The lake's leg of the rollup stream: the last version of each document."""
    lake = Lake(spark, scratch(spark, "lake"))
    jobs.rollup_leg(stream_of(spark, sf_dir, False), ServingTable(spark, scratch(spark, "serving")), scratch(spark, "state"), once=True, lake=lake).awaitTermination()
    return lake.read(newest_of=jobs.LAKE_KEY).select("day", "tenant_id", "entity_id", "n", "mean_score")


@query(f"WITH {_EV} SELECT event_id, entity_id, ts FROM ev")
@few_partitions
def stream_dedup(spark, sf_dir):
    path = scratch(spark, "dedup")
    jobs.dedup_leg(stream_of(spark, sf_dir, False), path, scratch(spark, "state"), once=True).awaitTermination()
    return spark.read.schema(EVENT).parquet(path).select("event_id", "entity_id", "ts")


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    path = scratch(spark, name)
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch(spark, "state")).outputMode("append")
    w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).where("tenant_id <> '~flush'")


@query(f"WITH {_STATS} SELECT tenant_id, entity_id, window_start, window_end, n, round(sum_score, 6) AS sum_score, min_score, max_score FROM ws")
@few_partitions
def stream_window_stats(spark, sf_dir):
    return rounded(run_to_table(spark, jobs.stream_window_stats(stream_of(spark, sf_dir, True, False), WINDOW_MS, 5000), "stats"), "sum_score")


@query(_ZSCORE_SQL)
@few_partitions
def stream_anomalies(spark, sf_dir):
    return short(run_to_table(spark, jobs.stream_anomalies(stream_of(spark, sf_dir, True, False), ZSCORE, WINDOW_MS, 5000), "anomalies"))


@query(
    f"""WITH {_EV}, b AS (SELECT *, hash_batch AS batch FROM (SELECT *, (event_id::BIGINT * 7919) % 10 AS hash_batch FROM ev)),
m AS (SELECT batch, max(ts) AS m FROM b GROUP BY batch),
w AS (SELECT a.batch AS now, max(x.m) - 5000 AS mark FROM m a JOIN m x ON x.batch <= a.batch - 2 GROUP BY a.batch)
SELECT tenant_id, entity_id, ts, batch FROM b JOIN w ON b.batch = w.now WHERE (ts // {WINDOW_MS} + 1) * {WINDOW_MS} <= mark"""
)
def late_events(spark, sf_dir):
    e = events_of(spark, sf_dir).withColumn("batch", (F.col("event_id").cast("long") * 7919) % 10)
    return jobs.late_replay(e, "batch", WINDOW_MS, 5000).select("tenant_id", "entity_id", "ts", "batch")


@query(
    f"""WITH {_EV}, b AS (SELECT *, (event_id::BIGINT * 7919) % 4 AS batch FROM ev), m AS (SELECT batch, max(ts) AS m FROM b GROUP BY batch),
w AS (SELECT a.batch AS now, max(x.m) - 5000 AS mark FROM m a JOIN m x ON x.batch <= a.batch - 2 GROUP BY a.batch)
SELECT tenant_id, entity_id, ts, batch FROM b JOIN w ON b.batch = w.now WHERE (ts // {WINDOW_MS} + 1) * {WINDOW_MS} <= mark"""
)
def late_leg(spark, sf_dir):
    """The late leg itself, fed four batches, each twice."""
    e = events_of(spark, sf_dir).withColumn("batch", (F.col("event_id").cast("long") * 7919) % 4)
    leg = jobs.LateLeg(spark, path := scratch(spark, "late"), WINDOW_MS, 5000)
    for k in range(4):
        for _ in range(2):
            leg(e.where(F.col("batch") == k).drop("batch"), k)
    return spark.read.parquet(f"{path}/late").withColumn("batch", F.col("batch").cast("long"))


@query(f"WITH {_EV} SELECT event_id, min(score) AS score, min(ts) AS ts, count(*) AS copies FROM (SELECT event_id, score, ts FROM ev UNION ALL SELECT event_id, score + 1, ts + 1000 FROM ev WHERE event_id::BIGINT % 20 = 0) GROUP BY event_id")
def dedup_two_payloads(spark, sf_dir):
    """One id with two payloads: the earlier stays."""
    e = events_of(spark, sf_dir)
    both = e.union(e.where(F.col("event_id").cast("long") % 20 == 0).withColumns({"score": F.col("score") + 1, "ts": F.col("ts") + 1000}).select(*e.columns))
    kept = R.dedup(R.with_event_time(both)).select("event_id", "score", "ts")
    return kept.join(both.groupBy("event_id").agg(F.count("*").alias("copies")), "event_id")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


