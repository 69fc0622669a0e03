"""Column expressions for identities, routing and names; all of them stay in generated code."""

from __future__ import annotations

import datetime as dt
import hashlib
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import DEFAULT_TENANT

# Formats of names.
TENANT_PATTERN = r"^[a-z0-9][a-z0-9_-]{0,31}$"
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def event_id() -> Column:
    """The first 20 hex digits of SHA-1 over tenant|entity|type|source|ts; the score takes no part."""
    return F.substring(F.sha1(F.concat_ws("|", "tenant_id", "entity_id", "signal_type", "source", F.col("ts").cast("string"))), 1, 20)


def make_event_id(entity_id: str, signal_type: str, source: str, ts: int, tenant_id: str = DEFAULT_TENANT) -> str:
    return hashlib.sha1("|".join((tenant_id, entity_id, signal_type, source, str(ts))).encode()).hexdigest()[:20]


def query_hash(sql: Column) -> Column:
    """The first 16 hex digits of SHA-1 over the statement with its white space made single."""
    return F.substring(F.sha1(F.trim(F.regexp_replace(sql, r"\s+", " "))), 1, 16)


def hash_of(sql: str) -> str:
    return hashlib.sha1(" ".join(sql.split()).encode()).hexdigest()[:16]


def doc_id() -> Column:
    return F.concat_ws(":", "tenant_id", "entity_id")


def doc_tenant(doc: Column) -> Column:
    """What stands before the first colon."""
    return F.substring_index(doc, ":", 1)


def doc_entity(doc: Column) -> Column:
    return F.regexp_replace(doc, "^[^:]*:", "")


def routing_bucket(partitions: int) -> Column:
    """The tenant, or with several partitions tenant#k by crc32 of the entity."""
    if partitions <= 1:
        return F.col("tenant_id")
    return F.concat(F.col("tenant_id"), F.lit("#"), (F.crc32(F.col("entity_id").cast("binary")) % partitions).cast("string"))


def index_name(prefix: str, dedicated: list[str]) -> Column:
    """prefix-tenant-day for dedicated tenants, prefix-day for the pool."""
    pooled = F.concat_ws("-", F.lit(prefix), "day")
    return F.when(F.col("tenant_id").isin(dedicated), F.concat_ws("-", F.lit(prefix), "tenant_id", "day")).otherwise(pooled) if dedicated else pooled


def index_day(index: Column) -> Column:
    return F.regexp_extract(index, r"(\d{4}-\d{2}-\d{2})$", 1)


def index_tenant(index: Column, prefix: str) -> Column:
    """The dedicated tenant in an index name; null for the pool."""
    found = F.regexp_extract(index, "^" + re.escape(prefix) + r"-(.+)-\d{4}-\d{2}-\d{2}$", 1)
    return F.when(found != "", found)


def tenant_valid(tenant: Column) -> Column:
    return tenant.rlike(TENANT_PATTERN)


def human_bytes(n: float | None) -> str:
    """A size in the largest binary unit that leaves at least one."""
    if n is None:
        return "unknown"
    power = min(4, max(0, int(n).bit_length() - 1) // 10)
    return f"{n / (1 << 10 * power):.1f} {('B', 'KiB', 'MiB', 'GiB', 'TiB')[power]}"


def parse_pairs(text: str) -> dict[str, int]:
    """``a=1,b=2`` to a dict."""
    return {k.strip(): int(v) for k, _, v in (p.partition("=") for p in text.split(",") if p.strip())}


def shift_day(day: str, n: int) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=n)).isoformat()
