"""Nodes, shards and monthly cost for a workload; every constant is an assumption that can be overridden."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict, dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GIB = 1 << 30
# vCPU, memory in GiB and list price in USD an hour; storage in USD a GiB and month.
NODE_TYPES = {
    "m6g.large.search": (2, 8, 0.128),
    "m6g.xlarge.search": (4, 16, 0.256),
    "r6g.large.search": (2, 16, 0.167),
    "r6g.xlarge.search": (4, 32, 0.335),
    "r6g.2xlarge.search": (8, 64, 0.669),
}
STORAGE_PRICE, HOURS = 0.122, 730


@dataclass(frozen=True)
class Workload:
    events_per_sec: float
    entities_per_day: int
    retention_days: int = 30
    replicas: int = 1
    doc_bytes: float = 400.0
    dedicated_tenants: int = 0
    dedicated_share: float = 0.0
    trigger_seconds: float = 10.0


@dataclass(frozen=True)
class Assumptions:
    index_overhead: float = 1.3
    target_shard_gib: float = 30.0
    max_shards_per_gib_heap: float = 25
    heap_fraction: float = 0.5
    disk_headroom: float = 0.8
    docs_per_sec_per_vcpu: float = 1000
    ebs_gib_per_node: float = 512


class Numbers:
    """How the formulas compute on plain numbers."""

    up, most, least = staticmethod(ceil), staticmethod(max), staticmethod(min)


class Columns:
    """How they compute on columns."""

    @staticmethod
    def _column(x) -> Column:
        return x if isinstance(x, Column) else F.lit(x)

    @classmethod
    def up(cls, x) -> Column:
        return F.ceil(cls._column(x)).cast("long")

    @classmethod
    def most(cls, *x) -> Column:
        return F.greatest(*(cls._column(v).cast("long") for v in x))

    @classmethod
    def least(cls, *x) -> Column:
        return F.least(*(cls._column(v).cast("double") for v in x))


def sizes(w, on: type[Numbers] | type[Columns], node_type: str, a: Assumptions) -> dict:
    """What a workload (its numbers, or columns, by name) needs: the one place of the formulas, for single plans and tables."""
    vcpu, memory, _ = NODE_TYPES[node_type]
    heap = min(32.0, memory * a.heap_fraction)
    copies, days = w("replicas") + 1, w("retention_days") + 1  # tomorrow's index is there already
    gib = w("entities_per_day") * w("doc_bytes") * a.index_overhead / GIB
    upserts = on.least(w("events_per_sec"), w("entities_per_day") / w("trigger_seconds"))
    shards = lambda part: on.most(1, on.up(part / a.target_shard_gib))
    tenants = w("dedicated_tenants")
    per_day = shards(gib * (1 - w("dedicated_share"))) + tenants * shards(gib * w("dedicated_share") / on.most(tenants, 1))
    total = per_day * days * copies
    storage = gib * days * copies / a.disk_headroom
    needs = {
        "nodes_by_storage": on.up(storage / a.ebs_gib_per_node), "nodes_by_shards": on.up(total / (heap * a.max_shards_per_gib_heap)),
        "nodes_by_ingest": on.up(upserts * copies / (vcpu * a.docs_per_sec_per_vcpu)),
    }
    return {"gib": gib, "upserts": upserts, "shards_per_day": per_day, "primaries": per_day * days, "total_shards": total, "storage": storage, **needs, "data_nodes": on.most(*needs.values(), copies)}


# What binds, by need; of equal needs the first one here.
BOTTLENECKS = {"nodes_by_ingest": "ingest", "nodes_by_shards": "shards", "nodes_by_storage": "storage"}
FLOOR = "replica floor"


def plan(w: Workload, node_type: str = "r6g.large.search", a: Assumptions = Assumptions(), hourly: float | None = None) -> dict:
    if w.replicas < 0 or min(w.retention_days, w.entities_per_day) < 1:
        raise ValueError("replicas must not be negative, retention and entities at least 1")
    s, price = sizes(lambda name: getattr(w, name), Numbers, node_type, a), NODE_TYPES[node_type][2] if hourly is None else hourly
    money = {"instance": s["data_nodes"] * price * HOURS, "storage": s["data_nodes"] * a.ebs_gib_per_node * STORAGE_PRICE}
    return {
        "docs_per_day": w.entities_per_day, "upserts_per_sec": round(s["upserts"], 1), "primary_gib_per_day": round(s["gib"], 3), "total_primary_shards": s["primaries"], "storage_gib": round(s["storage"], 1),
        **{k: s[k] for k in ("shards_per_day", "total_shards", "nodes_by_storage", "nodes_by_shards", "nodes_by_ingest", "data_nodes")},
        "bottleneck": next((what for need, what in BOTTLENECKS.items() if s[need] == s["data_nodes"]), FLOOR),
        "shards_per_node": round(s["total_shards"] / s["data_nodes"], 1), "node_type": node_type,
        **{f"monthly_{k}_usd": round(v, 2) for k, v in money.items()}, "monthly_usd": round(sum(money.values()), 2),
    }


def grid(workloads: DataFrame, node_type: str = "r6g.large.search", a: Assumptions = Assumptions()) -> DataFrame:
    """The plan's sizes for a table of workloads; a column that is missing has the workload's default."""
    default = Workload(0, 1)
    w = lambda name: F.col(name) if name in workloads.columns else F.lit(getattr(default, name))
    s = sizes(w, Columns, node_type, a)
    out = workloads.withColumns({k: s[k].cast("long") for k in ("total_shards", "nodes_by_storage", "nodes_by_shards", "nodes_by_ingest", "data_nodes")})
    which = F.lit(FLOOR)
    for need, what in reversed(BOTTLENECKS.items()):
        which = F.when(F.col(need) == F.col("data_nodes"), what).otherwise(which)
    return out.withColumn("bottleneck", which)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    for name, value in asdict(Workload(0, 1)).items():
        p.add_argument("--" + name.replace("_", "-"), type=type(value) if not isinstance(value, float) else float, default=value, required=name in ("events_per_sec", "entities_per_day"))
    p.add_argument("--node-type", choices=sorted(NODE_TYPES), default="r6g.large.search")
    p.add_argument("--hourly", type=float)
    a = vars(p.parse_args(args))
    node, hourly = a.pop("node_type"), a.pop("hourly")
    a["events_per_sec"] = float(a["events_per_sec"])
    print(json.dumps(plan(Workload(**a), node, hourly=hourly), indent=1))


if __name__ == "__main__":
    main()
