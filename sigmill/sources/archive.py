"""The event archive: Parquet in day=YYYY-MM-DD folders, always read with its schema.

The folders alone say what the archive holds, so batches, streams and compaction can share them. A
stream's batch is written aside and moved in under names that carry its number, then marked as
whole; a batch that is run again replaces what it had moved, or is skipped if it was whole.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import ARCHIVE, EVENT
from ..operators.rollup import with_event_time
from .fs import Store


def by_day(rows: DataFrame) -> DataFrame:
    """Dealt for a write by day: a day's rows are together up to the advisory partition size, and split beyond, so the number of files follows the bytes."""
    return rows.hint("rebalance", "day")


def write_archive(events: DataFrame, path: str) -> None:
    """Append events to their days."""
    by_day(with_event_time(events).select(*EVENT.names, "day")).write.mode("append").partitionBy("day").parquet(path)


def append_batch(events: DataFrame, path: str, batch: str) -> None:
    """Append events as one batch of a stream, once for each name of a batch."""
    store = Store(events.sparkSession, path)
    if store.exists(f"_batches/{batch}"):
        return
    aside = f"_batch-{batch}"
    by_day(with_event_time(events).select(*EVENT.names, "day")).write.mode("overwrite").partitionBy("day").parquet(f"{path}/{aside}")
    for folder in (d for d in store.list("") if d.startswith("day=")):
        for name in (n for n in store.list(folder) if n.startswith(f"{batch}-")):  # of an attempt that broke off
            store.delete(f"{folder}/{name}")
    for folder in (d for d in store.list(aside) if d.startswith("day=")):
        store.make(folder)
        for k, name in enumerate(n for n in store.list(f"{aside}/{folder}") if n.endswith(".parquet")):
            store.move(f"{aside}/{folder}/{name}", f"{folder}/{batch}-{k:05d}.parquet")
    store.create(f"_batches/{batch}", "")
    store.delete(aside)


def read_archive(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Events of one day, whose folder alone is read, or of all."""
    rows = spark.read.schema(ARCHIVE).parquet(path)
    return (rows.where(F.col("day") == day) if day else rows).drop("day")


def compact_day(spark: SparkSession, path: str, day: str, files: int = 1) -> int:
    """Rewrite a day as ``files`` files and return how many there were; 0 for a missing day.

    Only the listed files are replaced: what arrives meanwhile stays, and so do the files of a batch
    that is not whole yet. A journal names the old and the new files before any moves, and the next
    run completes one that broke off; a reader between sees events twice, as after a redelivery, but
    never misses one.
    """
    store = Store(spark, path)
    folder, journal, aside = f"day={day}", f"_compact-{day}.json", f"_new-{day}"

    def finish() -> None:
        plan = json.loads(store.read(journal))
        for name in plan["new"]:
            if store.exists(f"{aside}/{name}"):
                store.move(f"{aside}/{name}", f"{folder}/{name}")
        for name in plan["old"]:
            store.delete(f"{folder}/{name}")
        store.delete(journal)
        store.delete(aside)

    if store.exists(journal):
        finish()
    whole = set(store.list("_batches"))
    before = [n for n in store.list(folder) if n.endswith(".parquet") and (n.startswith("part-") or n.rsplit("-", 1)[0] in whole)]
    if not before:
        return 0
    store.delete(aside)
    rows = spark.read.schema(EVENT).parquet(*(f"{path}/{folder}/{n}" for n in before))
    (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.parquet(f"{path}/{aside}")
    store.create(journal, json.dumps({"old": before, "new": [n for n in store.list(aside) if n.endswith(".parquet")]}))
    finish()
    return len(before)
