"""Shared helpers of the corpus operators: scratch tables, byte-level text kernels, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that the array kernels handle at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 18
#: Rows up to which a table of (long) keys is broadcast: about 24 MB as a hashed relation.
BROADCAST_ROWS = 500_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``; only where it is unset, as in tests, a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root, deleted when the session's JVM ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS, FEW_ROWS = 10_000, 1000


def batch_rows(spark: SparkSession, rows: int = FEW_ROWS) -> None:
    """Rows of the Arrow batches from now on, unless the session has a number of its own: documents are long, and several Python processes share an executor's memory."""
    if spark.conf.get(_BATCH) in (str(_DEFAULT_ROWS), str(FEW_ROWS)):
        spark.conf.set(_BATCH, str(rows))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the Arrow pool holds of one that is done goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that is kept from every learner: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def bounded_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hashes of the columns ``by``: the same rows for any partitioning.

    A first cut by the hash's value leaves little more than ``rows`` in all, so that no task sends
    many rows to the one that sorts.
    """
    n = df.count()
    at = F.pmod(F.xxhash64(*by, F.lit(97)), F.lit(1 << 62))
    if n > rows:
        df = df.where(at < int(min(1.0, 1.25 * rows / n + 1e-9) * (1 << 62)))
    return df.orderBy(at, *by).limit(rows)


# --------------------------------------------------------------------------------------------
# Text as bytes


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of a string column as (first row, end row, bytes, offsets); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    column = column.cast(pa.large_string()).fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return _LOWER[data]


def word_bounds(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes within each text, and for each text the index of its first word (one more entry at the end)."""
    if not len(is_word):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before = np.empty(len(is_word), bool)
    before[0] = False
    before[1:] = is_word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(is_word)]
    before[firsts] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(len(is_word), bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    lasts = offsets[1:] - 1
    after[lasts[lasts >= 0]] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        _powers[key] = np.cumprod(p, dtype=np.uint64)
        if size > 16 * CHUNK_BYTES:  # do not keep the table of one huge text
            return _powers.pop(key)[:n]
    return _powers[key][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for every pair, from prefix sums of a polynomial."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power(_BASE_INVERSE, n + 1)[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words_by_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the words ``[^\\x20\\x09-\\x0D]+``."""
    return word_bounds(~_SPACE[data], offsets)


_WEIGHTS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _WEIGHTS[k]
    return mix64(total)


def shingle_sets(column: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of ``size`` words, letters A-Z in lower case; of fewer words the run of all; empty without words."""
    for i, j, data, offsets in text_chunks(column):
        data = lower_ascii(data)
        starts, ends, first = words_by_space(data, offsets)
        words = span_hashes(data, starts, ends)
        whole = window_hashes(words, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                yield np.unique(whole[a : b - size + 1])
            elif b > a:
                yield window_hashes(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --------------------------------------------------------------------------------------------
# Components


#: Edges whose components the driver finds by itself: 16 bytes each, and 16 for each of their ids.
AT_ONCE = 200_000
#: A node with more than this share of all rows is joined by broadcast: there are at most 1 / HUB of them.
HUB = 1 / 400


def _with_least(pairs: DataFrame, total: int, own: bool) -> DataFrame:
    """``pairs`` (a, b) with m, the least b of each a (or a itself, with ``own``).

    The rows of an ``a`` that has more than the share HUB of all ``total`` rows stay where they are
    and meet its least by broadcast (at most 1 / HUB rows, whatever the input); only the others are
    dealt by ``a``, so no task holds a hub's neighbours.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c"))
    if own:
        least = least.withColumn("m", F.least("a", "m"))
    least = materialize(least, "least")
    hubs = F.broadcast(least.where(F.col("c") > total * HUB).select("a", "m"))
    rest = least.where(F.col("c") <= total * HUB).select("a", "m")
    return pairs.join(hubs, "a").unionByName(pairs.join(hubs.select("a"), "a", "left_anti").join(rest, "a"))


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the edges (a, b), sorted, and the smallest id that each can reach."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    least = np.arange(len(ids))
    a, b = at[: len(a)], at[len(a) :]
    while len(a):
        a, b = least[a], least[b]
        open_ = a != b
        a, b = np.maximum(a, b)[open_], np.minimum(a, b)[open_]
        np.minimum.at(least, a, b)
        while (least[least] != least).any():
            least = least[least]
    return ids, ids[least]


def connected_components(edges: DataFrame, rounds: int = 60, at_once: int = 0) -> DataFrame:
    """``edges`` (a, b) to (id, component): the smallest id that can be reached; ids without an edge have no row.

    Alternating large-star and small-star rounds: only minima and edges move between tasks, and each
    round is written to the shared folder. The number of rounds grows with the logarithm of the
    longest chain; edges that are not done after ``rounds`` raise an error. Up to ``at_once`` edges
    are done by the driver instead, whose memory a dozen plans a round cost more than so few edges.
    """
    edges = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = None
    for _ in range(rounds):
        stats = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if stats[0] == 0 or stats == seen:
            break
        if stats[0] <= at_once:
            held = edges.toArrow()
            ids, least = least_reached(held.column("a").to_numpy(), held.column("b").to_numpy())
            return materialize(edges.sparkSession.createDataFrame(pa.table({"id": ids, "component": least})), "components")
        seen = stats
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, 2 * stats[0], own=True).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "stars")
        small = (
            _with_least(large, stats[0], own=False)
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        edges = materialize(small, "edges")
    else:
        raise RuntimeError(f"components are not complete after {rounds} rounds")
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id").unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that columns of ``df`` have."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def schema_with(df: DataFrame, **added: str) -> T.StructType:
    """The schema of ``df`` with further columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in added.items())])
