"""N-gram Jaccard join by a token-group matrix, exact at the given similarity.

A document's set is its distinct 5-word shingles. Equal sets are one class. Then:

1. *Groups.* Classes that share one of a few min-hash keys are compared with the smallest class of
   that key; verified links make groups of similar classes.
2. *Token-group matrix.* Shingles get a global order, rare ones first. A class whose set is similar
   enough to another shares at least one of its first |x| - ceil(0.8 |x|) + 1 shingles with it, so the
   matrix (shingle, group) of these prefixes, the union over each group's classes, holds at least one
   common row for every pair of groups with a link between them.
3. *Bound.* The rows that two groups share bound the overlap of any two of their classes from above;
   pairs of groups that cannot reach the threshold are dropped.
4. *Open.* What is left is opened: each class of one group is held against the union of the other
   group's shingles, and only if that overlap reaches the threshold against its classes one by one.

The links of 1 and 4 are all that components need: no pair within a group is listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import AT_ONCE, BROADCAST_ROWS, batch_rows, connected_components, materialize, mix64, released, shingle_sets, signed

SIZE = 5
#: Similarity as a fraction: linked if DEN * |x & y| >= NUM * |x | y|.
NUM, DEN = 4, 5
#: Min-hash keys of a class, and values in each.
KEYS, VALUES = 6, 2
#: Shingles that a block of BLOCK counts in at least SEEN documents are candidates for the end of the order; at most HOT of them move there.
BLOCK, SEEN, HOT = 2_000_000, 4, 1 << 18
#: Classes that a comparison holds at once, and those that ask it.
HELD, ASKED = 256, 1024

_SEEDS = mix64(np.arange(101, 101 + KEYS * VALUES, dtype=np.uint64))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit words that name a set."""
    if not len(shingles):
        return 0, 0
    with np.errstate(over="ignore"):
        return tuple(int(x.astype(np.int64)) for x in (mix64(shingles).sum(), np.bitwise_xor.reduce(mix64(shingles + np.uint64(13)))))


def minhash_keys(shingles: np.ndarray) -> list[int]:
    """KEYS words, each of VALUES min-hashes."""
    if not len(shingles):
        return []
    least = np.array([mix64(shingles ^ s).min() for s in _SEEDS], np.uint64)
    out = []
    for k in range(KEYS):
        part = least[k * VALUES : (k + 1) * VALUES]
        out.append(int(mix64(np.array([(part * (np.arange(VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(3))).sum() + np.uint64(k)], np.uint64))[0].astype(np.int64)))
    return out


def prefix_size(n: int) -> int:
    """So many of a set's first shingles meet those of every similar set."""
    return n - -(-NUM * n // DEN) + 1


def needed_overlap(a: int, b: int) -> int:
    """The least overlap of linked sets of these sizes."""
    return -(-NUM * (a + b) // (DEN + NUM))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def in_order(shingles: np.ndarray, hot: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shingles by the global order: those that are not hot by value, then the hot ones by count and value."""
    if not len(hot):
        return shingles
    at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
    weight = np.where(hot[at] == shingles, counts[at], 0)
    return shingles[np.argsort(weight, kind="stable")]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        n, h1, h2, keys = [], [], [], []
        for s in shingle_sets(batch.column(1), SIZE):
            n.append(len(s))
            a, b = set_key(s)
            h1.append(a)
            h2.append(b)
            keys.append(minhash_keys(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
            names=["id", "n", "h1", "h2", "keys"],
        )


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of many documents, with their numbers, block by block; equal sets count once in a block."""
    held, size, seen = [], 0, set()

    def flush() -> Iterator[pa.RecordBatch]:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        keep = counts >= SEEN
        yield pa.RecordBatch.from_arrays([pa.array(signed(tokens[keep])), pa.array(counts[keep].astype(np.int64))], names=["token", "n"])

    for batch in released(batches):
        for s in shingle_sets(batch.column(0), SIZE):
            key = set_key(s)
            if len(s) and key not in seen:
                seen.add(key)
                held.append(s)
                size += len(s)
                if size >= BLOCK:
                    yield from flush()
                    held, size, seen = [], 0, set()
    if held:
        yield from flush()


def _prefixes(hot: np.ndarray, counts: np.ndarray):
    """Rows (token, class, size, whether the token is hot) of every class's prefix; a class that a task meets again is left out while it remembers it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in released(batches):
            tokens, classes, sizes = [], [], []

            def pack() -> pa.RecordBatch:
                lengths = [len(t) for t in tokens]
                token = np.concatenate([np.zeros(0, np.uint64), *tokens])
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(token)), pa.array(np.repeat(np.array(classes, np.int64), lengths)), pa.array(np.repeat(np.array(sizes, np.int32), lengths)),
                        pa.array(np.isin(token, hot)),
                    ],
                    names=["token", "class", "n", "hot"],
                )

            rows = 0
            for s in shingle_sets(batch.column(0), SIZE):
                key = set_key(s)
                if not len(s) or key in seen:
                    continue
                if len(seen) < 1 << 18:
                    seen.add(key)
                tokens.append(in_order(s, hot, counts)[: prefix_size(len(s))])
                classes.append(key[0])
                sizes.append(len(s))
                rows += len(tokens[-1])
                if rows > 1 << 18:
                    yield pack()
                    tokens, classes, sizes, rows = [], [], [], 0
            yield pack()

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token, those whose token has more than one class; of a token that goes on in the next batch one row is held until another class shows."""
    held, shared = None, False  # the last token's first row, and whether it has been passed on
    for batch in batches:
        token, cls, n = (batch.column(k).to_numpy() for k in range(3))
        if not len(token):
            continue
        if held is not None:
            token, cls, n = (np.concatenate([[a], b]) for a, b in zip(held, (token, cls, n), strict=True))
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(token))))
        several = np.bincount(run, cls != cls[first][run]) > 0
        if held is not None:
            several[0] |= shared
        keep = several[run]
        if held is not None and shared:
            keep[0] = False  # it has gone before
        shared = bool(several[-1])
        held = token[-1], cls[first[-1]], n[first[-1]]
        yield pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(cls[keep]), pa.array(n[keep].astype(np.int32))], names=["token", "class", "n"])


def _shared_or_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of hot shingles as they are, and of the others (which come first) those that ``_shared`` leaves."""
    hot: list[pa.RecordBatch] = []

    def cold() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = int(pc.sum(batch.column(3)).as_py() or 0)
            yield batch.slice(0, batch.num_rows - n)
            if n:
                hot.append(batch.slice(batch.num_rows - n).select([0, 1, 2]))

    for out in _shared(cold()):
        yield out
        while hot:
            yield hot.pop()
    while hot:
        yield hot.pop()


def _open(one_link: bool):
    """Rows (task, held, id, text) by task, held ones first, to links (a, b) of the others with the held ones: of each other one, or only one of the whole task (of two groups, each connected, one link tells all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, sets, union, done = None, [], [], None, False
        out_a, out_b = [], []
        for batch in released(batches):
            tasks, is_held, own = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for t, h, i, s in zip(tasks, is_held, own, shingle_sets(batch.column(3), SIZE), strict=True):
                if t != task:
                    task, ids, sets, union, done = t, [], [], None, False
                if h:
                    ids.append(i)
                    sets.append(s)
                    union = None
                    continue
                if done or not sets or not len(s):
                    continue
                if union is None:
                    union = np.unique(np.concatenate(sets)) if len(sets) > 1 else sets[0]
                if len(sets) > 1 and DEN * len(np.intersect1d(s, union, assume_unique=True)) < NUM * len(s):
                    continue  # the bound: no set of the group can reach the threshold
                for j, other in zip(ids, sets, strict=True):
                    if linked(s, other):
                        out_a.append(i)
                        out_b.append(j)
                        done = one_link
                        break
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
                out_a, out_b = [], []

    return run


def open_tasks(docs: DataFrame, tasks: DataFrame, one_link: bool) -> DataFrame:
    """The links found in ``tasks`` (task, held, id): texts are fetched for their ids only. A task has at most HELD + ASKED rows."""
    tasks = materialize(tasks, "tasks")
    wanted = tasks.select("id").distinct()
    n = tasks.count()
    if n == 0:
        return tasks.sparkSession.createDataFrame([], "a long, b long")
    texts = docs.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, "id", "left_semi")
    rows = texts.join(tasks, "id").select("task", "held", "id", "text")
    rows = rows.repartition("task").sortWithinPartitions("task", F.desc("held"))
    return materialize(rows.mapInArrow(_open(one_link), "a long, b long"), "links")


def most_frequent(counted: DataFrame, rows: int) -> DataFrame:
    """The rows (token, n) with the largest n, as many as there are up to ``rows``, by a threshold from a histogram: no task sorts them."""
    step = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, None
    for r in sorted(counted.groupBy(step.alias("step")).count().collect(), key=lambda r: -r.step):  # at most 8 * 63 steps
        total += r["count"]
        if total > rows:
            break
        least = r.step
    return counted.where(F.lit(False)) if least is None else counted.where(step >= least)


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``documents``: id, n_shingles, component_id (the smallest id that links reach).

    Words are runs of other bytes than space and \\t..\\r, A-Z in lower case; a text of one to four
    words has the run of all as its one shingle; null and empty texts have none and link with
    nothing. Equal sets link. Rows that repeat an id are told apart by their texts only; a null id
    keeps its row but takes part in no link and is its own (null) component. Ids that are no integers
    raise a TypeError. Very long texts are compared whole. Other columns are not read, whatever their
    names; an empty table gives an empty result.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    if not isinstance(documents.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer: the smallest of a component names it")
    batch_rows(docs.sparkSession)
    known = docs.where(F.col("id").isNotNull())
    sig = materialize(docs.mapInArrow(_signatures, "id long, n long, h1 long, h2 long, keys array<long>"), "signatures")
    classes = materialize(
        sig.where("n > 0 AND id IS NOT NULL").groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "classes"
    )
    # 1. groups
    keyed = classes.select("rep", "n", F.explode("keys").alias("key"))
    leaders = keyed.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("l"), F.count("*").alias("c")).where("c > 1").select("key", F.col("l.rep").alias("leader"), F.col("l.n").alias("ln"))
    near = (
        keyed.join(leaders, "key")
        .where((F.col("rep") != F.col("leader")) & (DEN * F.least("n", "ln") >= NUM * F.greatest("n", "ln")))
        .select("rep", "leader")
        .distinct()
    )
    near = materialize(near, "near")
    held = near.groupBy("leader").agg(F.ceil(F.count("*") / ASKED).alias("parts"))
    salted = near.join(held, "leader").select(F.concat_ws("/", "leader", F.pmod(F.xxhash64("rep"), "parts")).alias("task"), "leader", F.col("rep").alias("id"))
    tasks = salted.select("task", F.lit(False).alias("held"), "id").union(salted.select("task", F.lit(True), "leader").distinct())
    first_links = open_tasks(known, tasks, one_link=False)
    groups = connected_components(first_links, at_once=AT_ONCE).withColumnRenamed("id", "rep").withColumnRenamed("component", "group_id")
    member = materialize(classes.select("h1", "rep", "n").join(groups, "rep", "left").select("h1", "rep", "n", F.coalesce("group_id", "rep").alias("group_id")), "members")
    # 2. token-group matrix
    frequent = known.select("text").mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequent = materialize(frequent.where(F.col("n") >= 2 * SEEN), "frequent")
    hot_rows = most_frequent(frequent, HOT).toArrow()
    hot = hot_rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(hot)
    hot, counts = hot[order], hot_rows.column("n").to_numpy()[order]
    # Hot shingles have several classes for sure, so only the others are dealt by shingle to find out, and none of those has many rows.
    rows = known.select("text").mapInArrow(_prefixes(hot, counts), "token long, class long, n int, hot boolean")
    dealt = rows.select(F.when(F.col("hot"), F.xxhash64("token", "class")).otherwise(F.col("token")).alias("k"), "token", "class", "n", "hot")
    sorted_rows = dealt.repartition("k").drop("k").sortWithinPartitions("hot", "token")
    shared = materialize(sorted_rows.mapInArrow(_shared_or_hot, "token long, class long, n int"), "matrix")
    by_group = shared.join(member.select(F.col("h1").alias("class"), "group_id", F.col("n").cast("int").alias("n")), ["class", "n"])
    matrix = materialize(by_group.groupBy("token", "group_id").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "group-matrix")
    # 3. bound
    other = matrix.select("token", F.col("group_id").alias("g2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    meet = (
        matrix.withColumnRenamed("group_id", "g1")
        .join(other, "token")
        .where((F.col("g1") < F.col("g2")) & (DEN * F.col("hi") >= NUM * F.col("lo2")) & (DEN * F.col("hi2") >= NUM * F.col("lo")))
        .groupBy("g1", "g2")
        .agg(F.count("*").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("lo2").alias("lo2"), F.max("hi2").alias("hi2"))
    )
    # Two sets of sizes a, b share at least 1 + needed_overlap(a, b) - ceil(0.8 max(a, b)) of their prefixes. But for
    # rounding, by one at most, this grows up to a = b and falls beyond: over ranges of sizes it is least at their ends.
    ends = [
        1 + F.ceil(NUM * (F.col(a) + F.col(b)) / F.lit(DEN + NUM)) - F.ceil(NUM * F.greatest(F.col(a), F.col(b)) / F.lit(DEN))
        for a in ("lo", "hi") for b in ("lo2", "hi2")
    ]
    one_size = (F.col("lo") == F.col("hi")) & (F.col("lo2") == F.col("hi2"))
    pairs = meet.where(F.col("c") >= F.least(*ends) - F.when(one_size, 0).otherwise(1))
    pairs = materialize(pairs.select("g1", "g2"), "pairs")
    # 4. open
    sizes = member.groupBy("group_id").agg(F.count("*").alias("m"))
    sized = pairs.join(sizes.withColumnRenamed("group_id", "g1").withColumnRenamed("m", "m1"), "g1").join(
        sizes.withColumnRenamed("group_id", "g2").withColumnRenamed("m", "m2"), "g2"
    )
    # the smaller group is held; either goes in parts if it is large
    sized = sized.select(
        F.when(F.col("m1") <= F.col("m2"), F.col("g1")).otherwise(F.col("g2")).alias("held_group"), F.when(F.col("m1") <= F.col("m2"), F.col("g2")).otherwise(F.col("g1")).alias("ask_group"),
        F.ceil(F.least("m1", "m2") / HELD).cast("int").alias("parts"), F.ceil(F.greatest("m1", "m2") / ASKED).cast("int").alias("ask_parts"),
    )
    parted = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("ask_part", F.explode(F.sequence(F.lit(0), F.col("ask_parts") - 1)))
    name = F.concat_ws("/", "held_group", "ask_group", "part", "ask_part").alias("task")
    holds = parted.join(member.select(F.col("group_id").alias("held_group"), F.col("rep").alias("id")), "held_group").where(F.pmod(F.xxhash64("id"), F.col("parts")) == F.col("part"))
    asks = parted.join(member.select(F.col("group_id").alias("ask_group"), F.col("rep").alias("id")), "ask_group").where(F.pmod(F.xxhash64("id"), F.col("ask_parts")) == F.col("ask_part"))
    tasks = holds.select(name, F.lit(True).alias("held"), "id").union(asks.select(name, F.lit(False), "id"))
    links = first_links.unionByName(open_tasks(known, tasks, one_link=True))
    components = connected_components(links, at_once=AT_ONCE).withColumnRenamed("id", "rep")
    named = classes.select("h1", "h2", "n", "rep").join(components, "rep", "left").select("h1", "h2", "n", F.coalesce("component", "rep").alias("c"))
    # documents of equal sets join the class's component; a large class is split by the adaptive skew join
    out = sig.select("id", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
    mine = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("c"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(mine, "id").alias("component_id"))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with one document of each component, that of its own smallest id; rows with a null id stay."""
    found = jaccard_components(documents, id_col, text_col).where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return documents.join(found, id_col, "left_anti")

