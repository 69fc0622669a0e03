"""Embedding near-duplicates by a subspace pigeonhole join.

Two unit vectors with cosine >= c differ by a squared distance <= 2 - 2c. After a rotation the
coordinates are split into blocks, and each block gets a share of that budget in proportion to its
spread; if the whole distance is within budget, at least one block's distance is within the block's
share. So the join runs once per block, as a range join in few dimensions, and the union of what it
finds holds every pair; each pair is then verified in double precision on the original vectors.

Within a block, vectors are dealt into cells along the block's widest directions (a cell is as wide
as the block's reach, so partners are in the same or an adjacent cell), more of them the more vectors
there are: few cells send each vector to few tasks, many cells compare it with few others. A cell with
many rows is cut into tiles, and tile meets tile, so that no task holds an unbounded group. A pair
that several blocks find is counted by the first of them only, which each task can tell by itself.

Equal vectors (by their exact components) are one class with a count, joined once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, connected_components, materialize

THRESHOLD = 0.95
#: Dimensions of a block, and vectors from which the rotation is fitted (results do not depend on it).
BLOCK, FIT_ROWS = 16, 5000
#: Rows of a tile of 64 dimensions (fewer of more): two tiles are what one comparison holds.
TILE = 16_384
#: Most directions that cells are cut along, and the cells of one that are counted on when their number is chosen.
DIRECTIONS, SPLIT = 4, 4
#: Rotated coordinates are whole multiples of 1/GRID, so that every task finds the same distances within blocks.
GRID = 1 << 20
#: Slack on squared distances for that rounding; verification is exact.
SLACK = 1e-5


@dataclass
class Rotation:
    matrix: np.ndarray  # columns: the new axes, block after block, each block's widest first
    cuts: np.ndarray  # starts of the blocks, with the end
    budgets: np.ndarray  # squared distance that each block may have

    @property
    def blocks(self) -> int:
        return len(self.budgets)


def fit_rotation(sample: np.ndarray, dim: int, threshold: float, block: int = BLOCK) -> Rotation:
    """Principal axes dealt over the blocks in turn, so that each has wide and narrow ones; budgets in proportion to the blocks' variances."""
    if len(sample) > dim:
        values, axes = np.linalg.eigh(np.cov(sample.T).reshape(dim, dim))
        values, axes = values[::-1], axes[:, ::-1]
    else:
        values, axes = np.ones(dim), np.eye(dim)
    values = np.maximum(values, 1e-9)
    n = max(1, dim // block)
    order = np.concatenate([np.arange(b, dim, n) for b in range(n)])
    cuts = np.cumsum([0, *(len(np.arange(b, dim, n)) for b in range(n))])
    spread = np.array([values[order[a:b]].sum() for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    return Rotation(axes[:, order], cuts, (2 - 2 * threshold) * spread / spread.sum() + SLACK)


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)  # or squares of tiny or huge components are lost
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def turn(rows: np.ndarray, rotation: Rotation) -> np.ndarray:
    """Unit rows to rotated whole coordinates."""
    return np.rint(rows @ rotation.matrix * GRID).astype(np.int64)


def _classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(every row with its class, usable classes): a class is a set of rows with equal components, named by its smallest id."""
    v = F.col("v")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(vectors[id_col].alias("id"), vectors[vec_col].cast("array<float>" if single else "array<double>").alias("v")).withColumn("ok", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: F.when(x != 0, x).otherwise(F.lit(0.0).cast("float" if single else "double")))))  # no negative zeros
    classes = rows.where("ok").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = classes.withColumn("dim", F.size("v"))
    return rows, materialize(classes, "vectors")


def tile_rows(dim: int) -> int:
    return max(16, min(TILE, TILE * 64 // dim))


def directions(n: int, tile: int) -> int:
    """Along how many directions n vectors are cut: so many that a cell has about a tile of them."""
    d = 1
    while d < DIRECTIONS and n > tile * SPLIT**d:
        d += 1
    return d


def _deal(rotation: Rotation, d: int):
    """Batches of classes to one row for each block: the block's cell along its d widest directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                n = part.num_rows
                if not n:
                    continue
                turned = turn(unit(_matrix(part.column(1))), rotation)
                ids, blocks, cells = [], [], []
                for b in range(rotation.blocks):
                    reach = int(np.ceil(np.sqrt(rotation.budgets[b]) * GRID))
                    own = turned[:, rotation.cuts[b] : min(rotation.cuts[b] + d, rotation.cuts[b + 1])] // reach
                    ids.append(part.column(0))
                    blocks.append(np.full(n, b, np.int32))
                    cells.append(np.hstack([own, np.zeros((n, d - own.shape[1]), np.int64)]).astype(np.int32))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d * rotation.blocks + 1, d, dtype=np.int32)), pa.array(np.concatenate(cells).ravel()))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.array(np.concatenate(blocks)), listed], names=["rep", "block", "cell"])

    return run


def _compare(rotation: Rotation, threshold: float):
    """Sorted rows (task, side, rep, copies, v) to (kind 0: rep, partners) and (kind 1: linked rep, rep)."""

    budgets = np.floor(rotation.budgets * GRID * GRID).astype(np.int64)

    rounding = 1e-5

    def sides(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose products are block k's share less its squared distance, in single precision."""
        p, q = (x[:, rotation.cuts[k] : rotation.cuts[k + 1]].astype(np.float32) / GRID for x in (a, b))
        one = lambda x: np.ones((len(x), 1), np.float32)
        left = np.hstack([2 * p, one(p), -(p * p).sum(1, keepdims=True)])
        right = np.hstack([q, np.float32(rotation.budgets[k]) - (q * q).sum(1, keepdims=True), one(q)])
        return left, np.ascontiguousarray(right.T)

    def exact(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        d = a[:, rotation.cuts[k] : rotation.cuts[k + 1]] - b[:, rotation.cuts[k] : rotation.cuts[k + 1]]
        return (d * d).sum(1)

    def links(a: np.ndarray, a_turned: np.ndarray, b: np.ndarray, b_turned: np.ndarray, block: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """The linked pairs whose first block within its share is ``block``."""
        found = []
        products = {block: sides(a_turned, b_turned, block)}
        for at in range(0, len(a), 128):
            left, right = products[block]
            near = left[at : at + 128] @ right >= -rounding
            if same:
                near[:, : at + 1] = False
                near &= np.arange(len(b))[None, :] > np.arange(at, at + len(near))[:, None]
            if block and np.count_nonzero(near) > near.size // 16:  # a dense group: leave what an earlier block surely has
                for k in range(block):
                    if k not in products:
                        products[k] = sides(a_turned, b_turned, k)
                    left, right = products[k]
                    near &= left[at : at + 128] @ right <= rounding
            i, j = np.nonzero(near)
            if not len(i):
                continue
            i += at
            keep = exact(a_turned[i], b_turned[j], block) <= budgets[block]
            i, j = i[keep], j[keep]
            for k in range(block):
                keep = exact(a_turned[i], b_turned[j], k) > budgets[k]
                i, j = i[keep], j[keep]
            hit = np.einsum("ij,ij->i", a[i], b[j]) >= threshold
            found.append((i[hit], j[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, out = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if task is None:
                return
            block, same = task[0], task[1]
            rows = [np.concatenate(x) for x in zip(*held, strict=True)]
            side, ids, copies, v = rows
            turned = turn(v, rotation)
            a, b = (side == 0, side == 0) if same else (side == 0, side == 1)
            i, j = links(v[a], turned[a], v[b], turned[b], block, same)
            if not len(i):
                return
            u, w, cu, cw = ids[a], ids[b], copies[a], copies[b]
            who, inverse = np.unique(np.concatenate([u[i], w[j]]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([cw[j], cu[i]])).astype(np.int64)
            yield pack(np.zeros(len(who), np.int32), who, n)
            # a spanning forest of the links is enough for components
            root = np.arange(len(who))
            p, q = inverse[: len(i)], inverse[len(i) :]
            while True:
                low = np.minimum(root[p], root[q])
                new = root.copy()
                np.minimum.at(new, p, low)
                np.minimum.at(new, q, low)
                new = np.minimum(new, new[new])
                if (new == root).all():
                    break
                root = new
            other = root != np.arange(len(root))
            yield pack(np.ones(int(other.sum()), np.int32), who[other], who[root[other]])

        for batch in batches:
            # rows of one task stand together; a task is block, whether its sides are one, cells and tiles
            keys = batch.column(0).to_pylist()
            start = 0
            block, same = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            side, ids, copies = (batch.column(k).to_numpy() for k in (3, 4, 5))
            v = unit(_matrix(batch.column(6))) if len(keys) else None
            for k in range(1, len(keys) + 1):
                if k < len(keys) and keys[k] == keys[start]:
                    continue
                now = (int(block[start]), bool(same[start]), keys[start])
                if now != task:
                    yield from flush()
                    task, held = now, []
                held.append((side[start:k], ids[start:k], copies[start:k], v[start:k]))
                start = k
        yield from flush()

    def pack(kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    return run


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    so do vectors of different lengths with each other. Equal vectors link with each other; of rows
    that repeat an id each counts. Very long vectors are compared whole, in smaller tiles. Other
    columns are not read, whatever their names; an empty table gives an empty result.
    """
    rows, classes = _classes(vectors, id_col, vec_col)
    links = []
    for dim in [r["dim"] for r in classes.select("dim").distinct().collect()]:
        own = classes.where(F.col("dim") == dim)
        fitted = np.array([r["v"] for r in bounded_sample(own.select("rep", "v"), FIT_ROWS, "rep").collect()])
        rotation = fit_rotation(unit(fitted), dim, threshold)
        tile = tile_rows(dim)
        d = directions(own.count(), tile)
        dealt = own.select("rep", "v").mapInArrow(_deal(rotation, d), "rep long, block int, cell array<int>")
        cells = materialize(dealt, "cells")
        tiles = cells.groupBy("block", "cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("n_tiles"))
        placed = cells.join(tiles, ["block", "cell"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("n_tiles")).cast("int"))
        # the cell itself and the half of its neighbours that comes after it meet all pairs of cells once
        after = [s for s in product((-1, 0, 1), repeat=d) if s >= (0,) * d]
        steps = F.array(*(F.array(*map(F.lit, s)) for s in after))
        other = tiles.select("block", F.col("cell").alias("cell2"), F.col("n_tiles").alias("n_other"))
        meet = (
            tiles.withColumn("s", F.explode(steps))
            .select("block", "cell", "n_tiles", F.zip_with("cell", "s", lambda c, s: c + s).alias("cell2"))
            .join(other, ["block", "cell2"])
        )
        own_cell = F.col("cell") == F.col("cell2")
        pairs = (
            meet.withColumn("t1", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
            .withColumn("t2", F.explode(F.sequence(F.when(own_cell, F.col("t1")).otherwise(F.lit(0)), F.col("n_other") - 1)))
            .select(
                "block", (own_cell & (F.col("t1") == F.col("t2"))).alias("same"),
                F.concat_ws(";", F.col("block").cast("string"), F.concat_ws(",", F.col("cell").cast("array<string>")), F.col("t1").cast("string"), F.concat_ws(",", F.col("cell2").cast("array<string>")), F.col("t2").cast("string")).alias("task"),
                "cell", "t1", "cell2", "t2",
            )
        )
        one = F.struct(F.lit(0).alias("side"), F.col("cell"), F.col("t1").alias("tile"))
        two = F.struct(F.lit(1).alias("side"), F.col("cell2").alias("cell"), F.col("t2").alias("tile"))
        sides = pairs.select("task", "block", "same", F.explode(F.when(F.col("same"), F.array(one)).otherwise(F.array(one, two))).alias("c")).select("task", "block", "same", "c.*")
        sent = placed.join(sides, ["block", "cell", "tile"]).select("task", "block", "same", "side", "rep")
        full = sent.join(own.select("rep", "copies", "v"), "rep").select("task", "block", "same", "side", "rep", "copies", "v")
        full = full.repartition("task").sortWithinPartitions("task")
        links.append(full.mapInArrow(_compare(rotation, threshold), "kind int, a long, b long"))
    found = links[0] if links else None
    for more in links[1:]:
        found = found.unionByName(more)
    reps = classes.select(F.col("v").alias("cv"), "rep", "copies")
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialize(found, "links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("partners"))
    components = connected_components(found.where("kind = 1").select("a", "b"))
    known = (
        reps.join(counts, "rep", "left").join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .select("cv", (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    out = rows.select("id", F.when(F.col("ok"), F.col("v")).alias("cv")).join(known, "cv", "left")
    component = F.coalesce("c", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
