"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected on TABLES random 16-dimensional subspaces; each half of a projection is decoded to its
nearest E8 lattice point, and the two points name a cell. A vector stands in its own cell and also looks into the
cells made of the nearest points of the other coset of D8 in one or both halves. Vectors that meet in a cell are
compared by cosine in double precision. The tables are deterministic; nothing is fitted.

Equal vectors are one class, so copies cost one row. A cell of more than BLOCK rows is dealt out in pairs of blocks, so
no task holds a whole one. Pairs are never written out: a task counts a pair in the first table and cell in which it
meets, adds up links per vector, and gives the pairs' components as stars.

Defined results: null, empty and zero vectors and vectors with a null or non-finite component link with nothing;
vectors of different lengths link with nothing; a null vec_id links with nothing, has no component and is kept; rows
with one vec_id and equal vectors are one vector; rows of one vec_id with different vectors each count by their own;
other columns are left alone; an empty table gives an empty table. A pair at the
threshold 0.9 is found with probability 0.969, at 0.95 with 0.9996 (20,000 made pairs each).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import dealt_in_blocks, map_arrow, stored, whole_groups
from spendlens.llm.graph import components

TABLES, SCALE, BLOCK = 12, 0.25, 512


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (integers with an even sum) to the rows of x."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(x - near)[odd].argmax(1)
    near[odd, worst] += np.where(x[odd, worst] >= near[odd, worst], 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest E8 point of each row, doubled to integers, and the nearest point of the other coset of D8."""
    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    first = (((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1))[:, None]
    near, other = np.where(first, half, whole), np.where(first, whole, half)
    return (2 * near).astype(np.int64), (2 * other).astype(np.int64)


@lru_cache(maxsize=16)
def _projections(dimension: int) -> np.ndarray:
    draw = np.random.default_rng(20_000 + dimension).normal(size=(TABLES, dimension, 16))
    return np.concatenate([np.linalg.qr(m)[0] if dimension >= 16 else m / np.sqrt(dimension) for m in draw], axis=1)


def _mixed(points: np.ndarray, seed: int) -> np.ndarray:
    h = np.full(len(points), seed, np.uint64)
    for k in range(points.shape[1]):
        h = (h ^ points[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def cells(unit: np.ndarray) -> np.ndarray:
    """(rows, TABLES, 4) cell names of unit vectors; the first of each four is the vector's own cell."""
    rows, dimension = unit.shape
    # The usual length of a projection is sqrt(16 / dimension); the scale is relative to that of 64 dimensions.
    flat = unit @ _projections(dimension) / (SCALE * np.sqrt(64 / max(dimension, 16)))
    out = np.empty((rows, TABLES, 4), np.uint64)
    for t in range(TABLES):
        a, b = (nearest_e8(flat[:, 16 * t + 8 * h:16 * t + 8 * h + 8]) for h in (0, 1))
        left = [_mixed(p, 2 * t + 1 + 1000 * dimension) for p in a]
        right = [_mixed(p, 2 * t + 2 + 1000 * dimension) for p in b]
        for k in range(4):
            out[:, t, k] = left[k & 1] * np.uint64(0xBF58476D1CE4E5B9) ^ right[k >> 1]
    return out.view(np.int64)


def units(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _unit_rows(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Length of each vector, its place among those of its length, and the unit vectors by length."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    size = np.diff(offsets)
    place = np.empty(len(size), np.int64)
    by_size = {}
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        place[rows] = np.arange(len(rows))
        by_size[int(d)] = units(values[offsets[rows][:, None] + np.arange(d)])
    return size, place, by_size


def _with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 4000):
            batch = whole.slice(start, 4000)
            size, _, by_size = _unit_rows(batch.column("vector"))
            names = np.empty((len(size), TABLES * 4), np.int64)
            for d, unit in by_size.items():
                names[size == d] = cells(unit).reshape(len(unit), -1)
            offsets = pa.array(np.arange(len(size) + 1, dtype="i4") * TABLES * 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(names.ravel()))],
                                             [*batch.schema.names, "cells"])


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least member of the component of each of n nodes under the edges a, b."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        then = label.copy()
        np.minimum.at(then, a, least)
        np.minimum.at(then, b, least)
        then = then[then]
        if (then == label).all():
            return label
        label = then


def _links(rows: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """node, number of links, centre of its star, for whole groups of rows that lie together."""
    cell, first, second, block, node, copies = (rows.column(c).to_numpy() for c in ("cell", "first", "second", "block", "node", "copies"))
    size, place, by_size = _unit_rows(rows.column("vector").combine_chunks())
    fresh = (cell[1:] != cell[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    group = np.r_[0, np.cumsum(fresh)]
    found = []
    live, shift = np.arange(len(node) - 1), 1
    while len(live):
        live = live[live + shift < len(node)]
        live = live[group[live] == group[live + shift]]
        other = live + shift
        ok = (node[live] != node[other]) & (size[live] == size[other]) & ((first[live] == second[live]) | (block[live] != block[other]))
        a, b = live[ok], other[ok]
        for d in np.unique(size[a]):
            x, y = a[size[a] == d], b[size[a] == d]
            close = np.einsum("ij,ij->i", by_size[d][place[x]], by_size[d][place[y]]) >= threshold
            found.append(np.stack([x[close], y[close]]))
        shift += 1
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    if not pairs.shape[1]:
        return (np.empty(0, np.int64),) * 3
    # A pair counts in the first table in which the two share any of their four cells, and there in the first of those.
    own = np.zeros((len(node), TABLES, 4), np.int64)
    used = np.unique(pairs)
    for d in np.unique(size[used]):
        of = used[size[used] == d]
        own[of] = cells(by_size[d][place[of]])
    keep = []
    for start in range(0, pairs.shape[1], 50_000):
        x, y = pairs[:, start:start + 50_000]
        x, y = np.where(node[x] < node[y], x, y), np.where(node[x] < node[y], y, x)
        shared = (own[x][:, :, :, None] == own[y][:, :, None, :]).any(3).reshape(len(x), -1)
        keep.append(own[x].reshape(len(x), -1)[np.arange(len(x)), shared.argmax(1)] == cell[x])
    x, y = pairs[:, np.concatenate(keep)]
    names, back, index = np.unique(node, return_index=True, return_inverse=True)
    a, b, weight = index[x], index[y], copies[back]
    links = np.zeros(len(names), np.int64)
    np.add.at(links, a, weight[b])
    np.add.at(links, b, weight[a])
    label, linked = _labels(a, b, len(names)), np.flatnonzero(links)
    return names[linked], links[linked], names[label[linked]]


def _count_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the groups of one task; its rows are sorted by group, and a group has 2 * BLOCK rows at most."""
    for rows in whole_groups(batches, ("cell", "first", "second"), 4 * BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _links(rows, threshold)], ["node", "links", "centre"])


def near_vectors(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce((F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    classes = stored(base.where(sound).groupBy("vector").agg(F.min("vec_id").alias("node"), F.countDistinct("vec_id").alias("copies")), "vectors")
    kind = classes.schema["vector"].dataType.simpleString()
    rows = map_arrow(classes, _with_cells, f"vector {kind}, node bigint, copies bigint, cells array<bigint>").select(
        F.explode("cells").alias("cell"), "node", "copies", "vector")
    shared = map_arrow(classes, _with_cells, f"vector {kind}, node bigint, copies bigint, cells array<bigint>").select(
        F.explode("cells").alias("cell")).groupBy("cell").count().where("count > 1")
    grouped = dealt_in_blocks(rows.join(shared, "cell"), "cell", "node", "count", BLOCK)
    counted = stored(map_arrow(grouped, lambda b: _count_links(b, threshold), "node bigint, links bigint, centre bigint"), "links")
    found = components(counted.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")))
    degree = counted.groupBy("node").agg(F.sum("links").alias("links"))
    by_class = classes.join(degree, "node", "left").join(found, "node", "left").select(
        F.col("vector").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    keyed = base.withColumn("sound", F.when(sound, F.col("vector")))
    joined = keyed.join(by_class, keyed["sound"] == by_class["class"], "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
