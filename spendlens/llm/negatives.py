"""Hard-negative mining with Four-Russians scoring.

Components become whole numbers, floor(scale * x). A candidate is kept as bit planes: for each plane, one byte for every
eight dimensions. An anchor is kept as tables: for each eight dimensions, the sums of all 256 subsets of its numbers. A
candidate's byte is an index into such a table; the found sums of a plane, added over the groups of eight and shifted by
the plane, give the full exact inner product (the top plane counts negative).

Every anchor is scored against every row, in blocks: rows are dealt by a hash of their id into blocks of about
`BLOCK_ROWS`, anchors into chunks of about `CHUNK_ANCHORS`, and a (block, chunk) unit is one small task's work. The first
pass scores rows of an anchor's own label and finds its positives; the second scores the other labels and
keeps, for each anchor and positive, the first rows whose score lies in the window below the positive's score. A unit
returns at most `positives` or `positives * negatives` rows for an anchor; those are ranked again over all units.
No label, vector or id is a grouping key before that, so a hot label or a vector that many rows share changes nothing.

Defined results: rows with a null id, a null label, a null vector, or a null or non-finite component take no part; nor do
rows with a component of `MOST` or more in amount, as their products need not fit in 64 bits; ids and labels that are
no whole numbers count as null; rows with one id are one row (the least label, then the least vector); vectors of different lengths are not compared; empty vectors score
0 with each other; equal scores are ordered by id; an anchor without positives, and a positive without negatives, gives
no row; other columns are left alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendlens.llm.common import map_arrow, stored

BLOCK_ROWS, CHUNK_ANCHORS = 2048, 512
MOST = float(1 << 18)
#: Tasks of a pass at most; a task has the work of several units beyond that.
MOST_TASKS = 20_000
#: Rows scored at once: their sums and a table stay in a core's cache.
STRIP = 256

BLOCK = "block int, size int, planes int, ids array<bigint>, labels array<bigint>, bits binary"
CHUNK = "chunk int, size int, ids array<bigint>, labels array<bigint>, numbers array<bigint>, positives array<bigint>, scores array<bigint>, counts array<int>"


def numbers_of(vectors: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of rows of one length, as int64."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(scale * flat).astype(np.int64).reshape(len(vectors), -1)


def planes_for(numbers: np.ndarray) -> int:
    """Bits that hold the numbers in two's complement."""
    if not numbers.size:
        return 1
    return 1 + max(max(int(numbers.max()), 0).bit_length(), max(-int(numbers.min()) - 1, 0).bit_length())


def pack(numbers: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups of eight dimensions) bytes; dimension 8 g + k is bit k of group g."""
    bits = (numbers[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(numbers: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors) sums of the subsets of each eight of an anchor's numbers."""
    anchors, size = numbers.shape
    groups = -(-size // 8)
    padded = np.zeros((anchors, 8 * groups), kind)
    padded[:, :size] = numbers
    eights = padded.reshape(anchors, groups, 8).transpose(1, 2, 0)
    sums = np.zeros((groups, 256, anchors), kind)
    for k in range(8):
        sums[:, 1 << k:2 << k] = sums[:, :1 << k] + eights[:, k:k + 1]
    return sums


def score(bits: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products from bit planes and subset sums."""
    rows, planes, groups = bits.shape
    total = np.zeros((rows, sums.shape[2]), sums.dtype)
    for start in range(0, rows, STRIP):
        out, part = total[start:start + STRIP], bits[start:start + STRIP]
        found = np.empty_like(out)
        for p in range(planes - 1, -1, -1):
            for g in range(groups):
                np.take(sums[g], part[:, p, g], axis=0, out=found, mode="clip")
                out += found
            if p == planes - 1:
                np.negative(out, out=out)
            if p:
                out <<= 1
    return total


def _kind(anchors: np.ndarray, planes: int) -> type:
    """The narrower integer in which no score of these anchors can overflow."""
    return np.int32 if anchors.size == 0 or int(np.abs(anchors).sum(1).max()) << planes < 2**31 else np.int64


def _runs(columns: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, end) of runs of equal values in all columns."""
    n = len(columns[0])
    fresh = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1 if n > 1 else np.empty(0, int)
    edges = [0, *fresh.tolist(), n] if n else [0]
    return list(zip(edges[:-1], edges[1:]))


def in_order(scores: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of all usable scores: by anchor, higher scores first, then earlier rows."""
    rows, anchors = np.nonzero(usable)
    order = np.lexsort((rows, -scores[rows, anchors].astype(np.int64), anchors))
    return anchors[order], rows[order]


def unit_positives(block: dict, chunk: dict, most: int) -> list[np.ndarray]:
    """anchor, positive, score: the first `most` rows of each anchor's label in one block."""
    out = []
    for label in np.intersect1d(block["labels"], chunk["labels"]):
        mine, theirs = np.flatnonzero(chunk["labels"] == label), np.flatnonzero(block["labels"] == label)
        numbers = chunk["numbers"][mine]
        got = score(block["bits"][theirs], subset_sums(numbers, _kind(numbers, block["planes"])))
        usable = block["ids"][theirs][:, None] != chunk["ids"][mine]
        if len(theirs) > most + 1:
            # At most one row is the anchor itself: nothing below the (most + 1)-th score can be among the first.
            usable &= got >= np.partition(got, -most - 1, axis=0)[-most - 1]
        a, r = in_order(got, usable)
        place = np.arange(len(a)) - np.searchsorted(a, a)
        a, r = a[place < most], r[place < most]
        out.append(np.stack([chunk["ids"][mine][a], block["ids"][theirs][r], got[r, a].astype(np.int64)]))
    return out


def unit_negatives(block: dict, chunk: dict, most: int, low: int, high: int) -> list[np.ndarray]:
    """anchor, positive, negative, positive_score, negative_score: the first `most` rows of one block in each window."""
    numbers, ends = chunk["numbers"], np.cumsum(chunk["counts"])
    live = np.flatnonzero(chunk["counts"])
    if not len(live):
        return []
    got = score(block["bits"], subset_sums(numbers[live], _kind(numbers[live], block["planes"])))
    # low * p <= 100 * n <= high * p in whole numbers.
    least, top = -(-low * chunk["scores"] // 100), high * chunk["scores"] // 100
    starts = ends[live] - chunk["counts"][live]
    usable = (got >= np.minimum.reduceat(least, starts)) & (got <= np.maximum.reduceat(top, starts))
    usable &= block["labels"][:, None] != chunk["labels"][live]
    anchors, rows = in_order(got, usable)
    values = got[rows, anchors].astype(np.int64)
    # One ascending key for (anchor, falling score), from the ranks of all scores and window ends.
    ranks = np.unique(np.concatenate([values, least, top]), return_inverse=True)[1]
    span = len(ranks) + 1
    of = np.repeat(np.arange(len(live)), chunk["counts"][live])  # counts of the others are 0: windows are in this order
    rank, rank_least, rank_top = np.split(ranks, [len(values), len(values) + len(least)])
    keys = anchors * span - rank
    begin = np.searchsorted(keys, of * span - rank_top)
    taken = np.clip(np.searchsorted(keys, of * span - rank_least, "right") - begin, 0, most)
    window = np.repeat(np.arange(len(of)), taken)
    at = np.arange(len(window)) - np.repeat(np.cumsum(taken) - taken, taken) + begin[window]
    return [np.stack([chunk["ids"][live][of[window]], chunk["positives"][window], block["ids"][rows[at]], chunk["scores"][window], values[at]])]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k] for c in batch.schema.names}
            size = row["size"].as_py()
            listed = {c: row[c].values.to_numpy(zero_copy_only=False) for c in ("ids", "labels", "a_ids", "a_labels", "numbers", "positives", "scores", "counts")}
            planes = row["planes"].as_py()
            bits = np.array(row["bits"].as_buffer(), np.uint8).reshape(len(listed["ids"]), planes, -(-size // 8))
            yield ({"ids": listed["ids"], "labels": listed["labels"], "planes": planes, "bits": bits},
                   {"ids": listed["a_ids"], "labels": listed["a_labels"], "numbers": listed["numbers"].reshape(len(listed["a_ids"]), size),
                    "positives": listed["positives"], "scores": listed["scores"], "counts": listed["counts"]})


def _batch(parts: list[np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(parts, axis=1)], names)


def _packed_rows(batches: Iterator[pa.RecordBatch], key: str, scale: int, build) -> Iterator[pa.RecordBatch]:
    """One row for each run of equal `key` and vector length; runs may be cut where a batch ends."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        keys = batch.column(key).to_numpy()
        for first, end in _runs([keys, sizes]):
            part = batch.slice(first, end - first)
            yield build(int(keys[first]), int(sizes[first]), part, numbers_of(part.column("vector"), scale))


def _one(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    flat = pa.array(values.ravel(), kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256, block_rows: int = BLOCK_ROWS, chunk_anchors: int = CHUNK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` has vec_id, label (whole numbers) and embedding (array of float or double); `anchor` says of a row of
    (vec_id, label) whether it is an anchor. A negative's score lies between `low` and `high` percent of the positive's.
    """
    x = F.col("vector")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < MOST))
    base = vectors.select(F.col("vec_id").try_cast("long").alias("vec_id"), F.col("label").try_cast("long").alias("label"), F.col("embedding").alias("vector")).where(
        F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound, F.lit(False)))
    rows = stored(base.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*").select(
        "*", F.size("vector").alias("size"), F.coalesce(anchor, F.lit(False)).alias("anchor")), "numbers")
    count = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks_of, chunks_of = max(1, ceil(count["rows"] / block_rows)), max(1, ceil(count["anchors"] / chunk_anchors))

    def pack_block(key: int, size: int, part: pa.RecordBatch, numbers: np.ndarray) -> pa.RecordBatch:
        planes = planes_for(numbers)
        return pa.RecordBatch.from_arrays([
            pa.array([key], pa.int32()), pa.array([size], pa.int32()), pa.array([planes], pa.int32()), _one(part.column("vec_id").to_numpy(), pa.int64()),
            _one(part.column("label").to_numpy(), pa.int64()), pa.array([pack(numbers, planes).tobytes()], pa.binary())],
            ["block", "size", "planes", "ids", "labels", "bits"])

    def pack_chunk(key: int, size: int, part: pa.RecordBatch, numbers: np.ndarray) -> pa.RecordBatch:
        lists = part.column("positives"), part.column("scores")
        return pa.RecordBatch.from_arrays([
            pa.array([key], pa.int32()), pa.array([size], pa.int32()), _one(part.column("vec_id").to_numpy(), pa.int64()),
            _one(part.column("label").to_numpy(), pa.int64()), _one(numbers, pa.int64()), *[_one(c.flatten().to_numpy(), pa.int64()) for c in lists],
            _one(np.diff(lists[0].offsets.to_numpy()), pa.int32())],
            ["chunk", "size", "ids", "labels", "numbers", "positives", "scores", "counts"])

    def packed(df: DataFrame, key: str, build, schema: str, name: str) -> DataFrame:
        dealt = df.repartition(key).sortWithinPartitions(key, "size", "vec_id")
        return stored(map_arrow(dealt, lambda b: _packed_rows(b, key, scale, build), schema), name)

    blocks = packed(rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks_of)).cast("int")), "block", pack_block, BLOCK, "blocks")
    anchors = rows.where("anchor").withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(chunks_of)).cast("int"))
    empty = F.array().cast("array<bigint>")

    def units(chunks: DataFrame) -> DataFrame:
        """Every block with every chunk of vectors of its length, one row each."""
        keys, tasks = ["block", "chunk", "size"], min(blocks_of * chunks_of, MOST_TASKS)
        left = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks_of - 1))).alias("chunk"))
        right = chunks.withColumnsRenamed({"ids": "a_ids", "labels": "a_labels"}).select(
            "*", F.explode(F.sequence(F.lit(0), F.lit(blocks_of - 1))).alias("block"))
        return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys).hint("shuffle_merge"), keys)

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, chunk in _units(batches):
            yield from _batch(unit_positives(block, chunk, positives), ["anchor_id", "positive_id", "positive_score"])

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, chunk in _units(batches):
            yield from _batch(unit_negatives(block, chunk, negatives, low, high),
                              ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    def first(df: DataFrame, keys: list[str], by: str, tie: str, most: int) -> DataFrame:
        place = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(by).desc(), F.col(tie)))
        return df.withColumn("rank", place.cast("int")).where(F.col("rank") <= most)

    bare = packed(anchors.select("*", empty.alias("positives"), empty.alias("scores")), "chunk", pack_chunk, CHUNK, "anchors")
    found = first(map_arrow(units(bare), find_positives, "anchor_id bigint, positive_id bigint, positive_score bigint"),
                  ["anchor_id"], "positive_score", "positive_id", positives)
    by_anchor = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("found")).select(
        "vec_id", F.col("found.positive_id").alias("positives"), F.col("found.positive_score").alias("scores"))
    chunks = packed(anchors.join(by_anchor, "vec_id"), "chunk", pack_chunk, CHUNK, "positives")
    mined = map_arrow(units(chunks), find_negatives,
                      "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    return first(mined, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
