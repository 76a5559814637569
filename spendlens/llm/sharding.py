"""Contiguous shards of minimal capacity over ordered, atomic groups.

Groups are equal texts (null counts as the empty text), ordered by the 128-bit digest of their text; a group's size
is the sum of its rows' sizes. The smallest capacity C is sought for which cutting greedily, each shard taking
groups in order while they fit into C, needs no more than `shards` shards. Feasibility is checked greedily on sums
of digest ranges, never on single groups: each level splits the ranges in which a cut may still lie into `FAN`
parts, so the driver holds at most about shards * shards * FAN sums, whatever the number of groups; it ends when
those ranges are single groups, so the result is exact. A row's shard then follows from comparing its digest with
at most `shards` - 1 cut digests: no join, no shuffle, and a hot group costs its rows one comparison each.

Slots number a shard's rows from 0 without gaps: rows are numbered inside blocks of `block_rows` neighbours of the
stored key table, and the blocks' counts are summed; no task sorts a whole shard.

Defined results: a null or empty text has size 1 and all of them form one group; null or repeated doc_ids are
ordinary rows; an empty table has no shards; other columns are left alone.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from spendlens.llm.common import stored

FAN_BITS = 10
DIGEST_HEX = 32


def minimax_capacity(sizes: list[int], shards: int) -> int:
    """Smallest capacity for which the greedy check needs at most `shards` runs of `sizes` (in order)."""
    ends = list(accumulate(sizes))
    low, high = max([*sizes, -(-ends[-1] // shards)]), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if len(greedy_cuts(ends, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def greedy_cuts(ends: list[int], capacity: int) -> list[int]:
    """End positions (in sizes) of the greedy runs; every single size must fit."""
    cuts, at = [], 0
    while at < ends[-1]:
        at = ends[bisect_right(ends, at + capacity) - 1]
        cuts.append(at)
    return cuts


def _sums(keyed: DataFrame, prefixes: list[str], hex_digits: int) -> dict[str, list[tuple[str, int, str, str]]]:
    """For each digest prefix: (longer prefix, bytes, least and greatest digest) of its parts, in order."""
    length = len(prefixes[0]) if prefixes else 0
    spark = keyed.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(p,) for p in prefixes], "head string"))
    rows = (
        keyed.withColumn("head", F.substring("digest", 1, length)).join(wanted, "head", "left_semi")
        .groupBy(F.substring("digest", 1, length + hex_digits).alias("part"))
        .agg(F.sum("size").alias("size"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        .collect()  # at most 16 ** hex_digits rows for each prefix
    )
    found: dict[str, list] = {p: [] for p in prefixes}
    for r in sorted(rows, key=lambda r: r["part"]):
        found[r["part"][:length]].append((r["part"], r["size"], r["low"], r["high"]))
    return found


def minimax_cuts(keyed: DataFrame, shards: int) -> tuple[int, list[str]]:
    """Capacity, and the greatest digest of every shard but the last.

    `parts` always covers all groups in order by ranges of digests. With ranges not yet split, greedy over range
    ends is feasible for any capacity it accepts, which bounds C from above; each cut of the true greedy run then
    lies between where range ends put it for the lower bound and `k` times the upper bound, and only ranges in
    between that hold more than one group are split further.
    """
    step = FAN_BITS // 4
    parts = _sums(keyed, [""], step)[""]
    if not parts:
        return 0, []
    while True:
        sizes = [p[1] for p in parts]
        ends = list(accumulate(sizes))
        high = minimax_capacity(sizes, shards)
        whole = [p[2] == p[3] for p in parts]
        low = max([-(-ends[-1] // shards), *(s for s, one in zip(sizes, whole) if one)])
        split = set()
        at = 0
        for k in range(1, shards + 1):
            # The k-th cut lies in (at, k * high]; where even the lower bound reaches is known to be before it.
            first, last = bisect_right(ends, at + low), bisect_right(ends, min(ends[-1], k * high))
            split.update(i for i in range(first, min(last, len(parts) - 1) + 1) if not whole[i])
            reach = bisect_right(ends, at + low)
            at = ends[reach - 1] if reach else 0
        split |= {i for i, s in enumerate(sizes) if not whole[i] and s > low}
        if not split or low >= high:
            break
        finer: dict[str, list] = {}
        by_length: dict[int, list[str]] = {}
        for i in split:
            by_length.setdefault(len(parts[i][0]), []).append(parts[i][0])
        for heads in by_length.values():
            finer |= _sums(keyed, sorted(heads), step)
        parts = [q for i, p in enumerate(parts) for q in (finer[p[0]] if i in split else [p])]
    cuts = greedy_cuts(ends, high)
    at_end = dict(zip(ends, (p[3] for p in parts)))
    return high, [at_end[c] for c in cuts[:-1]]


def key_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, digest of each row; stored, as it is read several times."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("digest")), "shard-keys")


def shard_documents(docs: DataFrame, shards: int = 16, block_rows: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard, slot of every row."""
    keyed = key_table(docs)
    _, cuts = minimax_cuts(keyed, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("digest") > cut).cast("int")
    rows = keyed.select(
        "doc_id", "size", "text_crc32", "digest", shard.alias("shard"), F.col("_metadata.file_name").alias("file"),
        F.floor(F.col("_metadata.row_index") / block_rows).alias("block"), F.col("_metadata.row_index").alias("place"))
    block = ["shard", "file", "block"]
    counts = rows.groupBy(*block).count()
    before = counts.select(*block, (F.sum("count").over(
        W.partitionBy("shard").orderBy("file", "block").rowsBetween(W.unboundedPreceding, 0)) - F.col("count")).alias("before"))
    numbered = rows.withColumn("number", F.row_number().over(W.partitionBy(*block).orderBy("place")) - 1)
    return numbered.join(before, block).select(
        "doc_id", "size", "text_crc32", "digest", "shard", (F.col("before") + F.col("number")).alias("slot"))
