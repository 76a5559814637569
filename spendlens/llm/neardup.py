"""Near-duplicate documents by HyperMinHash.

Words are runs of other characters than ASCII white space (A-Z lower-cased); a document's set holds its distinct
`words`-word shingles, or its whole word sequence if it is shorter. Equal sets are one class with the least doc_id as
its node. Each set is dealt by hash into `BANDS * ROWS` buckets; a bucket's register keeps its least hash as leading
zeros plus MANTISSA bits. Classes meet if a band of registers is equal; pairs are first judged by the share of equal
registers, corrected for chance collisions, within `SIGMAS` standard errors of the threshold, then on their full sets.

For banding, an empty bucket borrows the register of a full one that a fixed permutation names, so that small sets meet
no more often than their similarity allows. Pairs inside a band's bucket are not written out. First every member
meets the bucket's least node, and verified links give components. Only then are members of different components that
share a bucket compared, in pairs of blocks of BLOCK members; members of one component need no further link. A first
pass judges by registers and keeps the members that have a promising pair in the first band the two share; these
fetch their full sets, and a second pass verifies inside the task. A link that joins nothing new is not looked at, so
at most members - 1 links of a pair of blocks leave the task. Sets are compared as 64-bit hashes of their shingles.

Defined results: a null, empty or blank text has an empty set and links with nothing; a null doc_id links with nothing,
has no component and is kept; rows with one doc_id are one document; equal rows give equal rows; an empty table gives
an empty table; other columns are left alone. A link at the threshold is missed with probability
(1 - 0.8 ** ROWS) ** BANDS, 6e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import dealt_in_blocks, map_arrow, stored, whole_groups
from spendlens.llm.graph import components

ROWS, BANDS, MANTISSA = 5, 36, 10
REGISTERS = ROWS * BANDS
EMPTY = 0xFFFF
SIGMAS = 4.5
BLOCK = 512
WORD_MEMORY = 100_000

_WORDS: dict[bytes, int] = {}
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[1]
    h = (h ^ (h >> np.uint64(27))) * _MIX[2]
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    memory = _WORDS
    if len(memory) > WORD_MEMORY:
        memory.clear()
    hashes = np.empty(len(tokens), np.uint64)
    for i, t in enumerate(tokens):
        h = memory.get(t)
        if h is None:
            h = xxhash.xxh3_64_intdigest(t)
            if len(t) <= 64:
                memory[t] = h
        hashes[i] = h
    size = min(words, len(tokens))
    run = np.full(len(tokens) - size + 1, size, np.uint64)
    for k in range(size):
        run = _scrambled(run * _MIX[0] + hashes[k:len(tokens) - size + 1 + k])
    return np.unique(run)


def registers(hashes: np.ndarray) -> np.ndarray:
    """uint16 registers of a sorted set of hashes: leading zeros (6 bits) and mantissa of each bucket's least hash."""
    out = np.full(REGISTERS, EMPTY, np.uint16)
    if len(hashes):
        step = np.uint64((1 << 64) // REGISTERS + 1)
        bucket = hashes // step
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rest = (hashes[first] - bucket[first] * step).astype(np.float64) / float(step)
        fraction, power = np.frexp(np.maximum(rest, 2.0 ** -62))
        out[bucket[first].astype(np.int64)] = ((-power).astype(np.int64) << MANTISSA) | ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return out


#: For each bucket, the buckets it may borrow from, in order.
LOANS = np.argsort(np.random.default_rng(5).random((REGISTERS, REGISTERS)), axis=1)


def bands(row: np.ndarray) -> np.ndarray:
    """BANDS int64 keys of a row of registers; none for an empty set."""
    full = row != EMPTY
    if not full.any():
        return np.empty(0, np.int64)
    lent = row.astype(np.uint64)
    empty = np.flatnonzero(~full)
    lent[empty] = row[LOANS[empty, full[LOANS[empty]].argmax(1)]]
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0]
    for k in range(ROWS):
        key = _scrambled(key * _MIX[0] + lent.reshape(BANDS, ROWS)[:, k])
    return key.view(np.int64)


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated Jaccard similarity and its standard error at 0.8, for register rows a and b of sets of n_a and n_b."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(1)
    both = (a != EMPTY) & (b != EMPTY)
    equal = ((a == b) & both).sum(1)
    # Two unrelated minima share leading zeros and mantissa with chance 0.72 * 2**-MANTISSA * ab / (a + b)**2 nearly.
    chance = 0.7213 * 2.0 ** -MANTISSA * n_a * n_b / np.maximum(n_a + n_b, 1.0) ** 2
    expected = both.sum(1) * chance
    rest = np.maximum(used - expected, 1e-9)
    return np.clip((equal - expected) / rest, 0, 1), np.sqrt(0.16 / np.maximum(used, 1))


def _sketch(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            n, digest, key, regs = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text, words)
                n.append(len(h))
                digest.append(md5(h.tobytes()).digest())
                key.append(md5((text or "").encode()).digest())
                regs.append(registers(h).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(key, pa.binary()), pa.array(regs, pa.binary())],
                ["doc_id", "n_shingles", "digest", "text_md5", "registers"])
    _WORDS.clear()  # the worker is used again by other stages


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), text_md5, registers (binary) of every row."""
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), lambda batches: _sketch(batches, words), "doc_id bigint, n_shingles bigint, digest binary, text_md5 binary, registers binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """key, node: one row for each band of a class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [bands(np.frombuffer(r, np.uint16)) for r in batch.column("registers").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["node", "bands"])

    found = map_arrow(classes.select("node", "registers"), run, "node bigint, bands array<bigint>")
    return found.select(F.explode_outer("bands").alias("key"), "node").where("key is not null")


def _close(reg_a, reg_b, n_a, n_b, threshold: float) -> np.ndarray:
    value, error = estimates(reg_a, reg_b, n_a, n_b)
    return (value >= threshold - SIGMAS * error) & (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b))


def _band_rows(reg: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(len(reg), BANDS) keys, filled in for `rows` only."""
    out = np.zeros((len(reg), BANDS), np.int64)
    for i in rows:
        out[i] = bands(reg[i])
    return out


def _promising_rows(table: pa.Table, threshold: float) -> np.ndarray:
    """Pairs of rows of different labels that may reach the threshold, in the group of the first band they share.

    `table` holds whole groups (key, first, second); rows of a pair stand in one group, in the two blocks of it.
    """
    key, first, second, block, label, size = (table.column(c).to_numpy() for c in ("key", "first", "second", "block", "label", "n_shingles"))
    group = np.r_[0, np.cumsum((key[1:] != key[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1]))]
    reg = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint16).reshape(len(key), REGISTERS)
    size = size.astype(float)
    live, shift, found = np.arange(len(key) - 1), 1, [np.empty((2, 0), np.int64)]
    while len(live):
        live = live[live + shift < len(key)]
        live = live[group[live] == group[live + shift]]
        other = live + shift
        ok = (label[live] != label[other]) & ((first[live] == second[live]) | (block[live] != block[other]))
        a, b = live[ok], other[ok]
        near = np.minimum(size[a], size[b]) >= threshold * np.maximum(size[a], size[b])
        a, b = a[near], b[near]
        if len(a):
            close = _close(reg[a], reg[b], size[a], size[b], threshold)
            found.append(np.stack([a[close], b[close]]))
        shift += 1
    pairs = np.concatenate(found, axis=1)
    if not pairs.shape[1]:
        return pairs
    band = _band_rows(reg, np.unique(pairs))
    keep = [np.empty(0, bool)]
    for start in range(0, pairs.shape[1], 100_000):
        a, b = pairs[:, start:start + 100_000]
        keep.append(band[a, (band[a] == band[b]).argmax(1)] == key[a])
    return pairs[:, np.concatenate(keep)]


def _spanning_links(table: pa.Table, threshold: float, percent: int) -> np.ndarray:
    """(2, links) nodes: verified pairs that join what the labels, and the links before, have not joined."""
    pairs = _promising_rows(table, threshold)
    node, label = (table.column(c).to_numpy() for c in ("node", "label"))
    sets = table.column("hashes")
    unpacked: dict[int, np.ndarray] = {}
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    def hashes(i: int) -> np.ndarray:
        if i not in unpacked:
            if len(unpacked) >= 2 * BLOCK:
                unpacked.clear()
            unpacked[i] = np.frombuffer(sets[i].as_buffer(), np.uint64)
        return unpacked[i]

    out = []
    for a, b in pairs.T.tolist():
        x, y = root(label[a]), root(label[b])
        if x != y:
            s, t = hashes(a), hashes(b)
            common = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * common >= percent * (len(s) + len(t) - common):
                parent[max(x, y)] = min(x, y)
                out.append((node[a], node[b]))
    return np.array(out, np.int64).reshape(-1, 2).T


def _across(members: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) that join all nodes of different labels which share a key and have similar full sets."""
    threshold = percent / 100
    counts = members.groupBy("key").agg(F.count("*").alias("members"))
    side = classes.select("node", "n_shingles", "registers")
    dealt = dealt_in_blocks(members.join(counts, "key").join(side, "node"), "key", "node", "members", BLOCK)
    place = ["key", "first", "second"]

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, tuple(place), 4 * BLOCK):
            rows = np.unique(_promising_rows(table, threshold))
            if len(rows):
                yield from table.take(rows).select([*place, "block", "node", "label"]).to_batches()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, tuple(place), BLOCK):
            a, b = _spanning_links(table, threshold, percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    kept = stored(map_arrow(dealt, involved, "key bigint, first int, second int, block int, node bigint, label bigint"), "involved")
    sets = _full_sets(kept.select("node").distinct(), classes, docs, words)
    again = kept.join(side, "node").join(sets, "node").repartition(*place).sortWithinPartitions(*place)
    return map_arrow(again, link, "a bigint, b bigint").distinct()


def _texts_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """node, text of the given nodes: the text whose set stands for the node's class."""
    wanted = nodes.join(classes, "node").select("node", "text_md5")
    keyed = docs.select(F.col("doc_id").cast("long").alias("node"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("text_md5"), "text")
    return keyed.join(wanted, ["node", "text_md5"], "left_semi").groupBy("node", "text_md5").agg(F.min("text").alias("text")).drop("text_md5")


def _full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """node, hashes (sorted 64-bit hashes of the full set, as binary); stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sets = [shingles(t, words).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "hashes"])
        _WORDS.clear()

    return stored(map_arrow(_texts_of(nodes, classes, docs), run, "node bigint, hashes binary"), "sets")


def _promising(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose registers may belong to sets as similar as the threshold."""
    side = classes.select("node", "n_shingles", "registers")
    joined = pairs.join(side.toDF("a", "n_a", "reg_a"), "a").join(side.toDF("b", "n_b", "reg_b"), "b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            reg = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(rows, REGISTERS) for c in ("reg_a", "reg_b")]
            size = [batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b")]
            yield batch.select(["a", "b"]).filter(pa.array(_close(*reg, *size, threshold)))

    return map_arrow(joined, judge, "a bigint, b bigint")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    texts = stored(_texts_of(nodes, classes, docs), "texts")
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 100):  # two whole texts a row
                batch = whole.slice(start, 100)
                keep = []
                for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                    s, t = shingles(x, words), shingles(y, words)
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * common >= percent * (len(s) + len(t) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        _WORDS.clear()

    return map_arrow(joined, judge, "a bigint, b bigint").distinct()


def joined_components(nodes: DataFrame, first: DataFrame, more: DataFrame) -> DataFrame:
    """`nodes` with the component of each `node`, its own number if it has no links: what `first` (node, component) becomes by further links `more` (a, b).

    Only components that `more` links are contracted again, as nodes by their least number.
    """
    label = first.select(F.col("node").alias("end"), F.col("component").alias("label"))
    for end in ("a", "b"):
        more = more.join(label.withColumnRenamed("end", end), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    merged = components(more.where("a <> b")).select(F.col("node").alias("label"), F.col("component").alias("merged"))
    labelled = nodes.join(first, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    return labelled.join(merged, "label", "left").withColumn("component", F.coalesce("merged", "label")).drop("label", "merged")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    light = stored(sketches(docs, words), "sketches")
    linkable = light.where("doc_id is not null and n_shingles > 0")
    by_set = linkable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "text_md5")).alias("least"), F.min("n_shingles").alias("n_shingles"), F.min("registers").alias("registers"))
    classes = stored(by_set.select(
        F.col("least.doc_id").alias("node"), F.col("least.text_md5").alias("text_md5"), "digest", "n_shingles", "registers"), "classes")

    keys = band_keys(classes)
    meeting = keys.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("members")).where("members > 1")
    shared = stored(keys.join(meeting, "key").select("key", "node", "center"), "bands")

    star = shared.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    tried = stored(_promising(star, classes, percent / 100), "pairs")
    links = stored(_verified(tried, classes, docs, words, percent), "links")
    first = components(links)

    labelled = shared.select("key", "node").join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    more = stored(_across(stored(labelled.join(mixed, "key"), "mixed"), classes, docs, words, percent), "links")
    by_node = joined_components(classes.select("digest", "node"), first, more).select("digest", F.col("component").alias("component_id"))
    rows = light.select("doc_id", "n_shingles", F.when(F.expr("doc_id is not null and n_shingles > 0"), F.col("digest")).alias("digest"))
    found = rows.join(by_node, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay: one for each component, with all columns; rows with a null doc_id all stay.

    Of rows with one doc_id, which are one document, the one with the least hash of its text stays.
    """
    gone = near_duplicates(docs, words, percent).where("not kept").select("doc_id").distinct()
    rest = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti")
    best = rest.groupBy("doc_id").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64("text")).alias("best"))
    return best.select("best.*").unionAll(docs.where("doc_id is null"))
