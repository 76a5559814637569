"""Benchmark decontamination: a hash set of test n-grams is looked up by every token window of every document.

Words are maximal runs of ASCII letters and digits (A-Z lower-cased) and of all characters above 0x7F. A window of
an item is `n` consecutive words; an item of fewer words, but not none, is one window. Window hashes of the items
are broadcast if `max_broadcast` rows bound them, and joined by a shuffle beyond that; each hit is verified word by
word. Documents are looked at as (doc_id, text): equal rows share one search and each gets its result.

Defined results: null or empty texts and items have no words and hit nothing; null ids are ordinary values; repeated
items count by their distinct item_id; an empty benchmark hits nothing; other columns are left alone. Only DataFrame
expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import lower_ascii

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: Item windows that are broadcast at most: hash, words and item, under 300 bytes each for usual words.
MAX_BROADCAST = 200_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def _run_hash(hashed: Column, start: Column, length: int) -> Column:
    """Hash of `length` neighbours in an array of word hashes."""
    return F.xxhash64(*[F.get(hashed, start + k) for k in range(length)])


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """item_id, gram (array of words), hash: each distinct window of each item."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    length = F.least(F.size("words"), F.lit(n))
    grams = items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("gram")).distinct()
    hashes = F.coalesce(*[
        F.when(F.size("gram") == k, F.xxhash64(*[F.xxhash64(F.get("gram", F.lit(j))) for j in range(k)])) for k in range(1, n + 1)])
    return grams.withColumn("hash", hashes)


def _spots(base: DataFrame, lengths: list[int], *carried: str) -> DataFrame:
    """The carried columns, pos, hash: one row for each window of each length (some hashes are null for several lengths).

    Positions are exploded, not arrays of hashes: hashing and the join that follows then run in one generated loop, which
    refers to the carried arrays of a document and does not copy them for each window. The outer form keeps Spark from
    testing the array in a filter of its own, which would split every text twice.
    """
    words = F.size("hashed")
    at = base.select(*carried, "hashed", F.explode_outer(
        F.when(words >= lengths[0], F.sequence(F.lit(0), words - lengths[0]))).alias("pos")).where("pos IS NOT NULL")
    first, *longer = [_run_hash(F.col("hashed"), F.col("pos"), k) for k in lengths]
    if longer:
        first = F.explode(F.array(first, *[F.when(F.col("pos") + k <= words, h) for k, h in zip(lengths[1:], longer)]))
    return at.select(*carried, "pos", first.alias("hash"))


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, text_key, item_id, pos (of the first hit word, from 0), length: each verified occurrence."""
    windows = item_windows(benchmark, n)
    sizes = windows.groupBy(F.size("gram").alias("length")).count().collect()  # n rows at most
    base = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), words_of(F.col("text")).alias("words"))
    hashed = base.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))
    lengths = sorted(r["length"] for r in sizes) or [n]
    if sum(r["count"] for r in sizes) <= max_broadcast:
        found = _spots(hashed, lengths, "doc_id", "text_key", "words").join(F.broadcast(windows), "hash")
        # The size is the gram's: an equality with one table on each side would become a key, built for every window.
        true = found.where(F.slice("words", F.col("pos") + 1, F.size("gram")) == F.col("gram"))
        return true.select("doc_id", "text_key", "item_id", "pos", F.size("gram").alias("length"))
    met = _spots(hashed, lengths, "doc_id", "text_key").join(windows, "hash")
    spots = met.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_id", "pos", "gram")).alias("spots"))
    # Only documents that have met a hash fetch their words, once each.
    told = base.alias("b").join(spots.alias("s"), F.col("b.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("b.text_key") == F.col("s.text_key")))
    true = F.filter("spots", lambda x: F.slice("words", x["pos"] + 1, F.size(x["gram"])) == x["gram"])
    return told.select("b.doc_id", "b.text_key", F.inline(true)).select("doc_id", "text_key", "item_id", "pos", F.size("gram").alias("length"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, so that rows with one doc_id and different texts stay apart."""
    return F.concat_ws(":", F.xxhash64(text), F.hash(text), F.octet_length(text))


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document row: doc_id, text_key, n_words, hits (sorted array of word positions), items (sorted strings)."""
    hits = find_hits(docs, benchmark, n, max_broadcast)
    found = hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.col("length") - 1))))).alias("hits"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    rows = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.alias("d").join(
        found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key")), "left")
    return joined.select(
        "d.doc_id", "d.text_key", "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows of `docs` without any hit, with all their columns."""
    bad = find_hits(docs, benchmark, n, max_broadcast).select(
        F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"))
    return keyed.join(bad, F.col("id").eqNullSafe(F.col("_bad_id")) & (F.col("key") == F.col("_bad_key")), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id and the text with its hit words, and the gap after each, taken out; texts without a hit are unchanged."""
    found = decontaminate(docs, benchmark, n, max_broadcast).select("doc_id", "text_key", "hits").distinct()
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("text_key"))
    rows = keyed.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_key") == F.col("f.text_key")), "left")
    gap = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"  # here in the text's own case
    lead = F.regexp_extract("text", f"^([{gap}]*)", 1)
    pieces = F.regexp_extract_all("text", F.lit(f"([^{gap}]+[{gap}]*)"), F.lit(1))
    kept = F.concat(lead, F.concat_ws("", F.filter(pieces, lambda _, i: ~F.array_contains("hits", i))))
    return rows.select("d.doc_id", F.when(F.size("hits") > 0, kept).otherwise(F.col("text")).alias("text"))
