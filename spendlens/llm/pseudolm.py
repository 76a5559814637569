"""Masked pseudo-likelihood of documents under a bidirectional window network.

Tokens are runs of other characters than ASCII white space (A-Z lower-cased) and are counted over all documents. The
network knows units: the corpus's most frequent tokens, and hashed buckets for the others; their number grows with the
square root of that of the distinct tokens. It sees the SIDE units on either side of a masked position and predicts the
unit in two steps, its class and its place in the class. A token of a bucket has the bucket's probability times its
share of it, n / (total of the bucket + 1), from the table of all counts, which is joined and never gathered; what is
left of a bucket goes to a token that the corpus does not hold. Texts are split once, into a stored table of their units
and of their tokens in buckets, which all rounds and the scores read. The network is
trained in numpy: in each round every task starts from the same weights, takes gradient steps on the masked positions
(a hash picks MASKED of them) of all its documents and gives its weights, which are averaged by the number of
positions, in a tree, so that the driver adds up at most MERGED of them. Scores sum up the log-probabilities of all
tokens of a text, each predicted from both sides.

Defined results: a null, empty or blank text has no tokens, a sum of 0 and null means; equal texts score equally for
one model; other columns and null ids are left alone; an empty table gives an empty table (and an untrained model).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import lower_ascii, map_arrow, stored

SIDE, WIDTH, LEAST_CLASSES = 2, 16, 32
MASKED, ROUNDS, MERGED = 0.15, 2, 32
PAD, BLOCK, BATCH, RATE = 0, 8192, 1024, 0.1
OFFSETS = np.array([k for k in range(-SIDE, SIDE + 1) if k])
#: Log-counts are added up as whole numbers of this part, so that a sum doesn't depend on its order.
STEP = 1e9


def classes_for(distinct: int) -> int:
    """Classes of the network, and places in each, for so many distinct tokens: 2 * sqrt(distinct) units at least."""
    return max(LEAST_CLASSES, 8 * -(-(isqrt(2 * isqrt(distinct)) + 1) // 8))


def buckets_of(classes: int) -> int:
    return classes * classes // 16


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    return {"window": (2 * SIDE, classes * classes, WIDTH), "bias": (WIDTH,), "kind": (WIDTH, classes), "kind_bias": (classes,),
            "place": (classes, WIDTH, classes), "place_bias": (classes, classes)}


def classes_in(flat: np.ndarray) -> int:
    """The number of classes whose weights are as many as `flat` has."""
    return isqrt(len(flat) // (2 * SIDE * WIDTH + WIDTH + 1))


def start_weights(classes: int = LEAST_CLASSES) -> np.ndarray:
    draw = np.random.default_rng(11)
    return (draw.normal(size=sum(int(np.prod(s)) for s in shapes(classes).values())) * 0.05).astype(np.float32)


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(classes_in(flat)).items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def token_counts(docs: DataFrame) -> DataFrame:
    """token, n over all documents."""
    words = docs.select(F.explode_outer(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("word")).where("word <> ''")
    written = words.groupBy("word").agg(F.count("*").alias("n"))  # lower-casing each way of writing once is cheaper than whole texts
    return written.groupBy(lower_ascii(F.col("word")).alias("token")).agg(F.sum("n").alias("n"))


def split_tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@dataclass
class WindowModel:
    ids: dict[bytes, int] = field(default_factory=dict)
    flat: np.ndarray = field(default_factory=start_weights)
    #: By unit: the logarithm of a bucket's total count and 1; 0 for tokens of the vocabulary.
    totals: np.ndarray = field(default_factory=lambda: np.zeros(LEAST_CLASSES * LEAST_CLASSES))
    #: token, n of the tokens in buckets.
    counts: DataFrame | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"ids": self.ids, "flat": self.flat, "totals": self.totals, "counts": None}

    def tokens(self, text: str | None) -> list[int]:
        get, buckets = self.ids.get, buckets_of(classes_in(self.flat))
        return [get(t) or 1 + zlib.crc32(t) % buckets for t in split_tokens(text)]

    def stream(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Padded ids of several texts, the positions of their tokens, and the number of tokens of each."""
        return padded([np.array(self.tokens(t), np.int64) for t in texts])


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of several texts with SIDE gaps around each, the positions of the units, and the number of units of each."""
    counts = np.array([len(r) for r in rows], np.int64)
    where = np.repeat(SIDE * np.arange(1, len(rows) + 1), counts) + np.arange(counts.sum())
    flat = np.full(counts.sum() + SIDE * (len(rows) + 1), PAD, np.int64)
    flat[where] = np.concatenate([np.empty(0, np.int64), *rows])
    return flat, where, counts


def counted_model(docs: DataFrame) -> WindowModel:
    """Units and counts of a corpus, untrained. The most frequent tokens (ties in byte order) are units of their own, and
    their frequency ranks are dealt over the classes; the counts of all other tokens stay a table."""
    counts = stored(token_counts(docs), "tokens")
    classes = classes_for(counts.count())
    buckets = buckets_of(classes)
    rows = counts.orderBy(F.desc("n"), "token").limit(classes * classes - 1 - buckets).collect()
    ids = {r["token"].encode(): 1 + buckets + i for i, r in enumerate(rows)}
    rest = counts.where((F.col("n") < rows[-1]["n"]) | ((F.col("n") == rows[-1]["n"]) & (F.col("token") > rows[-1]["token"]))) if rows else counts
    totals = np.zeros(classes * classes)
    for r in rest.groupBy((1 + F.crc32(F.col("token").cast("binary")) % buckets).alias("unit")).agg(F.sum("n").alias("n")).collect():
        totals[r["unit"]] = np.log1p(r["n"])
    return WindowModel(ids, start_weights(classes), totals, rest)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def _hidden(w, ids: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    context = [ids[at + k] for k in OFFSETS]
    hidden = w["window"][0].take(context[0], axis=0)
    for k, c in enumerate(context[1:], 1):
        hidden += w["window"][k].take(c, axis=0)
    hidden += w["bias"]
    return context, np.tanh(hidden, out=hidden)


def _by_class(ids: np.ndarray, at: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """An order of the positions by the class of their units, classes and places in that order, and (class, from, to) of those met."""
    kind, place = np.divmod(ids[at], classes)
    order = np.argsort(kind, kind="stable")
    kind, place = kind[order], place[order]
    bounds = np.searchsorted(kind, np.arange(classes + 1)).tolist()
    return order, kind, place, [(c, i, j) for c, (i, j) in enumerate(zip(bounds, bounds[1:])) if i < j]


def _place_logits(w, hidden: np.ndarray, met: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.empty((len(hidden), w["place_bias"].shape[1]), np.float32)
    for c, i, j in met:
        np.matmul(hidden[i:j], w["place"][c], out=out[i:j])
        out[i:j] += w["place_bias"][c]
    return out


def _most(weights: np.ndarray, bias: np.ndarray) -> float:
    """No logit is further from 0: hidden values lie between -1 and 1."""
    return float((np.abs(weights).sum(-2) + np.abs(bias)).max())


def _log_chosen(logits: np.ndarray, chosen: np.ndarray, most: float) -> np.ndarray:
    """Log-softmax of one column of each row; `logits`, none of which is further from 0 than `most`, are used up."""
    if most > 60:  # else no exponential is out of range
        logits -= logits.max(1, keepdims=True)
    mine = logits[np.arange(len(logits)), chosen].astype(float)
    np.exp(logits, out=logits)
    return mine - np.log(logits.sum(1))


def log_probabilities(flat: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log-probability of the unit at each position, given those around it."""
    w, classes = unpacked(flat), classes_in(flat)
    out, most = np.empty(len(at)), (_most(w["kind"], w["kind_bias"]), _most(w["place"], w["place_bias"]))
    for start in range(0, len(at), BLOCK):
        here = at[start:start + BLOCK]
        order, kind, place, met = _by_class(ids, here, classes)
        _, hidden = _hidden(w, ids, here[order])
        logits = hidden @ w["kind"]
        logits += w["kind_bias"]
        logs = _log_chosen(logits, kind, most[0]) + _log_chosen(_place_logits(w, hidden, met), place, most[1])
        out[start + order] = np.maximum(logs, np.log(1e-30))
    return out


def train_on(flat: np.ndarray, ids: np.ndarray, at: np.ndarray, squares: np.ndarray) -> None:
    """One Adagrad step on `flat` (in place; `squares` holds the summed squares) for each BATCH of masked positions."""
    w, sums, classes = unpacked(flat), unpacked(squares), classes_in(flat)

    def step(name: str, at, g: np.ndarray) -> None:
        # Weights without a gradient don't move, so only the rows that were met are touched.
        g /= n
        total = sums[name][at] + g * g
        sums[name][at] = total
        total += 1e-10
        np.sqrt(total, out=total)
        g *= RATE
        g /= total
        w[name][at] -= g

    for start in range(0, len(at), BATCH):
        here = at[start:start + BATCH]
        n = len(here)
        order, kind, place, met = _by_class(ids, here, classes)
        context, hidden = _hidden(w, ids, here[order])
        wrong = _softmax(hidden @ w["kind"] + w["kind_bias"])
        wrong[np.arange(n), kind] -= 1
        back = wrong @ w["kind"].T
        step("kind", ..., hidden.T @ wrong)
        step("kind_bias", ..., wrong.sum(0))
        wrong = _softmax(_place_logits(w, hidden, met))
        wrong[np.arange(n), place] -= 1
        g = np.empty((len(met), WIDTH, classes), np.float32)
        for k, (c, i, j) in enumerate(met):
            back[i:j] += wrong[i:j] @ w["place"][c].T
            np.matmul(hidden[i:j].T, wrong[i:j], out=g[k])
        classes_met = ... if len(met) == classes else [c for c, _, _ in met]
        step("place", classes_met, g)
        step("place_bias", classes_met, np.add.reduceat(wrong, [i for _, i, _ in met], axis=0))
        back *= 1 - hidden * hidden
        step("bias", ..., back.sum(0))
        for k, c in enumerate(context):
            alike = np.argsort(c, kind="stable")
            c = c[alike]
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            step("window", (k, c[first]), np.add.reduceat(back[alike], first, axis=0))


def _kind_of_units(classes: int) -> str:
    return "<u2" if classes <= 256 else "<u4"


def encoded(docs: DataFrame, model: WindowModel) -> DataFrame:
    """row, doc_id, units (as binary), rare (the tokens that stand in buckets, by spaces), times (how often) of every document; stored."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids, classes = model.ids, classes_in(model.flat)
    buckets = buckets_of(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = ids.get
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                words = [split_tokens(t) for t in batch.column("text").to_pylist()]
                units = [np.array([get(t) or 1 + zlib.crc32(t) % buckets for t in row], _kind_of_units(classes)) for row in words]
                found = [Counter(compress(row, (of <= buckets).tolist())) for row, of in zip(words, units)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([u.tobytes() for u in units], pa.binary()),
                     pa.array([b" ".join(f) for f in found], pa.binary()).cast(pa.string()), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                    ["doc_id", "units", "rare", "times"])

    found = map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, units binary, rare string, times array<int>")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "units")


def _streams(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            yield batch, *padded([np.frombuffer(u, kind) for u in batch.column("units").to_pylist()])


def _trained(batches: Iterator[pa.RecordBatch], flat: np.ndarray) -> Iterator[pa.RecordBatch]:
    weights, squares, seen = flat.copy(), np.zeros(len(flat), np.float32), 0
    for _, tokens, at, _ in _streams(batches, _kind_of_units(classes_in(flat))):
        at = at[(at * 2654435761 + tokens[at] * 40503) % 65536 < MASKED * 65536]
        train_on(weights, tokens, at, squares)
        seen += len(at)
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([weights.tobytes()], pa.binary())], ["seen", "weights"])


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, seen = 0.0, 0
    for batch in batches:
        for n, raw in zip(batch.column("seen").to_pylist(), batch.column("weights").to_pylist()):
            total = total + n * np.frombuffer(raw, np.float32).astype(float)
            seen += n
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([(total / seen).astype(np.float32).tobytes()], pa.binary())], ["seen", "weights"])


def _train_rounds(model: WindowModel, units: DataFrame, rounds: int) -> None:
    texts, schema = units.select("units"), "seen bigint, weights binary"
    for _ in range(rounds):
        flat = model.flat
        parts = map_arrow(texts, lambda b: _trained(b, flat), schema)
        for width in (max(MERGED, isqrt(texts.rdd.getNumPartitions())), MERGED):
            parts = map_arrow(parts.repartition(width, F.crc32("weights")), _averaged, schema)
        rows = parts.collect()  # MERGED rows of one model's size at most
        if rows:
            seen = np.array([r["seen"] for r in rows], float)
            model.flat = (np.array([np.frombuffer(r["weights"], np.float32) for r in rows]) * (seen / seen.sum())[:, None]).sum(0).astype(np.float32)


def train(docs: DataFrame, rounds: int = ROUNDS) -> WindowModel:
    model = counted_model(docs)
    _train_rounds(model, encoded(docs, model), rounds)
    return model


def score_documents(docs: DataFrame, model: WindowModel) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (sum, natural log), mean_log_likelihood, pseudo_perplexity."""
    return _scored(encoded(docs, model), model)


def train_and_score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The scores of the documents that the network learns from, which are split once."""
    model = counted_model(docs)
    units = encoded(docs, model)
    _train_rounds(model, units, rounds)
    return _scored(units, model)


def _scored(units: DataFrame, model: WindowModel) -> DataFrame:
    kind, flat, totals = units.schema["doc_id"].dataType.simpleString(), model.flat, model.totals

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, tokens, at, counts in _streams(batches, _kind_of_units(classes_in(flat))):
            logs = log_probabilities(flat, tokens, at) - totals[tokens[at]]
            sums = np.bincount(np.repeat(np.arange(len(counts)), counts), logs, len(counts)).astype(float)  # from left to right within each text
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(counts), pa.array(sums)], ["row", "doc_id", "n_tokens", "units"])

    scored = map_arrow(units.select("row", "doc_id", "units"), run, f"row bigint, doc_id {kind}, n_tokens bigint, units double")
    log_likelihood = F.col("units")
    if model.counts is not None:
        # What a bucket's tokens have of it: their counts; a count of 1 adds nothing, nor does a token that was never seen.
        often = model.counts.where("n > 1").select("token", F.round(F.log("n") * STEP).cast("long").alias("steps"))
        pairs = units.select("row", F.inline(F.arrays_zip(F.split("rare", " ").alias("token"), "times")))
        added = pairs.join(often.hint("shuffle_hash"), "token").groupBy("row").agg(F.sum(F.col("times") * F.col("steps")).alias("steps"))
        scored = scored.join(added, "row", "left")
        log_likelihood = F.col("units") + F.coalesce("steps", F.lit(0)) / F.lit(STEP)
    summed = scored.select("doc_id", "n_tokens", log_likelihood.alias("log_likelihood"))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return summed.withColumn("mean_log_likelihood", mean).withColumn("pseudo_perplexity", F.exp(-F.col("mean_log_likelihood")))
