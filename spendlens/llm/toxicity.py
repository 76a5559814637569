"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents: one on the windows that are
over-represented in toxic texts (log-likelihood ratio above SIGNIFICANT), one on windows of ordinary texts. A window is
one word (longer runs are cut into overlapping pieces). Its distance is its compressed length with the ordinary
dictionary less that with the toxic one, behind a constant run that keeps a frame's fixed costs equal. A logistic
calibration, fitted on sampled documents that the dictionaries did not see, turns a document's largest distances and
its number of windows into a probability at the labels' base rate. Every window of every text is measured.

Defined results: null, empty or wordless texts are scored as having no window; labels that are null, contradict each
other or belong to no document are not learnt from; without labels of both kinds, or without any telling word, every
document gets the share of label 1 (0 if there are no labels); equal texts score equally; all columns of `docs` pass
through `with_toxicity`; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.llm.common import labelled_sample, learnt, map_arrow

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LEVEL, PAD = 19, b" " * 24
TOXIC_BYTES, ORDINARY_BYTES = 4096, 16384
#: A chi-square of 40 has p = 3e-10: chance words among millions of candidates stay below it.
SIGNIFICANT = 40.0
SAMPLE_ROWS, SAMPLE_WORDS, ORDINARY_WINDOWS = 6000, 1500, 60_000
TOP, LONGEST, MEMORY = 3, 48, 400_000


def windows(text: str | None) -> set[bytes]:
    """The distinct windows of a text."""
    out = set()
    for word in set(WORD.findall((text or "").encode().lower())):
        if len(word) <= LONGEST:
            out.add(word)
        else:
            out.update(word[i:i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2))
    return out


@dataclass
class ToxicityModel:
    base: float
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray | None = None
    memory: dict[bytes, int] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"base": self.base, "toxic": self.toxic, "ordinary": self.ordinary, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state, memory={})

    def compressors(self):
        made = []
        for content in (self.ordinary, self.toxic):
            rules = zstandard.ZstdCompressionDict(content)
            rules.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=rules, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return made

    def features(self, texts: list[Collection[bytes]]) -> np.ndarray:
        ordinary, toxic = self.compressors()
        rows = np.zeros((len(texts), TOP + 1))
        memory = self.memory
        for row, words in zip(rows, texts):
            best = [-8] * TOP
            for w in words:
                d = memory.get(w)
                if d is None:
                    if len(memory) > MEMORY:
                        memory.clear()
                    framed = PAD + b" " + w + b" "
                    d = memory[w] = len(ordinary(framed)) - len(toxic(framed))
                if d > best[-1]:
                    best = sorted([*best[:-1], d], reverse=True)
            row[:TOP], row[TOP] = np.clip(best, -8, 12), log(1 + len(words))
        return rows

    def score(self, texts: list[Collection[bytes]]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.base)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights[1:] + self.weights[0], -30, 30)))


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; for too few samples, which the trainer refuses, their distinct words as raw content."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(w for w, _ in sorted(Counter(samples).items(), key=lambda x: (x[1], x[0])))[-size:]


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression by Newton's method."""
    z = np.c_[np.ones(len(x)), x]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-3] + [penalty] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def log_likelihood_ratios(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> np.ndarray:
    """Of shares a / n_a and b / n_b being one share; 0 where all or none of the rows count."""
    def part(k, n, p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / (n * p)), 0) + np.where(n > k, (n - k) * np.log((n - k) / (n * (1 - p))), 0)
    p = (a + b) / (n_a + n_b)
    return np.where((p > 0) & (p < 1), 2 * (part(a, n_a, p) + part(b, n_b, p)), 0.0)


def fit(words: list[bytes], texts: list[np.ndarray], labels: list[int], base: float) -> ToxicityModel:
    """Dictionaries from two of three rows, calibration on the others; `base` is the share of label 1 to calibrate for.

    `words` is sorted; a text is the rising numbers of its distinct windows in it.
    """
    constant = ToxicityModel(base)
    check = list(zip(texts[::3], labels[::3]))
    learn = [(t, y) for i, (t, y) in enumerate(zip(texts, labels)) if i % 3]
    bad, good = [t for t, y in learn if y], [t for t, y in learn if not y]
    if not bad or not good or len({y for _, y in check}) < 2:
        return constant
    in_bad, in_good = (np.bincount(np.concatenate(part), minlength=len(words)) for part in (bad, good))
    ratio = np.where(in_bad / len(bad) > in_good / len(good), log_likelihood_ratios(in_bad, in_good, len(bad), len(good)), -1.0)
    telling = np.flatnonzero(ratio > SIGNIFICANT)
    if not len(telling):
        telling = np.sort(np.argsort(-ratio, kind="stable")[:min(10, int((ratio >= 0).sum()))])
    if not len(telling):
        return constant
    of_good = np.concatenate(good)
    of_good = of_good[np.random.default_rng(7).permutation(len(of_good))[:ORDINARY_WINDOWS]]
    ordinary = [b" " + words[i] + b" " for i in of_good]
    toxic = [b" " + words[i] + b" " for t in bad for i in np.intersect1d(t, telling)]
    if not ordinary or not toxic:
        return constant
    model = ToxicityModel(base, _dictionary(TOXIC_BYTES, toxic), _dictionary(ORDINARY_BYTES, ordinary))
    y = np.array([y for _, y in check], float)
    weights = logistic(model.features([[words[i] for i in t] for t, _ in check]), y)
    drawn, base = y.mean(), min(max(base, 1e-4), 1 - 1e-4)
    weights[0] += log(base / (1 - base)) - log(drawn / (1 - drawn))
    model.weights = weights
    model.memory.clear()
    return model


def learn_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from at most `rows` labelled documents, and at most SAMPLE_WORDS distinct words of each."""
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b" ".join(sorted(sorted(windows(t)), key=hash_of)[:SAMPLE_WORDS]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())], ["doc_id", "label", "words"])

    sample = labelled_sample(docs, labels, "toxic", rows, usable)
    kind = sample.schema["doc_id"].dataType.simpleString()
    seen = labels.where(F.col("toxic").isin(0, 1) & (usable if usable is not None else F.lit(True))).agg(F.avg("toxic")).first()[0]

    def fitted(batches: list[pa.RecordBatch]) -> ToxicityModel:
        numbers: dict[bytes, int] = {}  # a text is held as the numbers of its words
        got = [(hash_of(str(i).encode()), str(i), y, np.array([numbers.setdefault(w, len(numbers)) for w in found.as_py().split()], np.int32))
               for b in batches for i, y, found in zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(), b.column("words"))]
        got.sort(key=lambda r: r[:2])
        words = sorted(numbers)
        place = np.empty(len(words), np.int32)
        place[[numbers[w] for w in words]] = np.arange(len(words))
        del numbers
        return fit(words, [np.sort(place[r[3]]) for r in got], [r[2] for r in got], float(seen or 0.0))

    return learnt(map_arrow(sample, sampled, f"doc_id {kind}, label int, words binary"), fitted)


def hash_of(word: bytes) -> int:
    return zlib.crc32(word)


def with_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "toxicity") -> DataFrame:
    """`docs` with the probability of label 1 in `column`, which must be a new name."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                score = model.score([windows(t) for t in batch.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, column])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
