"""Document quality by co-training of two views.

The text view sees how words are written (hashed words, shapes and the marks around them, as shares of a text's
words); the metadata view sees language, source and the page's layout in numbers (length, lines, shares of kinds of
characters, repeated lines and words). Each round, both views learn from their labelled rows, and the unlabelled rows of
which a view is surest become labelled rows of the other view. Each view is then calibrated on labelled rows kept
apart; a score is the sum of both views' evidence at the labels' base rate. Learning uses at most LABELLED labelled and
POOL unlabelled documents; every document is scored on its whole text.

Defined results: a null or empty text is scored from zero text features and its metadata; null lang or source is a value
of its own; null n_chars counts as the text's length, as any n_chars does; labels that are null or contradict
each other are not learnt from; without labels of both kinds every document gets the share of label 1 (1.0 without
labels, so that nothing is rejected unjudged); equal rows score equally; all columns pass through `with_quality`.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.llm.common import labelled_sample, learnt, map_arrow
from spendlens.llm.toxicity import logistic

LABELLED, POOL, ROUNDS, GIVEN = 2000, 2000, 4, 60
DIMENSIONS, MEMORY = 1024, 150_000
#: Values of lang and source share this many columns.
PLACES = 32
LAYOUT = 12
SPLIT = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)

_TOKENS: dict[str, tuple[int, ...]] = {}


def _token_places(token: str) -> tuple[int, ...]:
    found = _TOKENS.get(token)
    if found is None:
        if len(_TOKENS) > MEMORY:
            _TOKENS.clear()
        head, body, tail = SPLIT.match(token).groups()
        shape = ("U" if body.isupper() and len(body) > 1 else "T" if body[:1].isupper() else "l" if body.islower() else "0" if body.isdigit() else "x") \
            + str(min(len(body), 12) // 3)
        names = (f"h{head[:4]}", f"t{tail[:4]}", f"s{shape}", f"w{body[:24].lower()}")
        found = tuple(zlib.crc32(n.encode()) % DIMENSIONS for n in names)
        if len(token) <= 64:
            _TOKENS[token] = found
    return found


def text_view(text: str) -> np.ndarray:
    """Square roots of the shares of a text's words that fall on each hashed feature."""
    out = np.zeros(DIMENSIONS)
    tokens = Counter(text.split())
    total = sum(tokens.values())
    if total:
        places = np.array([_token_places(t) for t in tokens])
        counts = np.repeat(np.fromiter(tokens.values(), float, len(tokens))[:, None], places.shape[1], 1)
        out = np.sqrt(np.bincount(places.ravel(), counts.ravel(), DIMENSIONS) / total)
    return out


def metadata_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    out = np.zeros(2 * PLACES + LAYOUT)
    out[zlib.crc32(f"l{lang}".encode()) % PLACES] = 1
    out[PLACES + zlib.crc32(f"s{source}".encode()) % PLACES] = 1
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = max(len(codes), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    words = text.split()
    upper = ((codes >= 65) & (codes <= 90)).sum()
    lower = ((codes >= 97) & (codes <= 122)).sum()
    digit = ((codes >= 48) & (codes <= 57)).sum()
    space = ((codes == 32) | ((codes >= 9) & (codes <= 13))).sum()
    wide = (codes > 127).sum()
    end = np.isin(codes, (46, 44, 63)).sum()
    mark = n - upper - lower - digit - space - wide - end if len(codes) else 0
    out[2 * PLACES:] = (
        log(1 + len(codes)) / 10, log(1 + len(words)) / 10, log(1 + len(lines)) / 5, upper / n, digit / n, space / n, wide / n,
        end / n, mark / n, 1 - len(set(lines)) / max(len(lines), 1), 1 - len(set(words)) / max(len(words), 1),
        np.mean([len(w) for w in words]) / 10 if words else 0.0)
    return out


@dataclass
class QualityModel:
    base: float
    text: np.ndarray | None = None
    metadata: np.ndarray | None = None
    scale: tuple[np.ndarray, np.ndarray] | None = None
    text_line: tuple[float, float] = (0.0, 1.0)
    metadata_line: tuple[float, float] = (0.0, 1.0)

    def views(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated evidence (log-odds without the base rate) of both views."""
        a = self.text[0] + x @ self.text[1:]
        b = self.metadata[0] + (m - self.scale[0]) / self.scale[1] @ self.metadata[1:]
        return self.text_line[0] + self.text_line[1] * a, self.metadata_line[0] + self.metadata_line[1] * b

    def score(self, x: np.ndarray, m: np.ndarray) -> np.ndarray:
        if self.text is None:
            return np.full(len(x), self.base)
        a, b = self.views(x, m)
        prior = log(self.base / (1 - self.base))
        # The views are not independent given the label, so their evidence is averaged, not added up twice.
        return 1 / (1 + np.exp(-np.clip(prior + (a + b) / 2 * 1.5, -30, 30)))


def _linear(x: np.ndarray, y: np.ndarray, penalty: float) -> np.ndarray:
    """Weights of a class-balanced ridge logistic regression by accelerated gradient steps."""
    z = np.c_[np.ones(len(x)), x]
    weight = np.where(y > 0.5, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = v = np.zeros(z.shape[1])
    top = np.ones(z.shape[1])
    for _ in range(20):  # the largest eigenvalue of the weighted Gram matrix, by power iteration
        top = z.T @ (weight * (z @ (top / np.linalg.norm(top))))
    step = 4 / (1.1 * np.linalg.norm(top) + 4 * penalty)
    for k in range(300):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + penalty * np.r_[0.0, v[1:]]
        then = v - step * gradient
        v = then + k / (k + 3) * (then - w)
        w = then
    return w


def co_train(x: np.ndarray, m: np.ndarray, y: np.ndarray, base: float) -> QualityModel:
    """Views x and m of labelled rows (y 0 or 1) and pool rows (y -1); every fourth labelled row calibrates only."""
    labelled = np.flatnonzero(y >= 0)
    if len(np.unique(y[labelled])) < 2:
        return QualityModel(base)
    apart = np.concatenate([np.flatnonzero(y == k)[3::4] for k in (0, 1)])
    learn = np.setdiff1d(labelled, apart)
    if len(np.unique(y[apart])) < 2 or len(np.unique(y[learn])) < 2:
        return QualityModel(base)
    base = min(max(base, 1e-3), 1 - 1e-3)
    scale = (m[learn].mean(0), m[learn].std(0) + 0.05)
    views = (x, (m - scale[0]) / scale[1])
    penalty = (1e-4, 1e-3)
    known = [dict(zip(learn, y[learn].astype(float))) for _ in views]
    pool = np.flatnonzero(y < 0)
    for _ in range(ROUNDS):
        fitted = [_linear(v[list(k)], np.array(list(k.values())), p) for v, k, p in zip(views, known, penalty)]
        for i, (view, w) in enumerate(zip(views, fitted)):
            other = known[1 - i]
            free = np.array([r for r in pool if r not in other], int)
            if not len(free):
                continue
            odds = w[0] + view[free] @ w[1:]
            order = np.argsort(odds, kind="stable")
            few, many = round(GIVEN * (1 - base)), round(GIVEN * base)
            other |= {r: 0.0 for r, o in zip(free[order[:few]], odds[order[:few]]) if o < -1}
            other |= {r: 1.0 for r, o in zip(free[order[::-1][:many]], odds[order[::-1][:many]]) if o > 1}
    fitted = [_linear(v[list(k)], np.array(list(k.values())), p) for v, k, p in zip(views, known, penalty)]
    lines = []
    drawn = y[apart].mean()
    for view, w in zip(views, fitted):
        line = logistic((w[0] + view[apart] @ w[1:])[:, None], y[apart].astype(float))
        lines.append((line[0] - log(drawn / (1 - drawn)), max(line[1], 0.0)))
    return QualityModel(base, fitted[0], fitted[1], scale, *lines)


def _views(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    columns = [batch.column(names.index(c)).to_pylist() if c in names else [None] * batch.num_rows for c in ("text", "lang", "source")]
    rows = [(t or "", a, b) for t, a, b in zip(*columns)]
    return np.array([text_view(r[0]) for r in rows]).reshape(len(rows), DIMENSIONS), np.array([metadata_view(*r) for r in rows]).reshape(len(rows), -1)


def learn_quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> QualityModel:
    wanted = [c for c in ("text", "lang", "source") if c in docs.columns]
    known = labelled_sample(docs, labels, "quality", labelled, None, tuple(wanted))
    ids = labels.select("doc_id").where("doc_id is not null").distinct()
    free = docs.select("doc_id").where("doc_id is not null").join(ids, "doc_id", "left_anti").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool)
    unknown = docs.select("doc_id", *wanted).join(F.broadcast(free), "doc_id").groupBy("doc_id").agg(
        F.lit(-1).alias("label"), *[F.min(c).alias(c) for c in wanted])
    rows = known.unionByName(unknown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _views(batch, batch.schema.names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in m], pa.binary())],
                ["doc_id", "label", "x", "m"])
        _TOKENS.clear()

    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = labels.where(F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    base = 1.0 if seen is None else float(seen)

    def fitted(batches: list[pa.RecordBatch]) -> QualityModel:
        got = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "label", "x", "m")))]
        got.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
        x = np.array([np.frombuffer(r[2], "<f4") for r in got], float).reshape(len(got), DIMENSIONS)
        m = np.array([np.frombuffer(r[3]) for r in got]).reshape(len(got), 2 * PLACES + LAYOUT)
        return co_train(x, m, np.array([r[1] for r in got], int), base)

    return learnt(map_arrow(rows, run, f"doc_id {kind}, label int, x binary, m binary"), fitted)  # fixed size for each row


def with_quality(docs: DataFrame, model: QualityModel, column: str = "quality") -> DataFrame:
    """`docs` with the probability of good quality in `column`, which must be a new name."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                score = model.score(*_views(batch, names))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, column])
        _TOKENS.clear()  # the worker is used again by other stages

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))
