"""Language identification by unigram piece models whose segmentations are summed out.

The pieces come from a fixed public vocabulary. Each language has a probability for every piece; a word's probability
in a language is the sum, over all ways to cut it into pieces, of the product of their probabilities. A forward
pass over the positions of the word gives that sum. A text's words are its runs of letters (with their marks), each
behind the word sign `▁`; no piece reaches across a word, so the text's log-probability is the sum over its words. The
languages' shares of the learning rows are the prior, and the posterior of the best language is the score.

Learning counts the words of a bounded sample: about `ROWS` learning documents of each language (whole texts), those
whose hashed id lies below the share that makes `ROWS`. Expected piece counts come from forward and backward passes, which
Spark deals out over the distinct (language, word) rows; they start from equal probabilities and are repeated
`ROUNDS` times. A language's counts are smoothed with those of all languages together. Characters that no piece covers
count as the byte pieces of their UTF-8 form.

The driver holds one number for each language and piece; labels beyond a few thousand languages are not what this is for.
Scoring is one projection over all rows. A worker remembers words of a partition up to a bound and frees them after it.

Defined results: a null text or one without a letter is `und` with score 0, as is every text if there is nothing to learn
from; a row with a null label, or one whose `usable` is null, is not learnt from; a language whose sample holds no letter is
not learnt; the first of equally likely languages in alphabetical order is taken; equal texts give equal results;
other columns are left alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import map_arrow, stored

SPACE = "▁"
#: Stands between words that are searched together, and in no piece; pieces are shorter than CODE.
BETWEEN, CODE = "\x00", 1 << 10
ROWS, ROUNDS = 1500, 3
#: Weight, in pieces, of the pooled counts in a language's probabilities, and of equal probabilities in the pooled counts.
POOLED, EQUAL = 2000.0, 3000.0
#: Expected counts are added up as whole parts of this size, so that no order of adding changes them.
GRAIN = 1e-6
MEMORY_WORDS, MEMORY_CHARS = 150_000, 6_000_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNKNOWN = "und"


class Pieces:
    """The vocabulary: normal pieces by an Aho-Corasick automaton, byte pieces for what they do not cover."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        normal = [(i, p.piece) for i, p in enumerate(proto.pieces) if p.type == 1]
        self.size = len(proto.pieces)
        self.byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(proto.pieces):
            if p.type == 6:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.usable = np.zeros(self.size, bool)
        self.usable[[i for i, _ in normal]] = True
        self.usable[self.byte_ids] = True
        self.longest = max(len(p) for _, p in normal)
        if self.longest >= CODE or any(BETWEEN in p or SPACE in p.lstrip(SPACE) for _, p in normal):
            raise ValueError("a piece is too long, or reaches across words")
        self.single = {p for _, p in normal if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for i, p in normal:
            self.automaton.add_word(p, i * CODE + len(p))
        self.automaton.make_automaton()

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """word, start, end and piece of every piece in the words (signs in front included); ids of uncovered characters.

        Rows are sorted by word. An uncovered character's piece is -1 - k, where the k-th list holds the ids of its bytes.
        """
        whole = BETWEEN.join([SPACE + w for w in words]) + BETWEEN
        sizes = np.array([len(w) + 2 for w in words])
        begin = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(words)), sizes)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(whole)), np.int64).reshape(-1, 2)
        word = of[found[:, 0]]
        end = found[:, 0] + 1 - begin[word]
        start, piece = end - found[:, 1] % CODE, found[:, 1] // CODE
        odd = sorted(set(whole) - self.single - {BETWEEN})
        spelled = [self.byte_ids[list(c.encode("utf-8", "surrogatepass"))] for c in odd]
        if odd:
            known = {c: -1 - k for k, c in enumerate(odd)}
            at = np.array([(i, known[c]) for i, c in enumerate(whole) if c in known])
            word, piece = np.r_[word, of[at[:, 0]]], np.r_[piece, at[:, 1]]
            alone = at[:, 0] - begin[of[at[:, 0]]]
            start, end = np.r_[start, alone], np.r_[end, alone + 1]
            order = np.argsort(word, kind="stable")
            word, start, end, piece = word[order], start[order], end[order], piece[order]
        return word, start, end, piece, spelled


def _log_chances(pieces: np.ndarray, spelled: list[np.ndarray], logs: np.ndarray) -> np.ndarray:
    """(arcs, languages) log-probabilities."""
    if not spelled:
        return logs[pieces]
    extra = np.array([logs[ids].sum(0) for ids in spelled])
    return np.where((pieces < 0)[:, None], extra[np.where(pieces < 0, -1 - pieces, 0)], logs[np.maximum(pieces, 0)])


def _by(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts the rows by `key`, the keys that occur, and where each begins (one more entry: the end)."""
    order = np.argsort(key, kind="stable")
    values, starts = np.unique(key[order], return_index=True)
    return order, values, np.r_[starts, len(key)]


def forward_logs(pieces: Pieces, logs: np.ndarray, words: list[str]) -> np.ndarray:
    """(words, languages) log-probabilities, all segmentations summed; `logs` are the pieces' log-probabilities.

    Position k of all words at a time; only the last positions that a piece can reach back to are held.
    """
    ring = pieces.longest + 1
    word, start, end, piece, spelled = pieces.arcs(words)
    # Arcs with one end stay sorted by word, as they were found.
    order, ends, edges = _by(end)
    word, start, chance = word[order], start[order], _log_chances(piece[order], spelled, logs)
    length = np.array([len(w) + 1 for w in words])
    alpha, out = np.zeros((ring, len(words), logs.shape[1])), np.zeros((len(words), logs.shape[1]))
    for e, first, last in zip(ends, edges[:-1], edges[1:]):
        w = word[first:last]
        part = alpha[start[first:last] % ring, w] + chance[first:last]
        fresh = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        most = np.maximum.reduceat(part, fresh)
        part = np.exp(part - np.repeat(most, np.diff(np.r_[fresh, last - first]), axis=0))
        alpha[e % ring, w[fresh]] = most + np.log(np.add.reduceat(part, fresh))
        done = np.flatnonzero(length == e)
        out[done] = alpha[e % ring, done]
    return out


def expected_counts(pieces: Pieces, logs: np.ndarray, words: list[str], times: np.ndarray) -> np.ndarray:
    """Expected number of each piece in `words`, each counted `times`, in parts of GRAIN; `logs` are one language's.

    Words of one length at a time, with whole tables of forward and backward sums.
    """
    counts = np.zeros(pieces.size, np.int64)
    length = np.array([len(w) + 1 for w in words])
    for n in np.unique(length):
        mine = np.flatnonzero(length == n)
        step = max(1, 500_000 // int(n))
        for begin in range(0, len(mine), step):
            some = mine[begin:begin + step]
            word, start, end, piece, spelled = pieces.arcs([words[i] for i in some])
            chance = _log_chances(piece, spelled, logs[:, None])[:, 0]
            forward = np.full((len(some), n + 1), -np.inf)
            backward = np.full((len(some), n + 1), -np.inf)
            forward[:, 0], backward[:, n] = 0, 0
            for into, of, at, key in ((forward, start, end, end), (backward, end, start, -start)):
                order, _, edges = _by(key)
                for first, last in zip(edges[:-1], edges[1:]):
                    rows = order[first:last]
                    np.logaddexp.at(into, (word[rows], at[rows]), into[word[rows], of[rows]] + chance[rows])
            share = np.rint(np.exp(forward[word, start] + chance + backward[word, end] - forward[word, n]) * times[some][word] / GRAIN).astype(np.int64)
            covered = piece >= 0
            np.add.at(counts, piece[covered], share[covered])
            for k, part in zip(-1 - piece[~covered], share[~covered]):
                np.add.at(counts, spelled[k], part)
    return counts


def probabilities(counts: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """(pieces, languages) probabilities from expected counts: smoothed with the pooled ones, those with equal ones."""
    pooled = counts.sum(1) + EQUAL * usable / usable.sum()
    pooled /= pooled.sum()
    table = counts + POOLED * pooled[:, None]
    return table / table.sum(0)


@dataclass(frozen=True)
class LanguageModel:
    """What scoring needs: a few megabytes for some ten languages."""

    model: bytes
    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


_PIECES: dict[int, Pieces] = {}


def _pieces(model: bytes) -> Pieces:
    """Once per Python worker."""
    key = hash(model)
    if key not in _PIECES:
        _PIECES.clear()
        _PIECES[key] = Pieces(model)
    return _PIECES[key]


def learn_languages(docs: DataFrame, usable: Column, model_file: str, label: str = "lang", rows: int = ROWS, rounds: int = ROUNDS) -> LanguageModel:
    """The model learnt from the texts and labels of the rows that are `usable`."""
    with open(model_file, "rb") as file:
        model = file.read()
    spark, pieces = docs.sparkSession, Pieces(model)
    learning = docs.where(F.coalesce(usable, F.lit(False)) & F.col(label).isNotNull()).select("doc_id", F.col("text"), F.col(label).cast("string").alias("label"))
    shares = learning.groupBy("label").count()
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53)
    sample = learning.join(F.broadcast(shares), "label").where(place * F.col("count") < rows).select("label", "text")

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 50):
                batch = whole.slice(start, 50)
                found: dict[tuple[str, str], int] = {}
                for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for word in WORD.findall(text or ""):
                        found[language, word] = found.get((language, word), 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                                                  pa.array(list(found.values()), pa.int64())], ["label", "word", "n"])

    counted = stored(map_arrow(sample, words_of, "label string, word string, n bigint").groupBy("label", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(r["label"] for r in counted.select("label").distinct().collect())
    totals = {r["label"]: r["count"] for r in shares.collect()}
    prior = np.array([float(totals[k]) for k in languages])
    table = probabilities(np.zeros((pieces.size, len(languages))), pieces.usable)
    for _ in range(rounds if languages else 0):
        table = probabilities(_expected(counted, model, languages, table), pieces.usable)
    return LanguageModel(model, languages, np.log(prior / prior.sum()) if languages else prior, table)


def _expected(counted: DataFrame, model: bytes, languages: list[str], table: np.ndarray) -> np.ndarray:
    """(pieces, languages) expected counts: one pass over the (label, word, n) rows; at most one number each comes back."""
    place = {k: i for i, k in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, logs, counts = _pieces(model), np.log(np.maximum(table, 1e-300)), np.zeros(table.shape, np.int64)
        for batch in batches:
            label = np.array([place[k] for k in batch.column("label").to_pylist()], np.int64)
            words, times = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for k in np.unique(label):
                mine = np.flatnonzero(label == k)
                counts[:, k] += expected_counts(pieces, logs[:, k], [words[i] for i in mine], times[mine].astype(float))
        at = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(counts[at])], ["piece", "label", "n"])

    out = np.zeros(table.shape)
    found = map_arrow(counted.repartition("label", "word"), run, "piece int, label int, n bigint").groupBy("piece", "label").agg(F.sum("n").alias("n"))
    for piece, label, n in found.collect():
        out[piece, label] = n * GRAIN
    return out


def with_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(_pieces(model.model), np.log(np.maximum(model.table, 1e-300)))
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                best, score = memory.best(batch.column(1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", F.col("text")), run, f"doc_id {kind}, lang_pred string, score double")


class _Memory(dict):
    """Row of the log-probabilities of every word seen in a partition; emptied beyond a bound of words or characters."""

    def __init__(self, pieces: Pieces, table: np.ndarray):
        super().__init__()
        self.pieces, self.table, self.logs, self.chars, self.new = pieces, table, np.empty((0, table.shape[1])), 0, []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place

    def best(self, texts: list[str | None], model: LanguageModel) -> tuple[list[str], np.ndarray]:
        if len(self) > MEMORY_WORDS or self.chars > MEMORY_CHARS:
            self.clear()
            self.logs, self.chars = self.logs[:0], 0
        found = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in (WORD.findall(t or "") for t in texts)]
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not model.languages:
            self.new.clear()
            return best, score
        self.learn()
        for k, rows in enumerate(found):
            if len(rows):
                logs = self.logs[rows].sum(0) + model.prior
                winner = int(logs.argmax())
                best[k], score[k] = model.languages[winner], 1 / np.exp(logs - logs[winner]).sum()
        return best, score

    def learn(self) -> None:
        """Forward sums of the new words, in batches of like length."""
        new, self.new = self.new, []
        if not new:
            return
        self.chars += sum(map(len, new))
        logs = np.empty((len(new), self.logs.shape[1]))
        order = sorted(range(len(new)), key=lambda i: len(new[i]))
        for first in range(0, len(order), 4000):
            some = order[first:first + 4000]
            logs[some] = forward_logs(self.pieces, self.table, [new[i] for i in some])
        self.logs = np.concatenate([self.logs, logs])
