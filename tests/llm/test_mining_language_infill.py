"""Hard negatives, language identification and fill-in-middle against brute force and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spendlens.llm import infill, langid, negatives, queries

PIECE_FILE = public_tokenizers.path(queries.PIECE_MODEL)
VECTORS = "vec_id long, label int, embedding array<double>, score string, rank string, block string, size string"


def brute_negatives(rows, every=100, positives=5, negatives_=5, low=80, high=100):
    """Plain loops over all rows: the contract, word for word."""
    least = {}
    for i, label, vector, *_ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) or abs(x) >= negatives.MOST for x in vector):
            continue
        least[i] = min(least.get(i, (label, vector)), (label, vector))
    numbers = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in least.items()}
    out = set()
    for a, (label, v) in numbers.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in numbers.items() if i != a and len(w) == len(v))
        for p_score, p, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and low * -p_score <= 100 * -s[0] <= high * -p_score][:negatives_]
            out |= {(a, p, k + 1, n, -p_score, -s) for k, (s, n, _) in enumerate(fit)}
    return out


def mined(spark, rows, schema=VECTORS, **options):
    got = negatives.hard_negatives(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0, **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_scores_are_inner_products():
    draw = np.random.default_rng(1)
    for size, most in ((64, 256), (1, 3), (13, 1 << 26), (8, 1), (0, 1)):
        a, b = (draw.integers(-most, most + 1, (n, size)) for n in (9, 700))
        planes = negatives.planes_for(b)
        got = negatives.score(negatives.pack(b, planes), negatives.subset_sums(a, negatives._kind(a, planes)))
        assert (got == b @ a.T).all()
    assert [negatives.planes_for(np.array([[x]])) for x in (0, -1, 1, -2, 127, -128, 128, -129)] == [1, 1, 2, 2, 8, 8, 9, 9]


def test_hard_negatives_against_brute_force(spark):
    draw = random.Random(4)
    hot = [0.3, -0.2, 0.5, 0.1, 0.0, 0.7, -0.1, 0.2, 0.4]
    rows = []
    for i in range(-300, 900):
        vector = hot if i % 3 == 0 else [draw.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) if i % 5 else draw.gauss(0, 1) for _ in range(9)]
        rows.append((i, 1 if i % 4 == 0 else draw.randrange(3), vector, "x", "y", "z", "w"))
    expected = brute_negatives(rows)
    assert len(expected) > 100
    assert mined(spark, rows) == expected
    assert mined(spark, rows, block_rows=70, chunk_anchors=3) == expected
    other = {"positives": 2, "negatives": 9, "low": 50, "high": 90}
    assert mined(spark, rows, block_rows=150, **other) == brute_negatives(rows, positives=2, negatives_=9, low=50, high=90)


def test_hard_negatives_odd(spark):
    rest = ("x", "y", "z", "w")
    rows = [(0, 1, [1.0, 2.0], *rest), (100, 1, [1.0, 2.0], *rest), (1, 1, [1.0, 2.0], *rest), (1, 1, [1.0, 2.0], *rest), (2, 2, [1.0, 1.9], *rest), (2, 1, [9.0, 9.0], *rest),
            (3, 2, [1.0, 2.0], *rest), (4, None, [1.0, 2.0], *rest), (None, 2, [1.0, 2.0], *rest), (5, 2, None, *rest), (6, 2, [1.0, None], *rest),
            (7, 2, [float("nan"), 1.0], *rest), (8, 2, [float("inf"), 1.0], *rest), (9, 2, [1e9, 1.0], *rest), (10, 3, [2.0], *rest), (200, 3, [], *rest),
            (201, 3, [], *rest), (202, 4, [], *rest), (300, 5, [-1.0, -1.0], *rest), (301, 5, [1.0, 1.0], *rest), (302, 6, [1.0, 1.0], *rest),
            (400, 9, [-200000.0, 3.0], *rest), (401, 9, [-200000.0, 2.0], *rest), (402, 8, [-200000.0, 1.0], *rest)]
    got = mined(spark, rows)
    assert got == brute_negatives(rows) and (200, 201, 1, 202, 0, 0) in got and any(g[0] == 400 for g in got)
    assert mined(spark, []) == set()
    assert mined(spark, [r for r in rows if r[0] is None or r[0] % 100]) == set()
    assert mined(spark, [("a", "b", [1.0]), ("100", "1", [1.0])], "vec_id string, label string, embedding array<float>") == set()


@pytest.fixture(scope="module")
def vocabulary():
    with open(PIECE_FILE, "rb") as file:
        return langid.Pieces(file.read())


def test_forward_sums_all_segmentations(vocabulary):
    from sentencepiece import sentencepiece_model_pb2

    with open(PIECE_FILE, "rb") as file:
        ids = {p.piece: i for i, p in enumerate(sentencepiece_model_pb2.ModelProto.FromString(file.read()).pieces) if p.type == 1}
    table = np.random.default_rng(2).random((vocabulary.size, 3))

    def segmentations(rest):
        if not rest:
            yield []
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids:
                yield from ([ids[rest[:k]], *more] for more in segmentations(rest[k:]))
        if rest and rest[0] not in ids:
            yield from ([*vocabulary.byte_ids[list(rest[0].encode())], *more] for more in segmentations(rest[1:]))

    words = ["the", "été", "𐍈a𐍈", "x", "Straße", "national"]
    every = [list(segmentations("▁" + w)) for w in words]
    expected = [np.log(sum(table[s].prod(0) for s in found)) for found in every]
    assert np.allclose(langid.forward_logs(vocabulary, np.log(table), words), expected, atol=1e-9)
    counts = np.zeros(vocabulary.size)
    for times, found in zip((3, 1, 2, 1, 1, 5), every):
        weights = np.array([table[s, 1].prod() for s in found])
        for share, s in zip(weights / weights.sum(), found):
            np.add.at(counts, s, times * share)
    got = langid.expected_counts(vocabulary, np.log(table[:, 1]), words, np.array([3.0, 1, 2, 1, 1, 5])) * langid.GRAIN
    assert np.allclose(got, counts, atol=1e-4)
    assert np.isfinite(langid.forward_logs(vocabulary, np.log(table / table.sum(0)), ["x" * 30_000, "ЩД" * 500])).all()


def test_language_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op12_language(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(rows)
    apart = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in apart} == {i for i, g in got.items() if g.held_out}
    readable = [r for r in apart if any(c.isalpha() for c in r.text or "")]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in readable)
    print("held out", right, "of", len(readable))
    assert right >= 0.97 * len(readable)
    assert all(0 <= g.score <= 1 and (g.lang_pred != "und") == (g.score > 0) for g in got.values())


def test_languages_odd(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score string, label string"
    rows = [(1, "the house and the garden", "en", *"xyz"), (1, "the house and the garden", "en", *"xyz"), (2, "das Haus und der Garten", "de", *"xyz"), (3, None, "en", *"xyz"),
            (4, "", None, *"xyz"), (5, "12 !? \n", "xx", *"xyz"), (None, "the garden", "de", *"xyz"), (6, "und der " * 30_000 + "x" * 40_000, None, *"xyz"), (7, "中文 ﷽ 𐍈", None, *"xyz")]
    docs = spark.createDataFrame(rows, schema)
    model = langid.learn_languages(docs, F.col("doc_id").isNotNull(), PIECE_FILE)
    assert model.languages == ["de", "en"] and np.allclose(model.table.sum(0), 1)
    found = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in langid.with_language(docs, model).collect()), key=str)
    assert [f[:2] for f in found] == [(0, "en"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de"), (7, found[-1][1])]
    assert found[1][2] == found[2][2] and {f[2] for f in found if f[1] == "und"} == {0.0}
    dealt = langid.learn_languages(docs.repartition(5, "text"), F.col("doc_id").isNotNull(), PIECE_FILE)
    assert (dealt.table == model.table).all()
    nothing = langid.learn_languages(docs, F.lit(False), PIECE_FILE)
    assert {r.lang_pred for r in langid.with_language(docs, nothing).collect()} == {"und"}
    none = spark.createDataFrame([], schema)
    assert langid.with_language(none, model).count() == 0 and langid.learn_languages(none, F.lit(True), PIECE_FILE).languages == []
    sampled = langid.learn_languages(docs, F.lit(True), PIECE_FILE, rows=1, rounds=1)
    assert set(sampled.languages) <= {"de", "en"}


def plain_infill(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    text = text or ""
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_fill_in_middle_against_plain_strings(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choice("ab<>PSM/ é😀中\ń") for _ in range(draw.choice([0, 1, 2, 3, 9, 40, 3000]))) for _ in range(600)]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [
        (None, "no id", "x", "y"), (-5, None, "x", "y"), (7, "again", "x", "y"), (7, "again", "x", "y"), (1000, "a<P>b", "x", "y"), (1001, "long 😀" * 900_000, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string").repartition(3)
    done = infill.restore(infill.fill_in_middle(docs)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in done), key=str)
    assert got == sorted(((i, *plain_infill(i, t)) for i, t, *_ in rows), key=str)
    assert sorted(r.restored for r in done) == sorted(t or "" for _, t, *_ in rows)
    assert {r.form for r in done} == {"plain", "psm", "spm"}
    assert infill.restore(infill.fill_in_middle(docs.limit(0))).count() == 0


def test_restoring_refuses_other_texts(spark):
    with pytest.raises(Exception, match="each mark once"):
        infill.restore(spark.createDataFrame([("psm", "no marks")], "form string, output string")).collect()


def test_vocabulary_is_the_librarys(vocabulary):
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    assert vocabulary.size == processor.vocab_size()
