"""Text operators against brute force, libraries and planted cases, and their defined results on odd input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, differences
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from spendlens.llm import common, cotraining, decontaminate, graph, lattice, licences, neardup, pieces, pseudolm, queries, sharding, templates, toxicity

ODD = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                    T.StructField("shard", T.StringType()), T.StructField("key", T.StringType())])


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"word{i}" for i in range(30_000)) + "x" * 20_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (4, long, "en", "a", None), (5, "one two", "en", None, 7),
            (6, "one two", "en", "a", 7), (6, "one two", "en", "a", 7), (None, "one two", None, "a", 7), (7, "Released under the MIT License.", "en", "a", 1)]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ODD)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.mark.parametrize("name", sorted(queries.CHECK_SQL))
def test_query_equals_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), queries.CHECK_SQL[name]) == []


def test_licences(spark, odd, none):
    full = ("MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction.\nThe above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software.\nThe software is provided \"as is\", without warranty of any kind, "
            "express or implied.\nLicensed under CC BY-NC 4.0.")
    got = licences.scan_licences(spark.createDataFrame([(1, full), (2, "not a mit license text")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0].licences == ["MIT", "CC-BY-NC-4.0"] and got[0].sentence_ids[0] == "mit-title" and got[1].licences == []
    rows = licences.scan_licences(odd).collect()
    assert len(rows) == 9 and [r.licences for r in rows if r.doc_id == 7] == [["MIT"]] and {r.n_sentences for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert licences.scan_licences(none).count() == 0


def brute_components(rows, percent=80):
    sets = {i: frozenset(neardup.shingles(t).tolist()) for i, t in rows}
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        s, t = sets[a], sets[b]
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = root(a), root(b)
            least[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_near_duplicates_against_brute_force(spark, docs):
    base = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    draw = random.Random(3)
    for k in range(120):  # edited copies on both sides of the threshold, of long and short texts
        words = draw.choice(base[:60])[1].split()[:draw.choice([5, 9, 30, 200])]
        for _ in range(draw.randint(0, max(1, len(words) // 25))):
            words[draw.randrange(len(words))] = f"new{k}"
        base.append((10_000 + k, " ".join(words)))
    components, sizes = brute_components(base)
    got = neardup.near_duplicates(spark.createDataFrame(base, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == components
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd(odd, none):
    got = sorted(((r.doc_id or 0, r.component_id, r.kept, r.n_shingles) for r in neardup.near_duplicates(odd).collect()), key=lambda r: r[0])
    assert [g for g in got if g[0] in (5, 6)] == [(5, 5, True, 1), (6, 5, False, 1), (6, 5, False, 1)]
    assert got[0] == (0, None, True, 1) and {g[1] for g in got if g[0] in (1, 2, 3)} == {1, 2, 3}
    assert neardup.near_duplicates(none).count() == 0
    stays = neardup.one_of_each(odd)
    assert stays.columns == odd.columns and sorted(r.doc_id or 0 for r in stays.collect()) == [0, 1, 2, 3, 4, 5, 7]


def test_register_estimate():
    draw = np.random.default_rng(1)
    for share in (0.3, 0.8, 0.95):
        both = draw.integers(0, 2**63, 4000).astype(np.uint64)
        n = round(4000 * share)
        rest = (4000 - n) // 2
        a, b = np.unique(both[:n + rest]), np.unique(np.r_[both[:n], both[n + rest:]])
        value, error = neardup.estimates(*[neardup.registers(np.sort(neardup._scrambled(x)))[None] for x in (a, b)],
                                         np.array([len(a)]), np.array([len(b)]))
        assert abs(value[0] - share) < 5 * error[0] + 0.02


def test_components(spark):
    edges = [(i + 1, i) for i in range(50)] + [(200, k) for k in range(100, 120)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[k] == 100 for k in [200, *range(100, 120)])


def test_quality(spark, small, docs, odd, none):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = cotraining.learn_quality(docs, labels)
    got = cotraining.with_quality(docs, model, "q").join(labels, "doc_id").collect()
    assert np.mean([(r.q >= 0.5) == (r.quality == 1) for r in got]) > 0.95
    scored = cotraining.with_quality(odd, model, "q")
    assert scored.count() == 9 and scored.where("q is null or q < 0 or q > 1").count() == 0 and scored.columns == [*odd.columns, "q"]
    assert cotraining.with_quality(none, model, "q").count() == 0
    unlabelled = cotraining.learn_quality(docs, labels.limit(0))
    assert unlabelled.text is None and unlabelled.score(np.zeros((2, 3)), np.zeros((2, 3))).tolist() == [1.0, 1.0]


def test_toxicity_held_out(spark, docs, odd, none):
    draw = random.Random(5)
    common_words = ["the", "and", "of", "tion", "ing", "ther", "sher", "ent", "onerth", "reat"]
    rows = []
    for i in range(1500):
        words = ["".join(draw.choice(common_words) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(5, 60))]
        bad = i % 5 == 0
        for _ in range(3 * bad):
            words[draw.randrange(len(words))] = "grumz" + draw.choice(["", "ak", "ilo", "ven"])
        rows.append((i, " ".join(words), int(bad)))
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn_toxicity(made.drop("toxic"), made.drop("text"), ~queries.held_out(F.col("doc_id")))
    got = [r for r in toxicity.with_toxicity(made, model, "s").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.s >= 0.5) == (r.toxic == 1) for r in got]) > 0.97
    scored = toxicity.with_toxicity(odd, model, "s")
    assert scored.where("s is null or s < 0 or s > 1").count() == 0 and scored.count() == 9
    assert toxicity.with_toxicity(none, model, "s").count() == 0
    assert toxicity.learn_toxicity(docs, made.drop("text").limit(0)).score([set()]).tolist() == [0.0]


PAGE = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use</div>
<div class="wrap"><div class="sidebar"><p>side</p></div><main><h1>T &amp; x %d</h1><div class="post"><p>One  two\n three <a href=x>link</a> %s.</p><div class="ad">buy</div>
<ul><li>a<li>b %d</ul><script>var a="</p>"</script></div></main><div class="comments"><p>c1</p></div></div><form><p>f</p></form><footer>f</footer></body></html>"""


def test_main_text(spark, small):
    rows = [(i, f"http://h.example/{i}", PAGE % (i, "long text " * 20, i)) for i in range(6)]
    rows += [(10, None, None), (11, "http://e/", ""), (12, "nonsense", "plain &lt; text"), (12, "nonsense", "plain &lt; text"), (13, "http://e/", "<p>a<p>b<div"), (14, "http://e/", "<p>" + "x " * 50_000)]
    got = {r.page_id: r.text for r in templates.extract_pages(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()}
    for i in range(6):
        assert got[i] == f"T & x {i}\nOne two three link {('long text ' * 20).strip()} .\na\nb {i}"
    assert got[10] == got[11] == "" and got[12] == "plain < text" and got[13].startswith("a\nb") and len(got[14]) == 99_999
    assert templates.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    pages = spark.read.parquet(f"{small}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in templates.extract_pages(pages).collect():
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S).group(1)
        parts = [re.sub(r"\s+", " ", templates.html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in re.split(r"</?(?:p|h1|br)>", inner)]
        assert r.text == "\n".join(p for p in parts if p)


def test_equal_vectors_of_tokens_are_one_class(spark):
    pages = spark.createDataFrame([(i, "http://h/", f"<body><div><p>fixed {'x' * 20}</p><div>own text {i} {'y' * 90}</div></div></body>") for i in range(4)], "page_id long, url string, html string")
    found = templates.deduce_templates(pages).collect()
    assert [len(r.texts) for r in found] == [1]
    assert [r.text for r in templates.extract_pages(pages).orderBy("page_id").collect()] == [f"own text {i} {'y' * 90}" for i in range(4)]


def test_pseudo_likelihood(spark, docs, odd, none):
    model = pseudolm.train(docs.limit(120))
    texts = [r.text for r in docs.limit(40).collect()]
    draw = random.Random(2)
    mixed = [" ".join(draw.sample(t.split(), len(t.split()))) for t in texts]

    def mean(weights, some):
        ids, at, _ = model.stream(some)
        return pseudolm.log_probabilities(weights, ids, at).mean()

    assert mean(model.flat, texts) > mean(pseudolm.start_weights(), texts) + 0.5 and mean(model.flat, texts) > mean(model.flat, mixed)
    got = {r.doc_id: r for r in pseudolm.score_documents(odd, model).collect()}
    assert got[1].log_likelihood == 0 and got[1].mean_log_likelihood is None and got[4].n_tokens == 30_000
    assert got[5].log_likelihood == got[6].log_likelihood < 0
    assert pseudolm.score_documents(none, model).count() == 0 and pseudolm.train(none).ids == {}


def test_lattice_points_are_nearest():
    draw = np.random.default_rng(0).normal(size=(300, 8)) * 1.5
    near = lattice.nearest_e8(draw)[0] / 2
    steps = [np.array(s) for s in np.ndindex(*(3,) * 8)]
    d8 = np.array([s - 1 for s in steps if (s - 1).sum() % 2 == 0], float)
    for x, p in zip(draw[:40], near):
        others = np.concatenate([np.rint(x) - np.rint(x) % 2 + d8, np.floor(x / 2) * 2 + d8 + 0.5])
        others = others[np.isclose(others.sum(1) % 2, 0)]
        assert ((x - p) ** 2).sum() <= ((x - others) ** 2).sum(1).min() + 1e-9


def test_near_vectors_against_brute_force(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(60, 64))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i % 6] + draw.normal(size=64) * draw.uniform(0.01, 0.3)).tolist()) for i in range(700)]  # cells of several blocks
    rows += [(5000 + i, base[0].tolist()) for i in range(30)]
    unit = np.array([v for _, v in rows]) / np.linalg.norm([v for _, v in rows], axis=1)[:, None]
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(rows), dtype=bool)
    wrong = [(9000, None), (9001, []), (9002, [0.0] * 64), (9003, [float("nan")] * 64), (9004, [None, 1.0]), (9005, [1.0, 2.0]), (None, base[0].tolist())]
    frame = spark.createDataFrame([(*r, 1) for r in rows + wrong], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in lattice.near_vectors(frame).collect()}
    counted, true = np.array([got[i].n_links for i, _ in rows]), links.sum(1)
    assert (counted <= true).all() and counted.sum() >= 0.97 * true.sum()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in wrong if i)
    assert got[None].n_links == 0 and got[None].component_id is None and got[None].kept
    assert got[5000].component_id == 0 and not got[5000].kept
    assert lattice.near_vectors(frame.limit(0)).count() == 0


def test_recall_at_the_threshold():
    draw = np.random.default_rng(9)
    a = lattice.units(draw.normal(size=(2000, 64)))
    b = draw.normal(size=a.shape)
    b = lattice.units(b - (b * a).sum(1, keepdims=True) * a)
    for cosine, least in ((0.9, 0.9), (0.95, 0.99)):
        x, y = lattice.cells(a), lattice.cells(cosine * a + np.sqrt(1 - cosine**2) * b)
        assert ((x[:, :, :1] == y).any(2) | (y[:, :, :1] == x).any(2)).any(1).mean() >= least


def test_pieces_equal_the_library(docs, odd, none):
    path = public_tokenizers.path(queries.PIECE_MODEL)
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceModel(open(path, "rb").read())
    draw = random.Random(1)
    letters = "  ▁ab\n\tthe<s>é漢字́🙂\x00﻿.,0x41>ing"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(3000)] + [" " * n + "the" + " " * n for n in range(60)] + ["a" * 5000]
    for text in texts:
        n, raw, back = own.encode(text)
        ids = library.encode(text)
        assert np.frombuffer(raw, "<i4").tolist() == ids and back == library.decode(ids) and n == len(ids)
    for frame in (docs, odd):
        known = {r.doc_id: r.text or "" for r in frame.collect()}
        for r in queries.piece_digests(frame).collect():
            ids = library.encode(known[r.doc_id])
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert queries.piece_digests(none).count() == 0


def greedy_least(sizes, shards):
    for capacity in range(max(sizes), sum(sizes) + 1):
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity


def test_shards_are_minimax(spark, odd, none):
    draw = random.Random(8)
    rows = [(i, draw.choice(["", "same text", None]) if i % 3 == 0 else "t" * draw.randint(0, 90) + str(i % 400)) for i in range(1200)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 7, block_rows=50).collect()
    assert len(got) == 1200
    groups, shard_of, sizes, slots = defaultdict(int), defaultdict(set), defaultdict(int), defaultdict(list)
    texts = dict(rows)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw) and r.digest == hashlib.md5(raw).hexdigest()
        groups[r.digest] += r.size
        shard_of[r.digest].add(r.shard)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    order = sorted(groups)
    assert max(sizes.values()) <= greedy_least([groups[d] for d in order], 7) and all(len(s) == 1 for s in shard_of.values())
    assert [min(shard_of[d]) for d in order] == sorted(min(s) for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(r.slot for r in sharding.shard_documents(odd).collect())[0] == 0 and sharding.shard_documents(none).count() == 0


def test_decontamination(spark, odd, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    bench = spark.createDataFrame([(1, item), (1, item), (2, "tiny Item"), (3, None), (4, "  ")], "item_id long, text string")
    rows = [(1, f"start {item.upper()}, end"), (2, item[:40]), (3, "a tiny, item here"), (3, "other"), (None, "tiny item"), (5, None), (5, "tiny item tiny item")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hits string")
    for bound in (10**6, 0):  # broadcast, and the shuffled way beyond the bound
        got = decontaminate.decontaminate(frame, bench, max_broadcast=bound).collect()
        assert sorted(((r.doc_id or 0), len(r.hits), ",".join(r["items"])) for r in got) == [
            (0, 2, "2"), (1, 11, "1"), (2, 0, ""), (3, 0, ""), (3, 2, "2"), (5, 0, ""), (5, 4, "2")]
    clean = decontaminate.clean_documents(frame, bench)
    assert sorted(clean.collect()) == [(2, item[:40], "x"), (3, "other", "x"), (5, None, "x")] and clean.columns == frame.columns
    assert {r.text for r in decontaminate.remove_spans(frame, bench).collect()} == {"start end", item[:40], "a here", "other", "", None}
    assert decontaminate.decontaminate(odd, bench.limit(0)).where("size(hits) > 0").count() == 0 and decontaminate.decontaminate(none, bench).count() == 0
    plan = decontaminate.decontaminate(frame, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark, small, docs):
    at, seen = docs, {"start": docs.count()}
    for name, stage in corpus_pipeline.STAGES:
        before = at
        at = common.stored(stage(spark, at, small), name)
        seen[name] = at.count()
        if name != "tokens":
            assert at.columns == docs.columns and at.join(before, "doc_id", "left_anti").count() == 0
        if name == "near_duplicates":
            components, _ = brute_components([(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()])
            assert {r.doc_id for r in at.collect()} == {i for i, c in components.items() if i == c}
        if name == "decontamination":
            bad = {r.doc_id for r in decontaminate.decontaminate(before, spark.read.parquet(f"{small}/benchmark.parquet")).where("size(hits) > 0").collect()}
            assert {r.doc_id for r in at.collect()} == {r.doc_id for r in before.collect()} - bad
    assert seen["start"] > seen["quality"] > seen["near_duplicates"] >= seen["decontamination"] == seen["tokens"] > 0
    assert corpus_pipeline.run(spark, small).count() == seen["tokens"]


def test_pipeline_takes_odd_rows(spark, small, odd):
    at = odd
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, small)
    assert at.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    at.collect()


def test_each_rare_token_has_a_probability_of_its_own(spark):
    classes = pseudolm.LEAST_CLASSES
    buckets = pseudolm.buckets_of(classes)
    common = [f"c{i}" for i in range(classes * classes - 1 - buckets)]
    same = [w for w in (f"r{i}" for i in range(2000)) if zlib.crc32(w.encode()) % buckets == 5]
    corpus = spark.createDataFrame([(1, " ".join(common * 9)), (2, " ".join([same[0]] * 6 + [same[1]] * 2 + [same[2]]))], "doc_id int, text string")
    model = pseudolm.train(corpus)
    texts = [f"c1 c2 {w} c3 c4" for w in same[:4]]
    got = [r.log_likelihood for r in pseudolm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model).orderBy("doc_id").collect()]
    assert len(model.ids) == len(common) and np.allclose(np.array(got) - got[2], np.log([6, 2, 1, 1]), atol=1e-6)
    ids, at, _ = model.stream(texts[:1])
    assert np.isclose(got[0], pseudolm.log_probabilities(model.flat, ids, at).sum() + np.log(6 / 10), atol=1e-6)


def test_units_grow_with_the_corpus():
    sizes = [pseudolm.classes_for(n) for n in (0, 10_000, 400_000, 40_000_000, 4_000_000_000)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[2] < sizes[3] < sizes[4]
    assert all(c * c >= 2 * n ** 0.5 for c, n in zip(sizes, (0, 10_000, 400_000, 40_000_000, 4_000_000_000)))
    assert all(pseudolm.classes_in(pseudolm.start_weights(c)) == c for c in (32, 40, 88))


def test_pairs_that_meet_only_where_both_look_are_linked(spark):
    draw = np.random.default_rng(9)
    a = lattice.units(draw.normal(size=(1500, 64)))
    b = draw.normal(size=a.shape)
    b = lattice.units(b - (b * a).sum(1, keepdims=True) * a)
    b = lattice.units(0.9001 * a + np.sqrt(1 - 0.9001**2) * b)
    x, y = lattice.cells(a), lattice.cells(b)
    meet = (x[:, :, :, None] == y[:, :, None, :]).any((1, 2, 3))
    narrow = ((x[:, :, :1] == y).any(2) | (y[:, :, :1] == x).any(2)).any(1)
    assert (meet & ~narrow).sum() > 20
    rows = [(2 * i, v.tolist()) for i, v in enumerate(a)] + [(2 * i + 1, v.tolist()) for i, v in enumerate(b)]
    got = {r.vec_id: r for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    linked = np.array([got[2 * i].n_links >= 1 and got[2 * i + 1].component_id == got[2 * i].component_id for i in range(len(a))])
    assert (linked == meet).all()
    print("recall", linked.mean(), "narrow", narrow.mean())


@pytest.mark.parametrize("page,text", [
    ("<html><head><meta charset=x><body><p>all</p>", ["all"]),
    ("<html><head><title>t</title><script>s()</script><noscript><img src=x></noscript><p>all</p>", ["all"]),
    ('<article><p>a<svg class="i"/></p><p>kept</p></article>', ["a", "kept"]),
    ("<article><p>a<math/>b</p><p>kept</p><svg><text>no</text></svg></article>", ["ab", "kept"]),
    ("<div><p>a<svg><path d=x></p><p>kept</p></div>", ["a", "kept"]),
    ("<article><div>a<button>no</div><p>kept</p><button>no</button></article><p>end</p>", ["a", "kept", "end"]),
    ("<div>a<select><option>no<p>kept</p></div><p>end</p>", ["a", "kept", "end"]),
    ("<div>a<noscript>no<div>no</div></div><p>kept</p>", ["a", "kept"]),
    ("<div>a<iframe src=x></div><div>b<object>no</div><p>kept</p>", ["a", "b", "kept"]),
    ("<p>a<noscript><div>no</div></noscript>b<svg><foreignObject><div>no</div></foreignObject></svg>c</p>", ["abc"]),
    ("<p>a<button><svg/>no</button>b</p><p>c", ["ab", "c"]),
    ("<p>a</p><script>no<p>no", ["a"]),
])
def test_unclosed_elements_drop_no_further_text(page, text):
    assert [b[1] for b in templates.blocks(page)] == text


def test_pages_own_elements_are_never_side():
    page = '<html class="no-js cookie"><body class="right-sidebar"><main id="main-share"><article class="comment-open"><p>text</p></article></main><div class="comments"><p>no</p></div></body></html>'
    assert [(b[1], b[3]) for b in templates.blocks(page)] == [("text", False), ("no", True)]
    assert templates.main_text(page, None, frozenset()) == "text"


def test_near_duplicate_query_against_sets_of_words(spark):
    """op2 by four-word tuples, without any helper of the operator; blocks of many near copies that miss their least member."""
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]

    def word_sets(rows):
        out = {}
        for i, text in rows:
            words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
            out[i] = {tuple(words[k:k + 4]) for k in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set()
        return out

    def least_reachable(sets):
        of = {i: i for i in sets}
        for a, b in combinations(sorted(sets), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and of[a] != of[b]:
                low, high = sorted((of[a], of[b]))
                of = {i: low if c == high else c for i, c in of.items()}
        return of

    sets = word_sets(rows)
    got = queries.op2_near_duplicates(spark, folder).collect()
    assert {r.doc_id: r.component_id for r in got} == least_reachable(sets) and {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}

    draw = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    chain = []
    for i in range(700):  # near copies with up to eight changed words: many pairs lie on either side of the threshold
        words = list(base)
        for _ in range(draw.randint(0, 8)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(6)}"
        chain.append((i, " ".join(words)))
    found = neardup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: r.component_id for r in found} == least_reachable(word_sets(chain))


def test_links_across_components_are_a_forest():
    draw = np.random.default_rng(3)
    base = np.unique(draw.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.unique(np.r_[base[draw.random(len(base)) > 0.04], draw.integers(0, 2**63, 6).astype(np.uint64)]) for _ in range(60)]
    regs = [neardup.registers(s) for s in sets]
    keys = [neardup.bands(r) for r in regs]
    linked = []
    for key in sorted({int(k) for row in keys for k in row}):
        rows = [i for i in range(60) if key in keys[i]]
        n = len(rows)
        block = pa.table({"key": pa.array([key] * n), "first": pa.array([0] * n, pa.int32()), "second": pa.array([0] * n, pa.int32()), "block": pa.array([0] * n, pa.int32()),
                          "node": pa.array(rows), "label": pa.array(rows), "n_shingles": pa.array([len(sets[i]) for i in rows]),
                          "registers": pa.array([regs[i].tobytes() for i in rows]), "hashes": pa.array([sets[i].tobytes() for i in rows])})
        links = neardup._spanning_links(block, 0.8, 80)
        assert links.shape[1] <= max(n - 1, 0)
        linked += links.T.tolist()
    true = {(a, b) for a, b in combinations(range(60), 2)
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
    assert linked and set(map(tuple, np.sort(linked).tolist())) <= true

    def parts(edges):
        of = list(range(60))
        for a, b in edges:
            low, high = sorted((of[a], of[b]))
            of = [low if c == high else c for c in of]
        return of

    assert parts(linked) == parts(true)


def test_decontamination_by_a_real_shuffle(spark):
    """Items of many lengths, a text of 50,000 words, and no broadcast anywhere: the same hits by both ways."""
    draw = random.Random(8)
    items = [(i, " ".join(f"q{draw.randrange(300)}" for _ in range(n))) for i, n in enumerate([1, 2, 2, 3, 5, 9, 10, 11, 30, 30, 40])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    long = " ".join(f"z{i}" for i in range(50_000)).split()
    for k, (_, text) in enumerate(items[5:]):
        long[1000 * k:1000 * k] = text.split()
    rows = [(1, " ".join(long), "k"), (2, "x " + items[8][1] + " y", "k"), (2, "x " + items[8][1] + " y", "k"), (None, items[4][1], "k"), (3, "none of it", "k"), (4, None, "k")]
    rows += [(10 + i, " ".join(f"q{draw.randrange(300)}" for _ in range(200)), "k") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text_key string")

    def brute(text):
        words, hits, found = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower()), set(), set()
        for i, item in items:
            item = item.split()
            n = min(10, len(item))
            grams = {tuple(item[k:k + n]) for k in range(len(item) - n + 1)}
            for k in range(len(words) - n + 1):
                if tuple(words[k:k + n]) in grams:
                    hits |= set(range(k, k + n))
                    found.add(str(i))
        return sorted(hits), sorted(found)

    expected = sorted(((i, *map(tuple, brute(t))) for i, t, _ in rows), key=str)
    for bound in (0, 10_000):
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            df = decontaminate.decontaminate(docs, bench, max_broadcast=bound)
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == (bound > 0)
            got = sorted(((r.doc_id, tuple(r.hits), tuple(r.items)) for r in df.collect()), key=str)
            clean = decontaminate.clean_documents(docs, bench, max_broadcast=bound)
            assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, hits, _ in expected if not hits}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert got == expected


def test_windows_are_looked_up_by_their_hash_alone(spark):
    """The words of a window are compared where its hash is met; no window is built or copied to be looked up."""
    ten = [f"w{i}" for i in range(10)]
    rows = [(1, " ".join(["x", *ten])), (2, " ".join(ten)), (3, " ".join(ten[:9])), (4, " ".join([*ten, "y", "a", "b"])), (5, "a"), (6, "b a"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for texts, expected in [([" ".join(ten)], {(1, 1, 10), (2, 0, 10), (4, 0, 10)}),
                            ([" ".join(ten), "a b", "a"], {(1, 1, 10), (2, 0, 10), (4, 0, 10), (4, 11, 2), (4, 11, 1), (5, 0, 1), (6, 1, 1)})]:
        found = decontaminate.find_hits(docs, spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
        assert sorted((r.doc_id, r.pos, r.length) for r in found.collect()) == sorted(expected)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"BroadcastHashJoin \[(.*?)\], \[(.*?)\]", re.sub(r"#\d+L?", "", plan))) == {("hash", "hash")}
        assert re.search(r"\*\(\d+\) Generate explode\(CASE", plan)  # in one generated loop with the join


def test_one_vector_on_several_rows_is_no_other_vector(spark):
    rows = [(5, [1.0, 0.0, 2.0]), (5, [1.0, 0.0, 2.0]), (7, [1.0, 0.0, 2.0]), (8, [1.0, 0.0, 2.01]), (8, [1.0, 0.0, 2.01]), (9, [-1.0, 0.0, 0.0])]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (8, 2, 5, False), (8, 2, 5, False), (9, 0, 9, True)]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD2 = """Copyright (c) 2020, Someone. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""
GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY."""
GPL2 = GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2")
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."


def wrapped(text, width, mark):
    import textwrap

    lines = []
    for paragraph in text.split("\n\n"):
        lines += [f"{mark}{line}".rstrip() for line in textwrap.wrap(" ".join(paragraph.split()), width)] + [mark.rstrip()]
    return "\n".join(lines)


@pytest.mark.parametrize("text,licence", [
    (MIT, "MIT"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (APACHE, "Apache-2.0"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (MPL, "MPL-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3.0")])
def test_real_licence_texts(spark, text, licence):
    """Whole paragraphs, wrapped at three widths, and as comments of four kinds, with code before and after."""
    texts = [text, text.replace("\n", "\r\n")] + [wrapped(text, w, m) for w in (30, 72, 78) for m in ("", "# ", " * ", "// ", "-- ")]
    texts += [f"int main();\n\n/*\n{wrapped(text, 72, ' * ')}\n */\nreturn 0;"]
    if "GNU GENERAL" in text:
        texts = [text, "# GNU GENERAL PUBLIC LICENSE\n#   Version 3, 29 June 2007\n#\n# Copyright"]
    got = licences.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert {tuple(r.licences) for r in got} == {(licence,)}


def test_licence_notices(spark):
    told = {
        "Licensed under the MIT license, see LICENSE.": "MIT", "This file is released under the MIT License": "MIT", "// SPDX-License-Identifier: Apache-2.0\ncode();": "Apache-2.0",
        "# SPDX-License-Identifier: MIT": "MIT", "The code is distributed\nunder the MIT license since 2010.": "MIT", "This package is licensed under the BSD 3-Clause License (see COPYING).": "BSD-3-Clause",
        "Text without an end\nReleased under the MIT License.\nMore text": "MIT", "x\n\nSPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later"}
    silent = ["Das Haus. mit. Garten", "This is not licensed under the MIT license, sorry.", "We discuss the MIT license and the Apache license here.", "mit license holders of the world"]
    rows = [(t, n) for t, n in told.items()] + [(t, None) for t in silent]
    got = {r.doc_id: r.licences for r in licences.scan_licences(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id int, text string")).collect()}
    assert {t: got[i] for i, (t, _) in enumerate(rows)} == {t: [n] if n else [] for t, n in rows}


def test_template_text_inside_articles(spark):
    """A share line of every page goes, also in an article; text of copies stays; words that merely hold a mark are no marks."""
    share = '<p class="x9">Pass this page on to your friends today</p>'
    rows = [(i, f"http://a.example/{i}", f"<body><nav>Home</nav><article><h1>Head {i}</h1><p>Body {i} {'word ' * 30}</p>{share}<p>End {i} of it</p></article></body>") for i in range(6)]
    body = f"<p>{'same text ' * 20}</p><p>and {'more of it ' * 9}</p>"
    rows += [(10 + i, f"http://b.example/{i}", f"<html><body><div><h2>Heading {i}</h2>{body}</div></body></html>") for i in range(6)]
    odd_names = '<h2 id="side-effects">Side effects</h2><section class="related-work"><p>Others found</p></section><p class="legal-basis">Paragraph nine</p>'
    rows += [(20, "http://c.example/", f'<article><p>Before</p>{odd_names}<div class="ad-box">Buy</div><div class="site-footer">Imprint</div><div id="newsletter">Join</div></article>')]
    got = {r.page_id: r.text for r in templates.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Head {i}\nBody {i} {('word ' * 30).strip()}\nEnd {i} of it"
        assert got[10 + i] == f"Heading {i}\n{('same text ' * 20).strip()}\nand {('more of it ' * 9).strip()}"
    assert got[20] == "Before\nSide effects\nOthers found\nParagraph nine"


def test_scores_split_texts_once_and_are_those_of_the_network_itself(spark, docs, monkeypatch):
    some = docs.select("doc_id", F.concat("text", F.lit(" Zebra ZEBRA zebra")).alias("text")).limit(60).coalesce(1).cache()
    tables, stored = [], pseudolm.stored
    monkeypatch.setattr(pseudolm, "stored", lambda df, name: tables.append(name) or stored(df, name))
    got = {r.doc_id: r for r in pseudolm.train_and_score(some).collect()}
    assert tables == ["tokens", "units"]
    model = pseudolm.train(some)
    counts = {r.token: r.n for r in pseudolm.token_counts(some).collect()}
    w, classes = pseudolm.unpacked(model.flat), pseudolm.classes_in(model.flat)
    texts = {r.doc_id: r.text for r in some.collect()}
    assert counts == Counter(t.decode() for text in texts.values() for t in pseudolm.split_tokens(text)) and counts["zebra"] >= 180

    def log_softmax(x):
        return x - np.log(np.exp(x).sum())

    for doc_id in sorted(texts)[:8]:
        words = pseudolm.split_tokens(texts[doc_id])
        units = [0, 0, *model.tokens(texts[doc_id]), 0, 0]
        total = 0.0
        for i, word in enumerate(words, 2):
            seen = [units[i + k] for k in pseudolm.OFFSETS]
            hidden = np.tanh(sum(w["window"][k][u].astype(float) for k, u in enumerate(seen)) + w["bias"])
            kind, place = divmod(units[i], classes)
            total += log_softmax(hidden @ w["kind"] + w["kind_bias"])[kind] + log_softmax(hidden @ w["place"][kind] + w["place_bias"][kind])[place]
            if word not in model.ids:
                total += np.log(counts[word.decode()]) - model.totals[units[i]]
        assert got[doc_id].n_tokens == len(words) and np.isclose(got[doc_id].log_likelihood, total, rtol=1e-5)


def test_training_steps_are_those_of_a_plain_network():
    classes, draw = 32, np.random.default_rng(4)
    flat = pseudolm.start_weights(classes) * 4
    ids = draw.integers(0, classes * classes, 900) // draw.integers(1, 40, 900)
    at = np.sort(draw.choice(np.arange(2, 898), 300, replace=False))
    want = flat.astype(float)
    w, g = pseudolm.unpacked(want), pseudolm.unpacked(np.zeros(len(flat)))
    for i in at:
        seen = [ids[i + k] for k in pseudolm.OFFSETS]
        hidden = np.tanh(sum(w["window"][k][u] for k, u in enumerate(seen)) + w["bias"])
        kind, place = divmod(ids[i], classes)
        p, q = np.exp(hidden @ w["kind"] + w["kind_bias"]), np.exp(hidden @ w["place"][kind] + w["place_bias"][kind])
        p, q = p / p.sum(), q / q.sum()
        p[kind] -= 1
        q[place] -= 1
        back = (w["kind"] @ p + w["place"][kind] @ q) * (1 - hidden ** 2)
        for name, at_, part in (("kind", ..., np.outer(hidden, p)), ("kind_bias", ..., p), ("place", kind, np.outer(hidden, q)), ("place_bias", kind, q), ("bias", ..., back)):
            g[name][at_] += part / len(at)
        for k, u in enumerate(seen):
            g["window"][k, u] += back / len(at)
    flat_g = np.concatenate([x.ravel() for x in g.values()])
    want -= pseudolm.RATE * flat_g / np.sqrt(flat_g ** 2 + 1e-10)
    pseudolm.train_on(flat, ids, at, squares := np.zeros(len(flat), np.float32))
    assert np.allclose(squares, flat_g ** 2, rtol=1e-3, atol=1e-9) and np.abs(flat - want).max() < 2e-3
    big = flat * 300  # logits whose exponentials are out of range
    assert np.isfinite(pseudolm.log_probabilities(big, ids, at)).all()


def test_learning_hands_the_driver_a_model_and_no_rows(spark, docs, small, monkeypatch):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    frame, handed = type(docs), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: handed.append(rows := collect(self)) or rows)
    monkeypatch.setattr(frame, "toLocalIterator", lambda self, *a: iter(self.collect()))
    cotraining.learn_quality(docs, labels)
    toxicity.learn_toxicity(docs, labels)
    assert sum(len(rows) for rows in handed) <= 4
    empty = docs.limit(0)
    assert cotraining.learn_quality(empty, labels.limit(0)).base == 1.0 and toxicity.learn_toxicity(empty, labels.limit(0)).base == 0.0


def test_joined_components_are_those_of_all_links(spark):
    draw = random.Random(8)
    links = [tuple(draw.sample(range(60), 2)) for _ in range(25)]
    more = [tuple(draw.sample(range(60), 2)) for _ in range(12)]
    edges = lambda rows: spark.createDataFrame(rows, "a long, b long")
    nodes = spark.range(60).withColumnRenamed("id", "node")
    want = list(range(60))
    for _ in range(60):
        for a, b in links + more:
            want[a] = want[b] = min(want[a], want[b])
    got = {r.node: r.component for r in neardup.joined_components(nodes, graph.components(edges(links)), edges(more)).collect()}
    assert got == dict(enumerate(want))
    none = {r.node: r.component for r in neardup.joined_components(nodes, graph.components(edges(links)), edges([])).collect()}
    assert none == {r.node: r.component for r in nodes.join(graph.components(edges(links)), "node", "left").withColumn("component", F.coalesce("component", "node")).collect()}
