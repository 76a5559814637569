"""One query for each text operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import cotraining, decontaminate, infill, langid, lattice, licences, neardup, negatives, pieces, pseudolm, sharding, templates, toxicity
from spendlens.llm.common import ASCII_LOWER, ASCII_UPPER, table

PIECE_MODEL = "piece_bpe_32k.model"


def held_out(doc_id: Column) -> Column:
    """Rows that no toxicity model learns from: crc32 of the id's text mod 5 is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents"))
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", " ").alias("sentence_ids"),
                        F.array_join("licences", " ").alias("licences"), F.array_join("kinds", " ").alias("kinds"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), words=4)


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    scored = cotraining.with_quality(docs, cotraining.learn_quality(docs, table(spark, folder, "labels")), "score")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).alias("accepted"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return templates.extract_pages(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudolm.train_and_score(table(spark, folder, "documents").select("doc_id", "text"))


def op6_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(table(spark, folder, "embeddings"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.learn_toxicity(docs, table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.with_toxicity(docs, model, "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def piece_digests(docs: DataFrame) -> DataFrame:
    done = pieces.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))
    return done.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return piece_digests(table(spark, folder, "documents"))


def op9_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are ids divisible by 100; where 7 divides an id, its label moves on by one, to make labels disagree with vectors."""
    vectors, label = table(spark, folder, "embeddings"), F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(vectors.select("vec_id", moved.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))
    model = langid.learn_languages(docs, ~apart, public_tokenizers.path(PIECE_MODEL))
    return langid.with_language(docs, model).select("doc_id", apart.alias("held_out"), "lang_pred", "score")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    done = infill.restore(infill.fill_in_middle(table(spark, folder, "documents").select("doc_id", "text")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_licences, op2_near_duplicates, op3_quality, op4_main_text, op5_pseudo_likelihood, op6_near_vectors, op7_toxicity,
    op8_pieces, op9_shards, op10_decontaminate, op11_hard_negatives, op12_language, op13_fill_in_middle)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_sql() -> str:
    names = ", ".join(_quoted(s) for s in licences.KNOWN)
    ids = ", ".join(_quoted(i) for i in licences.KNOWN.values())
    inside = " ".join(f"WHEN contains(' ' || p.whole || ' ', {_quoted(f' {n} ')}) THEN [{_quoted(n)}]"
                      for n in sorted(licences.NOTICES, key=lambda n: (-len(n), n)))
    steps, last = [], "s0"
    for k, (_, _, identifiers) in enumerate(licences.RULES):
        run = _quoted(licences.rule_text(identifiers))
        steps.append(f"s{k + 1} AS (SELECT * EXCLUDE (rest), contains(rest, {run}) AS r{k}, replace(rest, {run}, ' |') AS rest FROM {last})")
        last = f"s{k + 1}"

    def listed(place: int) -> str:
        seen = dict.fromkeys(rule[place] for rule in licences.RULES)
        found = {n: [k for k, rule in enumerate(licences.RULES) if rule[place] == n] for n in seen}
        first = {n: "least(" + ", ".join(f"CASE WHEN r{k} THEN {k} ELSE 999 END" for k in ks) + ", 999)" for n, ks in found.items()}
        entries = ", ".join(f"{{'at': {at}, 'name': {_quoted(n)}}}" for n, at in first.items())
        return f"coalesce(array_to_string(list_transform(list_sort(list_filter([{entries}], lambda e: e.at < 999)), lambda e: e.name), ' '), '')"

    return f"""
WITH pieces AS (
  SELECT doc_id, list_transform(string_split_regex(regexp_replace(regexp_replace(
    chr(10) || translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '{licences.LINE_END}', chr(10), 'g'),
    '{licences.COMMENT_MARK}', chr(10), 'g'), '{licences.SENTENCE_END}'), lambda p: {{
      'whole': trim(regexp_replace(p, '{licences.OTHER}', ' ', 'g')),
      'single': list_filter(list_transform(string_split(p, chr(10)), lambda l: trim(regexp_replace(l, '{licences.OTHER}', ' ', 'g'))), lambda l: l <> '')}}) AS pieces
  FROM documents),
cut AS (
  SELECT doc_id, flatten(list_transform(pieces, lambda p: CASE
    WHEN list_contains([{names}], p.whole) THEN [p.whole]
    WHEN len(list_filter(p.single, lambda l: list_contains([{names}], l))) > 0 THEN p.single
    WHEN contains(' ' || p.whole || ' ', ' not ') THEN p.single
    {inside}
    ELSE p.single END)) AS sentences FROM pieces),
known AS (
  SELECT doc_id, len(sentences) AS n_sentences, list_filter(list_transform(sentences,
    lambda p: [{ids}][list_position([{names}], p)]), lambda i: i IS NOT NULL) AS found FROM cut),
s0 AS (SELECT doc_id, n_sentences, found, coalesce(array_to_string(list_transform(found, lambda i: ' ' || i || ';'), ''), '') AS rest FROM known),
{', '.join(steps)}
SELECT doc_id, n_sentences, coalesce(array_to_string(found, ' '), '') AS sentence_ids, {listed(0)} AS licences, {listed(1)} AS kinds FROM {last}"""


def _words_sql(column: str) -> str:
    return (f"list_filter(string_split_regex(translate(coalesce({column}, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), "
            "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")


CHECK_SQL: dict[str, str] = {
    "op1_licences": licence_sql(),
    "op6_near_vectors": """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(degree.n, 0) AS n_links, least.component_id, e.vec_id = least.component_id AS kept
FROM embeddings e JOIN least ON least.a = e.vec_id LEFT JOIN degree ON degree.a = e.vec_id""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, {_words_sql('text')} AS w FROM documents),
i AS (SELECT item_id, {_words_sql('text')} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, size, w[k:k + size - 1] AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)),
spots AS (
  SELECT doc_id, size, k, w[k:k + size - 1] AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d CROSS JOIN (SELECT DISTINCT size FROM grams) WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, s.size, k FROM spots s JOIN grams g ON s.gram = g.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id))::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, n, ('0x' || h[1:8])::UBIGINT % (n + 1) AS x, ('0x' || h[9:16])::UBIGINT % (n + 1) AS y,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || h[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
cut AS (
  SELECT doc_id, t, n, form, least(x, y)::BIGINT AS a, (greatest(x, y) - least(x, y))::BIGINT AS b,
    substring(t, 1, a) AS prefix, substring(t, a + 1, b) AS middle, substring(t, a + b + 1) AS suffix FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM cut""",
}
