"""The operators' queries over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import embedding_join, gated_lm, html_text, language_id, line_quality, ngram_join, private_spans, sentencepiece_codec, source_mixing, token_alignment, token_counts, token_store, vector_codes
from wardline.llm.common import held_out, table
from wardline.operators.store import workspace

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    languages, matrix = language_id.fit(docs, ~out)
    found = language_id.predict(docs.select("doc_id", "text"), languages, matrix)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to a store and read them back through its index."""
    address = f"{workspace(spark)}/wardline/tokens-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    token_store.write_store(docs, public_tokenizers.path(WORD_TOKENIZER), address)
    return token_store.read_store(spark, address)


@query
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics, and lines that too many documents of a source share."""
    return line_quality.judge(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE_SQL["op3_line_quality"] = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         {_WORDS.format("coalesce(text, '')")} AS w
  FROM documents
), line AS (
  SELECT doc_id, host, t, pos, raw, {_WORDS.format(f"translate(raw, '{_UPPER}', '{_LOWER}')")} AS lw
  FROM (SELECT doc_id, host, t, generate_subscripts(string_split(t, chr(10)), 1) AS pos,
               unnest(string_split(t, chr(10))) AS raw FROM d)
), real_line AS (
  SELECT doc_id, host, t, pos, raw, array_to_string(lw, ' ') AS norm, len(lw) AS n FROM line WHERE len(lw) > 0
), dup AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id, raw ORDER BY pos) AS k FROM real_line)
  WHERE k > 1 GROUP BY 1
), win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1)
  GROUP BY 1
), texts AS (
  SELECT host, t, min(doc_id) AS doc_id FROM d GROUP BY 1, 2
), freq AS (
  SELECT r.host, norm, min(r.doc_id) AS first_id
  FROM real_line r JOIN texts USING (host, doc_id)
  GROUP BY r.host, norm
  HAVING count(DISTINCT r.doc_id) > CASE WHEN max(n) >= {line_quality.LONG_WORDS} THEN {line_quality.LONG_TEXTS} ELSE {line_quality.MIN_TEXTS} END
), gone AS (
  SELECT r.doc_id, sum(n) AS n FROM real_line r JOIN freq f ON r.host = f.host AND r.norm = f.norm
  WHERE r.doc_id <> first_id GROUP BY 1
), s AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, len(w) - coalesce(gone.n, 0) AS n_left
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_left::BIGINT AS n_left_words,
  n_words < {line_quality.MIN_WORDS} OR 100 * n_repeat_words > {line_quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT base_failed AND n_left >= {line_quality.MIN_LEFT_WORDS} AND n_left >= {line_quality.MIN_LEFT_SHARE} * n_words AS kept
FROM s
"""


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text with the SentencePiece model."""
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_codec.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the SentencePiece model."""
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path(PIECE_MODEL))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated sampling probability and draw of every document."""
    return source_mixing.mix_documents(table(spark, sf_dir, "documents"))


def _mixing_sql() -> str:
    topics = " ".join(f"WHEN regexp_matches(t, '(?i){p}') THEN '{n}'" for n, p in source_mixing.TOPICS)
    parts = [f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    CASE {topics} ELSE '{source_mixing.OTHER}' END AS topic, len({_WORDS.format("t")})::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)
), total AS (SELECT sum(n_tokens)::DOUBLE AS total FROM d
), c0 AS (
  SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / (SELECT total FROM total) AS w
  FROM d GROUP BY 1, 2, 3
)"""]
    for m in source_mixing.MARGINS:
        power = source_mixing.POWERS[m]
        parts.append(f""", p_{m} AS (SELECT {m}, sum(tokens) ** {power} AS p FROM c0 GROUP BY 1)
, t_{m} AS (SELECT {m}, p / (SELECT sum(p) FROM p_{m}) AS target FROM p_{m})""")
    step = 0
    for _ in range(source_mixing.ROUNDS):
        for m in source_mixing.MARGINS:
            parts.append(f""", c{step + 1} AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, c.tokens, c.w * CASE WHEN s.held > 0 THEN t.target / s.held ELSE 1 END AS w
  FROM c{step} c JOIN (SELECT {m}, sum(w) AS held FROM c{step} GROUP BY 1) s USING ({m}) JOIN t_{m} t USING ({m}))""")
            step += 1
    most = source_mixing.MOST_COPIES
    parts.append(f""", f AS (
  SELECT source, lang, topic, CASE WHEN tokens > 0 THEN w * (SELECT total FROM total) / tokens END AS raw FROM c{step}
), p AS (
  SELECT source, lang, topic, coalesce(raw, 1) AS factor,
    coalesce(raw, 1) * greatest(1 / (SELECT max(raw) FROM f), {source_mixing.LEAST_SHARE}::DOUBLE) AS expected FROM f
), n AS (
  SELECT *, least(expected, {most}::DOUBLE) AS e,
    ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT / {1 << 52}.0::DOUBLE AS u FROM d JOIN p USING (source, lang, topic))
SELECT doc_id, source, lang, topic, n_tokens, round(factor, 6) AS factor, round(expected, 6) AS expected,
  (floor(e) + CASE WHEN u < e - floor(e) THEN 1 ELSE 0 END)::BIGINT AS copies,
  round(greatest(expected / {most}::DOUBLE, 1::DOUBLE), 6) AS weight, floor(e) + CASE WHEN u < e - floor(e) THEN 1 ELSE 0 END > 0 AS kept
FROM n""")
    return "".join(parts)


ORACLE_SQL["op8_source_mixing"] = _mixing_sql()


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op9_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within each label."""
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents by the Jaccard similarity of their shingle sets."""
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


@query
def op7_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every whole text under a gated recurrent model and a base."""
    return gated_lm.score_documents(table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, with codebooks fitted on all of them."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)


def _codes_sql() -> str:
    """Rounds unrolled; squared distances by inner products, which are exact here."""
    n, m = vector_codes.PARTS, vector_codes.ENTRIES

    def assign(name: str, books: str) -> str:
        return f""", {name} AS MATERIALIZED (
  SELECT p.row, p.pos, min(struct_pack(d := CAST(p.xx - 2 * list_inner_product(p.x, b.x) + b.xx AS BIGINT), k := b.k)) AS best
  FROM p JOIN {books} b USING (pos) GROUP BY 1, 2)"""

    parts = [f"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda y: floor(y::DOUBLE * {vector_codes.SCALE})) AS z
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), p AS MATERIALIZED (
  SELECT row, vec_id, pos, x, list_inner_product(x, x) AS xx FROM (
    SELECT row, vec_id, pos, z[pos * len(z) // {n} + 1 : (pos + 1) * len(z) // {n}] AS x
    FROM v, (SELECT unnest(range({n})) AS pos))
), b0 AS MATERIALIZED (
  SELECT pos, k, x, xx FROM (
    SELECT pos, x, xx, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS k FROM p) WHERE k < {m}
)"""]
    for r in range(vector_codes.ROUNDS):
        parts.append(assign(f"a{r}", f"b{r}"))
        parts.append(f""", s{r} AS (
  SELECT pos, k, list(t ORDER BY i) AS x FROM (
    SELECT pos, best.k AS k, i, floor(sum(x[i]) / count(*)) AS t
    FROM (SELECT pos, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{r} JOIN p USING (row, pos)) GROUP BY 1, 2, 3) GROUP BY 1, 2
), b{r + 1} AS MATERIALIZED (
  SELECT pos, k, x, list_inner_product(x, x) AS xx FROM (
    SELECT b.pos, b.k, coalesce(s.x, b.x) AS x FROM b{r} b LEFT JOIN s{r} s USING (pos, k)))""")
    last = f"b{vector_codes.ROUNDS}"
    parts.append(assign("f", last))
    parts.append(f""", digest AS (
  SELECT sha256(string_agg(t, ',' ORDER BY pos, k)) AS codebooks_sha256
  FROM (SELECT pos, k, array_to_string(list_transform(x, lambda y: y::BIGINT::VARCHAR), ',') AS t FROM {last})
), c AS (
  SELECT row, string_agg(printf('%02x', best.k), '' ORDER BY pos) AS code, sum(best.d)::BIGINT AS error FROM f GROUP BY 1)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM c JOIN v USING (row), digest""")
    return "".join(parts)


ORACLE_SQL["op12_vector_codes"] = _codes_sql()


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between byte-level BPE tokens and SentencePiece pieces."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align(docs, public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))


@query
def op11_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base patterns and the model's further spans."""
    return private_spans.digest(private_spans.find_private(table(spark, sf_dir, "documents")))
