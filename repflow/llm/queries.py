"""Registered queries of the package: thin, whole tables, production parameters."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from repflow.llm.ann import nearest
from repflow.llm.ctw import score_texts
from repflow.llm.dedup import exact_dedup
from repflow.llm.jaccard import jaccard_components
from repflow.llm.langid import identify
from repflow.llm.mixing import mix_sources
from repflow.llm.packing import pack
from repflow.llm.piece import round_trip
from repflow.llm.quality import quality
from repflow.llm.spelling import spelling_variants
from repflow.llm.tables import crc_mod, table
from repflow.llm.tokenbin import token_shards
from repflow.llm.toxicity import score_documents
from repflow.llm.turns import conversation_trie

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""WITH d AS (SELECT doc_id, sha256({_LOW}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM d""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query(r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
  s AS (SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::BIGINT AS weight FROM d GROUP BY source),
  t AS (SELECT sum(source_size)::BIGINT AS total FROM s),
  o AS (SELECT *, coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS held,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS free FROM s, t
    WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
  c AS (SELECT *, bool_and(weight * (total - held) > 3 * source_size * free) OVER (ORDER BY source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clamped FROM o),
  f AS (SELECT coalesce(sum(3 * source_size) FILTER (clamped), 0)::BIGINT AS held, sum(weight) FILTER (NOT clamped)::BIGINT AS free FROM c),
  p AS (SELECT source, source_size, CASE WHEN clamped THEN (3 * source_size)::DOUBLE
    ELSE (weight * (total - f.held))::DOUBLE / f.free::DOUBLE END AS target FROM c, f),
  g AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS whole FROM p),
  k AS (SELECT *, target - whole * source_size AS gap FROM g),
  r AS (SELECT d.*, k.* EXCLUDE (source), sum(d.size) OVER (PARTITION BY d.source ORDER BY h, doc_id NULLS FIRST) AS upto
    FROM d JOIN k ON d.source IS NOT DISTINCT FROM k.source),
  m AS (SELECT *, gap - coalesce(max(CASE WHEN upto <= gap THEN upto END) OVER (PARTITION BY source), 0)::DOUBLE AS missing FROM r),
  n AS (SELECT *, row_number() OVER (PARTITION BY source, upto > gap AND abs(size - missing) < missing ORDER BY abs(size - missing), h, doc_id NULLS FIRST) AS nth FROM m)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN gap > 0 AND (upto <= gap OR (abs(size - missing) < missing AND nth = 1)) THEN 1 ELSE 0 END))::BIGINT AS taken,
  (whole + CASE WHEN gap > 0 AND (upto <= gap OR (abs(size - missing) < missing AND nth = 1)) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM n""")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 3) == 1)


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) == 0)


@query()
def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query()
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents"))


@query()
def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=100)


@query()
def op9_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


@query()
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op1_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality(table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"))


@query("""WITH raw AS (SELECT conv_id, strlen(coalesce(text, '')) AS size, turn,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id FROM conversations WHERE conv_id IS NOT NULL),
  t AS (SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS p FROM raw),
  h AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(flatten(list_prepend([4294967295::BIGINT],
      list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: [ord(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x < 0 THEN xor(c >> 1, 3988292384 * (c & 1)) ELSE xor(c, x) END), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM raw)),
  r AS (SELECT h.conv_id, t.p, t.id, t.size FROM h JOIN t ON t.conv_id = h.base AND t.p <= h.h
    UNION ALL SELECT h.conv_id, t.p, t.id, t.size FROM h JOIN t ON t.conv_id = h.conv_id AND t.p > h.h),
  s AS (SELECT h.conv_id, coalesce(list(r.id ORDER BY r.p) FILTER (r.p IS NOT NULL), []) AS ids,
    coalesce(list(r.size ORDER BY r.p) FILTER (r.p IS NOT NULL), []) AS sizes FROM h LEFT JOIN r ON r.conv_id = h.conv_id GROUP BY h.conv_id),
  m AS (SELECT conv_id, depth, md5(array_to_string(ids[1:depth], ',')) AS node, coalesce(sizes[depth], 0) AS size, len(ids) = depth AS ends
    FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS depth FROM s)),
  n AS (SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY depth, node),
  a AS (SELECT m.depth, m.node, count(*) FILTER (n.leaf)::BIGINT AS n_leaves, sum(n.own)::BIGINT AS saved_tokens,
    count(*) FILTER (n.depth = m.depth + 1)::BIGINT AS n_children FROM n JOIN m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.depth, m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, a.n_children, a.n_leaves, a.saved_tokens, n.ends_sha256
FROM n JOIN a ON a.depth = n.depth AND a.node = n.node
LEFT JOIN (SELECT m.conv_id AS member, n.conv_id, n.depth FROM m JOIN n ON m.depth = n.depth AND m.node = n.node) p
  ON p.member = n.conv_id AND p.depth = n.depth - 1""")
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), rebuild=True)


_UP, _DOWN = string.ascii_uppercase, string.ascii_lowercase
# levenshtein counts bytes in DuckDB: the 64 letters of two bytes stand as one other character each
_LATIN = "".join(chr(c) for c in range(0xC0, 0x100))
_ONE = (_UP + string.digits + "!#$%&()*+,-./:;<=>?@[]^_`{|}~")[:64]


def _crc_step(value: int) -> int:
    """Four bits of crc32."""
    for _ in range(4):
        value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
    return value


_CRC = "[" + ", ".join(f"{_crc_step(i)}::BIGINT" for i in range(16)) + "]"


@query(f"""WITH RECURSIVE runs AS (SELECT id, run, count(*) AS c FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, '{_UP}', '{_DOWN}'), '[a-z\u00C0-\u00FF]+')) AS run
    FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
  hexed AS (SELECT run, c, hex(encode(id || ':' || run)) AS x FROM runs),
  crc AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x)),
      lambda i: (instr('0123456789ABCDEF', x[(i // 2) * 2 + 2 - i % 2]) - 1)::BIGINT)),
      lambda s, n: xor(s >> 4, {_CRC}[(xor(s, n) & 15) + 1])), 4294967295) AS h FROM hexed),
  words AS (SELECT word, sum(c)::BIGINT AS n FROM (
      SELECT c, CASE WHEN h % 199 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word FROM crc)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
  cuts AS (SELECT word, n, word AS k FROM words UNION ALL
    SELECT word, n, word[:i] || word[i + 2:] AS k FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
  pairs AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.k = b.k AND a.word <> b.word
    WHERE levenshtein(translate(a.word, '{_LATIN}', '{_ONE}'), translate(b.word, '{_LATIN}', '{_ONE}')) = 1),
  best AS (SELECT word, count(*) AS n_near, min({{'m': -near_n, 'w': near}}) AS b FROM pairs GROUP BY word),
  forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.b.m >= 5 * w.n THEN b.b.w END AS form,
    CASE WHEN -b.b.m >= 5 * w.n THEN -b.b.m END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
  chain AS (SELECT word, word AS root, form FROM forms UNION ALL
    SELECT c.word, f.word AS root, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word WHERE c.form IS NULL""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query()
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
