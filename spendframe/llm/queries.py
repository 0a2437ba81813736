"""Registered queries of the training-data operators, one per operator, and their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendframe.llm import bpe_stream, embedding_forest, fuzzy_lines, hard_negatives, license_scan, mixing, ngram_join, nn_descent, pii_bootstrap, quality_ledger, spelling, suffix_dedup, toxicity
from spendframe.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines FROM w),
u AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, word, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3 FROM u
      WINDOW p AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, word, w2, w3) AS c FROM g WHERE w3 IS NOT NULL),
p AS (SELECT DISTINCT rid, i + k AS place FROM r, (VALUES (0), (1), (2)) AS s(k) WHERE c >= 2),
n AS (SELECT rid, count(*) AS n_repeat_words FROM p GROUP BY rid),
f AS (SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN n USING (rid)),
b AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
       + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
       + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END)
       + (CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END)
       + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
       + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS BIGINT) AS fail_bits FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       fail_bits = 0 AS kept, n_lines, fail_bits FROM b
"""


@query("op5_quality_ledger", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ledger.ledger(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = quality_ledger.apply_policy(rows, "base", "_base_kept")
    return quality_ledger.apply_policy(base, "v1", "kept").selectExpr(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "NOT _base_kept AS base_failed", "kept", "n_lines", "fail_bits")


@query("op7_pivotal_mix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def word_vocabulary() -> str:
    """Path of the public word-end vocabulary; the tokenizer files are a package of their own."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_stream_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe_stream.digests(docs, word_vocabulary())


@query("op9_ngram_join")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_join.classes(docs).select("doc_id", "n_shingles", "component_id")


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.scores(docs, model)


@query("op3_bootstrap_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", *[pii_bootstrap.count_of("base", k).alias(f"n_{k}") for k in pii_bootstrap.KINDS[:4]],
                        F.sha2(pii_bootstrap.as_text("base"), 256).alias("base_sha256"),
                        pii_bootstrap.as_text("spans").alias("spans"))


@query("op6_fuzzy_lines")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = fuzzy_lines.clean(read_table(spark, sf_dir, "documents", "doc_id", "text"), every_position=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", "emptied",
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("copies")


@query("op4_nn_descent")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nn_descent.nearest(table, 5, F.col("vec_id") % 50 == 0)


#: crc32 by the usual rule (reflected polynomial 0xEDB88320), a table entry being eight steps.
OP13_SQL = r"""
WITH RECURSIVE
steps AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL
          SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
held AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                 lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                           ELSE [CAST(195 AS BIGINT), CAST(unicode(x) - 64 AS BIGINT)] END)) AS b FROM held),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
                  lambda c, x: xor(c // 256, tab[xor(c % 256, x) + 1])), 4294967295) AS h FROM bytes, crc),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                   ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS v
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.v = b.word
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.v = b.word),
ranked AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
                  row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.m >= 2 * w.n THEN r.other END AS form,
                 CASE WHEN r.m >= 2 * w.n THEN r.m END AS form_n
          FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) r USING (word)),
chain AS (SELECT word, word AS at FROM forms UNION
          SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms l ON c.at = l.word WHERE l.form IS NULL
"""


@query("op13_spelling", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents", "doc_id", "text"))


OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, s.id AS negative_id, positive_score,
       s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(hard_negatives.quantised(table), F.col("id") % 100 == 0)


OP11_SQL = """
WITH RECURSIVE
e AS (SELECT vec_id, embedding AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, CAST(v AS DOUBLE[]) AS v FROM e),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
      WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.9),
r AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""


@query("op11_embedding_forest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_duplicates(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
