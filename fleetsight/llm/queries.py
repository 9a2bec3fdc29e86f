"""The registered queries of this subpackage, over whole tables, and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.llm import (
    alignment,
    context_mixing,
    conv_classifier,
    forest,
    host_rules,
    id_store,
    language_codes,
    lexical_search,
    minhash,
    mixture,
    packing,
    secret_scan,
    warc,
)
from fleetsight.llm.common import bound_batches, crc_remainder
from fleetsight.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark, allow_local_default=True)}/llm-{name}-{uuid.uuid4().hex}"


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return context_mixing.score(docs, crc_remainder(F.col("doc_id"), 5) == 1)


def op2_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.taken_words(mixture.mix(_table(spark, sf_dir, "documents")))


def op3_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest.alias("base_sha256"), "spans", "n_novel")


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = _folder(spark, "warc")
    warc.write_archive(pages, path)
    index = warc.merged_index(warc.capture_runs(spark, path))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    net = conv_classifier.train(docs, labels, ~held_out)
    predicted = (F.col("score") >= conv_classifier.THRESHOLD).cast("int")
    return conv_classifier.score(docs, net).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_host_rules(_table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def op10_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark, "ids")
    id_store.write_ids(_table(spark, sf_dir, "documents"), path)
    return id_store.read_ids(spark, path)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op13_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    codes = language_codes.train(docs, ~held_out)
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").alias("text"))
    return language_codes.predict(rows, codes).drop("text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (
        op1_context_mixing,
        op2_source_mixture,
        op3_window_packing,
        op4_secret_scan,
        op5_projection_forest,
        op6_minhash,
        op7_warc_archive,
        op8_quality_scores,
        op9_host_rules,
        op10_id_store,
        op11_lexical_search,
        op12_token_alignment,
        op13_language_codes,
    )
    return {f.__name__: f for f in made}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# links -> the least node that each one reaches
_REACH = """
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
classes AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

_OP5_SQL = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
),
nodes AS (SELECT id, v FROM vectors WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_dot_product(v, v) > 0),
links AS (
  SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.id <> y.id
  WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v)) / sqrt(list_dot_product(y.v, y.v)) >= 0.95
),{_REACH}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = v.id) AS n_links, coalesce(component_id, id) AS component_id,
       coalesce(component_id, id) = id AS kept
FROM vectors v LEFT JOIN classes USING (id)"""

_OP6_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id AS id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
),
sets AS (
  SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1]))) END AS s FROM worded
),
nodes AS (SELECT id, len(s) AS n FROM sets),
items AS (SELECT id, unnest(s) AS x FROM sets),
common AS (SELECT p.id AS a, q.id AS b, count(*) AS c FROM items p JOIN items q ON p.x = q.x AND p.id <> q.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * c >= 80 * (p.n + q.n - c)
),{_REACH}
SELECT id AS doc_id, n AS n_shingles, component_id, component_id = id AS kept FROM nodes JOIN classes USING (id)"""

_OP7_SQL = """
WITH held AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
         CASE WHEN strlen(coalesce(html, '')) >= 100 THEN min(page_id) OVER (PARTITION BY coalesce(html, '')) END AS first_id
  FROM pages
)
SELECT page_id, payload_bytes, sha256(body) AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM held"""

_OP9_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS body, {_WORDS} AS w FROM documents),
places AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM rows),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM places),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY r
),
lines AS (
  SELECT r, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM rows
),
rules AS (
  SELECT doc_id, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM rows LEFT JOIN covered USING (r) JOIN lines USING (r)
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rules),
hosts AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (WHERE base_failed) AS DOUBLE) AS f FROM judged GROUP BY source),
totals AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS s, count(*) / sum(n) AS k FROM hosts),
excess AS (SELECT m, m * (1 - m) AS noise, s - m * m - m * (1 - m) * k AS e FROM totals),
prior AS (SELECT m, CASE WHEN e > 0 THEN least(greatest(noise / e - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM excess),
verdicts AS (SELECT source, (f + m * strength) / (n + strength) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(host_rate, 6) AS host_rate,
       NOT base_failed AND host_rate <= 0.5 AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source"""


_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

_OP11_SQL = f"""
WITH worded AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
held AS (SELECT r, doc_id, len(w) AS n FROM worded WHERE len(w) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM held),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM worded) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, docs
),
asked AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
wanted AS (SELECT i, item_id, term, count(*) AS q FROM (SELECT i, item_id, unnest(w) AS term FROM asked) GROUP BY ALL),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN postings USING (term) JOIN held USING (r), corpus GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """SQL for what it can express: the others need hashes, models, tokenizers or compression."""
    return {
        "op5_projection_forest": _OP5_SQL,
        "op6_minhash": _OP6_SQL,
        "op7_warc_archive": _OP7_SQL,
        "op9_host_rules": _OP9_SQL,
        "op11_lexical_search": _OP11_SQL,
    }
