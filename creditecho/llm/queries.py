"""Registered queries of the operators and, where SQL can express them, their DuckDB statements."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditecho.llm import (
    byte_bpe, jaccard_join, mixing, neighbours, quality_classifier, quality_rules, secret_scan, spelling, substring_dedup, suffix_array_dedup, token_alignment, url_filter, warc,
)
from creditecho.llm.store import new_folder

ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
ONE_IN = 100
K = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_rules.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return report.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.repeats_removed(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), round_trip=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_array_dedup.repeats_removed(_table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["first"].cast("string"), s["last"].cast("string"))), ",")
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept"), spans.alias("spans"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), every=ONE_IN, k=K)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]

    def listed(spans: Column) -> Column:
        text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(text, ",")

    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id", *[count(k) for k in kinds], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(_table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_alignment.align(_table(spark, sf_dir, "documents"), *(public_tokenizers.path(name) for name in ALIGNED))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


RUNS = {f.__name__: f for f in (
    op1_source_mix, op2_quality_rules, op3_substring_dedup, op4_url_filter, op5_byte_bpe, op6_quality_classifier, op7_suffix_array_dedup,
    op8_jaccard_join, op9_neighbours, op10_secret_scan, op11_spelling_variants, op12_warc,
    op13_token_alignment, pipeline,
)}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(concat_ws(':', '{mixing.SEED}', doc_id::VARCHAR)) AS m FROM documents),
classed AS (
  SELECT *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 4, 0)) % 8 AS step,
    ('0x' || m[1:1])::BIGINT % 2 = 0 AS rising, ('0x' || m[2:13])::BIGINT AS place FROM sized),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM classed GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap FROM totals),
levelled AS (
  SELECT *, coalesce(sum(cap) OVER earlier, 0)::BIGINT AS full_,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0))::DOUBLE AS level
  FROM weighed WINDOW earlier AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT arg_min(level, full_) FROM levelled WHERE level * w <= cap) * w) AS target FROM levelled),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, size > 0
    ORDER BY CASE WHEN rising THEN step ELSE 100000 - step END, place, doc_id NULLS FIRST, size) AS nth FROM classed)
SELECT doc_id, size, source_size, target,
  CASE WHEN size > 0 THEN ((floor(nth * (target / source_size) + u) - floor((nth - 1) * (target / source_size) + u)) * size)::BIGINT ELSE 0 END AS taken
FROM placed JOIN share ON placed.source IS NOT DISTINCT FROM share.source, (SELECT {mixing.offset_of(mixing.SEED)!r}::DOUBLE AS u)
"""

OP4 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts),
urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split),
rules(rule, h, p, verdict) AS (
  VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
    ('org/fr/', 'org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT urls.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (page_id)
"""

OP11 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b) AS c FROM range(256) r(b))),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS label, run FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
    FROM documents) WHERE length(run) >= 7),
hexed AS (SELECT label, run, hex(encode(label)) AS x, count(*) AS c FROM runs GROUP BY ALL),
hashed AS (
  SELECT run, c, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM hexed, crc_table),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
lacking AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM lacking a JOIN lacking b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM lacking a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM lacking a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM near GROUP BY word),
told AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk(word, here) AS (SELECT word, word FROM told UNION ALL SELECT walk.word, told.form FROM walk JOIN told ON walk.here = told.word WHERE told.form IS NOT NULL),
ends AS (SELECT walk.word, walk.here AS root FROM walk JOIN told ON walk.here = told.word WHERE told.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM told JOIN ends USING (word)
"""

OP12 = """
WITH bytes AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
shared AS (SELECT b, max(page_id) AS keeper FROM bytes WHERE octet_length(b) >= 1000 GROUP BY b HAVING count(*) > 1)
SELECT page_id, octet_length(bytes.b)::BIGINT AS payload_bytes, sha1(bytes.b) AS payload_digest,
  CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM bytes LEFT JOIN shared USING (b)
"""

SQL = {"op11_spelling_variants": OP11, "op12_warc": OP12, "op1_source_mix": OP1, "op4_url_filter": OP4}
