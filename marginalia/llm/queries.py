"""The queries of this subpackage and their SQL: each applies one operator, with production parameters, to its whole
table. Queries without SQL are held against brute force in tests/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC archives against a replica in which every 53rd page (and all of 97 x 9 pages) has a changed first
    byte."""
    from .warc import archive_records, audit, merkle_tree

    records = archive_records(_table(spark, sf_dir, "pages"), offsets=False)
    bad = F.pmod("ordinal", F.lit(53)) == 7
    replica = records.withColumn("record", F.when(bad | F.pmod("ordinal", F.lit(873)).between(100, 103), F.concat(F.encode(F.lit("X"), "UTF-8"), F.expr("substring(record, 2, 2147483647)"))).otherwise(F.col("record")))
    found = audit(merkle_tree(records, name="primary"), merkle_tree(replica, name="replica"))
    return found.select(F.col("ordinal").alias("page_id"), "archive", "node", F.col("begin").alias("begin_offset"), F.col("end").alias("end_offset"), "digest_a", "digest_b", "verdict")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .metric_join import range_join

    return range_join(_table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_languages

    return identify_languages(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .passages import repeated_passages

    return repeated_passages(_table(spark, sf_dir, "documents"))


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kneser_ney import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lsh_forest import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnowing import MIN_BYTES, dedup_lines

    cut = dedup_lines(_table(spark, sf_dir, "documents"), line_bytes=MIN_BYTES)
    return cut.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op10_apportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .apportion import mix_documents

    return mix_documents(_table(spark, sf_dir, "documents")).drop("source", "shard")


QUERIES = {f.__name__: f for f in (op1_warc_fixity, op2_decontaminate, op3_metric_join, op4_language_id, op5_token_counts, op6_passages, op7_kneser_ney, op8_lsh_forest, op9_winnowing, op10_apportion)}

ORACLES = {
    "op1_warc_fixity": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
  || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
  || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
  || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS r FROM pages),
o AS (SELECT page_id, page_id // 1000 AS archive, r, row_number() OVER a - 1 AS node, sum(strlen(r)) OVER a AS e FROM p
  WINDOW a AS (PARTITION BY page_id // 1000 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT page_id, archive, node, CAST(e - strlen(r) AS BIGINT) AS begin_offset, CAST(e AS BIGINT) AS end_offset, sha256(r) AS digest_a,
  sha256('X' || substr(r, 2)) AS digest_b, 'corrupt' AS verdict
FROM o WHERE page_id % 53 = 7 OR page_id % 873 BETWEEN 100 AND 103""",
    "op3_metric_join": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
g AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT g.id AS vec_id, coalesce(k.n, 0) AS n_links, g.c AS component_id, g.c = g.id AS kept
FROM g LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = g.id""",
    "op8_lsh_forest": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
h AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s WHERE len(s) > 0),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM h a JOIN h b ON a.h = b.h AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80 GROUP BY ALL),
l AS (SELECT a, b FROM i WHERE 100 * i >= 80 * (na + nb - i)),
r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
g AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, g.c AS component_id, g.c = s.doc_id AS kept FROM s JOIN g ON g.id = s.doc_id""",
    "op9_winnowing": """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL),
n AS (SELECT doc_id, i, x, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y FROM l),
w AS (SELECT doc_id, i, 2 AS m, x || chr(10) || y AS k FROM n WHERE y IS NOT NULL AND strlen(translate(x || y, ' ' || chr(9) || chr(13), '')) >= 40
  UNION ALL SELECT doc_id, i, 1, x FROM n WHERE strlen(translate(x, ' ' || chr(9) || chr(13), '')) >= 40),
r AS (SELECT doc_id, i, m, row_number() OVER (PARTITION BY m, k ORDER BY doc_id, i) AS rn FROM w),
g AS (SELECT DISTINCT doc_id, i + d AS i FROM r, (VALUES (0), (1)) v(d) WHERE rn > 1 AND d < m)
SELECT d.doc_id, coalesce(k.n, 0) AS n_lines, coalesce(k.gone, 0) AS n_removed, coalesce(k.removed, '') AS removed, md5(coalesce(k.t, '')) AS text_md5
FROM documents d LEFT JOIN (SELECT l.doc_id, count(*) AS n, count(g.i) AS gone, string_agg(CAST(g.i AS VARCHAR), ',' ORDER BY g.i) AS removed,
  string_agg(CASE WHEN g.i IS NULL THEN l.x END, chr(10) ORDER BY l.i) AS t FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id) k ON k.doc_id = d.doc_id""",
    "op10_apportion": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(list_extract([3, 1, 2], CAST(1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS BIGINT)) AS DOUBLE) AS w FROM d GROUP BY source),
t AS (SELECT *, CAST(2 * source_size AS DOUBLE) AS top, 2 * source_size / w AS q FROM s),
f AS (SELECT *, coalesce(sum(top) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM t WINDOW o AS (ORDER BY q, source IS NULL, source)),
v AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s) - full_before) / rest AS lev FROM f),
lv AS (SELECT arg_min(lev, q) AS lev FROM v WHERE lev * w <= top),
tg AS (SELECT source, source_size, least(top, w * (SELECT lev FROM lv)) AS target, CAST(ceil(greatest(source_size, 1) / 1000000) AS BIGINT) AS shards FROM v),
r AS (SELECT d.*, source_size, target, CAST('0x' || substr(h, 1, 8) AS BIGINT) % shards AS shard FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source),
ru AS (SELECT *, lpad(CAST(shard AS VARCHAR), 12, '0') || ':' || coalesce('s' || source, 'null') AS unit FROM r),
u AS (SELECT unit, CAST(sum(size) AS BIGINT) AS n, CASE WHEN any_value(source_size) > 0 THEN any_value(target) * sum(size) / any_value(source_size) ELSE 0 END AS value, CAST(floor(sum(size) * 2 / 8) AS BIGINT) AS most FROM ru GROUP BY unit),
k AS (SELECT unit, value / (2 * unnest(range(1, most + 1)) - 1) AS quotient FROM u WHERE value > 0),
z AS (SELECT unit, row_number() OVER (ORDER BY quotient DESC, unit) AS place FROM k),
e AS (SELECT u.unit, u.n, 8 * count(z.unit) AS want FROM u LEFT JOIN z ON z.unit = u.unit AND z.place <= CAST(floor((SELECT sum(size) FROM d) * 1.5 / 8 + 0.5) AS BIGINT) GROUP BY u.unit, u.n),
b AS (SELECT unit, n, CASE WHEN n > 0 THEN want // n ELSE 0 END AS rounds, CASE WHEN n > 0 THEN want % n ELSE 0 END AS run,
  CASE WHEN n > 0 THEN (CAST('0x' || substr(md5('mix-1/' || unit), 1, 8) AS BIGINT) % greatest(1, n // 8)) * 8 ELSE 0 END AS begin_at FROM e),
y AS (SELECT ru.*, b.n, b.rounds, b.run, b.begin_at, CAST(sum(size) OVER (PARTITION BY ru.unit ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS hi FROM ru JOIN b ON b.unit = ru.unit)
SELECT doc_id, size, source_size, target, CAST(rounds * size + greatest(0, least(hi, least(begin_at + run, n)) - greatest(hi - size, begin_at)) + greatest(0, least(hi, begin_at + run - n) - greatest(hi - size, 0)) AS BIGINT) AS taken FROM y""",
}
