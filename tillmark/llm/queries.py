"""The operators as queries over a folder of tables, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import (
    centroids,
    decontaminate,
    html_text,
    lexical,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality,
    sharding,
    topk,
    url_rules,
    warc,
)
from tillmark.llm.ship import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack_documents(docs, TOKENIZER, size=2048, end=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.report(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), least=0.3
    )


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules, default="allow").select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(
        table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), k=10
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = [
        op1_topk, op2_sharding, op3_packing, op4_decontaminate, op5_html_text, op6_pii, op7_warc,
        op8_near_dup, op9_quality, op10_url_rules, op11_centroids, op12_lexical, op13_line_dedup,
    ]
    return {f.__name__: _shipped(f) for f in own} | {"pipeline": corpus_pipeline.run}


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


# ---- SQL -------------------------------------------------------------------------------------

TOPK_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
           AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""

DECONTAMINATE_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') AS w
    FROM documents
), item_words AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text,
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '(?:[0-9a-z]|[^\x00-\x7F])+') AS w
    FROM benchmark WHERE text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
    FROM item_words, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS t(s)
    WHERE len(w) > 0
), lengths AS (
    SELECT DISTINCT n FROM item_windows
), doc_windows AS (
    SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
    FROM words, lengths, unnest(generate_series(1, len(w) - n + 1)) AS t(s)
    WHERE len(w) >= n
), hits AS (
    SELECT doc_id, n, s, item_id FROM doc_windows JOIN item_windows USING (n, g)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT doc_id, n, s FROM hits), unnest(generate_series(s, s + n - 1)) AS t(p)
    GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

WARC_SQL = """
WITH pages_ AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
           sha1(coalesce(html, '')) AS code
    FROM pages
), originals AS (
    SELECT *, min(page_id) OVER (PARTITION BY code) AS original FROM pages_
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(generate_series(0, 31), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(code, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT
                   >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END
           AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM originals
"""

NEAR_DUP_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT DISTINCT doc_id, hash(array_to_string(w[s:s + 4], ' ')) AS g
    FROM words, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS t(s)
    WHERE len(w) > 0
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id
    JOIN sizes a ON a.doc_id = x.doc_id JOIN sizes b ON b.doc_id = y.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN sizes USING (doc_id)
"""

URL_RULES_SQL = r"""
WITH urls AS (
    SELECT page_id, CASE WHEN contains(url, '://')
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), split_ AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
    FROM urls
), rules(verdict, host, path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
           ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting AS (
    SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST)
               AS place
    FROM split_ u LEFT JOIN rules r
      ON ('.' || u.host) LIKE ('%.' || r.host) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE place = 1
"""

CENTROIDS_ROUND = """, a{n} AS MATERIALIZED (
    SELECT row_, vec_id, v, min([d, c]) AS best
    FROM (SELECT k.*, c.c, (list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v)
                            + list_inner_product(c.v, c.v))::BIGINT AS d
          FROM kept k, c{n} c)
    GROUP BY row_, vec_id, v
), c{next} AS MATERIALIZED (
    SELECT c, coalesce(m, v) AS v
    FROM c{n} LEFT JOIN (
        SELECT c, list(x ORDER BY i) AS m
        FROM (SELECT c, i, floor(sum(x) / count(*)) AS x
              FROM (SELECT best[2] AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n})
              GROUP BY c, i)
        GROUP BY c) USING (c)
)"""

CENTROIDS_SQL = (
    """
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_, vec_id,
           list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS c, v
    FROM kept WHERE vec_id IS NOT NULL QUALIFY c < 16
)"""
    + "".join(CENTROIDS_ROUND.format(n=n, next=n + 1) for n in range(4))
    + """
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance,
       (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
       (sum(best[1]) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c3.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c3.c = best[2]
"""
)

LEXICAL_SQL = r"""
WITH words AS MATERIALIZED (
    SELECT row_number() OVER () AS row_, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+') AS w
    FROM documents
), totals AS MATERIALIZED (
    SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM words WHERE len(w) > 0
), tf AS MATERIALIZED (
    SELECT row_, doc_id, n, t, count(*) AS tf
    FROM (SELECT row_, doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM words)
    GROUP BY row_, doc_id, n, t
), weights AS MATERIALIZED (
    SELECT t, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM tf, totals GROUP BY t
), asked AS (
    SELECT item_id, t, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7F])+')) AS t FROM benchmark)
    GROUP BY item_id, t
), scored AS (
    SELECT item_id, row_, doc_id, sum(times * weight * ((1000000000 * tf)
               // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN tf USING (t) JOIN weights USING (t), totals
    GROUP BY item_id, row_, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

LINES_SQL = r"""
WITH split_ AS MATERIALIZED (
    SELECT row_, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place
    FROM (SELECT row_number() OVER () AS row_, doc_id,
                 string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), keyed AS MATERIALIZED (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split_
), repeated AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (r.key IS NULL), ''))
           AS kept_sha256
FROM keyed LEFT JOIN repeated r ON r.key = keyed.key
GROUP BY row_
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": TOPK_SQL,
        "op4_decontaminate": DECONTAMINATE_SQL,
        "op7_warc": WARC_SQL,
        "op8_near_dup": NEAR_DUP_SQL,
        "op10_url_rules": URL_RULES_SQL,
        "op11_centroids": CENTROIDS_SQL,
        "op12_lexical": LEXICAL_SQL,
        "op13_line_dedup": LINES_SQL,
    }
