"""One query for every operator here, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .common import table
from .embedding_dedup import near_duplicates
from .mixing import mix, weighed
from .ngram_join import jaccard_components
from .quality import quality
from .sharding import shard_rows
from .substring_dedup import dedup
from .topk import top_k
from .toxicity import toxicity
from .warc import warc_round_trip


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = weighed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return mix(docs, weights=(3, 1, 2), share=1.5, most=2.0).select("doc_id", "size", "source_size", "target", "taken")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_tokenizer())


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), n_shards=16)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), window=50)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_mixing, op2_bpe, op3_ngram_join, op4_toxicity, op5_warc, op6_topk, op7_sharding, op8_substring_dedup, op9_quality, op10_embedding_dedup)}


def _crc(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ (byte & 1) * 0xEDB88320
    return byte


#: What CRC-32 does to each byte, for SQL that has no such function.
CRC_TABLE = "[" + ", ".join(f"{_crc(i)}::BIGINT" for i in range(256)) + "]"

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": """
        WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
             d AS (SELECT d.doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size, coalesce(md5(text), '') AS th,
                   -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || coalesce(md5(text), '')), 1, 13) AS UBIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
                   / (CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS key
                   FROM documents d LEFT JOIN q ON q.doc_id = d.doc_id),
             s AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
             w AS (SELECT *, CAST([3, 1, 2][(sid - 1) % 3 + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM s),
             l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
                   FROM w WINDOW o AS (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
             t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, (cap / w, sid)) FROM l WHERE level * w <= cap)) AS target FROM l),
             b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
             p AS (SELECT d.*, source_size, target, epochs, floor(target - epochs * source_size + 0.5)
                   - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size, th ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_
                   FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(epochs * size + greatest(least(left_, size), 0) AS BIGINT) AS taken FROM p""",
    "op3_ngram_join": """
        WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, CAST(len(w) - 1 AS BIGINT)), lambda i: array_to_string(w[i:i + 2], ' '))) END AS x FROM t),
             g AS MATERIALIZED (SELECT DISTINCT x, sha256(array_to_string(list_sort(x), chr(10))) AS h FROM s WHERE len(x) > 0),
             r AS MATERIALIZED (SELECT h, any_value(len(x)) AS n, any_value(x) AS x FROM g GROUP BY h),
             e AS MATERIALIZED (SELECT h, n, unnest(x) AS y FROM r),
             c AS (SELECT a.h AS a, b.h AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.y = b.y AND a.h < b.h AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY 1, 2),
             l AS MATERIALIZED (SELECT a, b FROM c WHERE 100 * i >= 90 * (na + nb - i)), both_ AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             d AS MATERIALIZED (SELECT doc_id, len(x) AS n, CASE WHEN len(x) > 0 THEN sha256(array_to_string(list_sort(x), chr(10))) END AS h FROM s),
             m AS MATERIALIZED (SELECT h, min(doc_id) AS id FROM d WHERE h IS NOT NULL GROUP BY h),
             p AS (SELECT h, id FROM m UNION SELECT both_.b, p.id FROM p JOIN both_ ON both_.a = p.h),
             q AS (SELECT h, min(id) AS id FROM p GROUP BY h)
        SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(q.id, doc_id) AS component_id FROM d LEFT JOIN q ON q.h = d.h""",
    "op5_warc": """
        WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages),
             f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id > first_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d""",
    "op6_topk": """
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
             s AS (SELECT q.u, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.u <> c.u WHERE q.vec_id % 50 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op7_sharding": f"""
        WITH RECURSIVE d AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, text,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
             r AS MATERIALIZED (SELECT doc_id, size, h, list_reduce(list_prepend(4294967295, list_transform(range(1, size), lambda i: CAST('0x' || substr(hex(encode(text)), 2 * i - 1, 2) AS BIGINT))),
                   lambda x, y: xor(x // 256, {CRC_TABLE}[xor(x % 256, y) + 1])) AS x FROM d),
             s AS MATERIALIZED (SELECT doc_id, size, xor(x, 4294967295) AS text_crc32, h FROM r),
             n AS MATERIALIZED (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a, CAST(ceil(count(*) / ceil(sqrt(count(*)))) AS BIGINT) AS b FROM s),
             o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1 AS row_no FROM s),
             f AS (SELECT row_no, row_no // b AS l, row_no % b AS r, 0 AS i FROM o, n
                   UNION ALL
                   SELECT row_no, CASE WHEN i % 2 = 0 THEN (l + CAST('0x' || substr(md5('7:' || i % 6 || ':' || r), 1, 12) AS BIGINT)) % a ELSE l END,
                   CASE WHEN i % 2 = 1 THEN (r + CAST('0x' || substr(md5('7:' || i % 6 || ':' || l), 1, 12) AS BIGINT)) % b ELSE r END, i + 1 FROM f, n WHERE i = 0 OR i % 6 <> 0 OR l * b + r >= n.n),
             p AS (SELECT row_no, l * b + r AS p FROM f, n WHERE i > 0 AND i % 6 = 0 AND l * b + r < n.n)
        SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % 16 AS INTEGER) AS shard, p // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM o JOIN p USING (row_no)""",
    "op8_substring_dedup": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
             n AS (SELECT doc_id, ws, unnest(range(1, CAST(len(ws) - 48 AS BIGINT))) AS i FROM w WHERE len(ws) >= 50),
             g AS MATERIALIZED (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS h FROM n),
             f AS (SELECT h, min(doc_id) AS first_id FROM g GROUP BY h),
             c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g JOIN f ON g.h = f.h WHERE first_id < doc_id),
             r AS (SELECT doc_id, list(j) AS js FROM c GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string(CASE WHEN js IS NULL THEN ws ELSE list_transform(list_filter(list_zip(ws, range(1, CAST(len(ws) + 1 AS BIGINT))), lambda x: NOT list_contains(js, x[2])), lambda x: x[1]) END, ' '), '')) AS kept_sha256
        FROM w LEFT JOIN r ON r.doc_id = w.doc_id""",
    "op10_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                   AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
             l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
                   WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
             r AS (SELECT vec_id AS n, vec_id AS m FROM embeddings UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.n)
        SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c.m AS component_id, vec_id = c.m AS kept
        FROM embeddings e JOIN (SELECT n, min(m) AS m FROM r GROUP BY n) c ON c.n = e.vec_id""",
}
