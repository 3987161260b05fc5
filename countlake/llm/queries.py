"""The operators over their whole tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlake.llm import (
    byte_bpe,
    decontamination,
    exact_dedup,
    mixing,
    near_dedup,
    quality,
    substring_dedup,
    target_resampling,
    token_store,
    url_filter,
    vector_clusters,
    vector_search,
    warc_archive,
)
from countlake.llm.common import read_table
from countlake.session import shared_dir


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc_archive.write(read_table(spark, sf_dir, "pages"), path)
    return warc_archive.read(spark, path).select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn(
        "predicted", (F.col("score") >= quality.GOOD).cast("int")
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "tokens")
    token_store.write(
        read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    rows = token_store.checksums(token_store.read(spark, path))
    return rows.withColumnRenamed("key", "doc_id")


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(read_table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("placements")).alias("taken"),
    )


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    ).select("doc_id", "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op13_vector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_clusters.cluster(read_table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_warc_archive": op2_warc_archive,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_token_store": op8_token_store,
    "op9_vector_search": op9_vector_search,
    "op10_mixing": op10_mixing,
    "op11_target_resampling": op11_target_resampling,
    "op12_decontamination": op12_decontamination,
    "op13_vector_clusters": op13_vector_clusters,
}

def _kmeans_sql(rounds: int, centroids: int) -> str:
    """The rounds of the clustering, one after the other."""
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept
                  ORDER BY h, v LIMIT {centroids}))"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
            SELECT r, arg_min(c, d * {centroids} + c) AS c, min(d) AS d
            FROM (SELECT r, c, list_sum(list_transform(range(1, 65), lambda i:
                         (kept.v[i] - c{i}.v[i]) * (kept.v[i] - c{i}.v[i])))::BIGINT AS d FROM kept, c{i})
            GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""n{i} AS (
            SELECT c, list(m ORDER BY i) AS v
            FROM (SELECT c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m
                  FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i} JOIN kept USING (r))
                  GROUP BY c, i)
            GROUP BY c),
        c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN n{i} USING (c))"""
            )
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, c::INTEGER AS cluster, d AS distance,
               (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (c)
    """


#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda w: w <> '') AS words
            FROM documents),
        windows AS (
            SELECT r, s, md5(array_to_string(words[s:s + 34], ' ')) AS h
            FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS s FROM d WHERE len(words) > 34)),
        twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
        starts AS (SELECT r, s FROM windows WHERE h IN (FROM twice)),
        places AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
        judged AS (
            SELECT places.r, p, word,
                   coalesce(max(s) OVER (PARTITION BY places.r ORDER BY p
                                         ROWS UNBOUNDED PRECEDING) > p - 35, false) AS gone
            FROM places LEFT JOIN starts ON places.r = starts.r AND p = s)
        SELECT doc_id, len(any_value(words)) AS n_words,
               count(*) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
        FROM d LEFT JOIN judged ON d.r = judged.r
        GROUP BY d.r, doc_id
    """,
    "op2_warc_archive": """
        WITH t AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        u AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS newest FROM t)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < newest
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < newest
                    THEN newest END AS refers_to
        FROM u
    """,
    "op4_near_dedup": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents),
        shingles AS (
            SELECT DISTINCT r, md5(array_to_string(words[s:s + 4], ' ')) AS h
            FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 3, 2))) AS s
                  FROM d WHERE len(words) > 0)),
        sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
        met AS (
            SELECT a.r AS a, b.r AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.h = b.h AND a.r <> b.r GROUP BY ALL),
        links AS (
            SELECT a, b FROM met JOIN sizes x ON a = x.r JOIN sizes y ON b = y.r
            WHERE 100 * met.n >= 75 * (x.n + y.n - met.n)),
        reached AS (
            SELECT r, r AS t FROM d
            UNION
            SELECT reached.r, b FROM reached JOIN links ON a = t),
        named AS (
            SELECT reached.r, min(doc_id) AS component_id
            FROM reached JOIN d ON d.r = t GROUP BY reached.r)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d JOIN named ON d.r = named.r LEFT JOIN sizes ON d.r = sizes.r
    """,
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY digest) AS group_size,
               row_number() OVER w = 1 AS kept,
               digest AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY digest ORDER BY chars DESC, doc_id)
    """,
    "op11_target_resampling": r"""
        WITH steps AS (
            SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS step),
        cut AS MATERIALIZED (
            SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, text FROM documents
            UNION ALL SELECT 'b', item_id, 0, text FROM benchmark),
        words AS (
            SELECT kind, id, r, unnest(list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word
            FROM cut),
        bytes AS (
            SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
        hashed AS (
            SELECT word, xor(list_reduce(
                list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM bytes, steps),
        counts AS (
            SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
            FROM words JOIN hashed USING (word) GROUP BY bucket),
        gained AS (
            SELECT bucket, floor(1000 * ln(
                ((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
                / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM counts),
        weighed AS (
            SELECT r, count(*) AS n, floor(avg(gain))::BIGINT AS weight
            FROM words JOIN hashed USING (word) JOIN gained USING (bucket)
            WHERE kind = 'd' GROUP BY r),
        scored AS (
            SELECT id AS doc_id, cut.r, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296::DOUBLE)))::BIGINT AS score
            FROM cut LEFT JOIN weighed USING (r) WHERE kind = 'd'),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20
                                         ORDER BY score DESC, doc_id NULLS FIRST) AS place
            FROM scored)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= 20
                     AND place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20)
                    THEN place END AS rank
        FROM placed
    """,
    "op12_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
            FROM documents),
        b AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item, m, array_to_string(words[s:s + m - 1], ' ') AS phrase
            FROM (SELECT item, words, least(len(words), 10) AS m,
                         unnest(range(1, len(words) - least(len(words), 10) + 2)) AS s
                  FROM b WHERE len(words) > 0)),
        starts AS (
            SELECT r, s, m, array_to_string(words[s:s + m - 1], ' ') AS phrase
            FROM (SELECT r, words, m, unnest(range(1, len(words) - m + 2)) AS s
                  FROM d, (SELECT DISTINCT m FROM windows) WHERE len(words) >= m)),
        met AS (SELECT r, s, m, item FROM starts JOIN windows USING (m, phrase)),
        covered AS (
            SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT r, s, m FROM met)) GROUP BY r),
        items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
    """,
    "op13_vector_clusters": _kmeans_sql(rounds=5, centroids=40),
}
