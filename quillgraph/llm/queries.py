"""The operators over their whole tables, with production parameters, and the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_dedup import exact_duplicates
from .hard_negatives import hard_negatives
from .jaccard_join import jaccard_components
from .minhash import near_duplicates
from .packing import pack_documents
from .quality import classify_quality
from .spelling import spelling_variants
from .suffix_dedup import repeated_strings
from .sentencepiece_fst import encode_texts
from .substring_dedup import repeated_passages
from .token_counts import context_limits, encoded_lengths, length_histogram
from .vptree import nearest_vectors
from .warc import derive_records, response_records


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_records(response_records(table(spark, sf_dir, "pages")))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(length_histogram(encoded_lengths(table(spark, sf_dir, "documents"))))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), shingle=4, percent=85)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=5, percent=85)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_quality": op6_quality,
    "op7_pack": op7_pack,
    "op8_token_counts": op8_token_counts,
    "op9_nearest": op9_nearest,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_spelling": op12_spelling,
    "op13_minhash": op13_minhash,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"


def _components_sql(shingle: int, percent: int) -> str:
    return rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents
    ), w AS (
        SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p, len(ws) AS n FROM d WHERE len(ws) > 0
    ), g AS (
        SELECT doc_id, p, n, string_agg(word, ' ') OVER (
            PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {shingle - 1} FOLLOWING) AS shingle
        FROM w
    ), s AS (SELECT DISTINCT doc_id, shingle FROM g WHERE p = 0 OR p + {shingle} <= n),
    z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
        FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ), e AS (
        SELECT x, y FROM o JOIN z a ON a.doc_id = x JOIN z b ON b.doc_id = y
        WHERE 100 * common >= {percent} * (a.n + b.n - common)
    ), r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
    SELECT d.doc_id, coalesce(max(z.n), 0) AS n_shingles, min(r.y) AS component_id
    FROM d JOIN r ON r.x = d.doc_id LEFT JOIN z ON z.doc_id = d.doc_id GROUP BY d.doc_id
    """


ORACLE = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM d WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op5_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
        w AS (
            SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p, len(ws) AS n FROM d WHERE len(ws) > 0
        ), s AS (
            SELECT *, CASE WHEN p + 13 <= n THEN string_agg(word, ' ') OVER (
                PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS passage
            FROM w
        ), f AS (
            SELECT *, passage IS NOT NULL AND min(doc_id) OVER (PARTITION BY passage) < doc_id AS later FROM s
        ), c AS (
            SELECT *, bool_or(later) OVER (
                PARTITION BY doc_id ORDER BY p ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
            FROM f
        ), k AS (
            SELECT doc_id, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
                   coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone), '') AS kept
            FROM c GROUP BY doc_id
        )
        SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op10_jaccard_join": _components_sql(4, 85),
    "op13_minhash": f"SELECT *, doc_id = component_id AS kept FROM ({_components_sql(5, 85)})",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.x, c.x)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.x) = len(c.x) WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op12_spelling": r"""
        WITH RECURSIVE bits AS (
            SELECT list_transform(range(256), lambda i: list_reduce(
                [i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
        ), r AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
            WHERE len(run) >= 6 GROUP BY ALL
        ), b AS (
            SELECT *, hex(encode(doc_id || ':' || run)) AS code FROM r
        ), h AS (
            SELECT run, n, xor(list_reduce(
                [4294967295] || list_transform(range(1, len(code), 2), lambda i: ('0x' || substring(code, i, 2))::BIGINT),
                lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS h
            FROM b, bits
        ), e AS (
            SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % len(run)) || substring(run, h % len(run) + 2) ELSE run END AS word, n
            FROM h
        ), w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        d AS (
            SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS less
            FROM (SELECT word, n, unnest(range(len(word))) AS i FROM w)
        ), p AS (
            SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
            UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.less = w.word
            UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.less = w.word
        ), f AS (
            SELECT w.word, w.n, count(near) AS n_near, max(p.n) AS most, arg_min(near, (-p.n, encode(near))) AS best
            FROM w LEFT JOIN p ON p.word = w.word GROUP BY w.word, w.n
        ), g AS (
            SELECT word, n, n_near, CASE WHEN most >= 5 * n THEN best END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM f
        ), t AS (
            SELECT word, word AS here, 0 AS steps FROM g
            UNION ALL SELECT t.word, g.form, steps + 1 FROM t JOIN g ON g.word = t.here WHERE g.form IS NOT NULL
        )
        SELECT g.word, form, root, n, n_near, form_n
        FROM g JOIN (SELECT word, arg_max(here, steps) AS root FROM t GROUP BY word) USING (word)
    """,
    "op9_nearest": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
                AND len(list_filter(embedding, lambda e: e <> 0)) > 0
        ), p AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.x, c.x) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
        ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
