"""One query per operator, over whole tables, with SQL where SQL can express the rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trapiche.llm.centroids import cluster_vectors
from trapiche.llm.common import on_executors
from trapiche.llm.decontaminate import find_leaks
from trapiche.llm.exact_dedup import exact_dedup
from trapiche.llm.hard_negatives import mine_negatives
from trapiche.llm.jaccard_join import jaccard_groups
from trapiche.llm.language import identify_languages
from trapiche.llm.licenses import scan_licenses
from trapiche.llm.packing import pack_documents
from trapiche.llm.page_text import extract_main_text
from trapiche.llm.simhash import simhash_groups
from trapiche.llm.substring import drop_repeated_windows
from trapiche.llm.toxicity import score_toxicity, train_chain
from trapiche.llm.url_rules import judge_urls, rule

# The written rules of the URL contract.
URL_RULES = (
    rule("allow", "com/"),
    rule("block", "example.com/en/"),
    rule("allow", "www.example.com/en/"),
    rule("block", "net/es/"),
    rule("block", "net/fr/"),
)
# Categories of the label table, in chain order.
TOXIC_CHAIN = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_windows(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select("doc_id", "fingerprint", "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's path is its source, its language and its id."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = scan_licenses(docs, F.concat_ws("/", "source", "lang", "doc_id"))
    return found.select("doc_id", "license", "score", "origin", "license_dir")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the probabilities of the chain, and whether it is flagged as toxic."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train_chain(docs, _table(spark, sf_dir, "labels"), TOXIC_CHAIN)
    found = score_toxicity(docs, chain, categories=tuple(TOXIC_CHAIN))
    return found.select("doc_id", "p_low_quality", "p_toxic", "flagged")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_groups(docs).select("doc_id", "n_shingles", "component_id")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one, as the contract says."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(_table(spark, sf_dir, "embeddings"))
    return found.drop("evaluations")


_OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_url_filters": op7_url_filters,
    "op8_license_scans": op8_license_scans,
    "op9_toxicity": op9_toxicity,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_ngram_jaccard_join": op11_ngram_jaccard_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_centroid_clustering": op13_centroid_clustering,
}

QUERIES = {name: on_executors(query) for name, query in _OPERATORS.items()}


def _centroid_sql(rounds: int = 3) -> str:
    """Start, assign and move, written out round by round; products of whole numbers are exact
    in doubles at these sizes."""

    def assigned(number: int) -> str:
        return f"""paired{number} AS (
            SELECT k.vec_id, k.q, c.cluster, CAST(
                list_inner_product(k.q, k.q) - 2 * list_inner_product(k.q, c.q)
                + list_inner_product(c.q, c.q) AS BIGINT
            ) AS distance
            FROM kept k CROSS JOIN centre{number} c
        ), own{number} AS (
            SELECT vec_id, q, cluster, distance FROM paired{number}
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1
        )"""

    def moved(number: int) -> str:
        return f"""mean{number} AS (
            SELECT cluster, list(CAST(floor(total / size) AS DOUBLE) ORDER BY place) AS q
            FROM (
                SELECT cluster, place, CAST(sum(x) AS DOUBLE) AS total, count(*) AS size
                FROM (
                    SELECT cluster, unnest(q) AS x, unnest(range(64)) AS place FROM own{number - 1}
                ) GROUP BY cluster, place
            ) GROUP BY cluster
        ), centre{number} AS (
            SELECT cluster, coalesce(m.q, c.q) AS q
            FROM centre{number - 1} c LEFT JOIN mean{number} m USING (cluster)
        )"""

    steps = [assigned(0)]
    for number in range(1, rounds + 1):
        steps += [moved(number), assigned(number)]
    return f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE len(embedding) = 64
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), centre0 AS (
            SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER)
                AS cluster, q
            FROM kept QUALIFY cluster < 16
        ), {", ".join(steps)}
        SELECT vec_id, cluster, distance,
            CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
            CAST(sum(distance) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(list_transform(c.q, lambda x: CAST(x AS BIGINT)), ','))
                AS centroid_sha256
        FROM own{rounds} o JOIN centre{rounds} c USING (cluster)
    """


_SINGLE_SPACED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

# A word goes if one of the windows that cover it starts in a document with a smaller id.
ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH worded AS (
            SELECT doc_id, list_filter(
                string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''
            ) AS words
            FROM documents
        ), placed AS (
            SELECT doc_id, unnest(range(1, len(words) - 48)) AS first, words FROM worded
        ), windows AS (
            SELECT doc_id, first, array_to_string(words[first:first + 49], ' ') AS body FROM placed
        ), least AS (
            SELECT body, min(doc_id) AS min_id FROM windows GROUP BY body
            HAVING min(doc_id) < max(doc_id)
        ), hit AS (
            SELECT doc_id, first FROM windows JOIN least USING (body) WHERE doc_id > min_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(first, first + 50)) AS place FROM hit
        ), lists AS (
            SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
        ), kept AS (
            SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
                CASE WHEN places IS NULL THEN words ELSE list_filter(
                    words, lambda w, i: NOT list_contains(places, i)
                ) END AS left_over
            FROM worded LEFT JOIN lists USING (doc_id)
        )
        SELECT doc_id, n_words, n_removed,
            sha256(array_to_string(left_over, ' ')) AS kept_sha256
        FROM kept
    """,
    "op10_exact_dedup": f"""
        WITH digested AS (
            SELECT doc_id, {_SINGLE_SPACED} AS body, sha256({_SINGLE_SPACED}) AS text_sha256
            FROM documents
        ), grouped AS (
            SELECT body, min(doc_id) AS keep_id, count(*) AS group_size
            FROM digested GROUP BY body
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM digested JOIN grouped USING (body)
    """,
    "op11_ngram_jaccard_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
            ), lambda x: x <> '') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
                range(1, greatest(len(words) - 2, 2)),
                lambda i: array_to_string(words[i:i + 3], ' ')
            )) END AS shingles
            FROM worded
        ), elements AS (
            SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM elements a JOIN elements b
                ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
                AND 100 * b.size >= 85 * a.size AND 100 * a.size >= 85 * b.size
            GROUP BY a.doc_id, b.doc_id, a.size, b.size
            HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id
        FROM sets JOIN least USING (doc_id)
    """,
    "op12_hard_negatives": """
        WITH kept AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored
            WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER (
                PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id
            ) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score
            AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3
    """,
    "op13_centroid_clustering": _centroid_sql(),
}
