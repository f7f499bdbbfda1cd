"""One query per operator of this subpackage, over its whole table, and the SQL that each must equal where SQL
can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crewlens.llm.compact_windows import repeated_passages
from crewlens.llm.crc_resampling import ORACLE_SQL as RESAMPLING_SQL
from crewlens.llm.crc_resampling import resample
from crewlens.llm.dense_ranking import ORACLE_SQL as RANKING_SQL
from crewlens.llm.dense_ranking import rank_documents
from crewlens.llm.html_blocks import extract_main_text
from crewlens.llm.interpolation import interpolated_scores
from crewlens.llm.jaccard_regions import jaccard_components
from crewlens.llm.line_bitmaps import ORACLE_SQL as LINE_SQL
from crewlens.llm.line_bitmaps import line_digest
from crewlens.llm.maxplus_encode import digest, encode
from crewlens.llm.packing import pack_documents
from crewlens.llm.quality_ratio import quality_by_ratio
from crewlens.llm.secret_markov import scan_secrets
from crewlens.llm.shared import ship
from crewlens.llm.topk_histogram import top_k
from crewlens.llm.toxicity_fm import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of every document."""
    return interpolated_scores(_table(spark, sf_dir, "documents"))


def op2_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op4_histogram_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors for every vector whose id is divisible by 20."""
    return top_k(_table(spark, sf_dir, "embeddings"))


def op5_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the quality verdict of every document."""
    return quality_by_ratio(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_maxplus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts, scores and checksums of every document, chunk by chunk, and of the text decoded again."""
    return digest(encode(_table(spark, sf_dir, "documents")))


def op7_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op8_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op9_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into windows of 1024 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share."""
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op11_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and what is left of it without those that an earlier document has."""
    return line_digest(_table(spark, sf_dir, "documents"))


def op12_dense_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and draw of every document, with the benchmark's texts as the target."""
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_factorization_machine": op2_factorization_machine,
    "op3_line_blocks": op3_line_blocks,
    "op4_histogram_selection": op4_histogram_selection,
    "op5_ngram_ratio": op5_ngram_ratio,
    "op6_maxplus_scan": op6_maxplus_scan,
    "op7_secret_markov": op7_secret_markov,
    "op8_jaccard_regions": op8_jaccard_regions,
    "op9_differencing": op9_differencing,
    "op10_compact_windows": op10_compact_windows,
    "op11_line_bitmaps": op11_line_bitmaps,
    "op12_dense_ranking": op12_dense_ranking,
    "op13_crc_resampling": op13_crc_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op11_line_bitmaps": LINE_SQL,
    "op12_dense_ranking": RANKING_SQL,
    "op13_crc_resampling": RESAMPLING_SQL,
    "op4_histogram_selection": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS cells FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.cells, c.cells)::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op8_jaccard_regions": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
            FROM texts
        ), sizes AS (SELECT doc_id, len(shingles)::BIGINT AS n_shingles FROM sets
        ), held AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets
        ), shared AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM held a JOIN held b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)
        ), reached AS (
            SELECT doc_id, doc_id AS label FROM sizes
            UNION
            SELECT l.b, r.label FROM reached r JOIN links l ON l.a = r.doc_id
        )
        SELECT doc_id, any_value(n_shingles) AS n_shingles, min(label) AS component_id FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
}
