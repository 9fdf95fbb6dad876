"""The queries over the shared tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import anisotropic, katz, language, licenses, maxscore, mixing, quality, sentencepieces, simhash, toxicity
from waymark.llm.common import read

#: The vocabulary file that the SentencePiece operator is run with.
MODEL_NAME = "piece_bpe_32k.model"


def sentencepiece_model(name: str = MODEL_NAME) -> bytes:
    """A public tokenizer's file, read once on the driver and sent along with the work."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(documents(spark, sf_dir))


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the licence scan that SQL can say as well."""
    return op3_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", F.col("first_word").cast("double"), F.col("last_word").cast("double"), "base_labels")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anisotropic.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), read(spark, sf_dir, "labels", "doc_id", "quality"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(documents(spark, sf_dir), sentencepiece_model())


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_documents(documents(spark, sf_dir))


def op10_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.exact_top(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mixing, op2_toxicity, op3_license_scan, op4_nearest, op5_katz, op6_quality, op7_simhash, op8_sentencepiece, op9_language, op10_maxscore, license_base, pipeline)}

#: The others are trained, iterate to a fixed point, or use a hash or library that SQL lacks.
ORACLE_SQL = {
    "license_base": r"""
        WITH cut AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM documents),
        placed AS (
          SELECT doc_id, len(w) AS n,
            list_filter(range(len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
            list_filter(range(len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
            list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
          FROM cut)
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(mit) + len(apache) + len(gpl) AS BIGINT) AS n_base,
          CAST(list_min(mit || apache || gpl) AS DOUBLE) AS first_word, CAST(list_max(mit || apache || gpl) AS DOUBLE) AS last_word,
          concat_ws(',', CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(mit) > 0 THEN 'mit' END) AS base_labels
        FROM placed
    """,
    "op10_maxscore": """
        WITH whole AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
          WHERE q.vec_id % 20 = 0),
        ranked AS (
          SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}
