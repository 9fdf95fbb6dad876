"""A training-data pipeline over ``documents``, made of operators of ``waymark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``; extra columns, whatever their names, pass through those.
Whole texts count at every stage, however long; an empty table gives an empty one.
A stage's table is deleted once the next one's is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import mixing, nearcopies, quality, sentencepieces, toxicity
from waymark.llm.common import delete, fresh, read, shared_dir
from waymark.llm.queries import sentencepiece_model


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go: those that score below 0.7.

    Null and empty texts go or stay by the score of an empty text; repeated rows go or stay together.
    """
    name = fresh("score", docs.columns)
    return quality.with_scores(docs, read(spark, sf_dir, "labels", "doc_id", "quality"), name=name).where(F.col(name) >= 0.7).drop(name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go: those that score 0.3 or more.

    Null and empty texts go or stay by the score of a text without savings; repeated rows go or stay together.
    """
    name = fresh("score", docs.columns)
    return toxicity.with_scores(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"), name=name).where(F.col(name) < 0.3).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their five-word shingles one stays, that of the smallest id.

    SimHash balls and bands of minimum hashes propose the pairs; every one is compared exactly before it links.
    Null texts and texts without words are copies of each other; of rows that repeat an id and a text one stays; rows without an id stay.
    """
    return nearcopies.deduplicated(docs, shingle=5, least=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those without words have nothing to take, and go or stay by their place in the order alone."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and the spans of original bytes behind them; one row per document of the mix."""
    return sentencepieces.encode_documents(docs, sentencepiece_model(), spans=True).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: The stages are trained or use libraries and hashes that SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/waymark/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            delete(spark, [last])
        last = path
    return docs
