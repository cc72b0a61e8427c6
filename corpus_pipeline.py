"""From raw documents to shards: five stages over the ``documents`` table.

Each stage takes what its predecessor kept and returns the same columns; the
last returns the place of every document in the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, mixing, sharding, simhash
from strata.llm.common import materialized

#: The least score of a language, where there are too few labelled texts to set it from (see ``langid.threshold``).
MIN_LANGUAGE_SCORE = 0.1
SHARDS = 24
SHINGLE = 3  # words of a SimHash shingle; fingerprints at two or fewer differing bits are linked

# No stage can be said in SQL as a whole (see the README); tests hold each against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach; others go: foreign text, random
    letters, texts without letters."""
    return langid.keep_identified(docs, MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (``op5_simhash``'s shingles and bit distance): the one
    with the smallest id, null ids last, any one row of those that repeat it.

    Null, empty and blank texts have fingerprint 0 and form one group; an empty table stays empty; further
    columns, whatever their names, are kept.
    """
    return simhash.keep_one(docs, shingle=SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with passages of ``benchmark``."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{str(sf_dir).rstrip('/')}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One stream of all documents at smoothed source weights, in its order: sources that are smaller
    than their share occur as often as it takes."""
    nested = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("document"), "doc_id", "source")
    return mixing.in_stream_order(mixing.mix(nested)).select("document.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the stream; equal texts share a shard."""
    return sharding.shards(docs, SHARDS).select(F.col("id").alias("doc_id"), "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder before the next."""
    docs = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
