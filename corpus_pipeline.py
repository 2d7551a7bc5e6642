"""A training-corpus pipeline over `documents`: five stages, each of one operator of corvane.llm.

language_id    documents in no learned language go (no letter, or less than MIN_SCORE); a null lang takes the prediction
line_dedup     runs of lines that an earlier place has are removed from the text; n_chars follows
near_dedup     of each class of near-duplicates the first document stays
mix_sources    documents are repeated or left out so that sources come near their target weights
byte_bpe       ids of the text, and the digest of what they decode to

Every stage works on all rows that its predecessor kept and, but for the last, returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bpe, chunk_dedup, langid, mixing, near_dedup
from corvane.llm.common import P, documents, materialise, scratch, ship

MIN_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = langid.identify(docs, langid.fit(docs)).filter((F.col(f"{P}lang_pred") != langid.UND) & (F.col(f"{P}score") >= MIN_SCORE))
    return found.withColumn("lang", F.coalesce("lang", f"{P}lang_pred")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    done = chunk_dedup.deduplicate(docs)
    changed = F.col(f"{P}starts").isNotNull()
    return done.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.deduplicate(docs).filter(f"{P}stays").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.tokens(docs, bpe.vocabulary(), ["doc_id", "lang", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dups),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: Trained weights, signatures and merges are beyond SQL: tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # what the stage wrote besides goes when its result is there
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
