"""A training corpus from ``documents``: quality, language, one document per
near-duplicate group, source mix, packed sequences.

``run(spark, sf_dir)`` applies STAGES in order; each stage's result is
written to the shared checkpoint folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm import jaccard, mixing, packing, ppm, queries, quality
from ticksmith.llm.common import materialise, read

LANGUAGE_KEEP = 0.5      # least posterior of the predicted language
NEAR_WORDS, NEAR_PERCENT = 5, 80     # shingle size and least Jaccard of near duplicates (op6 has its own)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line-quality score reaches the query's threshold."""
    score = quality.scorer(spark, queries.quality_model(spark, docs, sf_dir))
    return docs.where(score(F.col("text").cast("binary")) >= queries.QUALITY_KEEP)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language: one is likelier than the others,
    and the text is coded about as well as that language's texts are."""
    found = ppm.predictor(spark, queries.language_model(docs))(F.col("text"))
    return docs.where((found["lang_pred"] != "und") & (found["score"] >= LANGUAGE_KEEP) & found["fits"])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return jaccard.keep_one(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source mix takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, queries.tokenizer_file())


STAGES = [("quality", by_quality), ("language", by_language), ("near_duplicates", one_of_each), ("mix", mixed), ("packing", packed)]

ORACLE_SQL = None        # models, sampling and tokenising are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
