"""A corpus made ready for training: good documents only, one of each group of near duplicates, no personal data, packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmetrics.llm import jaccard, packing, pii, quality
from fleetmetrics.llm.shared import materialise, ship, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones among them, does not reject.

    Null texts are scored as empty ones. Repeated rows are scored alike; rows without an id are never fitted on. Without
    labels every score is 0.5, below the threshold, and nothing is kept; no documents give none. Other columns stay.
    """
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of the smallest id.

    Of repeated rows one stays, of several texts of an id each that is no other's copy. Null and empty texts are copies
    of each other, texts of fewer than five words of those of the same words. Rows without an id stay. Other columns stay.
    """
    ship(spark)
    return jaccard.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, disguised or not, replaced by their kinds; n_chars follows the text.

    Every row stays, repeated ones and those without an id too; null stays null, empty stays empty. Other columns stay.
    """
    ship(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048.

    A null or empty text has one token, the end's. Every row is packed, repeated ones and those without an id too; no
    rows give no pieces. Only the pieces' columns are returned.
    """
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("near_duplicates", one_of_near_duplicates), ("pii", without_personal_data), ("packing", packed)]

#: Rules learned from data, connected components and tokenizers are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read back before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
