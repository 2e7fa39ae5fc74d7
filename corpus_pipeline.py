"""Documents to token ids in five stages."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequill.llm import exact_dedup, mixing, sentencepiece, simhash, toxicity
from pagequill.llm.shared import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shares of tokens wanted of good and poor documents. No document is dropped for them: rates
#: are 1 or more, and a document of a scarce domain is repeated.
TARGETS = {"good": 0.85, "poor": 0.15}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the model's threshold for toxicity, which its labelled rows set.

    A document without text scores as an empty one. Rows that repeat a text stay or go together.
    """
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=None)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of 3-word shingles that differ in 3 bits or fewer.

    That is the one with the smallest id, a null id counting as the last. Null and empty texts are one group.
    """
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights says, each at least once."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("coalesce(toxic, 0) = 0")
    return mixing.mixed(docs, mixing.domains_of(labels), TARGETS, floor=1.0, budget=None)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every document the mix returned, repeated ones repeated."""
    tokens = sentencepiece.encoded(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.select("doc_id", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]
#: The scores of the first stage, the fingerprints of the third and the segmentation of the last
#: are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what one returns is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
