"""Documents to token files: five stages, each on what the one before kept.

``run`` writes the result of every stage as Parquet in the shared folder and reads it
again for the next, so a lost executor repeats part of one stage at most.

Stages: documents that the quality classifier rejects go; of near duplicates one stays;
documents that hold a benchmark passage go; sources are mixed to their target weights,
where a document may come up to three times; what is left is written as token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import decontaminate, mil, mixing, neardup, tokens
from rosterlake.llm.common import Scratch, crc_mod, table
from rosterlake.llm.queries import settings, tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold.

    The labels of one document in five are not learned from, as in the query of the
    operator, so the stage can be measured on them. The model learns from the documents
    the stage is given.
    """
    settings(spark)
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = mil.train(docs, table(spark, sf_dir, "labels"), held_out)
    return mil.select_documents(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    settings(spark)
    return neardup.distinct_documents(docs, Scratch(spark, "stage-neardup"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    settings(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "stage-leaks"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    settings(spark)
    return mixing.mixed(docs, Scratch(spark, "stage-mix"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the token files: id, start, number of ids and their checksum."""
    settings(spark)
    return tokens.round_trip(docs, Scratch(spark, "stage-tokens"), tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", token_files),
]

# A trained classifier and a tokenizer are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES, 1):
        following = scratch.save(stage(spark, docs, sf_dir), f"stage{number}")
        if number > 1:
            scratch.drop(docs)
        docs = following
    return docs
