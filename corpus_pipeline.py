"""A corpus pipeline: documents in, packed sequences out.

Toxic and poor documents go, one of each group of near-duplicates stays, passages
that several documents share are cut out, and what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.llm import packing, rules, simhash, suffixes, toxicity
from sondar.llm.common import fresh, staged
from sondar.llm.ship import ship


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score at least 0.3 for toxicity."""
    ship(spark)
    return toxicity.clean(docs, _labels(spark, sf_dir))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score below 0.3 for quality."""
    ship(spark)
    return rules.good(docs, _labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    ship(spark)
    return simhash.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the strings of 200 bytes that occur again anywhere.

    Characters that a string cuts through go as a whole; a text may end up empty.
    """
    ship(spark)
    cut = suffixes.remove_repeats(docs, whole_characters=True)
    text = F.decode(fresh(docs, "kept"), "UTF-8")
    return cut.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids as pieces of sequences of 2048."""
    ship(spark)
    # Workers are shared with the other stages, so little is remembered here.
    return packing.pack_texts(
        docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False, together=8 << 20, remembered=200_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]

# Trained models, hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
