"""Keyword search by an index of trigrams.

Every name and description is cut into its runs of three characters, lower-cased. A keyword
can only be where all its own trigrams are, so a search reads the postings of its
rarest ones, looks at the few entries that have them all, and compares those literally.
Postings lie sorted by trigram, so that a search skips the rest of the files.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondar.model import CONTAINER_KEY
from sondar.operators.browse import search

GRAM = 3
#: Trigrams of a keyword that are looked up: the rarest say nearly as much as all.
LOOKED_UP = 3

_TEXTS = ["description", "native_description"]


def _grams(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    count = F.length(low) - (GRAM - 1)
    cut = F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.when(count > 0, cut).otherwise(F.array().cast("array<string>"))


def write_index(containers: DataFrame, columns: DataFrame, path: str) -> None:
    """Writes the index of an inventory below ``path``: ``entries``, ``postings`` and ``grams``.

    A trigram that a large part of all entries has is spread over as many files as any rows.
    """
    spark = containers.sparkSession
    kept = [*CONTAINER_KEY, *_TEXTS]
    nothing = F.lit(None).cast("string")
    both = containers.select(*kept, nothing.alias("column_name"), nothing.alias("native_type")).unionByName(
        columns.select(*kept, "column_name", "native_type"))
    both.withColumn("entry", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/entries")
    # From here on the numbers are those written.
    entries = spark.read.parquet(f"{path}/entries")
    names = F.coalesce("column_name", "container_name")
    grams = F.array_distinct(F.flatten(F.array(_grams(names), *[_grams(F.col(c)) for c in _TEXTS])))
    postings = entries.select(F.explode(grams).alias("gram"), "entry")
    postings.repartitionByRange("gram", "entry").sortWithinPartitions("gram", "entry").write.mode("overwrite").parquet(f"{path}/postings")
    counts = spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("entries"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/grams")


@dataclass(frozen=True)
class SearchIndex:
    """An index that ``write_index`` wrote."""

    spark: SparkSession
    path: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def candidates(self, keyword: str) -> DataFrame:
        """The entries that may hold the keyword; all where it is too short for a trigram."""
        word = keyword.strip().lower()
        entries = self._read("entries")
        wanted = sorted({word[i : i + GRAM] for i in range(len(word) - GRAM + 1)})
        if not wanted:
            return entries
        # A row for each trigram of the keyword at most.
        known = {
            row["gram"]: row["entries"]
            for row in self._read("grams").where(F.col("gram").isin(wanted)).collect()
        }
        if len(known) < len(wanted):
            return entries.where("false")
        rarest = sorted(known, key=lambda gram: (known[gram], gram))[:LOOKED_UP]
        met = (
            self._read("postings").where(F.col("gram").isin(rarest))
            .groupBy("entry").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") == len(rarest))
        )
        return entries.join(met.select("entry"), "entry", "left_semi")

    def search(self, keyword: str, **options: Any) -> DataFrame:
        """What ``browse.search`` finds, with its options, from the candidates only."""
        found = self.candidates(keyword)
        is_column = F.col("column_name").isNotNull()
        return search(found.where(~is_column), found.where(is_column), keyword, **options)
