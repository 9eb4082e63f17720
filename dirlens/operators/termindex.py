"""Inverted term index (N3, N4): a postings table in buckets of terms, sorted by term.

``write_index`` writes two tables below its path: ``postings(term, key)`` and ``terms(term, n)``, both in folders by
the term's hash bucket and sorted by term, so a search opens the asked terms' folders alone and, inside them,
skips row groups by the terms' bounds. A frequent term's postings are written by several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
SPLITS = 8


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(df: DataFrame, path: str, key: str, terms: Column, buckets: int = BUCKETS, splits: int = SPLITS) -> None:
    """Index the terms (an array column; nulls and repeats in it do not count) of every row under its ``key``."""
    post = (df.select(F.col(key).alias("key"), F.explode(F.array_distinct(terms)).alias("term"))
            .where(F.col("term").isNotNull()).withColumn("bucket", _bucket(F.col("term"), buckets)))
    (post.repartition("bucket", F.pmod(F.xxhash64("key"), F.lit(splits))).sortWithinPartitions("bucket", "term", "key")
     .write.partitionBy("bucket").parquet(f"{path}/postings"))
    written = df.sparkSession.read.parquet(f"{path}/postings")
    (written.groupBy("bucket", "term").agg(F.count_distinct("key").alias("n")).repartition("bucket")
     .sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms"))


class TermIndex:
    """Searches of one written index. Results are the distinct keys, column ``key``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.postings, self.terms = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms")

    def _of(self, table: DataFrame, asked: Sequence[str]) -> DataFrame:
        """The asked terms' rows. Their buckets are literals, so the other folders are pruned."""
        rows = self.spark.range(1).select(F.array(*[_bucket(F.lit(t), self.buckets) for t in asked]).alias("b")).first()
        return table.where(F.col("bucket").isin(*sorted(set(rows["b"]))) & F.col("term").isin(*asked))

    def find_any(self, asked: Sequence[str]) -> DataFrame:
        """Keys of the rows that hold at least one of the terms."""
        asked = sorted(set(asked))
        if not asked:
            return self.postings.select("key").limit(0)
        return self._of(self.postings, asked).select("key").distinct()

    def find_all(self, asked: Sequence[str]) -> DataFrame:
        """Keys of the rows that hold every term: the rarest term's postings, cut down by the next rarer ones. No
        terms at all find nothing."""
        asked = sorted(set(asked))
        known = {r["term"]: r["n"] for r in self._of(self.terms, asked).select("term", "n").collect()} if asked else {}
        if not asked or len(known) < len(asked):
            return self.postings.select("key").limit(0)
        order = sorted(asked, key=lambda t: (known[t], t))
        found = self._of(self.postings, order[:1]).select("key").distinct()
        for t in order[1:]:
            found = found.join(self._of(self.postings, [t]).select("key"), "key", "left_semi")
        return found
