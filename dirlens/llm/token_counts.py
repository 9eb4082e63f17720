"""Token counts from an exact length histogram.

Every whole text is encoded once, in Arrow batches, and only its length in tokens is kept. Spark
aggregates documents by length; suffix sums over the histogram then answer, for any context limit L,
how many documents reach it, how many tokens remain when every document is truncated at L
(sum of min(length, L)), and any quantile of the lengths, exactly. Sums run within ranges of
``STEP`` lengths and then over the ranges, so no task holds the whole histogram.

Defined results: null and empty texts have 0 tokens and count as documents of length 0. Special
tokens' strings are ordinary text. Empty input gives an empty histogram, totals of 0 and no quantiles.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut, ship_package

#: The vocabulary file; every executor reads it by this path.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how this vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STEP = 1024


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY, pattern: str = PATTERN):
    """The tokenizer, loaded once in each Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("pipeline", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_length(text: Column, path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    def run(column: pa.Array) -> pa.Array:
        encode = encoder(path, pattern).encode_ordinary
        return pa.array([len(encode(t)) if (t := x.as_py()) else 0 for x in column], pa.int64())
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "long")(text)


def histogram(docs: DataFrame, text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """n_tokens, n_docs: one row per length that occurs."""
    ship_package(docs.sparkSession)
    return (docs.select(token_length(F.col(text_col), path, pattern).alias("n_tokens"))
            .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """Per length L: n_docs, docs_ge, tokens_ge (documents of at least L tokens, and their tokens),
    docs_le, truncated (sum of min(length, L))."""
    h = cut(hist.withColumn("range", F.expr(f"n_tokens div {STEP}")).withColumn("tokens", F.col("n_tokens") * F.col("n_docs")))
    over = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (h.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
              .select("range", F.coalesce(F.sum("d").over(over), F.lit(0)).alias("docs_over"),
                      F.coalesce(F.sum("t").over(over), F.lit(0)).alias("tokens_over")))
    total = h.agg(F.struct(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("all"))).scalar()
    inside = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (h.withColumns({"d": F.sum("n_docs").over(inside), "t": F.sum("tokens").over(inside)})
         .join(ranges, "range").withColumn("total", total)
         .withColumns({"docs_ge": F.col("d") + F.col("docs_over"), "tokens_ge": F.col("t") + F.col("tokens_over")}))
    return s.select("n_tokens", "n_docs", "docs_ge", "tokens_ge",
                    (F.col("total.docs") - F.col("docs_ge") + F.col("n_docs")).alias("docs_le"),
                    (F.col("total.all") - F.col("tokens_ge") + F.col("n_tokens") * F.col("docs_ge")).alias("truncated"))


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, docs_truncated (longer than it), tokens (total after truncation), for any limits."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "limit long")
    # the next length at or above the limit has all that is needed
    whole = sums.agg(F.coalesce(F.max(F.struct("n_tokens", "truncated"))["truncated"], F.lit(0))).scalar()
    above = (sums.join(F.broadcast(asked), F.col("n_tokens") >= F.col("limit")).groupBy("limit")
             .agg(F.min(F.struct("n_tokens", "n_docs", "docs_ge", "truncated")).alias("x")))
    return (asked.join(above, "limit", "left").withColumn("whole", whole)
            .select("limit", F.when(F.col("x.n_tokens") == F.col("limit"), F.col("x.docs_ge") - F.col("x.n_docs"))
                    .otherwise(F.coalesce("x.docs_ge", F.lit(0))).alias("docs_truncated"),
                    F.coalesce(F.col("x.truncated") - (F.col("x.n_tokens") - F.col("limit")) * F.col("x.docs_ge"),
                               F.col("whole")).alias("tokens")))


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, n_tokens: the smallest length that at least this share of the documents do not exceed."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(float(x),) for x in shares], "share double")
    return (sums.withColumn("docs", sums.agg(F.sum("n_docs")).scalar())
            .join(F.broadcast(asked), F.col("docs_le") >= F.col("share") * F.col("docs"))
            .groupBy("share").agg(F.min("n_tokens").alias("n_tokens")))
