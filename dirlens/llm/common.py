"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space, the only separators between words here.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back (a lineage cut
    that keeps column pruning and compression)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(text: Column) -> Column:
    """The text with A-Z, and only those, in lower case; null gives the empty text.

    Texts of ASCII alone (as many bytes as characters) take the fast ``lower``."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(t) == F.char_length(t), F.lower(t))
            .otherwise(F.translate(t, string.ascii_uppercase, string.ascii_lowercase)))


def n_words(text: Column) -> Column:
    """Words (runs of anything but ASCII white space) in the whole text; 0 for null."""
    # words stand between single spaces; no array of strings is built for a text
    t = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))
    return (F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))) + (t != "").cast("int")).cast("long")


def carried(docs: DataFrame, *more: Column) -> DataFrame:
    """Columns ``own``, one struct of all the columns that ``docs`` came with, and ``more``. Whatever names the own
    columns have, none can clash with a derived one; ``own_columns`` takes them out again."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), *more)


def own_columns(rows: DataFrame) -> DataFrame:
    return rows.select("own.*")
