"""Exact duplicates by skew-safe combining, in DataFrame functions alone.

1. *Locally*: rows are grouped by (digest, salt, whole normalised text); Spark's partial
   aggregation folds a task's copies into one row before anything is shuffled.
2. *Salted groups*: the partial rows of one (digest, salt) meet in one task. The salt spreads a
   text that a third of the rows share over ``salts`` tasks.
3. *Globally*: at most ``salts`` winners a text are left and are combined by (digest, text).

The text itself is a grouping key at every stage, so rows whose digests collide stay apart. The
decision then goes back to the rows by narrow keys: digest, a second hash and the length.

Defined results: a null text counts as empty, and all empty texts are equal. Of equal texts the
largest doc_id stays; null ids lose to any other, and stay only where the whole group has null
ids. A row repeated with the same id and text is the same document: its copies all show
``kept`` (``drop_duplicates`` leaves one of them). A very long text is hashed and compared whole. Other
columns, whatever their names, stay as they came. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import carried, fold, own_columns

SALTS = 16


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    norm = fold(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
            .select("doc_id", "norm", digest(F.col("norm")).alias("digest"),
                    F.xxhash64("norm").alias("check"), F.octet_length("norm").alias("bytes")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row per distinct normalised text: digest, check, bytes, keep_id, group_size."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    salted = (_keyed(docs, id_col, text_col, digest)
              .groupBy("digest", salt.alias("salt"), "norm", "check", "bytes")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    return (salted.groupBy("digest", "norm", "check", "bytes")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")).drop("norm"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (the digest)."""
    rows = _keyed(docs, id_col, text_col, digest).drop("norm")
    won = winners(docs, id_col, text_col, salts, digest)
    return (rows.join(won, ["digest", "check", "bytes"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    salts: int = SALTS) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    # one key for the join and for the window, so the texts move once
    def key(digest, check, doc_id):
        return F.concat_ws("|", digest, check.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    won = winners(docs, id_col, text_col, salts).select(
        key(F.col("digest"), F.col("check"), F.col("keep_id")).alias("key"))
    norm = fold(F.col(text_col))
    rows = carried(docs, key(F.sha2(norm, 256), F.xxhash64(norm), F.col(id_col)).alias("key"))
    # a row repeated whole is one document
    one = Window.partitionBy("key").orderBy(F.col("own").getField(text_col).desc_nulls_last())
    stay = rows.join(won, "key", "left_semi").withColumn("place", F.row_number().over(one)).where("place = 1")
    return own_columns(stay)
