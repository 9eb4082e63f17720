"""Deletes that cascade, on partitioned Parquet tables, by copy on write.

Rows whose parent is gone are removed by rewriting the partitions that hold such rows, and no others: one anti join over
the key and the partition columns finds these partitions, their survivors are written beside the table (checkpoint
folder) and then replace them by dynamic partition overwrite. A partition without survivors is left as an empty one.

The list of touched partitions goes through the driver, as the table's own file listing does; rows never do. A run that
stops half-way leaves whole partitions, old or new, and the next run deletes what still has no parent.

Defined results: a null key refers to nothing and stays. Repeated parents count once. No parents: only rows with
null keys stay. A table without orphans is not written to. Partitions are known by their columns, null values included.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

ROWS_PER_FILE = 1_000_000


def _parents(parents: DataFrame, key: str) -> DataFrame:
    return parents.select(F.col(key).alias("__parent")).where(F.col("__parent").isNotNull()).distinct()


def _one_of(rows: list, by: list[str]) -> Column:
    """The condition that a row lies in one of these partitions, as literals, so that others are not listed."""
    if len(by) == 1 and all(r[by[0]] is not None for r in rows):
        return F.col(by[0]).isin([r[by[0]] for r in rows])
    each = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c])) for c in by]) for r in rows]
    return reduce(lambda a, b: a | b, each, F.lit(False))


def touched_partitions(child: DataFrame, by: list[str], child_key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """(partition columns, __deleted, __folder) of the partitions that hold rows without a parent."""
    p = _parents(parents, parent_key)
    # the column holds an address, with a space as %20; writers take the plain path
    address = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), r"\+", "%2B")
    folder = F.url_decode(address)
    rows = child.select(*by, F.col(child_key).alias("__key"), folder.alias("__folder")).where("__key IS NOT NULL")
    return (rows.join(p, F.col("__key") == F.col("__parent"), "left_anti").groupBy(*by)
            .agg(F.count(F.lit(1)).alias("__deleted"), F.max("__folder").alias("__folder")))


def cascade_delete(spark: SparkSession, path: str, by: list[str], child_key: str, parents: DataFrame, parent_key: str,
                   rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Delete the rows of the table at ``path``, partitioned by ``by``, whose ``child_key`` has no parent. Returns (partition
    columns, deleted, kept) of the partitions rewritten."""
    child = spark.read.parquet(path)
    touched = cut(touched_partitions(child, by, child_key, parents, parent_key))
    found = touched.collect()                                      # a row for each touched partition
    if not found:
        return touched.select(*by, F.col("__deleted").alias("deleted"), F.lit(0).cast("long").alias("kept"))
    p = _parents(parents, parent_key)
    rows = child.where(_one_of(found, by))
    alive = cut(rows.join(p, rows[child_key] == p["__parent"], "left")
                .where(F.col("__parent").isNotNull() | rows[child_key].isNull()).select(*child.columns))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__at_{c}")) for c in by])
    at = [F.col(c).alias(f"__at_{c}") for c in by]
    kept = cut(touched.join(alive.groupBy(*at).agg(F.count(F.lit(1)).alias("__kept")), same, "left")
               .select(*by, "__deleted", "__folder", F.coalesce("__kept", F.lit(0)).alias("__kept")))
    # as many tasks for a partition as it makes files
    files = kept.select(*at, F.ceil(F.col("__kept") / F.lit(rows_per_file)).alias("__files"))
    spread = (alive.join(files, same).withColumn("__file", F.pmod(F.xxhash64(*child.columns), F.col("__files")))
              .repartition(*by, "__file").select(*child.columns))
    (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(*by).parquet(path))
    bare = spark.createDataFrame([], child.drop(*by).schema)
    for row in kept.where("__kept = 0").select("__folder").collect():
        bare.write.mode("overwrite").parquet(row["__folder"])
    return kept.select(*by, F.col("__deleted").alias("deleted"), F.col("__kept").alias("kept"))
