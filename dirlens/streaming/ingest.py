"""Structured Streaming ingest (ST).

The reference appends page-wise partial files and re-aggregates them with a
last-wins rule. The streaming form here:

* file source with an explicit schema (new files = new micro-batches);
* stateless cleaning/scoring per batch (C1/Q4 are projections);
* last-wins per key as a streaming aggregation (state store holds one row
  per key, checkpointed in the shared folder for exactly-once recovery);
* ``update`` output written per epoch to a log-structured table; a reader
  resolves the latest version of each key with the same last-wins rule. Every few
  epochs are merged into a snapshot, and a reader takes the newest snapshot and the
  epochs after it, so its cost does not grow with the number of epochs;
* malformed envelope files go to a side output, not nowhere.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean_records import clean_providers
from ..operators.dedup import dedup_last
from ..operators.quality import score_providers


def stream_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """File stream over a directory (optionally only files matching ``file_glob``)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if fmt == "json":
        reader = reader.option("multiLine", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def clean_and_score_stream(raw: DataFrame) -> DataFrame:
    """Stateless per-record cleaning and scoring on a stream of provider records."""
    return score_providers(clean_providers(raw))


def last_wins_stream(stream: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Streaming D1: per key the values of the row with the highest ``seq`` and
    the key's first ``seq``."""
    others = [c for c in stream.columns if c not in keys and c != seq]
    return (stream.groupBy(*keys)
            .agg(F.max_by(F.struct(*others), F.col(seq)).alias("__last"), F.min(seq).alias(seq))
            .select(*keys, *[F.col(f"__last.{c}").alias(c) for c in others], seq))


COMPACT_EVERY = 10


def run_to_table(result: DataFrame, table_path: str, checkpoint: str, keys: list[str], mode: str = "update",
                 available_now: bool = True, compact_every: int = COMPACT_EVERY):
    """Run a streaming aggregation into an epoch-versioned parquet log, a folder for each epoch (an epoch that is
    run again replaces its folder), and merge the log after every ``compact_every`` epochs."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/log/__epoch={epoch}")
        if (epoch + 1) % compact_every == 0:
            compact(batch.sparkSession, table_path, keys, epoch)

    writer = (result.writeStream.outputMode(mode).foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def _versions(spark: SparkSession, table_path: str, upto: int | None = None) -> DataFrame:
    """The versions of the keys, with their __epoch: the newest snapshot's and those of the epochs after it."""
    log = spark.read.parquet(f"{table_path}/log")
    log = log.withColumn("__epoch", F.col("__epoch").cast("bigint"))
    if upto is not None:
        log = log.where(F.col("__epoch") <= upto)
    try:
        snapshots = spark.read.parquet(f"{table_path}/snapshots")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return log
    if upto is not None:
        snapshots = snapshots.where(F.col("__upto") <= upto)
    last = snapshots.agg(F.max("__upto")).first()[0]
    if last is None:
        return log
    return (snapshots.where(F.col("__upto") == last).drop("__upto")
            .unionByName(log.where(F.col("__epoch") > last)))


def compact(spark: SparkSession, table_path: str, keys: list[str], upto: int) -> None:
    """Merge the epochs up to ``upto`` (and the snapshot before) into a snapshot: one row per key, at the epoch of
    its newest version."""
    versions = _versions(spark, table_path, upto)
    others = [c for c in versions.columns if c not in keys]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*others), "__epoch").alias("__last")).select(*keys, "__last.*")
    newest.write.mode("overwrite").parquet(f"{table_path}/snapshots/__upto={upto}")


def read_latest(spark: SparkSession, table_path: str, keys: list[str]) -> DataFrame:
    """Resolve the epoch log: the newest version of every key."""
    return dedup_last(_versions(spark, table_path), keys, "__epoch").drop("__epoch")


def stream_last_wins(spark: SparkSession, source_path: str, schema: T.StructType, keys: list[str],
                     seq: str, work_dir: str, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None, file_glob: str | None = None,
                     compact_every: int = COMPACT_EVERY) -> DataFrame:
    """End to end: stream the source, keep last-wins state, return the resolved table."""
    src = stream_source(spark, source_path, schema, fmt, max_files_per_trigger, file_glob)
    agg = last_wins_stream(src, keys, seq)
    table = os.path.join(work_dir, "table")
    run_to_table(agg, table, os.path.join(work_dir, "_checkpoint"), keys, compact_every=compact_every)
    return read_latest(spark, table, keys)


def provider_stream(spark: SparkSession, path: str, field: str = "providers",
                    record: T.StructType | None = None, max_files_per_trigger: int | None = None,
                    with_quarantine: bool = False):
    """Stream of provider records from envelope JSON files (one envelope per file,
    new files = new micro-batches), cleaned and scored per record (stateless).

    ``with_quarantine`` also returns the stream of the files that are no envelope (file, _corrupt_record), to
    be run into a table of its own with its own checkpoint."""
    from ..schemas import PROVIDER_RAW
    rec = record or PROVIDER_RAW
    schema = T.StructType([T.StructField(field, T.ArrayType(rec)), T.StructField("_corrupt_record", T.StringType())])
    src = (stream_source(spark, path, schema, "json", max_files_per_trigger)
           .select(F.col("_metadata.file_path").alias("__file"), "*"))
    rows = src.select("__file", F.posexplode(field).alias("__pos", "__rec"))
    flat = rows.select("__rec.*", F.struct(F.col("__file").alias("file"), F.col("__pos").alias("pos")).alias("seq"))
    good = clean_and_score_stream(flat)
    if not with_quarantine:
        return good
    return good, src.where(F.col(field).isNull()).select(F.col("__file").alias("file"), "_corrupt_record")


def run_append(stream: DataFrame, table_path: str, checkpoint: str, available_now: bool = True):
    """Append a stateless stream to a parquet table (exactly-once via the checkpoint)."""
    writer = (stream.writeStream.outputMode("append").format("parquet")
              .option("path", table_path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
