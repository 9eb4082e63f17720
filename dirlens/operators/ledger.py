"""Ledger of processed keys (F7): what is done in one run is skipped by the next.

The keys stand in a Parquet table in folders by hash bucket, each run appending its own. A Bloom filter of a
fixed number of bits, one row of longs, is carried from run to run: a key that it does not know is new
without a look at the table, and only the others go through the anti join. A run writes its filter before its
keys, so after a crash in between the filter knows too much, which costs time and no result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 1 << 23            # one row of 1 MiB; about 800,000 keys before more than one in fifty new ones is looked up
HASHES = 5
BUCKETS = 64


class Ledger:
    def __init__(self, spark: SparkSession, path: str, bits: int = BITS, hashes: int = HASHES, buckets: int = BUCKETS):
        self.spark, self.path, self.bits, self.hashes, self.buckets = spark, path, bits, hashes, buckets

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bits)) for i in range(self.hashes)]

    def keys(self) -> DataFrame | None:
        """(key, bucket, run) of everything processed; None before the first run."""
        return self._read("keys")

    def _filter(self) -> tuple[int, DataFrame | None]:
        """(the last run's number, its filter as one row)."""
        all_runs = self._read("filters")
        if all_runs is None:
            return 0, None
        last = all_runs.agg(F.max("run")).first()[0]
        return last, all_runs.where(F.col("run") == last).select("words")

    def pending(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of ``df`` whose key no run has recorded. A null key is never recorded and always pending."""
        done = self.keys()
        if done is None:
            return df
        k = F.col(key).cast("string")
        words = self._filter()[1].scalar()
        known = F.lit(True)
        for place in self._places(k):
            bit = F.call_function("shiftright", F.get(words, F.floor(place / 64).cast("int")), (place % 64).cast("int"))
            known = known & (bit.bitwiseAND(F.lit(1)) == 1)
        known = F.coalesce(known & k.isNotNull(), F.lit(False))
        fresh = df.where(~known)
        seen = done.select(F.col("key").alias("__seen"))
        asked = df.where(known)
        return fresh.unionByName(asked.join(seen, asked[key].cast("string") == seen["__seen"], "left_anti"))

    def record(self, df: DataFrame, key: str) -> None:
        """Write the keys of ``df`` down as processed."""
        keys = df.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()
        run, before = self._filter()
        place = F.explode(F.array(*self._places(F.col("key"))))
        bits = (keys.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w"))
                .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("b")))
        if before is not None:
            bits = (bits.unionByName(before.select(F.posexplode("words").alias("w", "b")))
                    .groupBy("w").agg(F.bit_or("b").alias("b")))
        every = self.spark.range(self.bits // 64).withColumnRenamed("id", "w").join(bits, "w", "left")
        row = every.agg(F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0)).cast("long").alias("b")))).alias("x"))
        row.select(F.transform("x", lambda x: x["b"]).alias("words")).write.mode("overwrite").parquet(
            f"{self.path}/filters/run={run + 1}")
        bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
        (keys.withColumn("bucket", bucket).withColumn("run", F.lit(run + 1)).repartition("bucket")
         .sortWithinPartitions("bucket", "key").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/keys"))
