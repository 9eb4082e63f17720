"""One key holding a third of all rows: results stay exact with AQE skew handling on."""
from pyspark.sql import functions as F

from dirlens.operators.dedup import dedup_fuzzy, dedup_last
from dirlens.operators.stats import value_counts


def test_hot_key(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        df = spark.range(n).select(
            F.col("id").alias("seq"),
            F.when(F.col("id") % 3 == 0, F.lit("Hot Provider Ltd"))
             .otherwise(F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("q"))).alias("name"),
            (F.col("id") % 7).alias("v"))
        kept = dedup_fuzzy(df, "name", "seq", 0.85)
        hot = kept.where(F.lower("name") == "hot provider ltd").collect()
        assert len(hot) == 1 and hot[0].seq == 0          # only the first copy survives
        last = dedup_last(df, ["name"], "seq").where(F.col("name") == "Hot Provider Ltd").first()
        assert last.seq == 0 and last.v == (n - 3) % 7     # values of the last copy, first slot
        top = value_counts(df, "name").first()
        assert top["name"] == "Hot Provider Ltd" and top["count"] == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
