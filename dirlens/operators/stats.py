"""Aggregations and the one relational join.

Every aggregate is a partial (map-side) + final aggregation; top-N reports
use ``orderBy().limit()`` which plans as TakeOrderedAndProject (per-partition
top-N, then a tiny merge). Joins aggregate first and join the (much smaller)
aggregate, letting AQE choose broadcast or sort-merge from runtime sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.clean import format_kpi, format_percent, ratio, round_half_up
from ..session import cut


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """A1: counts per non-NULL value, count desc then value."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.desc(name), F.asc(col)))


def top_values(df: DataFrame, col: str, n: int = 10, name: str = "count") -> DataFrame:
    """A2/A3: top-N of A1 (the limit is the feature; ties broken by value)."""
    return value_counts(df, col, name).limit(n)


def distinct_count(df: DataFrame, col: str, approx: bool = False, name: str = "distinct") -> DataFrame:
    """A4: distinct non-NULL values; HyperLogLog++ when ``approx``."""
    agg = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.agg(agg.cast("bigint").alias(name))


def distinct_sketches(df: DataFrame, by: list[str], col: str, log2_size: int = 12) -> DataFrame:
    """A4 approximate: a mergeable sketch (2^log2_size cells at most) of the distinct values of ``col`` for every key. The
    sketches are small rows, so a day's can be stored and merged with other days' without the data."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(_c(col), log2_size).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str], name: str = "distinct") -> DataFrame:
    """The estimated distinct counts of stored sketches, merged to the coarser key ``by`` (none: one row)."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)
    return sketches.groupBy(*by).agg(merged)


def coverage_split(df: DataFrame, col: str, with_label: str = "With References",
                   without_label: str = "No References") -> DataFrame:
    """Rows with a positive (numeric-coerced) value vs the rest, as (category, count)."""
    v = F.coalesce(F.col(col).cast("string").try_cast("double"), F.lit(0.0))
    one = df.agg(F.count_if(v > 0).alias("w"), F.count_if(~(v > 0)).alias("wo"))
    return one.select(F.inline(F.array(
        F.struct(F.lit(with_label).alias("category"), F.col("w").alias("count")),
        F.struct(F.lit(without_label).alias("category"), F.col("wo").alias("count")))))


def positive_mean(c) -> Column:
    """mean over positive values only (aggregate-level filter)."""
    return F.avg(F.when(_c(c) > 0, _c(c)))


def left_join_counts(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
                     name: str = "client_count") -> DataFrame:
    """Left ⟕ (counts per key of right) on the key as string; missing -> 0.

    The right side is aggregated before the join, so only one row per key is
    shuffled; AQE broadcasts it when its runtime size is small.
    """
    rk = right_key or key
    counts = (right.groupBy(F.col(rk).cast("string").alias("__k"))
              .agg(F.count(F.lit(1)).alias(name)))
    return (left.withColumn("__k", F.col(key).cast("string"))
            .join(counts, "__k", "left").drop("__k")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint")))


def avg_by(df: DataFrame, group: str, value: str, name: str = "avg", digits: int = 6) -> DataFrame:
    """Mean per non-NULL group, sorted desc (then group)."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
            .agg(round_half_up(F.avg(F.col(value).cast("double")), digits).alias(name))
            .orderBy(F.desc(name), F.asc(group)))


def _maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else round_half_up(c, digits)


def category_stats(df: DataFrame, group: str, value: str, digits: int | None = None) -> DataFrame:
    """A10: count/mean/min/max/sum per non-NULL group, sorted by sum desc.

    With ``digits`` the sum is taken in DECIMAL (exact, order-independent) and the
    mean rounded; without, values are raw doubles as the source tables are.
    """
    total = (F.sum(F.col(value).cast(f"decimal(28,{digits})")).cast("double") if digits is not None
             else F.sum(F.col(value).cast("double")))
    return (df.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(value).alias("gig_count"),
                 _maybe_round(F.avg(F.col(value).cast("double")), digits).alias("avg_price"),
                 F.min(F.col(value).cast("double")).alias("min_price"),
                 F.max(F.col(value).cast("double")).alias("max_price"),
                 total.alias("total_value"))
            .orderBy(F.desc("total_value"), F.asc(group)))


def service_stats(df: DataFrame, group: str, value: str, digits: int | None = None) -> DataFrame:
    """count/mean/max per group, sorted by mean desc (mean rounded when ``digits``)."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(value).alias("gig_count"),
                 _maybe_round(F.avg(F.col(value).cast("double")), digits).alias("avg_price"),
                 F.max(F.col(value).cast("double")).alias("max_price"))
            .orderBy(F.desc("avg_price"), F.asc(group)))


def stack_metrics(one_row: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into (metric, value) rows, in the given order."""
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(label).alias("metric"),
                 F.col(col).cast("double").alias("value"))
        for i, (label, col) in enumerate(labels)])))


def exact_median(df: DataFrame, col: str) -> float | None:
    """Exact median, interpolating between the two middle values for even n (pandas
    semantics); NULL/NaN skipped.

    Equal values are counted first, so ties collapse whatever their number. The distinct
    values are range-sorted, counts are summed within each range and then over the ranges
    (one row each), and only the rows that hold the two middle ranks reach the driver."""
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = cut(v.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v"))
    tagged = counts.withColumn("part", F.spark_partition_id())
    totals = tagged.groupBy("part").agg(F.sum("n").alias("t"))
    starts = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"),
                           F.sum("t").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (tagged.withColumn("upto", F.sum("n").over(inside)).join(F.broadcast(starts), "part")
              .withColumn("end", F.col("before") + F.col("upto")).withColumn("start", F.col("end") - F.col("n")))
    middle = [F.expr("(total - 1) div 2"), F.expr("total div 2")]
    holds = [(F.col("start") <= m) & (m < F.col("end")) for m in middle]
    rows = placed.where(holds[0] | holds[1]).select("v").collect()      # one row or two
    return sum(r["v"] for r in rows) / len(rows) if rows else None


def executive_summary(df: DataFrame, value: str, digits: int | None = None) -> DataFrame:
    """N, mean, exact (interpolated) median, sum, max as (metric, value) rows.

    The median is a distributed exact selection (``exact_median``), not the
    exact ``median`` aggregate, whose buffer holds every distinct value of the
    group in one task.
    """
    v = F.col(value).cast("double")
    med = exact_median(df, value)
    total = (F.sum(F.col(value).cast(f"decimal(28,{digits})")) if digits is not None else F.sum(v))
    one = df.agg(F.count(F.lit(1)).alias("n"),
                 _maybe_round(F.avg(v), digits).alias("mean"),
                 _maybe_round(F.lit(med).cast("double"), digits).alias("median"),
                 total.alias("total"),
                 F.max(v).alias("max"))
    return stack_metrics(one, [("Total Gigs Analyzed", "n"), ("Average Market Price", "mean"),
                               ("Median Market Price", "median"), ("Total Market Value (Est.)", "total"),
                               ("Highest Price Gig", "max")])


def client_kpis(clients: DataFrame, partner_id: str = "Partner ID") -> DataFrame:
    """Distinct partners, total client rows, clients per partner (1 decimal)."""
    one = clients.agg(F.countDistinct(partner_id).alias("partners"), F.count(F.lit(1)).alias("clients"))
    return one.select(F.col("partners").cast("bigint").alias("total_partners"),
                      F.col("clients").cast("bigint").alias("total_clients"),
                      round_half_up(ratio("clients", "partners"), 1).alias("avg_clients_per_partner"))


def grand_kpis(partners: DataFrame, clients: DataFrame, country: str, experts: Column,
               retention: Column) -> DataFrame:
    """Partners, clients, countries, clients/partner, experts, avg positive retention/100,
    as (metric, value, display) rows: both inputs are tagged, unioned and aggregated once."""
    side = (partners.select(F.lit(True).alias("__p"), F.col(country).alias("__country"),
                            experts.cast("double").alias("__experts"), F.lit(None).cast("double").alias("__ret"))
            .unionByName(clients.select(F.lit(False).alias("__p"), F.lit(None).cast("string").alias("__country"),
                                        F.lit(None).cast("double").alias("__experts"),
                                        retention.cast("double").alias("__ret"))))
    one = side.agg(F.count_if(F.col("__p")).alias("partners"), F.countDistinct("__country").alias("countries"),
                   F.sum("__experts").alias("experts"), F.count_if(~F.col("__p")).alias("clients"),
                   positive_mean(F.col("__ret")).alias("retention")).select(
        "partners", "clients", "countries",
        ratio("clients", "partners").alias("avg_clients"),
        F.col("experts").cast("double").alias("experts"),
        (F.coalesce(F.col("retention"), F.lit(0.0)) / 100.0).alias("retention"))
    rows = stack_metrics(one, [("Total Partners", "partners"), ("Total Clients", "clients"),
                               ("Countries Covered", "countries"), ("Avg Clients/Partner", "avg_clients"),
                               ("Total Certified Experts", "experts"),
                               ("Avg Client Retention", "retention")])
    return rows.select("pos", "metric", round_half_up(F.col("value"), 6).alias("value"),
                       F.when(F.col("metric") == "Avg Client Retention", format_percent("value"))
                       .otherwise(format_kpi("value")).alias("display"))
