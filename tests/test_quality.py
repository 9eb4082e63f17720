"""Scoring goldens (FIXTURES.md §3)."""
from pyspark.sql import functions as F

from dirlens.operators.quality import flag_frequency, flags_text, quality_report, score_providers
from dirlens.schemas import PROVIDER_RAW

ROWS = [
    ("1", "Acme", "BD", "Dhaka", "Gold", "https://a.com", "d" * 100, ["s1"], [], "https://s/1"),
    ("2", "", "Germany", None, "Unknown", None, None, [], [], ""),
    ("3", "Beta", "US", "Austin", "Silver", "https://b.com", "d" * 400, ["a", "b", "c", "d"], [], "https://s/3"),
    ("4", "Gamma", "IN", "   ", "Ready", None, "d" * 49, ["a", "b"], [], "https://s/4"),
]


def test_scores_and_report(spark):
    df = spark.createDataFrame(ROWS, PROVIDER_RAW)
    scored = score_providers(df).orderBy("provider_id")
    got = [(r.data_completeness_score, r.data_quality_score, r.f)
           for r in scored.select("*", flags_text("quality_flags").alias("f")).collect()]
    assert got == [(0.87, 0.9, ""),
                   (0.22, 0.4, "missing_name,missing_source_url,no_website,short_description"),
                   (1.0, 1.0, ""),
                   (0.57, 0.8, "no_website,short_description")]
    rep = quality_report(scored).first().asDict()
    assert rep["total_providers"] == 4
    assert rep["average_completeness"] == 0.665 and rep["average_quality"] == 0.775
    assert (rep["completeness_high"], rep["completeness_medium"], rep["completeness_low"]) == (2, 1, 1)
    assert (rep["quality_high"], rep["quality_medium"], rep["quality_low"]) == (2, 1, 1)
    freq = [(r.flag, r.providers) for r in flag_frequency(scored).collect()]
    assert freq == [("no_website", 2), ("short_description", 2), ("missing_name", 1), ("missing_source_url", 1)]


def test_empty_report(spark):
    df = spark.createDataFrame(ROWS, PROVIDER_RAW).where(F.lit(False))
    rep = quality_report(score_providers(df)).first()
    assert rep.total_providers == 0 and rep.average_completeness is None


def test_exact_median_matches_sorting(spark):
    import random
    from dirlens.operators.stats import exact_median
    rnd = random.Random(5)
    for n in (1, 2, 7, 1000, 5001):
        vals = [float(rnd.randint(-50, 50)) for _ in range(n)]
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        s = sorted(vals)
        want = (s[(n - 1) // 2] + s[n // 2]) / 2.0
        assert exact_median(df, "x") == want
    # two equally common values: a million rows are two counts
    two = spark.range(1_000_000).select((F.col("id") % 2 * 10).cast("double").alias("x"))
    assert exact_median(two, "x") == 5.0
    assert exact_median(two.where("false"), "x") is None
