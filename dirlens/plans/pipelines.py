"""Composite pipelines: each returns a dict of named DataFrames (report tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Dictionary, QualityRules
from ..operators.clean_records import clean_providers, readable
from ..operators.dedup import dedup_fuzzy
from ..operators.quality import flag_share, quality_report, score_providers, split_quarantine
from ..session import cut


def clean_and_dedup(raw: DataFrame, dictionary: Dictionary | None = None,
                    threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """Clean (C1) then greedy fuzzy dedup on the cleaned name.

    Both results are cut to the shared checkpoint folder, so whatever reads them
    (counts, scores, reports) starts from the copy, not from the raw tables."""
    cleaned = cut(clean_providers(raw, dictionary))
    unique = cut(dedup_fuzzy(cleaned, "name", "seq", threshold))
    return cleaned, unique


def run_metrics(raw: DataFrame, cleaned: DataFrame, unique: DataFrame) -> DataFrame:
    """Records per stage as one row: the three inputs are tagged, unioned
    and counted in one partial+final aggregation (no data moves, no join)."""
    tagged = (raw.select(F.lit(0).alias("stage"))
              .unionByName(cleaned.select(F.lit(1).alias("stage")))
              .unionByName(unique.select(F.lit(2).alias("stage"))))
    return tagged.agg(F.count_if(F.col("stage") == 0).alias("original_count"),
                      F.count_if(F.col("stage") == 1).alias("cleaned_count"),
                      F.count_if(F.col("stage") == 2).alias("unique_count"))


def run_documents(metrics: DataFrame, records: DataFrame, column: str = "metadata") -> DataFrame:
    """K3: the run's counts beside the metadata of the envelopes that its records came from, one row per distinct
    metadata. ``records`` are a reader's rows with that column; ``metrics`` is one row."""
    counts = [metrics.select(c).scalar().alias(c) for c in metrics.columns]
    return records.select(f"{column}.*").distinct().select("*", *counts)


def observed(df: DataFrame, name: str):
    """K3 without extra passes: attach a row count to ``df``; the count is filled
    in by whatever action writes ``df`` (``obs.get["rows"]`` afterwards)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run_pipeline(raw: DataFrame, dictionary: Dictionary | None = None,
                 rules: QualityRules | None = None, threshold: float = 0.85) -> dict[str, DataFrame]:
    """Quarantine (F1) -> clean -> dedup -> counts -> score -> report.

    Entries that are no records go to ``quarantine`` and count as original alone. The cleaned and the
    deduplicated sets are checkpointed; scores are row-local expressions over the latter.
    """
    records, bad = split_quarantine(raw, readable(raw), "not a record")
    cleaned, unique = clean_and_dedup(records, dictionary, threshold)
    scored = score_providers(unique, rules)
    return {
        "quarantine": bad,
        "cleaned": cleaned,
        "unique": unique,
        "metrics": run_metrics(raw, cleaned, unique),
        "scored": scored,
        "report": quality_report(scored),
        "issues": flag_share(scored),
    }
