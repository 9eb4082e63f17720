"""Nested-data operators: flatten partner->client references (N1), the
flatten→dedup→sort pipeline (N2), array containment (N3), term search (N4),
and the tier-rank sort (O1).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_TIER_RANK, KeywordRules
from ..functions.classify import classify_first
from ..functions.clean import join_list, map_to_text
from .dedup import dedup_last


def flatten_references(df: DataFrame, rules: KeywordRules | None = None,
                       refs: str = "client_references_detailed", seq: str = "seq",
                       extra: Mapping[str, str] | None = None) -> DataFrame:
    """One row per client reference (15 export columns + ``seq``); a partner
    without references yields one row with 'N/A' client and industry. ``extra``
    carries more partner columns along: {column: exported name}.

    ``seq`` becomes struct(partner seq, reference position) so that row order
    survives the shuffle-based dedup that follows.
    """
    r = rules or KeywordRules()
    exploded = df.select("*", F.posexplode_outer(F.col(refs)).alias("__pos", "__ref"))
    has_ref = F.coalesce(F.size(F.col(refs)) > 0, F.lit(False))
    ref = F.col("__ref")
    desc = F.coalesce(ref["description"], F.lit(""))

    def d(c: str, default: str) -> Column:
        # a column without nulls stays itself, so that rows dealt out by it still count as such
        return F.coalesce(F.col(c), F.lit(default)) if df.schema[c].nullable else F.col(c)

    return exploded.select(
        d("company_name", "Unknown").alias("Partner Name"),
        d("tier", "Unknown").alias("Partner Tier"),
        F.when(has_ref, F.coalesce(ref["client_name"], F.lit("Unknown"))).otherwise(F.lit("N/A"))
        .alias("Client Name"),
        F.when(has_ref, classify_first(desc, r.industries, r.industry_fallback)).otherwise(F.lit("N/A"))
        .alias("Client Industry"),
        F.when(has_ref, join_list(ref["modules_implemented"], ", ")).otherwise(F.lit(""))
        .alias("Modules Implemented"),
        F.when(has_ref, F.coalesce(ref["outcomes"], F.lit(""))).otherwise(F.lit("")).alias("Key Outcomes"),
        F.when(has_ref, desc).otherwise(F.lit("")).alias("Project Description"),
        d("website", "").alias("Partner Website"),
        d("city", "").alias("Partner City"),
        d("partner_id", "").alias("Partner ID"),
        d("average_project_size", "N/A").alias("Avg Project Size"),
        d("large_project_size", "N/A").alias("Large Project Size"),
        d("certified_experts", "N/A").alias("Certified Experts"),
        d("reference_count_listed", "N/A").alias("Total References Listed"),
        map_to_text(F.col("certifications")).alias("Certifications"),
        *[F.col(c).alias(name) for c, name in (extra or {}).items()],
        F.struct(F.col(seq).alias("p"), F.coalesce(F.col("__pos"), F.lit(0)).alias("r")).alias("seq"),
    )


def tier_rank(c, ranks: Mapping[str, int] = DEFAULT_TIER_RANK, other: int = 3) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = F.lit(other)
    for k, v in ranks.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def sort_by_tier(df: DataFrame, tier: str = "Partner Tier", name: str = "Partner Name",
                 client: str = "Client Name", seq: str = "seq") -> DataFrame:
    """O1: tier rank, partner name, client name; ties keep first-insertion order."""
    return df.orderBy(tier_rank(tier), F.col(name), F.col(client), F.col(seq))


def flatten_dedup_sort(df: DataFrame, rules: KeywordRules | None = None,
                       extra: Mapping[str, str] | None = None) -> DataFrame:
    """N1 -> last-wins on (Partner ID, Client Name) -> O1."""
    flat = flatten_references(df, rules, extra=extra)
    return sort_by_tier(dedup_last(flat, ["Partner ID", "Client Name"], "seq"))


def has_any(arr, values: Sequence[str]) -> Column:
    """Array overlaps any of the values (GIN-index intent)."""
    col = F.col(arr) if isinstance(arr, str) else arr
    return F.coalesce(F.arrays_overlap(col, F.array(*[F.lit(v) for v in values])), F.lit(False))


def has_all(arr, values: Sequence[str]) -> Column:
    """Array contains every value."""
    col = F.col(arr) if isinstance(arr, str) else arr
    cond = F.lit(True)
    for v in values:
        cond = cond & F.coalesce(F.array_contains(col, F.lit(v)), F.lit(False))
    return cond


def name_terms(c) -> Column:
    """Lower-cased word terms of a text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(col), r"[^\p{L}\p{N}_]+"), lambda x: x != "")


def term_search(c, terms: Sequence[str]) -> Column:
    """Text contains every search term as a whole word (case-insensitive)."""
    words = name_terms(c)
    cond = F.lit(True)
    for t in terms:
        cond = cond & F.array_contains(words, F.lit(t.lower()))
    return cond
