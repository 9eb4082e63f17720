"""Clean a whole provider record in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Dictionary
from ..functions.clean import (clean_company_name, clean_text, clean_url, normalize_country,
                               normalize_tier)
from ..schemas import PROVIDER_RAW


def readable(df: DataFrame) -> Column:
    """Whether a row is a record at all: an entry of an envelope that is no object (a number, a text, null) is read as a
    row without any field. Such an entry cannot be cleaned."""
    found = F.lit(False)
    for c in PROVIDER_RAW.fieldNames():
        if c in df.columns:
            found = found | F.col(c).isNotNull()
    return found


def clean_providers(df: DataFrame, dictionary: Dictionary | None = None,
                    keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Ten fields, each with its own rule, in the fixed output order; pass-through
    columns in ``keep`` (e.g. the reader's ``seq``) are carried along."""
    d = dictionary or Dictionary()
    empty = F.array().cast("array<string>")
    cols = [
        F.coalesce(F.col("provider_id"), F.lit("")).alias("provider_id"),
        clean_company_name(F.col("name"), d.badges).alias("name"),
        normalize_country(F.col("country"), d).alias("country"),
        clean_text(F.col("location")).alias("location"),
        normalize_tier(F.col("tier"), d.tiers).alias("tier"),
        clean_url(F.col("website")).alias("website"),
        clean_text(F.col("description")).alias("description"),
        F.coalesce(F.col("services"), empty).alias("services"),
        F.coalesce(F.col("client_references"), empty).alias("client_references"),
        F.coalesce(F.col("source_url"), F.lit("")).alias("source_url"),
    ]
    return df.select(*cols, *[F.col(k) for k in keep if k in df.columns])
