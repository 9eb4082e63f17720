"""Keyword classification (C13 multi-label, C14 first-match) as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_INDUSTRY_FALLBACK, DEFAULT_INDUSTRY_KEYWORDS, DEFAULT_SERVICE_KEYWORDS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_contains(text: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def classify_multi(c, rules: Sequence[tuple[str, Sequence[str]]] = DEFAULT_SERVICE_KEYWORDS,
                   other: str = "Other", sep: str = ", ") -> Column:
    """Every label with a keyword contained in lower(text), joined in rule order."""
    text = F.lower(_c(c).cast("string"))
    labels = [F.when(_any_contains(text, kws), F.lit(label)) for label, kws in rules]
    return F.coalesce(F.nullif(F.concat_ws(sep, *labels), F.lit("")), F.lit(other))


def classify_first(c, rules: Sequence[tuple[str, str]] = DEFAULT_INDUSTRY_KEYWORDS,
                   default: str = DEFAULT_INDUSTRY_FALLBACK) -> Column:
    """C14: label of the first rule whose keyword occurs in lower(text); else default."""
    text = F.lower(F.coalesce(_c(c).cast("string"), F.lit("")))
    out = None
    for label, kw in rules:
        words = [kw] if isinstance(kw, str) else list(kw)
        cond = _any_contains(text, words)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
