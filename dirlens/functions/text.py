"""Character-bigram set similarity (D2) as native array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bigrams(c) -> Column:
    """Distinct character bigrams of a string; empty array below 2 characters.

    One linear regex pass: a zero-width lookahead captures the two characters
    at every position (indexing with substr would be quadratic on long texts).
    The second half of a character beyond the basic plane is no position.
    """
    s = _c(c)
    grams = F.regexp_extract_all(s, F.lit(r"(?s)(?!\p{Cs})(?=(..))"), 1)
    return F.coalesce(F.array_distinct(grams), F.array().cast("array<string>"))


def bigram_jaccard(a, b) -> Column:
    """Either side NULL/empty -> 0; equal -> 1; no bigrams on a side -> 0; else |A∩B|/|A∪B|."""
    x, y = _c(a), _c(b)
    bx, by = bigrams(x), bigrams(y)
    jac = F.size(F.array_intersect(bx, by)).cast("double") / F.size(F.array_union(bx, by)).cast("double")
    return (F.when(x.isNull() | y.isNull() | (x == "") | (y == ""), F.lit(0.0))
            .when(x == y, F.lit(1.0))
            .when((F.size(bx) == 0) | (F.size(by) == 0), F.lit(0.0))
            .otherwise(jac))
