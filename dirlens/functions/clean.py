"""Cleaning projections: every function maps Column -> Column (native Spark
expressions only, so they stay inside whole-stage codegen).

Whitespace follows Python's Unicode notion via Java's ``(?U)`` flag; digits
are ASCII ``[0-9]`` (documented difference for non-ASCII digits).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Dictionary

# Python's str.isspace() set, spelled out so Java and RE2 agree on it.
PY_SPACE = (r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Python's \w for str patterns: letters, numbers, underscore.
PY_WORD = r"\p{L}\p{N}_"
_WS = f"[{PY_SPACE}]+"
_EDGE_WS = f"^[{PY_SPACE}]+|[{PY_SPACE}]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_lit(d: Mapping) -> Column:
    """A literal MAP<STRING,STRING> (dictionaries here are config-sized)."""
    if not d:
        return F.create_map().cast("map<string,string>")
    parts = []
    for k, v in d.items():
        parts += [F.lit(k), F.lit(v)]
    return F.create_map(*parts)


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(c), _EDGE_WS, "")


def collapse_ws(c) -> Column:
    """Python ``' '.join(s.split())``."""
    return F.trim(F.regexp_replace(_c(c), _WS, " "))


def clean_company_name(c, badges: Iterable[str] = ("Gold", "Silver", "Ready")) -> Column:
    """Collapse whitespace, strip ONE trailing badge word (case-insensitive), trim."""
    alt = "|".join(badges)
    cleaned = F.trim(F.regexp_replace(collapse_ws(c), rf"(?i)\s*({alt})\s*$", ""))
    return F.when(_c(c).isNull() | (_c(c) == ""), F.lit("")).otherwise(cleaned)


def normalize_country(c, dictionary: Dictionary | None = None) -> Column:
    """C3: ''/NULL -> ''; 2 chars -> upper; name/full-name match -> code; else unchanged."""
    d = dictionary or Dictionary()
    lookup = _map_lit(d.country_lookup())
    col = _c(c)
    return (F.when(col.isNull() | (col == ""), F.lit(""))
            .when(F.length(col) == 2, F.upper(col))
            .otherwise(F.coalesce(F.try_element_at(lookup, F.lower(col)), col)))


def capitalize(c) -> Column:
    """Python ``str.capitalize()``: first char upper, the rest lower."""
    col = _c(c)
    return F.concat(F.upper(col.substr(F.lit(1), F.lit(1))), F.lower(col.substr(F.lit(2), F.lit(1 << 30))))


def normalize_tier(c, tiers: Iterable[str] = ("Gold", "Silver", "Ready")) -> Column:
    """C4: ''/NULL -> Unknown; strip + capitalize; outside the tier set -> Unknown."""
    t = capitalize(strip_ws(c))
    return F.when(t.isin(list(tiers)), t).otherwise(F.lit("Unknown"))


def clean_text(c) -> Column:
    """C5: ''/NULL -> NULL; collapse whitespace; delete NUL; blank -> NULL.

    What stays is blank unless some character is neither whitespace nor NUL; asking that first, the text is rewritten once."""
    col = _c(c)
    collapsed = F.regexp_replace(col, _WS, " ")
    out = F.trim(F.replace(collapsed, F.lit("\u0000"), F.lit("")))
    return F.when(col.rlike(f"[^{PY_SPACE}\\x00]"), out)


def clean_url(c) -> Column:
    """Strip; keep only if it starts with http:// or https:// (case-sensitive)."""
    s = strip_ws(c)
    return F.when(s.rlike(r"^https?://"), s).otherwise(F.lit(None).cast("string"))


def normalize_terms(arr, aliases: Mapping[str, str], taxonomy: Iterable[str]) -> Column:
    """Strip each item; exact alias -> value; case-insensitive taxonomy match
    -> canonical; else the stripped item; distinct; code-point sorted."""
    alias_m = _map_lit(dict(aliases))
    tax_m = _map_lit({t.lower(): t for t in reversed(list(taxonomy))})
    a = F.coalesce(_c(arr), F.array().cast("array<string>"))

    def norm(x):
        s = strip_ws(x)
        return F.coalesce(F.try_element_at(alias_m, s), F.try_element_at(tax_m, F.lower(s)), s)

    return F.sort_array(F.array_distinct(F.transform(F.filter(a, lambda x: x.isNotNull()), norm)))


def normalize_industries(arr, dictionary: Dictionary | None = None) -> Column:
    d = dictionary or Dictionary()
    return normalize_terms(arr, d.industry_aliases, d.industry_taxonomy)


def normalize_modules(arr, dictionary: Dictionary | None = None) -> Column:
    d = dictionary or Dictionary()
    return normalize_terms(arr, d.module_aliases, d.core_modules)


def first_int(c) -> Column:
    """First ASCII digit run as a number, else 0."""
    return F.coalesce(F.regexp_extract(_c(c).cast("string"), r"([0-9]+)", 1).try_cast("bigint"),
                      F.lit(0).cast("bigint"))


def price_token(c) -> Column:
    """First digit run kept as a STRING; '' when none or NULL."""
    col = _c(c).cast("string")
    return F.when(col.isNull() | (col == ""), F.lit("")).otherwise(F.regexp_extract(col, r"([0-9]+)", 1))


def clean_price(c) -> Column:
    """C11: all digits concatenated -> double; NULL or no digits -> 0."""
    digits = F.regexp_replace(_c(c).cast("string"), r"[^0-9]", "")
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("double"), F.lit(0.0))


def clean_title(c) -> Column:
    """NULL -> ''; lower; delete everything that is not a word char or whitespace."""
    return F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), f"[^{PY_WORD}{PY_SPACE}]", "")


def primary_value(c, sep: str = ",", missing: str = "Unknown") -> Column:
    """First item of a delimited list (no trim); NULL -> 'Unknown'."""
    return F.coalesce(F.substring_index(_c(c), sep, 1), F.lit(missing))


def to_number(c) -> Column:
    """Numeric coercion; anything unparsable -> 0."""
    return F.coalesce(_c(c).cast("string").try_cast("double"), F.lit(0.0))


def sum_matches(c, pattern: str = r"([0-9]+)\s+Certified") -> Column:
    """C17: sum of every captured integer (default: 'N Certified' counts)."""
    nums = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(pattern), 1)
    return F.aggregate(nums, F.lit(0).cast("bigint"),
                       lambda acc, x: acc + F.coalesce(x.try_cast("bigint"), F.lit(0).cast("bigint")))


def join_list(arr, sep: str = ", ") -> Column:
    """Array -> delimited text; NULL -> ''."""
    return F.array_join(F.coalesce(_c(arr), F.array().cast("array<string>")), sep)


def map_to_text(m) -> Column:
    """Map -> 'k: v, k: v' in entry order; NULL -> ''."""
    entries = F.map_entries(_c(m))
    txt = F.array_join(F.transform(entries, lambda e: F.concat(
        e["key"].cast("string"), F.lit(": "), F.coalesce(e["value"].cast("string"), F.lit("None")))), ", ")
    return F.coalesce(txt, F.lit(""))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """C20: replace NULL (or a missing column) by a default value."""
    cols = {}
    for name, value in defaults.items():
        if name in df.columns:
            cols[name] = F.coalesce(F.col(name), F.lit(value))
        else:
            cols[name] = F.lit(value)
    return df.withColumns(cols)


def blank_nulls(df: DataFrame) -> DataFrame:
    """Every column as text with NULL -> '' (export view)."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def round_half_up(c, digits: int) -> Column:
    """floor(x*10^d + 0.5) / 10^d (engine-independent on doubles)."""
    p = float(10 ** digits)
    return F.floor(_c(c) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def format_kpi(c) -> Column:
    """>100 -> thousands separators, no decimals; else one decimal.

    ``format_number`` rounds half-even on the exact binary value, as Python's
    ``format(v, ',.0f')`` / ``format(v, '.1f')`` do; the second form has no separators.
    """
    col = _c(c).cast("double")
    return F.when(col > 100, F.format_number(col, 0)).otherwise(
        F.regexp_replace(F.format_number(col, 1), ",", ""))


def format_percent(c) -> Column:
    """C23 ratio form (Python ``'.1%'``): 0.123 -> '12.3%'."""
    return F.concat(F.regexp_replace(F.format_number(_c(c).cast("double") * 100, 1), ",", ""), F.lit("%"))


def ratio(a, b) -> Column:
    """A5: a / b with 0 when b is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(a).cast("double"), _c(b).cast("double")), F.lit(0.0))


def select_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Project the listed columns that exist, in the listed order."""
    return df.select([c for c in cols if c in df.columns])


def title_case(c) -> Column:
    """Python ``str.title()``: a letter is upper-cased when the previous
    character is not a cased letter, otherwise lower-cased."""
    col = _c(c)
    n = F.length(col)
    chars = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.when(
            (i == 1) | ~col.substr(i - 1, F.lit(1)).rlike(r"^[\p{Lu}\p{Ll}\p{Lt}]$"),
            F.upper(col.substr(i, F.lit(1)))).otherwise(F.lower(col.substr(i, F.lit(1)))))
    return F.when(col.isNull(), col).otherwise(F.array_join(chars, ""))
