"""Column -> Column functions (cleaning, classification, similarity)."""

from .classify import classify_first, classify_multi
from .clean import (blank_nulls, capitalize, clean_company_name, clean_price, clean_text,
                    clean_title, clean_url, collapse_ws, first_int, format_kpi, format_percent,
                    join_list, map_to_text, normalize_country, normalize_industries,
                    normalize_modules, normalize_terms, normalize_tier, price_token,
                    primary_value, ratio, round_half_up, select_existing, strip_ws,
                    sum_matches, title_case, to_number, with_defaults)
from .text import bigram_jaccard, bigrams

__all__ = [n for n in dir() if not n.startswith("_")]
