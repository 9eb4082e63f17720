"""Independent DuckDB SQL for the registered queries (the correctness check).

Written directly in SQL from the operator semantics (not generated from the
Spark plans). Views available: region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations.
"""

from __future__ import annotations

from ..config import DEFAULT_WEIGHTS

# FIXED VALUES: Spark's default English stop-word list (StopWordsRemover), used
# by the tokenizer checks.
SPARK_ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]

WS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WORD = r"\p{L}\p{N}_"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP = "[" + ", ".join(_sq(w) for w in SPARK_ENGLISH_STOP_WORDS) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def clean_text(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE "
            f"nullif(trim(replace(regexp_replace({x}, '[{WS}]+', ' ', 'g'), chr(0), '')), '') END")


def clean_name(x: str) -> str:
    collapsed = f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE "
            f"trim(regexp_replace({collapsed}, '(?i)\\s*(Gold|Silver|Ready)\\s*$', '')) END")


def country(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' WHEN length({x}) = 2 THEN upper({x}) "
            f"ELSE coalesce(CASE lower({x}) WHEN 'bangladesh' THEN 'BD' WHEN 'india' THEN 'IN' "
            f"WHEN 'united states' THEN 'US' WHEN 'united states of america' THEN 'US' END, {x}) END")


def tier(x: str) -> str:
    t = strip(x)
    cap = f"(upper(substr({t}, 1, 1)) || lower(substr({t}, 2)))"
    return f"CASE WHEN {cap} IN ('Gold', 'Silver', 'Ready') THEN {cap} ELSE 'Unknown' END"


def url(x: str) -> str:
    t = strip(x)
    return f"CASE WHEN regexp_matches({t}, '^https?://') THEN {t} ELSE NULL END"


def jac(a: str, b: str, ga: str, gb: str) -> str:
    return (f"CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = '' OR {b} = '' THEN 0.0::DOUBLE "
            f"WHEN {a} = {b} THEN 1.0::DOUBLE WHEN len({ga}) = 0 OR len({gb}) = 0 THEN 0.0::DOUBLE "
            f"ELSE len(list_intersect({ga}, {gb}))::DOUBLE / len(list_distinct(list_concat({ga}, {gb})))::DOUBLE END")


def grams(x: str) -> str:
    return f"list_distinct(list_transform(range(1, length({x})), lambda i: substr({x}, i, 2)))"


def r(x: str, d: int) -> str:
    p = f"{10 ** d}.0::DOUBLE"
    return f"(floor(({x}) * {p} + 0.5) / {p})"


# ------------------------------------------------------------------ views
PROVIDER_VIEW = """
pv_supp AS (
  SELECT l_suppkey, list_sort(list_distinct(list(p_type))) AS services,
         list_sort(list_distinct(list(p_brand))) AS client_references
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_suppkey),
pv_en AS (SELECT doc_id, text AS description FROM documents),
pv AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS provider_id,
    CASE WHEN s_acctbal >= 8000 THEN s_name || ' Gold'
         WHEN s_acctbal >= 6000 THEN '  ' || s_name || '  silver '
         WHEN s_acctbal < 0 THEN '' ELSE s_name END AS name,
    CASE WHEN n_regionkey = 0 THEN 'bangladesh' WHEN n_regionkey = 1 THEN 'us'
         WHEN n_regionkey = 2 THEN 'United States of America' WHEN n_regionkey = 3 THEN 'India'
         ELSE n_name END AS country,
    CASE WHEN s_acctbal < 1000 THEN NULL ELSE ' ' || n_name || '   City ' END AS location,
    CASE WHEN s_acctbal >= 7500 THEN ' gold ' WHEN s_acctbal >= 5000 THEN 'SILVER'
         WHEN s_acctbal >= 2500 THEN 'ready' WHEN s_acctbal >= 0 THEN 'bronze' ELSE '' END AS tier,
    CASE WHEN s_acctbal < 2000 THEN NULL
         WHEN s_acctbal < 3000 THEN 'www.supplier-' || CAST(s_suppkey AS VARCHAR) || '.example.com'
         ELSE ' https://supplier-' || CAST(s_suppkey AS VARCHAR) || '.example.com ' END AS website,
    description,
    CASE WHEN s_acctbal >= 250 THEN coalesce(services, []::VARCHAR[]) ELSE []::VARCHAR[] END AS services,
    CASE WHEN s_acctbal >= 750 THEN coalesce(client_references, []::VARCHAR[]) ELSE []::VARCHAR[] END AS client_references,
    CASE WHEN s_acctbal < 500 THEN '' ELSE 'https://directory.example.com/providers/' || CAST(s_suppkey AS VARCHAR) END AS source_url,
    s_suppkey AS seq
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN pv_supp ON s_suppkey = pv_supp.l_suppkey
    LEFT JOIN pv_en ON s_suppkey = pv_en.doc_id)"""

CLEAN_VIEW = f"""
cl AS (
  SELECT coalesce(provider_id, '') AS provider_id, {clean_name('name')} AS name,
    {country('country')} AS country, {clean_text('location')} AS location, {tier('tier')} AS tier,
    {url('website')} AS website, {clean_text('description')} AS description,
    coalesce(services, []::VARCHAR[]) AS services,
    coalesce(client_references, []::VARCHAR[]) AS client_references,
    coalesce(source_url, '') AS source_url, seq
  FROM pv)"""


def _weights_total() -> float:
    total = 0.0
    for w in DEFAULT_WEIGHTS.values():
        total += w
    return total


def _present_str(x: str) -> str:
    return f"coalesce({strip(x)} <> '', false)"


def _urlv(x: str) -> str:
    n = f"regexp_replace(regexp_replace({x}, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g')"
    nl = f"regexp_extract({n}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN 0.5::DOUBLE "
            f"WHEN regexp_matches({n}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]+') "
            f"AND NOT (contains({nl}, '[') <> contains({nl}, ']')) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


def score_view(src: str, name: str = "sc") -> str:
    w = DEFAULT_WEIGHTS
    comp = (f"((CASE WHEN {_present_str('name')} THEN {w['name']}::DOUBLE ELSE 0.0::DOUBLE END"
            f" + CASE WHEN {_present_str('country')} THEN {w['country']}::DOUBLE ELSE 0.0::DOUBLE END"
            f" + CASE WHEN {_present_str('location')} THEN {w['location']}::DOUBLE ELSE 0.0::DOUBLE END"
            f" + CASE WHEN {_present_str('website')} THEN {w['website']}::DOUBLE ELSE 0.0::DOUBLE END"
            f" + CASE WHEN coalesce(len(services) > 0, false) THEN {w['services']}::DOUBLE * "
            f"least(len(services)::DOUBLE / 3.0::DOUBLE, 1.0::DOUBLE) ELSE 0.0::DOUBLE END)"
            f" / {repr(_weights_total())}::DOUBLE)")
    mand = ("CASE WHEN coalesce(name IS NOT NULL AND name <> '' AND country IS NOT NULL AND country <> '' "
            "AND source_url IS NOT NULL AND source_url <> '', false) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
    qual = (f"(({mand} + ({_urlv('website')} + {_urlv('source_url')}) / 2.0::DOUBLE"
            f" + CASE WHEN coalesce(regexp_matches(country, '^(?:^(BD|IN|US)$)'), false) THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END"
            f" + 1.0::DOUBLE"
            f" + CASE WHEN description IS NULL OR description = '' THEN 0.0::DOUBLE ELSE "
            f"least(length(description)::DOUBLE / 200.0::DOUBLE, 1.0::DOUBLE) END) / 5.0::DOUBLE)")
    flags = ("array_to_string(list_sort(list_filter(["
             "CASE WHEN NOT coalesce(name <> '', false) THEN 'missing_name' END, "
             "CASE WHEN NOT coalesce(country <> '', false) THEN 'missing_country' END, "
             "CASE WHEN NOT coalesce(source_url <> '', false) THEN 'missing_source_url' END, "
             "CASE WHEN NOT coalesce(website <> '', false) THEN 'no_website' END, "
             "CASE WHEN description IS NULL OR description = '' OR length(description) < 50 THEN 'short_description' END"
             "], lambda f: f IS NOT NULL)), ',')")
    return (f"{name} AS (SELECT *, {r(comp, 2)} AS data_completeness_score, {r(qual, 2)} AS data_quality_score, "
            f"{flags} AS flags FROM {src})")


def greedy_view(src: str, key: str, seq: str, t: float, prefix: str = "g") -> str:
    """Sequential first-wins scan over distinct lower-cased keys (recursive CTE)."""
    return f"""
{prefix}_names AS (SELECT lower({key}) AS k, min({seq}) AS seq FROM {src}
                   WHERE {key} IS NOT NULL AND {key} <> '' GROUP BY lower({key})),
{prefix}_ord AS (SELECT k, seq, {grams('k')} AS g, row_number() OVER (ORDER BY seq) AS rn FROM {prefix}_names),
{prefix}_walk AS (
  SELECT 0::BIGINT AS rn, []::STRUCT(seq BIGINT, g VARCHAR[])[] AS kept
  UNION ALL
  SELECT o.rn, CASE WHEN len(list_filter(w.kept, lambda x: len(x.g) > 0 AND len(o.g) > 0 AND
           len(list_intersect(x.g, o.g))::DOUBLE / len(list_distinct(list_concat(x.g, o.g)))::DOUBLE >= {t}))
           > 0 THEN w.kept ELSE list_append(w.kept, {{'seq': o.seq, 'g': o.g}}) END
  FROM {prefix}_walk w JOIN {prefix}_ord o ON o.rn = w.rn + 1),
{prefix}_kept AS (SELECT s.seq AS seq FROM (SELECT unnest(kept) AS s FROM {prefix}_walk
                  WHERE rn = (SELECT max(rn) FROM {prefix}_ord)) x),
{prefix}_rows AS (SELECT b.* FROM {src} b LEFT JOIN {prefix}_names n ON lower(b.{key}) = n.k
                  WHERE b.{key} IS NULL OR b.{key} = ''
                     OR (b.{seq} = n.seq AND n.seq IN (SELECT seq FROM {prefix}_kept)))"""


def report_select(src: str) -> str:
    def avg2(c):
        return f"(sum(CAST(round({c} * 100) AS BIGINT))::DOUBLE / (count({c})::DOUBLE * 100.0::DOUBLE))"

    def bands(c, p):
        return (f"coalesce(count_if({c} > 0.8), 0) AS {p}_high, "
                f"coalesce(count_if({c} >= 0.5 AND {c} <= 0.8), 0) AS {p}_medium, "
                f"coalesce(count_if({c} < 0.5), 0) AS {p}_low")
    return (f"SELECT count(*)::BIGINT AS total_providers, "
            f"{r(avg2('data_completeness_score'), 3)} AS average_completeness, "
            f"{r(avg2('data_quality_score'), 3)} AS average_quality, "
            f"{bands('data_completeness_score', 'completeness')}, {bands('data_quality_score', 'quality')} "
            f"FROM {src}")


def flag_freq_select(src: str, top: int = 10) -> str:
    return (f"SELECT flag, count(*)::BIGINT AS providers FROM (SELECT unnest(string_split(flags, ',')) AS flag "
            f"FROM {src} WHERE flags <> '') GROUP BY flag ORDER BY providers DESC, flag LIMIT {top}")


PARTNER_VIEW = """
pr AS (
  SELECT l_orderkey, list({'client_name': p_type, 'description': p_name || ' ' || lower(p_type),
           'modules': [p_name, p_type], 'outcomes': format('qty {:.0f}', l_quantity)}
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS refs
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
pt AS (
  SELECT o_orderkey, c_name, CASE o_orderpriority WHEN '1-URGENT' THEN 'Gold' WHEN '2-HIGH' THEN 'Silver'
           WHEN '3-MEDIUM' THEN 'Ready' ELSE 'Bronze' END AS tier,
         'https://partner-' || CAST(o_custkey AS VARCHAR) || '.example.com' AS website,
         c_mktsegment AS city, CAST(o_orderkey AS VARCHAR) AS partner_id,
         format('{} users', o_custkey) AS avg_size, o_orderpriority AS large_size,
         CASE o_orderstatus WHEN 'F' THEN CAST(c_nationkey AS VARCHAR)
           ELSE format('{} Certified v18, 2 Certified v17', c_nationkey) END AS experts,
         n_name AS country, CAST(greatest(0, least(100, floor(c_acctbal / 100)))::BIGINT AS VARCHAR) || '%' AS retention,
         CAST(coalesce(len(refs), 0) AS VARCHAR) AS ref_count,
         'v18: ' || o_orderstatus || ', v17: ' || c_mktsegment AS certs, refs
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN pr ON o_orderkey = pr.l_orderkey)"""

DIRECTORY_VIEW = """
turns AS (SELECT *, conv_id || '/' || turn AS place, coalesce(length(text), 0) AS n FROM conversations),
listing AS (SELECT conv_id * 2000000 + turn * 2 AS page_id, 'https://directory.example.com/list/' || place AS url, role, place,
    role = 'assistant' AND n < 400 AS blocked,
    CASE WHEN role = 'assistant' AND n > 1500 THEN NULL
         ELSE 'https://directory.example.com/list/' || conv_id || '/' || (turn + 1) END AS next_url FROM turns),
detail AS (SELECT conv_id * 2000000 + turn * 2 + 1 AS page_id, 'https://directory.example.com/providers/' || place AS url,
    place, coalesce(text, '') AS text FROM turns WHERE role = 'user')"""

INDUSTRY_CASE = ("CASE WHEN contains(lower({x}), 'manufacturing') THEN 'Manufacturing' "
                 "WHEN contains(lower({x}), 'retail') THEN 'Retail' "
                 "WHEN contains(lower({x}), 'health') THEN 'Healthcare' "
                 "WHEN contains(lower({x}), 'finance') THEN 'Finance' "
                 "WHEN contains(lower({x}), 'education') THEN 'Education' "
                 "WHEN contains(lower({x}), 'service') THEN 'Services' ELSE 'General' END")

FLAT_VIEW = PARTNER_VIEW + """,
fl_ref AS (
  SELECT pt.*, unnest(refs) AS rf, unnest(range(len(refs))) AS pos FROM pt WHERE coalesce(len(refs), 0) > 0),
flat AS (
  SELECT coalesce(c_name, 'Unknown') AS "Partner Name", tier AS "Partner Tier",
    coalesce(rf.client_name, 'Unknown') AS "Client Name",
    """ + INDUSTRY_CASE.format(x="coalesce(rf.description, '')") + """ AS "Client Industry",
    array_to_string(rf.modules, ', ') AS "Modules Implemented", coalesce(rf.outcomes, '') AS "Key Outcomes",
    coalesce(rf.description, '') AS "Project Description", website AS "Partner Website", city AS "Partner City",
    partner_id AS "Partner ID", avg_size AS "Avg Project Size", large_size AS "Large Project Size",
    experts AS "Certified Experts", ref_count AS "Total References Listed", certs AS "Certifications",
    retention AS "Customer Retention", o_orderkey AS p, pos
  FROM fl_ref
  UNION ALL
  SELECT coalesce(c_name, 'Unknown'), tier, 'N/A', 'N/A', '', '', '', website, city, partner_id, avg_size,
    large_size, experts, ref_count, certs, retention, o_orderkey, 0
  FROM pt WHERE coalesce(len(refs), 0) = 0),
flat_last AS (
  SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY "Partner ID", "Client Name" ORDER BY p DESC, pos DESC) = 1)"""

FLAT_COLS = ", ".join(f'"{c}"' for c in [
    "Partner Name", "Partner Tier", "Client Name", "Client Industry", "Modules Implemented", "Key Outcomes",
    "Project Description", "Partner Website", "Partner City", "Partner ID", "Avg Project Size",
    "Large Project Size", "Certified Experts", "Total References Listed", "Certifications"])

TITLE_CLEAN = f"regexp_replace(lower(coalesce(text, '')), '[^{WORD}{WS}]', '', 'g')"

TFIDF_VIEW = f"""
dt AS (SELECT doc_id, lang, {TITLE_CLEAN} AS t FROM documents),
tok AS (SELECT doc_id, unnest(regexp_extract_all(t, '[{WORD}]{{2,}}')) AS term FROM dt),
tc AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE NOT list_contains({STOP}, term) GROUP BY doc_id, term),
st AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM tc GROUP BY term),
vocab AS (SELECT term, df FROM st ORDER BY cf DESC, term LIMIT 1000),
nd AS (SELECT count(*) AS n FROM documents),
tw AS (SELECT doc_id, term, tf::DOUBLE * (ln((n::DOUBLE + 1.0::DOUBLE) / (df::DOUBLE + 1.0::DOUBLE)) + 1.0::DOUBLE) AS w
       FROM tc JOIN vocab USING (term), nd),
tfidf AS (SELECT doc_id, term, {r('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 6)} AS weight FROM tw)"""

UNESCAPE = ("replace(replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), "
            "'&amp;', '&')")

NAV_LINKS = """
hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages),
links AS (SELECT DISTINCT page_id,
            regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || """ + \
    UNESCAPE.format(x="href") + """ AS link FROM hrefs WHERE href <> '')"""


def _classify_multi(x: str) -> str:
    from ..config import DEFAULT_SERVICE_KEYWORDS
    parts = []
    for label, kws in DEFAULT_SERVICE_KEYWORDS:
        cond = " OR ".join(f"contains(lower({x}), {_sq(k)})" for k in kws)
        parts.append(f"CASE WHEN {cond} THEN {_sq(label)} END")
    return f"coalesce(nullif(concat_ws(', ', {', '.join(parts)}), ''), 'Other')"


def _fmt_kpi(v: str) -> str:
    return f"CASE WHEN {v} > 100 THEN format('{{:,.0f}}', {v}) ELSE format('{{:.1f}}', {v}) END"


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    W = "WITH " + PROVIDER_VIEW + "," + CLEAN_VIEW
    S["c01_clean_providers"] = W + """
SELECT provider_id, name, country, location, tier, website, length(description)::BIGINT AS description_len,
  array_to_string(services, '|') AS services, len(client_references)::BIGINT AS n_references, source_url FROM cl"""
    badged = ("CASE WHEN p_size > 40 THEN p_name || ' gold' WHEN p_size > 30 THEN ' ' || p_name || chr(9) || ' Silver  ' "
              "WHEN p_size > 20 THEN p_name || 'READY' ELSE p_name END")
    S["c02_company_name"] = f"SELECT p_partkey, {clean_name('(' + badged + ')')} AS name FROM part"
    S["c03_country"] = "WITH " + PROVIDER_VIEW + f" SELECT provider_id, {country('country')} AS country FROM pv"
    S["c04_tier"] = "WITH " + PROVIDER_VIEW + f" SELECT provider_id, {tier('tier')} AS tier FROM pv"
    S["c05_clean_text"] = f"SELECT doc_id, {clean_text('text')} AS text FROM documents"
    raw_url = "(' ' || CASE WHEN contains(url, '#') THEN upper(url) ELSE url END)"
    S["c06_clean_url"] = f"SELECT page_id, {url(raw_url)} AS url FROM pages"
    s = strip("x")
    S["c07_industries"] = f"""
SELECT p_brand, array_to_string(list_sort(list_distinct(list_transform(list(' ' || p_type), lambda x:
  CASE {s} WHEN 'ECONOMY' THEN 'Economy' WHEN 'SMALL' THEN 'Small' ELSE
    CASE lower({s}) WHEN 'large' THEN 'Large' WHEN 'medium' THEN 'Medium' WHEN 'promo' THEN 'Promo' ELSE {s} END END))),
  '|') AS industries FROM part GROUP BY p_brand"""
    S["c08_modules"] = f"""
SELECT user_id, array_to_string(list_sort(list_distinct(list_transform(list(event_type), lambda x:
  CASE {s} WHEN 'click' THEN 'Clicks' ELSE
    CASE lower({s}) WHEN 'view' THEN 'View' WHEN 'purchase' THEN 'Purchase' ELSE {s} END END))),
  '|') AS modules FROM events GROUP BY user_id"""
    S["c09_first_int"] = ("SELECT event_id, coalesce(TRY_CAST(nullif(regexp_extract(props, '([0-9]+)', 1), '') AS BIGINT), 0) "
                          "AS n FROM events")
    price = "('From $' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)))"
    S["c10_price_token"] = f"SELECT o_orderkey, regexp_extract({price}, '([0-9]+)', 1) AS price_numeric FROM orders"
    S["c11_clean_price"] = (f"SELECT o_orderkey, coalesce(TRY_CAST(nullif(regexp_replace({price}, '[^0-9]', '', 'g'), '') "
                            f"AS DOUBLE), 0.0) AS price_numeric FROM orders")
    S["c12_clean_title"] = f"SELECT doc_id, {TITLE_CLEAN} AS title_clean FROM documents"
    S["c13_classify_multi"] = f"SELECT doc_id, {_classify_multi('text')} AS service_match FROM documents"
    S["c14_classify_first"] = f"SELECT doc_id, {INDUSTRY_CASE.format(x='coalesce(text, ' + chr(39) * 2 + ')')} AS industry FROM documents"
    S["c15_primary_value"] = ("SELECT p_brand, coalesce(split_part(array_to_string(list_sort(list_distinct(list(p_type))), ','), ',', 1), "
                              "'Unknown') AS primary_type FROM part GROUP BY p_brand")
    S["c16_to_number"] = ("SELECT event_id, coalesce(TRY_CAST(regexp_extract(props, '.*: ([^}]*)', 1) AS DOUBLE), 0.0) AS k, "
                          "coalesce(TRY_CAST(event_type AS DOUBLE), 0.0) AS bad FROM events")
    S["c17_sum_matches"] = ("SELECT l_orderkey, l_linenumber, coalesce(list_sum(list_transform(regexp_extract_all("
                            "CAST(l_linenumber AS VARCHAR) || ' Certified v18, ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) "
                            "|| ' Certified v17', '([0-9]+)\\s+Certified', 1), lambda x: CAST(x AS BIGINT))), 0)::BIGINT AS experts "
                            "FROM lineitem")
    S["c18_join_list"] = ("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(CAST(l_linenumber AS VARCHAR)))), ', ') AS lines "
                          "FROM lineitem GROUP BY l_orderkey")
    S["c19_map_to_text"] = ("SELECT event_id, array_to_string(list_transform(json_keys(props), lambda k: k || ': ' || "
                            "(props->>k)), ', ') AS props_text FROM events")
    S["c20_with_defaults"] = ("SELECT c_custkey, coalesce(source, 'N/A') AS source FROM customer LEFT JOIN "
                              "(SELECT doc_id, source FROM documents) d ON d.doc_id = c_custkey")
    S["c21_blank_nulls"] = W + """
SELECT coalesce(provider_id, '') AS provider_id, coalesce(location, '') AS location,
  coalesce(website, '') AS website, coalesce(description, '') AS description FROM cl"""
    S["c23_format_kpi"] = f"SELECT c_custkey, {_fmt_kpi('(c_acctbal * 10.0::DOUBLE)')} AS display FROM customer"
    S["c26_select_existing"] = "SELECT p_name, p_brand FROM part"
    tc_s = "(p_name || ', 2nd-line')"
    S["c27_title_case"] = (f"SELECT p_partkey, array_to_string(list_transform(range(1, length({tc_s}) + 1), lambda i: "
                           f"CASE WHEN i = 1 OR NOT regexp_matches(substr({tc_s}, i - 1, 1), '^[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]$') "
                           f"THEN upper(substr({tc_s}, i, 1)) ELSE lower(substr({tc_s}, i, 1)) END), '') AS label FROM part")
    # filters
    S["f01_quarantine"] = ("SELECT doc_id, CASE WHEN text IS NOT NULL AND n_chars = length(text) AND n_chars >= 200 "
                           "THEN 'good' ELSE 'quarantine' END AS status FROM documents")
    S["f02_positive_mean"] = (f"SELECT c_mktsegment, {r('avg(CASE WHEN c_acctbal > 0 THEN c_acctbal END)', 4)} AS avg_positive "
                              "FROM customer GROUP BY c_mktsegment")
    S["f03_blocked"] = "WITH " + DIRECTORY_VIEW + " SELECT page_id, blocked FROM listing UNION ALL SELECT page_id, false FROM detail"
    S["f04_link_filter"] = ("WITH " + NAV_LINKS + " SELECT page_id, link FROM links WHERE contains(link, '/th') "
                            "AND NOT contains(link, 'the') AND NOT contains(link, 'that')")
    S["f05_empty_page"] = ("WITH " + DIRECTORY_VIEW + " SELECT page_id, (role = 'user')::BIGINT AS links, role <> 'user' AS empty_page "
                           "FROM listing UNION ALL SELECT page_id, 0, true FROM detail")
    S["f06_fallback"] = "WITH " + NAV_LINKS + " SELECT page_id, count(*)::BIGINT AS links FROM links GROUP BY page_id"
    S["f07_skip_done"] = ("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN "
                          "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
    S["f07_ledger_runs"] = ("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS run "
                            "FROM orders")
    # joins
    J1 = ("SELECT o_orderkey, o_orderpriority, coalesce(c.n, 0)::BIGINT AS client_count FROM orders LEFT JOIN "
          "(SELECT CAST(l_orderkey AS VARCHAR) AS k, count(*) AS n FROM lineitem GROUP BY 1) c "
          "ON CAST(o_orderkey AS VARCHAR) = c.k")
    S["j01_left_join_counts"] = J1
    S["j05_orphans"] = ("SELECT count(*)::BIGINT AS orphans FROM orders WHERE o_orderkey NOT IN "
                        "(SELECT l_orderkey FROM lineitem)")
    S["j05_cascade"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m') AS month "
                        "FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
    # aggregations
    S["a01_value_counts"] = ("SELECT c_mktsegment, count(*)::BIGINT AS count FROM customer WHERE c_mktsegment IS NOT NULL "
                             "GROUP BY 1 ORDER BY count DESC, c_mktsegment")
    S["a02_top_sources"] = ("SELECT source, count(*)::BIGINT AS count FROM documents WHERE source IS NOT NULL GROUP BY 1 "
                            "ORDER BY count DESC, source LIMIT 10")
    S["a03_top_customers"] = ("SELECT o_custkey, count(*)::BIGINT AS orders FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 "
                              "ORDER BY orders DESC, o_custkey LIMIT 10")
    S["a04_distinct_sketches"] = ("SELECT event_type, count(DISTINCT user_id)::BIGINT AS users, true AS close FROM events "
                                  "GROUP BY event_type")
    S["a04_distinct_count"] = "SELECT count(DISTINCT o_custkey)::BIGINT AS partners FROM orders"
    S["a06_coverage"] = ("SELECT 'With References' AS category, count_if(c_acctbal > 0) AS count FROM customer "
                         "UNION ALL SELECT 'No References', count_if(NOT (c_acctbal > 0)) FROM customer")
    S["a07_client_kpis"] = (f"SELECT count(DISTINCT o_custkey)::BIGINT AS total_partners, count(*)::BIGINT AS total_clients, "
                            f"{r('count(*)::DOUBLE / count(DISTINCT o_custkey)::DOUBLE', 1)} AS avg_clients_per_partner FROM orders")
    kp = """
kp AS (SELECT
  (SELECT count(*) FROM customer) AS partners,
  (SELECT count(*) FROM orders) AS clients,
  (SELECT count(DISTINCT n_name) FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey) AS countries,
  (SELECT sum(coalesce(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE), 0.0)) FROM customer) AS experts,
  (SELECT avg(CASE WHEN v > 0 THEN v END) FROM (SELECT coalesce(TRY_CAST(nullif(regexp_extract(o_orderpriority,
      '([0-9]+)', 1), '') AS BIGINT), 0) AS v FROM orders)) AS retention),
mv AS (
  SELECT 'Total Partners' AS metric, partners::DOUBLE AS value FROM kp
  UNION ALL SELECT 'Total Clients', clients::DOUBLE FROM kp
  UNION ALL SELECT 'Countries Covered', countries::DOUBLE FROM kp
  UNION ALL SELECT 'Avg Clients/Partner', coalesce(clients::DOUBLE / nullif(partners, 0)::DOUBLE, 0.0) FROM kp
  UNION ALL SELECT 'Total Certified Experts', experts::DOUBLE FROM kp
  UNION ALL SELECT 'Avg Client Retention', coalesce(retention, 0.0) / 100.0 FROM kp)"""
    S["a08_grand_kpis"] = ("WITH " + kp + f" SELECT metric, {r('value', 6)} AS value, CASE WHEN metric = 'Avg Client Retention' "
                           f"THEN format('{{:.1f}}', value * 100) || '%' ELSE {_fmt_kpi('value')} END AS display FROM mv")
    S["a09_avg_per_tier"] = (f"SELECT o_orderpriority, {r('avg(client_count)', 6)} AS avg_clients FROM ({J1}) "
                             "WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority ORDER BY avg_clients DESC, o_orderpriority")
    S["a10_category_stats"] = (f"SELECT l_returnflag, count(l_extendedprice)::BIGINT AS gig_count, {r('avg(l_extendedprice)', 2)} AS avg_price, "
                               "min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, "
                               "sum(CAST(l_extendedprice AS DECIMAL(28,2)))::DOUBLE AS total_value FROM lineitem "
                               "WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY total_value DESC")
    S["a11_service_stats"] = (f"SELECT service_match, count(n_chars)::BIGINT AS gig_count, {r('avg(n_chars)', 2)} AS avg_price, "
                              f"max(n_chars)::DOUBLE AS max_price FROM (SELECT {_classify_multi('text')} AS service_match, n_chars "
                              "FROM documents) GROUP BY 1 ORDER BY avg_price DESC")
    S["a12_executive_summary"] = f"""
WITH one AS (SELECT count(*) AS n, {r('avg(o_totalprice)', 2)} AS mean, {r('median(o_totalprice)', 2)} AS median,
  sum(CAST(o_totalprice AS DECIMAL(28,2)))::DOUBLE AS total, max(o_totalprice) AS mx FROM orders)
SELECT 'Total Gigs Analyzed' AS metric, n::DOUBLE AS value FROM one
UNION ALL SELECT 'Average Market Price', mean FROM one
UNION ALL SELECT 'Median Market Price', median FROM one
UNION ALL SELECT 'Total Market Value (Est.)', total FROM one
UNION ALL SELECT 'Highest Price Gig', mx FROM one"""
    # quality
    SC = W + "," + score_view("cl")
    S["q04_score_providers"] = SC + " SELECT provider_id, data_completeness_score, data_quality_score, flags FROM sc"
    raw = "CASE WHEN contains(url, '?') THEN replace(url, '://', ':') ELSE url END"
    S["q02b_url_validity"] = f"SELECT page_id, {_urlv('(' + raw + ')')} AS valid FROM pages"
    S["q06_check_mandatory"] = W + """
SELECT provider_id, CASE WHEN coalesce(name IS NOT NULL AND name <> '' AND location IS NOT NULL AND location <> ''
  AND website IS NOT NULL AND website <> '', false) THEN 1 ELSE 0 END AS ok FROM cl"""
    clients = """
clients AS (SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name, CAST(c_nationkey AS VARCHAR) AS provider_id,
  CASE lower(c_mktsegment) WHEN 'building' THEN 'Construction' WHEN 'tech' THEN 'IT & Technology'
    WHEN 'software' THEN 'IT & Technology' WHEN 'farming' THEN 'Agriculture' WHEN 'shop' THEN 'Retail' END AS industry
  FROM customer)"""
    S["q06_mandatory_by_entity"] = f"""
WITH providers AS (SELECT CASE WHEN s_acctbal < 0 THEN '' ELSE s_name END AS name, n_name AS country,
    CASE WHEN s_acctbal < 500 THEN '' ELSE 'url' END AS source_url
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey), {clients},
refs AS (SELECT CAST(o_custkey AS VARCHAR) AS client_id, CASE WHEN l_returnflag = 'R' THEN '' ELSE o_orderpriority END AS description
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
lacks AS (
  SELECT 'providers' AS entity, [('name', coalesce(name, '') = ''), ('country', coalesce(country, '') = ''),
    ('source_url', coalesce(source_url, '') = '')] AS f FROM providers
  UNION ALL SELECT 'clients', [('client_name', coalesce(client_name, '') = ''), ('provider_id', coalesce(provider_id, '') = ''),
    ('industry', coalesce(industry, '') = '')] FROM clients
  UNION ALL SELECT 'references', [('client_id', coalesce(client_id, '') = ''), ('description', coalesce(description, '') = '')] FROM refs),
cells AS (SELECT entity, unnest(f) AS x, 1 AS one FROM lacks)
SELECT entity, x[1] AS field, count(*) AS n_rows, count_if(x[2]) AS n_missing FROM cells GROUP BY 1, 2
UNION ALL SELECT entity, NULL, count(*), count_if(len(list_filter(f, lambda x: x[2])) > 0) FROM lacks GROUP BY 1"""
    S["s06_industry_terms"] = f"WITH {clients} SELECT industry, count(*) AS n_clients FROM clients GROUP BY industry"
    S["q07_constraints"] = """
SELECT 'null_l_orderkey' AS "check", count_if(l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'null_l_returnflag', count_if(l_returnflag IS NULL) FROM lineitem
UNION ALL SELECT 'len2_l_returnflag', count_if(length(l_returnflag) <> 2) FROM lineitem
UNION ALL SELECT 'range_l_discount', count_if(l_discount < 0 OR l_discount > 1) FROM lineitem
UNION ALL SELECT 'range_l_tax', count_if(l_tax < 0 OR l_tax > 1) FROM lineitem
UNION ALL SELECT 'dup_keys', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'orphans', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""
    S["q08_url_pattern"] = ("SELECT s_suppkey, CASE WHEN s_acctbal >= 2000 THEN s_acctbal >= 3000 END AS url_ok "
                             "FROM supplier")
    # X1 and the report family
    X1 = W + "," + greedy_view("cl", "name", "seq", 0.85, "g") + "," + score_view("g_rows")
    S["x1_report"] = X1 + " " + report_select("sc")
    S["x1_issues"] = (X1 + ", ff AS (" + flag_freq_select("sc") + "), tot AS (SELECT count(*) AS total FROM sc) "
                      f"SELECT flag, providers, {r('providers * 100.0::DOUBLE / total', 1)} AS pct FROM ff, tot")
    S["x1_scored"] = X1 + " SELECT provider_id, name, data_completeness_score, data_quality_score, flags FROM sc"
    S["x1_metrics"] = (X1 + " SELECT (SELECT count(*) FROM pv)::BIGINT AS original_count, (SELECT count(*) FROM cl)::BIGINT "
                       "AS cleaned_count, (SELECT count(*) FROM g_rows)::BIGINT AS unique_count")
    S["a13_quality_report"] = SC + " " + report_select("sc")
    S["a15_flag_frequency"] = SC + " " + flag_freq_select("sc")
    # dedup
    S["d01_last_wins"] = ("SELECT user_id, event_type, arg_max(value, event_id) AS value, min(event_id) AS seq FROM events "
                          "GROUP BY user_id, event_type")
    ga, gb = grams("a"), grams("b")
    S["d02_bigram_jaccard"] = (f"SELECT p_partkey, {r(jac('a', 'b', ga, gb), 6)} AS sim FROM (SELECT x.p_partkey, "
                               "lower(x.p_name) AS a, lower(y.p_name) AS b FROM part x JOIN part y ON y.p_partkey = x.p_partkey + 1)")
    S["d03_similar_pairs"] = f"""
WITH nm AS (SELECT lower(p_name) AS k, min(p_partkey) AS seq FROM part WHERE p_name <> '' GROUP BY 1),
g AS (SELECT k, seq, {grams('k')} AS g FROM nm)
SELECT src_k, dst_k, {r('sim', 6)} AS sim FROM (
  SELECT a.k AS src_k, b.k AS dst_k, {jac('a.k', 'b.k', 'a.g', 'b.g')} AS sim FROM g a JOIN g b ON a.seq < b.seq)
WHERE sim >= 0.5"""
    PN = "pn AS (SELECT p_partkey, p_name, p_partkey AS seq FROM part)"
    S["d04_dedup_fuzzy_085"] = "WITH RECURSIVE " + PN + "," + greedy_view("pn", "p_name", "seq", 0.85) + \
        " SELECT p_partkey, p_name FROM g_rows"
    S["d04_dedup_documents"] = f"""
WITH RECURSIVE nm AS (SELECT lower(text) AS k, min(doc_id) AS seq FROM documents WHERE text <> '' GROUP BY 1),
g AS (SELECT seq, {grams('k')} AS g, row_number() OVER (ORDER BY seq) AS rn FROM nm),
tok AS (SELECT rn, len(g) AS n, unnest(g) AS x FROM g),
links AS (SELECT b.rn AS dst, a.rn AS src FROM tok a JOIN tok b ON a.x = b.x AND a.rn < b.rn
          AND a.n >= 0.85 * b.n AND b.n >= 0.85 * a.n
          GROUP BY a.rn, b.rn, a.n, b.n HAVING count(*)::DOUBLE / (a.n + b.n - count(*))::DOUBLE >= 0.85),
near AS (SELECT g.rn, g.seq, coalesce(list(l.src) FILTER (WHERE l.src IS NOT NULL), []) AS earlier
         FROM g LEFT JOIN links l ON l.dst = g.rn GROUP BY g.rn, g.seq),
walk AS (SELECT 0::BIGINT AS rn, []::BIGINT[] AS kept
  UNION ALL SELECT n.rn, CASE WHEN len(list_intersect(n.earlier, w.kept)) > 0 THEN w.kept ELSE list_append(w.kept, n.rn) END
  FROM walk w JOIN near n ON n.rn = w.rn + 1),
stay AS (SELECT unnest(kept) AS rn FROM walk WHERE rn = (SELECT max(rn) FROM near))
SELECT doc_id FROM documents WHERE coalesce(text, '') = '' OR doc_id IN (SELECT seq FROM near JOIN stay USING (rn))"""
    S["d04_dedup_fuzzy_04"] = "WITH RECURSIVE " + PN + "," + greedy_view("pn", "p_name", "seq", 0.4) + \
        " SELECT p_partkey, p_name FROM g_rows"
    SN = "sn AS (SELECT s_suppkey, s_name, s_suppkey AS seq FROM supplier)"
    S["d04_dedup_suppliers"] = "WITH RECURSIVE " + SN + "," + greedy_view("sn", "s_name", "seq", 0.85) + \
        " SELECT s_suppkey, s_name FROM g_rows"
    S["d05_dedup_audit"] = "WITH RECURSIVE " + PN + "," + greedy_view("pn", "p_name", "seq", 0.4) + f""",
kn AS (SELECT o.k, o.seq, o.g FROM g_ord o WHERE o.seq IN (SELECT seq FROM g_kept)),
dn AS (SELECT o.k, o.seq, o.g FROM g_ord o WHERE o.seq NOT IN (SELECT seq FROM g_kept)),
near AS (SELECT d.seq AS first_seq, arg_min(k.seq, k.seq) AS matched_seq,
           arg_min({jac('k.k', 'd.k', 'k.g', 'd.g')}, k.seq) AS similarity
         FROM dn d JOIN kn k ON k.seq < d.seq WHERE {jac('k.k', 'd.k', 'k.g', 'd.g')} >= 0.4 GROUP BY d.seq),
rw AS (SELECT p.seq AS row_seq, n.seq AS first_seq FROM pn p JOIN g_names n ON lower(p.p_name) = n.k)
SELECT row_seq AS dropped_seq, first_seq AS matched_seq, 1.0::DOUBLE AS similarity FROM rw
  WHERE row_seq <> first_seq AND first_seq IN (SELECT seq FROM g_kept)
UNION ALL
SELECT rw.row_seq, near.matched_seq, {r('near.similarity', 6)} FROM rw JOIN near ON rw.first_seq = near.first_seq"""
    S["d06_distinct_links"] = "WITH " + NAV_LINKS + " SELECT DISTINCT link FROM links"
    S["u01_union"] = ("SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
                      "UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier")
    # nested
    S["n01_flatten"] = "WITH " + FLAT_VIEW + f" SELECT {FLAT_COLS} FROM flat"
    S["n02_flatten_dedup_sort"] = "WITH " + FLAT_VIEW + f" SELECT {FLAT_COLS} FROM flat_last"
    S["n03_array_contains"] = ("SELECT p_partkey, list_has_any(string_split(p_name, ' '), ['red', 'blue']) AS any_match, "
                               "list_has_all(string_split(p_name, ' '), ['red', 'blue']) AS all_match FROM part")
    S["n04_term_search"] = ("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split_regex(lower(p_name), "
                            "'[^\\p{L}\\p{N}_]+'), 'red')")
    S["o01_tier_sort_top"] = ("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders ORDER BY CASE o_orderpriority "
                              "WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END, o_custkey, "
                              "o_orderkey LIMIT 20")
    # pages
    S["h01_links"] = "WITH " + NAV_LINKS + " SELECT page_id, link FROM links"
    txt = lambda pat: f"trim({UNESCAPE.format(x=f'regexp_extract(html, {_sq(pat)}, 1)')})"
    S["h02_records"] = f"""
SELECT page_id, {txt('(?s)<h1>(.*?)</h1>')} AS name, {txt('(?s)<div class="ad">(.*?)</div>')} AS tier,
  {txt('(?s)<footer>(.*?)</footer>')} AS location,
  {UNESCAPE.format(x="regexp_extract(html, '<li><a href=\"([^\"]*)\"', 1)")} AS website,
  array_to_string(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1),
    lambda x: trim({UNESCAPE.format(x='x')})), '|') AS services,
  len(regexp_extract_all(html, '<a href="[^"]*"'))::BIGINT AS n_refs
FROM pages"""
    S["h07_next_page"] = "WITH " + DIRECTORY_VIEW + " SELECT page_id, next_url AS link FROM listing WHERE next_url IS NOT NULL"
    S["h09_collect_target"] = "WITH RECURSIVE " + DIRECTORY_VIEW + """,
chain(url, depth) AS (
  SELECT DISTINCT 'https://directory.example.com/list/' || conv_id || '/0', 1 FROM conversations
  UNION ALL
  SELECT l.next_url, c.depth + 1 FROM chain c JOIN listing l USING (url)
  WHERE c.depth < 10 AND NOT l.blocked AND l.next_url IS NOT NULL)
SELECT d.page_id AS seq, 'Partner ' || d.place AS name, 'BD' AS country, trim(d.text, E' \\t\\n\\r') AS description,
       'user,turn' AS services, d.url AS source_url
FROM detail d WHERE d.place IN (SELECT place FROM listing JOIN chain USING (url) WHERE NOT blocked AND role = 'user')"""
    S["h08_page_chain"] = """
WITH RECURSIVE nodes AS (SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url
                         FROM conversations),
edges AS (SELECT a.url, b.url AS next_url FROM nodes a JOIN nodes b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
chain(start_url, depth, url) AS (
  SELECT url, 1, url FROM nodes WHERE turn = 0
  UNION ALL
  SELECT c.start_url, c.depth + 1, e.next_url FROM chain c JOIN edges e ON e.url = c.url
  WHERE c.depth < 10 AND e.next_url <> e.url)
SELECT start_url, depth, url FROM chain"""
    # text
    S["m01_vocabulary"] = f"""
WITH dt AS (SELECT doc_id, {TITLE_CLEAN} AS t FROM documents),
tok AS (SELECT doc_id, unnest(regexp_extract_all(t, '[{WORD}]{{2,}}')) AS term FROM dt),
tc AS (SELECT doc_id, term, count(*) AS tf FROM tok WHERE NOT list_contains({STOP}, term) GROUP BY doc_id, term)
SELECT term, sum(tf)::BIGINT AS cf, count(*)::BIGINT AS df FROM tc GROUP BY term ORDER BY cf DESC, term LIMIT 1000"""
    S["m02_tfidf"] = "WITH " + TFIDF_VIEW + " SELECT doc_id, term, weight FROM tfidf"
    S["m04_top_terms_by_lang"] = "WITH " + TFIDF_VIEW + """,
mass AS (SELECT lang, term, sum(CAST(weight AS DECIMAL(20,6))) AS mass FROM tfidf JOIN dt USING (doc_id) GROUP BY ALL)
SELECT lang, rank::BIGINT AS rank, term FROM (
  SELECT lang, term, row_number() OVER (PARTITION BY lang ORDER BY mass DESC, term) AS rank FROM mass) WHERE rank <= 3"""
    # dashboards
    S["x3_client_industries"] = ("WITH " + FLAT_VIEW + ", pi AS (SELECT coalesce(split_part(\"Client Industry\", ',', 1), 'Unknown') "
                                 "AS \"Primary Industry\" FROM flat_last) SELECT \"Primary Industry\", count(*)::BIGINT AS count "
                                 "FROM pi GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10")
    S["x3_client_kpis"] = ("WITH " + FLAT_VIEW + f" SELECT count(DISTINCT \"Partner ID\")::BIGINT AS total_partners, "
                           f"count(*)::BIGINT AS total_clients, {r('count(*)::DOUBLE / count(DISTINCT \"Partner ID\")::DOUBLE', 1)} "
                           "AS avg_clients_per_partner FROM flat_last")
    S["x3_top_partners"] = ("WITH " + FLAT_VIEW + " SELECT \"Partner Name\", count(*)::BIGINT AS client_count FROM flat_last "
                            "GROUP BY 1 ORDER BY client_count DESC, 1 LIMIT 10")
    S["x3_project_sizes"] = ("WITH " + FLAT_VIEW + " SELECT \"Large Project Size\", count(*)::BIGINT AS count FROM flat_last "
                             "GROUP BY 1 ORDER BY count DESC, 1 LIMIT 5")
    S["x4_partners_by_tier"] = ("WITH " + PARTNER_VIEW + " SELECT tier, count(*)::BIGINT AS count FROM pt GROUP BY 1 "
                                "ORDER BY count DESC, tier")
    S["x5_coverage"] = ("WITH " + PARTNER_VIEW + " SELECT 'With References' AS category, "
                        "count_if(coalesce(TRY_CAST(ref_count AS DOUBLE), 0) > 0) AS count FROM pt UNION ALL "
                        "SELECT 'No References', count_if(NOT (coalesce(TRY_CAST(ref_count AS DOUBLE), 0) > 0)) FROM pt")
    # sources / sinks round trips: the rows that went in must come back
    S["s01_envelope_roundtrip"] = "SELECT * FROM customer"
    S["s02_mixed_roundtrip"] = "SELECT * FROM supplier"
    S["s04_csv_roundtrip"] = "SELECT * FROM part"
    S["k01_flat_csv"] = ("SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_type))), '; ') AS names FROM part "
                         "GROUP BY p_brand")
    S["k02_json_roundtrip"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                               "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders")
    S["s01_envelope_parts"] = S["k02_json_roundtrip"]
    S["k03_run_metrics"] = ("WITH g AS (SELECT * FROM documents WHERE text IS NOT NULL AND n_chars = length(text) "
                            "AND n_chars >= 200) SELECT (SELECT count(*) FROM documents)::BIGINT AS original_count, "
                            "(SELECT count(*) FROM g)::BIGINT AS cleaned_count, "
                            "(SELECT count(DISTINCT text) FROM g)::BIGINT AS unique_count")
    S["k06_partitioned_roundtrip"] = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
    S["j02_dictionary_join"] = "WITH " + PROVIDER_VIEW + f" SELECT provider_id, {country('country')} AS country FROM pv"
    S["st01_stream_last_wins"] = S["d01_last_wins"]
    S["s03_lists_only"] = "SELECT * FROM part WHERE p_size <= 25"
    S["s05_latest_file"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"
    S["k04_flat_clients_csv"] = S["n02_flatten_dedup_sort"]
    S["k05_gig_csv"] = ("SELECT 'https://gigs.example.com/' || CAST(doc_id AS VARCHAR) AS link, length(text)::BIGINT AS title_len, "
                        "coalesce(source, '') AS seller_name, 'From $' || format('{:,}', n_chars) AS price, "
                        "regexp_extract('From $' || format('{:,}', n_chars), '([0-9]+)', 1) AS price_numeric FROM documents")
    S["k07_report_tables"] = S["x1_report"]
    S["x2_clean_dedup"] = (W + "," + greedy_view("cl", "name", "seq", 0.85, "g") + """
SELECT provider_id, name, country, location, tier, website, length(description)::BIGINT AS description_len,
  array_to_string(services, '|') AS services, len(client_references)::BIGINT AS n_references, source_url FROM g_rows""")
    S["q05_empty_report"] = SC + " " + report_select("(SELECT * FROM sc WHERE country = 'ZZ')")
    S["x4_avg_clients_per_tier"] = ("WITH " + FLAT_VIEW + ", cc AS (SELECT \"Partner ID\" AS k, count(*) AS n FROM flat_last "
                                    "WHERE \"Client Name\" <> 'N/A' GROUP BY 1) SELECT tier AS \"Partner Tier\", "
                                    + r("avg(coalesce(n, 0))", 6) + " AS avg_clients FROM pt LEFT JOIN cc ON partner_id = cc.k "
                                    "WHERE tier IS NOT NULL GROUP BY tier")
    S["x4_top_countries"] = ("WITH " + PARTNER_VIEW + " SELECT country, count(*)::BIGINT AS count FROM pt WHERE country IS NOT NULL "
                             "GROUP BY 1 ORDER BY count DESC, country LIMIT 10")
    kp4 = """
kp AS (SELECT
  (SELECT count(*) FROM pt) AS partners,
  (SELECT count(*) FROM flat_last WHERE "Client Name" <> 'N/A') AS clients,
  (SELECT count(DISTINCT country) FROM pt) AS countries,
  (SELECT sum(coalesce(TRY_CAST(experts AS DOUBLE), 0.0)) FROM pt) AS experts,
  (SELECT avg(CASE WHEN v > 0 THEN v END) FROM (SELECT coalesce(TRY_CAST(nullif(regexp_extract("Customer Retention",
      '([0-9]+)', 1), '') AS BIGINT), 0) AS v FROM flat_last WHERE "Client Name" <> 'N/A')) AS retention)"""
    mv = kp[kp.index("mv AS"):]
    S["x4_grand_kpis"] = ("WITH " + FLAT_VIEW + "," + kp4 + ",\n" + mv + f" SELECT metric, {r('value', 6)} AS value, "
                          "CASE WHEN metric = 'Avg Client Retention' THEN format('{:.1f}', value * 100) || '%' ELSE "
                          f"{_fmt_kpi('value')} END AS display FROM mv")
    fi = "coalesce(TRY_CAST(nullif(regexp_extract({x}, '([0-9]+)', 1), '') AS BIGINT), 0)"
    S["x3_clients_clean"] = ("WITH " + FLAT_VIEW + " SELECT \"Partner ID\", \"Client Name\", "
                             + fi.format(x='"Avg Project Size"') + " AS \"Project Size (Numeric)\", "
                             "coalesce(split_part(\"Client Industry\", ',', 1), 'Unknown') AS \"Primary Industry\", "
                             + fi.format(x='"Customer Retention"') + " AS \"Retention (Numeric)\" FROM flat_last")
    S["x4_partners_clean"] = ("WITH " + PARTNER_VIEW + " SELECT partner_id AS \"Partner ID\", "
                              "coalesce(TRY_CAST(ref_count AS DOUBLE), 0.0) AS \"References Count\", "
                              "coalesce(TRY_CAST(experts AS DOUBLE), 0.0) AS \"Certified Experts\", "
                              "coalesce(list_sum(list_transform(regexp_extract_all(experts, '([0-9]+)\\s+Certified', 1), "
                              "lambda x: CAST(x AS BIGINT))), 0)::BIGINT AS \"Experts (Parsed)\" FROM pt")
    S["m06_market_services"] = S["a11_service_stats"].replace("service_match", "Service_Match")
    S["m06_market_summary"] = f"""
WITH one AS (SELECT count(*) AS n, {r('avg(n_chars)', 2)} AS mean, {r('median(n_chars)', 2)} AS median,
  sum(CAST(n_chars AS DECIMAL(28,2)))::DOUBLE AS total, max(n_chars)::DOUBLE AS mx FROM documents)
SELECT 'Total Gigs Analyzed' AS metric, n::DOUBLE AS value FROM one
UNION ALL SELECT 'Average Market Price', mean FROM one
UNION ALL SELECT 'Median Market Price', median FROM one
UNION ALL SELECT 'Total Market Value (Est.)', total FROM one
UNION ALL SELECT 'Highest Price Gig', mx FROM one"""
    # recursive CTEs need the RECURSIVE keyword on the outer WITH
    for k, v in list(S.items()):
        if "_walk" in v and not v.lstrip().startswith("WITH RECURSIVE"):
            S[k] = v.replace("WITH ", "WITH RECURSIVE ", 1)
    return S
