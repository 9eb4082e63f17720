"""The numbered operators as registered queries over the whole given tables, and DuckDB SQL for
those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (ann, collocations, decontamination, exact_dedup, lang_id, lexical, mixing, near_dup, packing, token_binary,
               token_counts, toxicity, url_filter)
from .common import table

REG: dict = {}
SQL: dict[str, str] = {}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def q(name):
    def deco(fn):
        REG[name] = fn
        return fn
    return deco


@q("op3_exact_dedup")
def op3(spark, d):
    return exact_dedup.exact_dedup(table(spark, d, "documents"))


SQL["op3_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_FOLD} AS t FROM documents)
WINDOW w AS (PARTITION BY t)"""


@q("op7_source_mix")
def op7(spark, d):
    return mixing.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        F.try_element_at("positions", F.lit(1)).alias("position"))


SQL["op7_source_mix"] = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")}) AS size, md5(coalesce(text, '')) AS digest FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM src),
capped AS (SELECT *, ((rk - 1) % {len(mixing.CYCLE)} + 1)::DOUBLE AS weight,
                  source_size * {mixing.MAX_EPOCHS} AS top FROM ranked),
filled AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total,
    coalesce(sum(top) OVER (ORDER BY top / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
    sum(weight) OVER (ORDER BY top / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM capped),
flagged AS (SELECT *, (total - below) * weight >= top * ahead AS is_full FROM filled),
opened AS (SELECT *, sum(CASE WHEN is_full THEN top ELSE 0 END) OVER ()::BIGINT AS spent,
                  sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE weight END) OVER () AS wopen FROM flagged),
plan AS (SELECT *, CASE WHEN is_full THEN top::DOUBLE WHEN wopen > 0 THEN (total - spent) * weight / wopen
                   ELSE 0.0 END AS target FROM opened),
goals AS (SELECT *, floor(target + 0.5)::BIGINT AS goal, ceil(docs / {mixing.BUCKET}.0)::BIGINT AS buckets FROM plan),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS epochs,
                 goal - CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * source_size AS part FROM goals),
placed AS (SELECT p.rk, s.doc_id, s.size, p.buckets, p.part,
    ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || s.size::VARCHAR || ':' || s.digest), 1, 8))::BIGINT AS h
    FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
bucketed AS (SELECT *, (h * buckets) >> 32 AS bucket FROM placed),
ordered AS (SELECT *, row_number() OVER w AS n, (sum(size) OVER w)::BIGINT - size AS inside FROM bucketed
    WINDOW w AS (PARTITION BY rk, bucket ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING)),
sums AS (SELECT rk, bucket, part, sum(size)::BIGINT AS words FROM ordered GROUP BY rk, bucket, part),
runs AS (SELECT *, (sum(words) OVER (PARTITION BY rk ORDER BY bucket))::BIGINT - words AS prior FROM sums),
split AS (SELECT o.*, r.part - r.prior AS room, 4 * (o.inside + o.size) > 3 * (r.part - r.prior) AS late
         FROM ordered o JOIN runs r USING (rk, bucket) WHERE r.prior + r.words > r.part AND r.prior < r.part),
tail AS (SELECT rk, n AS place, size, room, row_number() OVER (
         PARTITION BY rk ORDER BY late, CASE WHEN late THEN -size ELSE 0 END, h, doc_id, size) AS n FROM split),
greedy(rk, n, place, room, took) AS (
  SELECT DISTINCT rk, 0::BIGINT, 0::BIGINT, room, false FROM tail
  UNION ALL
  SELECT g.rk, t.n, t.place, CASE WHEN t.size <= g.room THEN g.room - t.size ELSE g.room END, t.size <= g.room
  FROM greedy g JOIN tail t ON t.rk = g.rk AND t.n = g.n + 1),
taken AS (SELECT o.rk, o.doc_id, o.size, r.prior + o.inside AS place,
    CASE WHEN r.prior + r.words <= r.part THEN 1 WHEN r.prior < r.part THEN coalesce(g.took, false)::INT ELSE 0 END AS extra
  FROM ordered o JOIN runs r USING (rk, bucket)
  LEFT JOIN greedy g ON g.rk = o.rk AND g.place = o.n AND r.prior + r.words > r.part AND r.prior < r.part)
SELECT t.doc_id, t.size, p.source_size, p.target, ((p.epochs + t.extra) * t.size)::BIGINT AS taken,
       (p.epochs + t.extra)::INT AS copies,
       CASE WHEN p.epochs + t.extra > 0 THEN least(t.place / greatest(p.goal, 1), 1.0) END AS position
FROM taken t JOIN parts p USING (rk)"""


@q("op10_minhash_near_dedup")
def op10(spark, d):
    return near_dup.near_duplicates(table(spark, d, "documents"), shingle=4)


SQL["op10_minhash_near_dedup"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_FOLD)} AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) >= 4
        THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS gs FROM w),
s AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS x FROM g),
links AS (SELECT a.doc_id AS p, b.doc_id AS o FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(p, o) AS (SELECT p, o FROM links UNION SELECT r.p, l.o FROM reach r JOIN links l ON r.o = l.p),
least_of AS (SELECT p, min(o) AS m FROM reach GROUP BY p),
classes AS (SELECT list_sort(gs) AS k, count(*) AS c FROM g WHERE len(gs) > 0 GROUP BY 1)
SELECT g.doc_id, len(g.gs)::BIGINT AS n_shingles, least(g.doc_id, coalesce(l.m, g.doc_id)) AS component_id,
       g.doc_id = least(g.doc_id, coalesce(l.m, g.doc_id)) AS kept, coalesce(c.c, 1)::BIGINT AS class_size
FROM g LEFT JOIN least_of l ON g.doc_id = l.p LEFT JOIN classes c ON len(g.gs) > 0 AND list_sort(g.gs) = c.k"""


@q("op4_language_mixture")
def op4(spark, d):
    return lang_id.identify_documents(table(spark, d, "documents"))


@q("op9_toxicity")
def op9(spark, d):
    return toxicity.score_toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@q("op1_best_fit_packing")
def op1(spark, d):
    return packing.pack(table(spark, d, "documents"), length=token_counts.token_length(F.col("text")))


@q("op5_token_histogram")
def op5(spark, d):
    return token_counts.suffix_sums(token_counts.histogram(table(spark, d, "documents")))


@q("op6_adaptive_ann")
def op6(spark, d):
    return ann.nearest(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@q("op8_training_order_shards")
def op8(spark, d):
    return token_binary.materialise(table(spark, d, "documents")).drop("file")


def url_inputs(spark, d):
    """Captures and list entries from the given tables: a page is fetched at the time of the event with
    its number; an event dates an entry about the page that has its user's number. Types and values
    choose the kind, the list, and whether the pattern is added or removed."""
    events, pages = table(spark, d, "events"), table(spark, d, "pages")
    captures = (pages.join(events, F.col("page_id") == F.col("event_id"), "left")
                .select(F.col("page_id").alias("capture_id"), "url", F.col("ts").alias("fetched")))
    # a page's URL is rewritten once, before it meets its events
    normed = pages.select("page_id", url_filter.normal_url(F.col("url")).alias("norm"))
    kind = (F.when(F.col("event_type") == "error", "domain").when(F.col("event_type") == "click", "host")
            .when(F.col("event_type") == "view", "prefix").otherwise("url"))
    host = F.substring_index("norm", "/", 1)
    pattern = (F.when(F.col("kind") == "domain", F.substring_index(host, ".", -3)).when(F.col("kind") == "host", host)
               .when(F.col("kind") == "prefix", F.substring_index("norm", "/", 2)).otherwise(F.col("norm")))
    entries = (events.join(normed, F.col("user_id") == F.col("page_id"))
               .select(F.col("event_id").alias("entry_id"), kind.alias("kind"), "norm",
                       F.when(F.col("event_type") == "purchase", "allow").otherwise("block").alias("list"),
                       F.when(F.col("value") >= 30, "add").otherwise("remove").alias("action"), F.col("ts").alias("at"))
               .select("entry_id", "list", "kind", pattern.alias("pattern"), "action", "at"))
    return captures, entries


@q("op2_temporal_url_filter")
def op2(spark, d):
    return url_filter.filter_urls(*url_inputs(spark, d)).select("capture_id", "url", "blocked", "n_active", "decided_by")


_NORM = r"""(CASE WHEN length(lower(regexp_replace(regexp_replace(split_part(bare, '/', 1), '^.*@', ''), ':\d*$', ''))) > 0
  THEN lower(regexp_replace(regexp_replace(split_part(bare, '/', 1), '^.*@', ''), ':\d*$', ''))
       || regexp_replace(regexp_extract(bare, '^[^/]*([\s\S]*)$', 1), '/+$', '') END)"""

SQL["op2_temporal_url_filter"] = rf"""
WITH bare AS (SELECT page_id, url, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://', ''), '[?#][\s\S]*$', '') AS bare
              FROM pages),
norm AS (SELECT page_id, url, {_NORM} AS norm FROM bare),
caps AS (SELECT n.page_id, n.url, n.norm, e.ts AS fetched FROM norm n LEFT JOIN events e ON n.page_id = e.event_id),
raw AS (SELECT e.event_id, e.ts AS dated, CASE WHEN e.event_type = 'purchase' THEN 'allow' ELSE 'block' END AS list,
    CASE e.event_type WHEN 'error' THEN 'domain' WHEN 'click' THEN 'host' WHEN 'view' THEN 'prefix' ELSE 'url' END AS kind,
    CASE WHEN e.value >= 30 THEN 'add' ELSE 'remove' END AS action, n.norm, string_split(split_part(n.norm, '/', 1), '.') AS labels
  FROM events e JOIN norm n ON e.user_id = n.page_id),
entries AS (SELECT *, CASE kind WHEN 'domain' THEN array_to_string(labels[greatest(len(labels) - 2, 1):], '.')
    WHEN 'host' THEN split_part(norm, '/', 1) WHEN 'prefix' THEN array_to_string(string_split(norm, '/')[1:2], '/')
    ELSE norm END AS pattern FROM raw WHERE norm IS NOT NULL AND dated IS NOT NULL),
lasts AS (SELECT list, kind, pattern, dated, max({{'a': action, 'i': event_id}}) AS x FROM entries GROUP BY ALL),
lines AS (SELECT *, lead(dated) OVER (PARTITION BY list, kind, pattern ORDER BY dated) AS upto FROM lasts),
live AS (SELECT * FROM lines WHERE x.a = 'add'),
asked AS (SELECT DISTINCT norm, fetched FROM caps WHERE norm IS NOT NULL AND fetched IS NOT NULL),
labelled AS (SELECT *, string_split(split_part(norm, '/', 1), '.') AS labels, string_split(norm, '/') AS parts FROM asked),
keyed AS (SELECT norm, fetched, 'url' AS kind, norm AS key FROM labelled
  UNION ALL SELECT norm, fetched, 'host', split_part(norm, '/', 1) FROM labelled
  UNION ALL SELECT norm, fetched, 'domain', unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) FROM labelled
  UNION ALL SELECT norm, fetched, 'prefix', unnest(list_transform(range(1, len(parts) + 1), lambda i: array_to_string(parts[1:i], '/'))) FROM labelled),
hits AS (SELECT DISTINCT k.norm, k.fetched, l.list, l.kind, l.pattern, l.dated FROM keyed k JOIN live l ON k.kind = l.kind AND k.key = l.pattern
         AND l.dated <= k.fetched AND (l.upto IS NULL OR k.fetched < l.upto)),
verdict AS (SELECT norm, fetched, count(*) AS n, bool_or(list = 'block') AS anyblock,
    max({{'r': CASE kind WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END, 'l': length(pattern),
         'w': (list = 'allow')::INT, 'name': list || ':' || kind || ':' || pattern}}) AS top
  FROM hits GROUP BY norm, fetched)
SELECT c.page_id AS capture_id, c.url, coalesce(v.anyblock AND v.top.w = 0, false) AS blocked, coalesce(v.n, 0) AS n_active,
       v.top.name AS decided_by
FROM caps c LEFT JOIN verdict v ON c.norm = v.norm AND c.fetched = v.fetched"""


@q("op11_phrase_collocations")
def op11(spark, d):
    return collocations.collocations(table(spark, d, "documents"))


SQL["op11_phrase_collocations"] = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLD}, '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, 1 AS m, unnest(ws) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i + 1], ' '))) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) FROM w),
f AS (SELECT lang, m, phrase, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
cuts AS (SELECT lang, phrase, m, c, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (SELECT x.lang, x.phrase, x.c AS a, h.c AS l, t.c AS r, x.k,
    (1000000::HUGEINT * x.c * x.c) // (h.c::HUGEINT * t.c) AS score
  FROM cuts x JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(x.ws[1:x.k], ' ')
  JOIN f t ON t.lang = x.lang AND t.phrase = array_to_string(x.ws[x.k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, c, ws[1:2] AS p FROM cuts WHERE m = 3 UNION ALL SELECT lang, c, ws[2:3] FROM cuts WHERE m = 3),
beyond AS (SELECT lang, array_to_string(p, ' ') AS phrase, max(c) AS c FROM parts GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN beyond b ON s.lang = b.lang AND s.phrase = b.phrase
         WHERE b.c IS NULL OR 100 * b.c < {collocations.EXTENSION} * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {collocations.TOP}"""


@q("op12_ranked_search")
def op12(spark, d):
    return lexical.search(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


_TERMS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op12_ranked_search"] = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
full_docs AS (SELECT doc_id, len(ws) AS n, ws FROM d WHERE len(ws) > 0),
figures AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM full_docs),
tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ws) AS term FROM full_docs) GROUP BY ALL),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM tfs, figures WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scores AS (SELECT a.item_id, t.doc_id,
    sum(a.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * t.n * g.docs) // g.length))))::BIGINT AS score
  FROM asked a JOIN weights w USING (term) JOIN tfs t USING (term), figures g GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10"""


@q("op13_benchmark_decontamination")
def op13(spark, d):
    found = decontamination.passages(table(spark, d, "documents"), table(spark, d, "benchmark"))
    hit = decontamination.n_hit(F.col("spans"))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


SQL["op13_benchmark_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {_TERMS} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_TERMS} AS ws FROM benchmark),
pats AS (SELECT DISTINCT item, least(len(ws), 10) AS m,
         unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2), lambda i: array_to_string(ws[i:i + 9], ' '))) AS p
         FROM b WHERE len(ws) > 0),
lens AS (SELECT DISTINCT m FROM pats),
spots AS (SELECT row_no, m, unnest(range(1, len(ws) - m + 2)) AS spot, ws FROM d, lens WHERE len(ws) >= m),
hits AS (SELECT s.row_no, s.spot, s.m, p.item FROM spots s JOIN pats p ON p.m = s.m AND p.p = array_to_string(s.ws[s.spot:s.spot + s.m - 1], ' ')),
covered AS (SELECT row_no, count(DISTINCT pos) AS n_hit FROM (SELECT row_no, unnest(range(spot, spot + m)) AS pos FROM hits) GROUP BY row_no),
named AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT row_no, item FROM hits) GROUP BY row_no)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (row_no) LEFT JOIN named n USING (row_no)"""
