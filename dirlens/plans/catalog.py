"""Registered queries: one (spark, sf_dir) -> DataFrame per operator of the
inventory, each bound to the given tables and run over them whole.

Outputs are flat scalar columns (arrays and maps joined to text) with names
that match the SQL checks in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Dictionary, QualityRules
from ..functions import classify as K
from ..functions import clean as C
from ..functions.text import bigram_jaccard
from ..operators import dedup as D
from ..operators import nested as N
from ..operators import pages as H
from ..operators import quality as Q
from ..operators import stats as A
from ..operators import termindex as TI
from ..operators import textml as M
from ..operators.clean_records import clean_providers
from ..session import cut
from . import pipelines as X
from .bindings import SITE, directory_pages, entity_tables, partner_directory, partner_pages, provider_view, table

REG: dict = {}


def q(name):
    def deco(fn):
        REG[name] = fn
        return fn
    return deco


def _flat_provider(df: DataFrame) -> DataFrame:
    return df.select("provider_id", "name", "country", "location", "tier", "website",
                     F.length("description").cast("bigint").alias("description_len"),
                     F.array_join("services", "|").alias("services"),
                     F.size("client_references").cast("bigint").alias("n_references"),
                     "source_url")


# ---------------------------------------------------------------- cleaning
@q("c01_clean_providers")
def c01(spark, d):
    return _flat_provider(clean_providers(provider_view(spark, d)))


def _badged_part_name(p: DataFrame):
    sz = F.col("p_size")
    return (F.when(sz > 40, F.concat(F.col("p_name"), F.lit(" gold")))
            .when(sz > 30, F.concat(F.lit(" "), F.col("p_name"), F.lit("\t Silver  ")))
            .when(sz > 20, F.concat(F.col("p_name"), F.lit("READY")))
            .otherwise(F.col("p_name")))


@q("c02_company_name")
def c02(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", C.clean_company_name(_badged_part_name(p)).alias("name"))


@q("c03_country")
def c03(spark, d):
    v = provider_view(spark, d)
    return v.select("provider_id", C.normalize_country("country").alias("country"))


@q("c04_tier")
def c04(spark, d):
    v = provider_view(spark, d)
    return v.select("provider_id", C.normalize_tier("tier").alias("tier"))


@q("c05_clean_text")
def c05(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", C.clean_text("text").alias("text"))


@q("c06_clean_url")
def c06(spark, d):
    pg = table(spark, d, "pages")
    raw = F.concat(F.lit(" "), F.when(F.col("url").contains("#"), F.upper(F.col("url"))).otherwise(F.col("url")))
    return pg.select("page_id", C.clean_url(raw).alias("url"))


BRAND_TERMS = Dictionary(industry_taxonomy=["Large", "Medium", "Promo"],
                         industry_aliases={"ECONOMY": "Economy", "SMALL": "Small"})


@q("c07_industries")
def c07(spark, d):
    p = table(spark, d, "part")
    # collect_set: bounded by the type domain, de-duplicated map-side (the result is a set anyway)
    g = p.groupBy("p_brand").agg(F.collect_set(F.concat(F.lit(" "), F.col("p_type"))).alias("a"))
    return g.select("p_brand", F.array_join(C.normalize_industries("a", BRAND_TERMS), "|").alias("industries"))


EVENT_MODULES = Dictionary(core_modules=["View", "Purchase"], module_aliases={"click": "Clicks"})


@q("c08_modules")
def c08(spark, d):
    e = table(spark, d, "events")
    g = e.groupBy("user_id").agg(F.collect_set("event_type").alias("a"))
    return g.select("user_id", F.array_join(C.normalize_modules("a", EVENT_MODULES), "|").alias("modules"))


@q("c09_first_int")
def c09(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", C.first_int("props").alias("n"))


def _price_text(col):
    return F.concat(F.lit("From $"), F.format_number(F.floor(col), 0))


@q("c10_price_token")
def c10(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", C.price_token(_price_text(F.col("o_totalprice"))).alias("price_numeric"))


@q("c11_clean_price")
def c11(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", C.clean_price(_price_text(F.col("o_totalprice"))).alias("price_numeric"))


@q("c12_clean_title")
def c12(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", C.clean_title("text").alias("title_clean"))


@q("c13_classify_multi")
def c13(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", K.classify_multi("text").alias("service_match"))


@q("c14_classify_first")
def c14(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", K.classify_first("text").alias("industry"))


@q("c15_primary_value")
def c15(spark, d):
    p = table(spark, d, "part")
    g = p.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_set("p_type")), ",").alias("types"))
    return g.select("p_brand", C.primary_value("types").alias("primary_type"))


@q("c16_to_number")
def c16(spark, d):
    e = table(spark, d, "events")
    inner = F.substring_index(F.substring_index(F.col("props"), ": ", -1), "}", 1)
    return e.select("event_id", C.to_number(inner).alias("k"), C.to_number("event_type").alias("bad"))


@q("c17_sum_matches")
def c17(spark, d):
    li = table(spark, d, "lineitem")
    s = F.concat(F.col("l_linenumber").cast("string"), F.lit(" Certified v18, "),
                 F.col("l_quantity").cast("int").cast("string"), F.lit(" Certified v17"))
    return li.select("l_orderkey", "l_linenumber", C.sum_matches(s).alias("experts"))


@q("c18_join_list")
def c18(spark, d):
    li = table(spark, d, "lineitem")
    g = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.col("l_linenumber").cast("string"))).alias("a"))
    return g.select("l_orderkey", C.join_list("a").alias("lines"))


@q("c19_map_to_text")
def c19(spark, d):
    e = table(spark, d, "events")
    m = F.from_json(F.col("props"), "map<string,string>")
    return e.select("event_id", C.map_to_text(m).alias("props_text"))


@q("c20_with_defaults")
def c20(spark, d):
    # more customers than documents: the missing values are those of customers without a document
    c = table(spark, d, "customer")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("c_custkey"), F.col("source"))
    return C.with_defaults(c.join(docs, "c_custkey", "left"), {"source": "N/A"}).select("c_custkey", "source")


@q("c21_blank_nulls")
def c21(spark, d):
    cl = clean_providers(provider_view(spark, d))
    return C.blank_nulls(cl.select("provider_id", "location", "website", "description"))


@q("c23_format_kpi")
def c23(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", C.format_kpi(F.col("c_acctbal") * 10.0).alias("display"))


@q("c26_select_existing")
def c26(spark, d):
    return C.select_existing(table(spark, d, "part"), ["p_name", "seller_name", "p_brand", "link"])


@q("c27_title_case")
def c27(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", C.title_case(F.concat(F.col("p_name"), F.lit(", 2nd-line"))).alias("label"))


# ---------------------------------------------------------------- filters
QUARANTINE_MIN_CHARS = 200


@q("f01_quarantine")
def f01(spark, d):
    docs = table(spark, d, "documents")
    rule = F.col("text").isNotNull() & (F.col("n_chars") == F.length("text")) & (F.col("n_chars") >= QUARANTINE_MIN_CHARS)
    good, bad = Q.split_quarantine(docs, rule, "short or inconsistent text")
    return (good.select("doc_id", F.lit("good").alias("status"))
            .unionByName(bad.select("doc_id", F.lit("quarantine").alias("status"))))


@q("f02_positive_mean")
def f02(spark, d):
    c = table(spark, d, "customer")
    return c.groupBy("c_mktsegment").agg(C.round_half_up(A.positive_mean("c_acctbal"), 4).alias("avg_positive"))


@q("f03_blocked")
def f03(spark, d):
    pg = directory_pages(spark, d)
    return pg.select("page_id", H.blocked("html").alias("blocked"))


def _nav_links(spark, d):
    return H.extract_links(table(spark, d, "pages"), "nav a")


@q("f04_link_filter")
def f04(spark, d):
    return H.link_filter(_nav_links(spark, d), include="/th", exclude=("the", "that"))


@q("f05_empty_page")
def f05(spark, d):
    pg = directory_pages(spark, d)
    return H.link_counts(pg, H.extract_links(pg, "a.provider-link"))


@q("f06_fallback")
def f06(spark, d):
    pg = table(spark, d, "pages")
    links = H.extract_links(pg, "div.col-12.mb-4 > div > a.text-decoration-none", fallback="nav li > a")
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))


@q("f07_skip_done")
def f07(spark, d):
    o = table(spark, d, "orders")
    done = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(done, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@q("f07_ledger_runs")
def f07_ledger(spark, d):
    # three runs over the orders, each with what the ledger has left: finished, open, and all of them
    from ..operators.ledger import Ledger
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    ledger = Ledger(spark, _scratch(spark, "ledger"))
    out = None
    for run, rows in enumerate([o.where(F.col("o_orderstatus") == "F"), o.where(F.col("o_orderstatus") == "O"), o], 1):
        fresh = cut(ledger.pending(rows, "o_orderkey").select("o_orderkey", F.lit(run).alias("run")))
        ledger.record(fresh, "o_orderkey")
        out = fresh if out is None else out.unionByName(fresh)
    return out


# ---------------------------------------------------------------- joins
@q("j01_left_join_counts")
def j01(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return A.left_join_counts(o, table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@q("j05_orphans")
def j05(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    return Q.orphans(o, li, "o_orderkey", "l_orderkey").agg(F.count(F.lit(1)).alias("orphans"))


@q("j05_cascade")
def j05_cascade(spark, d):
    from ..operators.cascade import cascade_delete
    path = _scratch(spark, "cascade")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                         F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    o.write.partitionBy("month").parquet(path)
    cascade_delete(spark, path, ["month"], "o_orderkey", table(spark, d, "lineitem"), "l_orderkey")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                           F.col("month").cast("string").alias("month"))


# ---------------------------------------------------------------- aggregations
@q("a01_value_counts")
def a01(spark, d):
    return A.value_counts(table(spark, d, "customer"), "c_mktsegment")


@q("a02_top_sources")
def a02(spark, d):
    return A.top_values(table(spark, d, "documents"), "source", 10)


@q("a03_top_customers")
def a03(spark, d):
    return A.top_values(table(spark, d, "orders"), "o_custkey", 10, "orders")


@q("a04_distinct_count")
def a04(spark, d):
    return A.distinct_count(table(spark, d, "orders"), "o_custkey", name="partners")


@q("a04_distinct_sketches")
def a04_sketches(spark, d):
    # sketches for every day and type, merged to the type; the estimate stands within a tenth of the exact count
    ev = table(spark, d, "events")
    days = A.distinct_sketches(ev.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    exact = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    both = exact.join(A.merge_sketches(days, ["event_type"], "estimate"), "event_type")
    return both.select("event_type", "users", (F.abs(F.col("estimate") - F.col("users")) * 10 <= F.col("users")).alias("close"))


@q("a06_coverage")
def a06(spark, d):
    return A.coverage_split(table(spark, d, "customer"), "c_acctbal")


@q("a07_client_kpis")
def a07(spark, d):
    return A.client_kpis(table(spark, d, "orders"), "o_custkey")


@q("a08_grand_kpis")
def a08(spark, d):
    cust = table(spark, d, "customer")
    nation = table(spark, d, "nation")
    partners = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    clients = table(spark, d, "orders")
    experts = C.to_number(F.col("c_acctbal").cast("string"))
    retention = C.first_int(F.col("o_orderpriority"))
    return A.grand_kpis(partners, clients, "n_name", experts, retention).drop("pos")


@q("a09_avg_per_tier")
def a09(spark, d):
    return A.avg_by(j01(spark, d), "o_orderpriority", "client_count", "avg_clients")


@q("a10_category_stats")
def a10(spark, d):
    return A.category_stats(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", digits=2)


@q("a11_service_stats")
def a11(spark, d):
    docs = table(spark, d, "documents").withColumn("service_match", K.classify_multi("text"))
    return A.service_stats(docs, "service_match", "n_chars", digits=2)


@q("a12_executive_summary")
def a12(spark, d):
    return A.executive_summary(table(spark, d, "orders"), "o_totalprice", digits=2).drop("pos")


# ---------------------------------------------------------------- quality + X1
def _scored(spark, d):
    return Q.score_providers(clean_providers(provider_view(spark, d)))


@q("q04_score_providers")
def q04(spark, d):
    s = _scored(spark, d)
    return s.select("provider_id", "data_completeness_score", "data_quality_score",
                    Q.flags_text("quality_flags").alias("flags"))


@q("q02b_url_validity")
def q02b(spark, d):
    pg = table(spark, d, "pages")
    raw = F.when(F.col("url").contains("?"), F.regexp_replace("url", "://", ":")).otherwise(F.col("url"))
    return pg.select("page_id", Q.url_validity(raw).alias("valid"))


@q("q06_check_mandatory")
def q06(spark, d):
    cl = clean_providers(provider_view(spark, d))
    return cl.select("provider_id", Q.check_mandatory(cl, ["name", "location", "website"]).alias("ok"))


@q("q06_mandatory_by_entity")
def q06e(spark, d):
    return Q.mandatory_report(entity_tables(spark, d))


@q("s06_industry_terms")
def s06(spark, d):
    return entity_tables(spark, d)["clients"].groupBy("industry").agg(F.count(F.lit(1)).alias("n_clients"))


@q("q07_constraints")
def q07(spark, d):
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    return Q.constraint_report(li, ["l_orderkey", "l_linenumber"], o, "l_orderkey", "o_orderkey",
                               not_null=["l_orderkey", "l_returnflag"], len2=["l_returnflag"],
                               unit_interval=["l_discount", "l_tax"])


@q("q08_url_pattern")
def q08(spark, d):
    p = provider_view(spark, d)
    return p.select(F.col("seq").alias("s_suppkey"), F.trim("website").rlike(QualityRules().url_pattern).alias("url_ok"))


def _x1(spark, d):
    return X.run_pipeline(provider_view(spark, d))


@q("x1_report")
def x1_report(spark, d):
    return _x1(spark, d)["report"]


@q("x1_issues")
def x1_issues(spark, d):
    return _x1(spark, d)["issues"]


@q("x1_scored")
def x1_scored(spark, d):
    s = _x1(spark, d)["scored"]
    return s.select("provider_id", "name", "data_completeness_score", "data_quality_score",
                    Q.flags_text("quality_flags").alias("flags"))


@q("x1_metrics")
def x1_metrics(spark, d):
    return _x1(spark, d)["metrics"]


@q("a15_flag_frequency")
def a15(spark, d):
    return Q.flag_frequency(_scored(spark, d))


@q("a13_quality_report")
def a13(spark, d):
    return Q.quality_report(_scored(spark, d))


# ---------------------------------------------------------------- dedup
@q("d01_last_wins")
def d01(spark, d):
    e = table(spark, d, "events").select("user_id", "event_type", "value", F.col("event_id").alias("seq"))
    return D.dedup_last(e, ["user_id", "event_type"], "seq")


@q("d02_bigram_jaccard")
def d02(spark, d):
    p = table(spark, d, "part")
    a = p.select("p_partkey", F.lower("p_name").alias("a"))
    b = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.lower("p_name").alias("b"))
    return a.join(b, "p_partkey").select("p_partkey", C.round_half_up(bigram_jaccard("a", "b"), 6).alias("sim"))


def _part_named(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", F.col("p_partkey").alias("seq"))


@q("d03_similar_pairs")
def d03(spark, d):
    e = D.similar_pairs(_part_named(spark, d), "p_name", "seq", 0.5, with_keys=True)
    return e.select("src_k", "dst_k", C.round_half_up("sim", 6).alias("sim"))


@q("d04_dedup_fuzzy_085")
def d04a(spark, d):
    return D.dedup_fuzzy(_part_named(spark, d), "p_name", "seq", 0.85).select("p_partkey", "p_name")


@q("d04_dedup_fuzzy_04")
def d04b(spark, d):
    return D.dedup_fuzzy(_part_named(spark, d), "p_name", "seq", 0.4).select("p_partkey", "p_name")


@q("d04_dedup_suppliers")
def d04c(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_suppkey").alias("seq"))
    return D.dedup_fuzzy(s, "s_name", "seq", 0.85).select("s_suppkey", "s_name")


@q("d05_dedup_audit")
def d05(spark, d):
    _, audit = D.dedup_fuzzy(_part_named(spark, d), "p_name", "seq", 0.4, with_audit=True)
    return audit.select("dropped_seq", "matched_seq", C.round_half_up("similarity", 6).alias("similarity"))


@q("d06_distinct_links")
def d06(spark, d):
    return D.distinct_values(_nav_links(spark, d), "link")


@q("u01_union")
def u01(spark, d):
    c = table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s, allowMissingColumns=True)


# ---------------------------------------------------------------- nested
@q("n01_flatten")
def n01(spark, d):
    return N.flatten_references(partner_pages(spark, d)).drop("seq")


@q("n02_flatten_dedup_sort")
def n02(spark, d):
    return N.flatten_dedup_sort(partner_pages(spark, d)).drop("seq")


@q("n03_array_contains")
def n03(spark, d):
    p = table(spark, d, "part")
    path = _scratch(spark, "index")
    TI.write_index(p, path, "p_partkey", F.split("p_name", " "))
    index = TI.TermIndex(spark, path)
    some = index.find_any(["red", "blue"]).select("key", F.lit(True).alias("any_match"))
    every = index.find_all(["red", "blue"]).select("key", F.lit(True).alias("all_match"))
    found = some.join(every, "key", "left").withColumnRenamed("key", "p_partkey")
    return (p.select("p_partkey").join(found, "p_partkey", "left")
            .select("p_partkey", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("any_match", "all_match")]))


@q("n04_term_search")
def n04(spark, d):
    p = table(spark, d, "part")
    path = _scratch(spark, "index")
    TI.write_index(p, path, "p_partkey", N.name_terms("p_name"))
    found = TI.TermIndex(spark, path).find_all(["red"]).withColumnRenamed("key", "p_partkey")
    return p.join(found, "p_partkey", "left_semi").select("p_partkey", "p_name")


@q("o01_tier_sort_top")
def o01(spark, d):
    o = table(spark, d, "orders")
    rank = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return (o.orderBy(N.tier_rank("o_orderpriority", rank), F.col("o_custkey"), F.col("o_orderkey"))
            .limit(20).select("o_orderkey", "o_custkey", "o_orderpriority"))


# ---------------------------------------------------------------- pages
@q("h01_links")
def h01(spark, d):
    return _nav_links(spark, d)


@q("h02_records")
def h02(spark, d):
    sel = {"name": "h1", "tier": "div.ad", "location": "footer", "website": "nav li > a",
           "description": "article > h1", "services": "nav li", "references": "ul a"}
    r = H.extract_records(table(spark, d, "pages"), sel)
    return r.select(F.col("seq").alias("page_id"), "name", "tier", "location", "website",
                    F.array_join("services", "|").alias("services"),
                    F.size("client_references").cast("bigint").alias("n_refs"))


@q("h08_page_chain")
def h08(spark, d):
    conv = table(spark, d, "conversations")
    node = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    nodes = conv.select("conv_id", "turn", node.alias("url"))
    nxt = nodes.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("url").alias("next_url"))
    edges = nodes.join(nxt, ["conv_id", "turn"], "left").select("url", "next_url")
    starts = nodes.where(F.col("turn") == 0).select(F.col("url").alias("start_url"))
    return H.page_chain(starts, edges, 10)


# ---------------------------------------------------------------- text ML
@q("m01_vocabulary")
def m01(spark, d):
    tc = M.term_counts(table(spark, d, "documents").select("doc_id", C.clean_title("text").alias("t")), "doc_id", "t")
    return M.fit_vocab(tc, 1000).select("term", F.col("cf").cast("bigint").alias("cf"),
                                        F.col("df").cast("bigint").alias("df"))


@q("m02_tfidf")
def m02(spark, d):
    docs = table(spark, d, "documents").select("doc_id", C.clean_title("text").alias("t"))
    return M.tfidf(docs, "doc_id", "t", 1000).select(F.col("doc").alias("doc_id"), "term", "weight")


@q("m04_top_terms_by_lang")
def m04(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", C.clean_title("text").alias("t"))
    w = M.tfidf(docs, "doc_id", "t", 1000)
    mass = (w.join(docs.select(F.col("doc_id").alias("doc"), "lang"), "doc")
            .groupBy("lang", "term").agg(F.sum(F.col("weight").cast("decimal(20,6)")).alias("mass")))
    from pyspark.sql.window import Window
    win = Window.partitionBy("lang").orderBy(F.desc("mass"), F.asc("term"))
    return (mass.withColumn("rank", F.row_number().over(win)).where(F.col("rank") <= 3)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "term"))


def _gigs(spark, d):
    docs = table(spark, d, "documents")
    return docs.select(F.col("text").alias("title"), F.col("source").alias("seller_name"),
                       F.concat(F.lit("From $"), F.format_number(F.col("n_chars"), 0)).alias("price"),
                       F.concat(F.lit("https://gigs.example.com/"), F.col("doc_id").cast("string")).alias("link"))


@q("m06_market_categories")
def m06(spark, d):
    out = M.analyze_market(_gigs(spark, d), digits=2)
    return out["category_analysis"]


@q("m06_market_services")
def m06s(spark, d):
    return M.market_services(_gigs(spark, d), digits=2)


@q("m06_market_summary")
def m06e(spark, d):
    return M.market_summary(_gigs(spark, d), digits=2).drop("pos")


# ---------------------------------------------------------------- dashboards
@q("x3_client_industries")
def x3_ind(spark, d):
    flat = N.flatten_dedup_sort(partner_pages(spark, d))
    return A.top_values(flat.withColumn("Primary Industry", C.primary_value("Client Industry")),
                        "Primary Industry", 10)


@q("x3_client_kpis")
def x3_kpi(spark, d):
    return A.client_kpis(N.flatten_dedup_sort(partner_pages(spark, d)))


@q("x3_top_partners")
def x3_top(spark, d):
    flat = N.flatten_dedup_sort(partner_pages(spark, d))
    return A.top_values(flat, "Partner Name", 10, "client_count")


@q("x3_project_sizes")
def x3_size(spark, d):
    flat = N.flatten_dedup_sort(partner_pages(spark, d))
    return A.top_values(flat, "Large Project Size", 5)


@q("x4_partners_by_tier")
def x4_tier(spark, d):
    return A.value_counts(partner_directory(spark, d), "tier")


@q("x5_coverage")
def x5_cov(spark, d):
    return A.coverage_split(partner_directory(spark, d), "reference_count_listed")


# ---------------------------------------------------------------- sources / sinks
def _scratch(spark, name):
    from ..session import scratch_path
    return scratch_path(spark, name)


@q("s01_envelope_roundtrip")
def s01(spark, d):
    from ..sources import io
    cust = table(spark, d, "customer")
    path = _scratch(spark, "envelope")
    io.write_envelope(cust, path, "providers", {"country_code": "XX"}, rows_per_file=500)
    return io.read_envelope(spark, path, "providers", cust.schema).drop("seq")


@q("s01_envelope_parts")
def s01_parts(spark, d):
    from ..sources import io
    from ..sources.json_parts import read_parts
    o = table(spark, d, "orders")
    path = _scratch(spark, "envelope-parts")
    io.write_envelope(o, path, "providers", {"country_code": "XX"}, rows_per_file=1 << 40, bytes_per_file=1 << 30)
    good, _ = read_parts(spark, path, o.schema, "providers", part_bytes=1 << 20)
    return good.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


@q("s02_mixed_roundtrip")
def s02(spark, d):
    from ..sources import io
    sup = table(spark, d, "supplier")
    path = _scratch(spark, "mixed")
    io.write_envelope(sup.where(F.col("s_acctbal") >= 5000), path + "/env", "partners", rows_per_file=40)
    io.write_lists(sup.where(~(F.col("s_acctbal") >= 5000)), path + "/lists", rows_per_file=40)
    spark.createDataFrame([("{not json",)], "value string").write.mode("overwrite").text(path + "/bad")
    good, bad = io.read_mixed(spark, path, "partners", sup.schema, with_quarantine=True)
    return good.drop("seq")


@q("s04_csv_roundtrip")
def s04(spark, d):
    from ..sources import io
    p = table(spark, d, "part")
    path = _scratch(spark, "csv")
    p.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return io.read_table(spark, path, p.schema)


@q("k01_flat_csv")
def k01(spark, d):
    from ..sources import io
    p = table(spark, d, "part")
    g = p.groupBy("p_brand").agg(F.sort_array(F.collect_set("p_type")).alias("names"))
    path = _scratch(spark, "flatcsv")
    io.to_flat_csv(g, path)
    return io.read_table(spark, path, T.StructType([T.StructField("p_brand", T.StringType()),
                                                    T.StructField("names", T.StringType())]))


@q("k02_json_roundtrip")
def k02(spark, d):
    from ..sources import io
    o = table(spark, d, "orders")
    path = _scratch(spark, "json")
    io.write_json(o, path)
    back = spark.read.schema(o.schema).json(path)
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")


@q("k03_run_metrics")
def k03(spark, d):
    docs = table(spark, d, "documents")
    good = docs.where(F.col("text").isNotNull() & (F.col("n_chars") == F.length("text"))
                      & (F.col("n_chars") >= QUARANTINE_MIN_CHARS))
    unique = good.select("text").distinct()
    return X.run_metrics(docs, good, unique)


@q("k06_partitioned_roundtrip")
def k06(spark, d):
    from ..sources import io
    c = table(spark, d, "customer")
    path = _scratch(spark, "partitioned")
    io.write_partitioned(c, path, ["c_mktsegment"])
    return spark.read.parquet(path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@q("j02_dictionary_join")
def j02(spark, d):
    from ..sources import io
    keys = io.dictionary_frames(spark)["country_keys"]
    v = provider_view(spark, d).select("provider_id", "country")
    return io.normalize_country_join(v, "country", keys)


@q("d04_dedup_documents")
def d04d(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("doc_id").alias("seq"))
    return D.dedup_fuzzy(docs, "text", "seq", 0.85).select("doc_id")


# ---------------------------------------------------------------- streaming, more sources/sinks
@q("st01_stream_last_wins")
def st01(spark, d):
    from ..session import scratch_path
    from ..streaming.ingest import stream_last_wins
    ev = table(spark, d, "events")
    out = stream_last_wins(spark, d, ev.schema, ["user_id", "event_type"], "event_id",
                           scratch_path(spark, "stream"), file_glob="events.parquet")
    return out.select("user_id", "event_type", "value", F.col("event_id").alias("seq"))


@q("s03_lists_only")
def s03(spark, d):
    from ..sources import io
    p = table(spark, d, "part")
    path = _scratch(spark, "lists")
    io.write_lists(p.where(F.col("p_size") <= 25), path + "/lists", rows_per_file=300)
    io.write_envelope(p.where(F.col("p_size") > 25), path + "/env", "gigs", rows_per_file=300)
    good, rejected = io.read_lists(spark, path, p.schema)
    return good.drop("seq")


@q("s05_latest_file")
def s05(spark, d):
    import time
    from ..sources import io
    o = table(spark, d, "orders")
    path = _scratch(spark, "latest")
    o.where(F.col("o_orderstatus") != "F").write.mode("overwrite").parquet(path + "/run1")
    time.sleep(1.5)
    o.where(F.col("o_orderstatus") == "F").write.mode("overwrite").parquet(path + "/run2")
    return io.read_newest(spark, path, o.schema, by="folder").select("o_orderkey", "o_custkey", "o_orderstatus")


@q("k04_flat_clients_csv")
def k04(spark, d):
    from ..schemas import FLAT_CLIENT_COLUMNS
    from ..sources import io
    flat = io.export_columns(N.flatten_dedup_sort(partner_pages(spark, d)), FLAT_CLIENT_COLUMNS)
    path = _scratch(spark, "clients")
    # an order without lines is a client row too, so there are rows exactly when there are orders
    io.to_flat_csv(flat, path, source=table(spark, d, "orders"), compression="gzip")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in FLAT_CLIENT_COLUMNS])
    return io.read_table(spark, path, schema).na.fill("")


@q("k05_gig_csv")
def k05(spark, d):
    from ..sources import io
    gigs = _gigs(spark, d).withColumn("price_numeric", C.price_token(F.col("price")))
    cols = ["title", "seller_name", "price", "link", "price_numeric"]
    path = _scratch(spark, "gigs")
    io.to_flat_csv(io.export_columns(gigs, cols), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    back = io.read_table(spark, path, schema).na.fill("")
    return back.select(F.col("link"), F.length("title").cast("bigint").alias("title_len"), "seller_name",
                       "price", "price_numeric")


@q("k07_report_tables")
def k07(spark, d):
    from ..sources import io
    out = _x1(spark, d)
    path = _scratch(spark, "report")
    io.write_report({"report": out["report"], "issues": out["issues"]}, path)
    return spark.read.parquet(path + "/report")


@q("x2_clean_dedup")
def x2(spark, d):
    _, unique = X.clean_and_dedup(provider_view(spark, d))
    return _flat_provider(unique)


@q("q05_empty_report")
def q05(spark, d):
    return Q.quality_report(_scored(spark, d).where(F.col("country") == "ZZ"))


@q("h07_next_page")
def h07(spark, d):
    return H.next_page_links(directory_pages(spark, d), "a[rel='next']")


@q("h09_collect_target")
def h09(spark, d):
    from ..config import target_named
    target = dict(target_named("bangladesh"), base_url=SITE)
    # the listing of every conversation starts at its turn 0
    starts = table(spark, d, "conversations").select(
        F.concat(F.lit(SITE + "/list/"), F.col("conv_id").cast("string"), F.lit("/0")).alias("start_url")).distinct()
    recs = H.collect_target(directory_pages(spark, d), target, starts)
    return recs.select("seq", "name", "country", "description", F.array_join("services", ",").alias("services"), "source_url")


def _partner_clients(spark, d):
    flat = N.flatten_dedup_sort(partner_pages(spark, d), extra={"customer_retention": "Customer Retention"})
    return flat.where(F.col("Client Name") != "N/A")


@q("x4_avg_clients_per_tier")
def x4_avg(spark, d):
    partners = partner_directory(spark, d).select(F.col("partner_id").alias("Partner ID"), F.col("tier").alias("Partner Tier"))
    joined = A.left_join_counts(partners, _partner_clients(spark, d), "Partner ID", "Partner ID", "client_count")
    return A.avg_by(joined, "Partner Tier", "client_count", "avg_clients")


@q("x4_top_countries")
def x4_countries(spark, d):
    return A.top_values(partner_directory(spark, d), "country", 10)


@q("x4_grand_kpis")
def x4_kpis(spark, d):
    partners = partner_directory(spark, d)
    clients = _partner_clients(spark, d)
    return A.grand_kpis(partners, clients, "country", C.to_number("certified_experts"),
                        C.first_int(F.col("Customer Retention"))).drop("pos")


@q("x3_clients_clean")
def x3_clean(spark, d):
    flat = N.flatten_dedup_sort(partner_pages(spark, d), extra={"customer_retention": "Customer Retention"})
    return flat.select("Partner ID", "Client Name",
                       C.first_int("Avg Project Size").alias("Project Size (Numeric)"),
                       C.primary_value("Client Industry").alias("Primary Industry"),
                       C.first_int("Customer Retention").alias("Retention (Numeric)"))


@q("x4_partners_clean")
def x4_clean(spark, d):
    p = partner_directory(spark, d)
    return p.select(F.col("partner_id").alias("Partner ID"),
                    C.to_number("reference_count_listed").alias("References Count"),
                    C.to_number("certified_experts").alias("Certified Experts"),
                    C.sum_matches(F.col("certified_experts")).alias("Experts (Parsed)"))
