"""Bindings: shape the given tables into the library's entities.

Each view is a declarative DataFrame over the whole tables, so Catalyst
prunes columns and pushes filters into the parquet scans. The same shapes
are written as SQL in ``__spark_entry__.oracle_sql`` for the DuckDB check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def provider_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw provider records (PROVIDER_RAW + seq), one per supplier.

    name/country/tier/location/website/source_url carry the dirt the cleaner
    must remove (badges, odd whitespace, country names, bad URLs, blanks),
    derived from each supplier's balance and region. description is the
    document with the supplier's id; services are the distinct part types and
    client_references the distinct part brands of all the supplier's lines
    (lineitem ⋈ part), missing for low balances. Both are sets over small
    domains, de-duplicated map-side, so no array grows with the data.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    docs = table(spark, sf_dir, "documents")

    lines = li.select("l_suppkey", "l_partkey")
    per_supp = (lines.join(p.select("p_partkey", "p_type", "p_brand"), lines.l_partkey == p.p_partkey)
                .groupBy("l_suppkey")
                .agg(F.sort_array(F.collect_set("p_type")).alias("services"),
                     F.sort_array(F.collect_set("p_brand")).alias("client_references")))
    # texts of no supplier are left behind before any text is shuffled
    text = (docs.select(F.col("doc_id"), F.col("text").alias("description"))
            .join(s.select(F.col("s_suppkey").alias("doc_id")), "doc_id", "left_semi"))

    bal = F.col("s_acctbal")
    sid = F.col("s_suppkey").cast("string")
    name = (F.when(bal >= 8000, F.concat(F.col("s_name"), F.lit(" Gold")))
            .when(bal >= 6000, F.concat(F.lit("  "), F.col("s_name"), F.lit("  silver ")))
            .when(bal < 0, F.lit(""))
            .otherwise(F.col("s_name")))
    country = (F.when(F.col("n_regionkey") == 0, F.lit("bangladesh"))
               .when(F.col("n_regionkey") == 1, F.lit("us"))
               .when(F.col("n_regionkey") == 2, F.lit("United States of America"))
               .when(F.col("n_regionkey") == 3, F.lit("India"))
               .otherwise(F.col("n_name")))
    location = F.when(bal < 1000, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(" "), F.col("n_name"), F.lit("   City ")))
    tier = (F.when(bal >= 7500, F.lit(" gold ")).when(bal >= 5000, F.lit("SILVER"))
            .when(bal >= 2500, F.lit("ready")).when(bal >= 0, F.lit("bronze")).otherwise(F.lit("")))
    website = (F.when(bal < 2000, F.lit(None).cast("string"))
               .when(bal < 3000, F.concat(F.lit("www.supplier-"), sid, F.lit(".example.com")))
               .otherwise(F.concat(F.lit(" https://supplier-"), sid, F.lit(".example.com "))))
    source_url = F.when(bal < 500, F.lit("")).otherwise(
        F.concat(F.lit("https://directory.example.com/providers/"), sid))
    empty = F.array().cast("array<string>")

    base = (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .join(per_supp, s.s_suppkey == per_supp.l_suppkey, "left")
            .join(text, s.s_suppkey == text.doc_id, "left"))
    return base.select(
        sid.alias("provider_id"), name.alias("name"), country.alias("country"),
        location.alias("location"), tier.alias("tier"), website.alias("website"),
        F.col("description"),
        F.when(bal >= 250, F.coalesce(F.col("services"), empty)).otherwise(empty).alias("services"),
        F.when(bal >= 750, F.coalesce(F.col("client_references"), empty)).otherwise(empty).alias("client_references"),
        source_url.alias("source_url"),
        F.col("s_suppkey").alias("seq"))


PARTNER_TIER = {"1-URGENT": "Gold", "2-HIGH": "Silver", "3-MEDIUM": "Ready"}


def _line_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines joined to their part: one client reference each."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    return li.join(p.select("p_partkey", "p_name", "p_type"), F.col("l_partkey") == F.col("p_partkey"))


def _partner_columns(partner_id=None) -> list:
    tier = F.coalesce(*[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in PARTNER_TIER.items()],
                      F.lit("Bronze"))
    certs = F.map_from_arrays(F.array(F.lit("v18"), F.lit("v17")),
                              F.array(F.col("o_orderstatus"), F.col("c_mktsegment")))
    # a plain number, or the breakdown by version
    experts = (F.when(F.col("o_orderstatus") == "F", F.col("c_nationkey").cast("string"))
               .otherwise(F.format_string("%d Certified v18, 2 Certified v17", F.col("c_nationkey"))))
    kept = F.greatest(F.lit(0), F.least(F.lit(100), F.floor(F.col("c_acctbal") / 100)))
    return [F.col("c_name").alias("company_name"), tier.alias("tier"),
            F.concat(F.lit("https://partner-"), F.col("o_custkey").cast("string"),
                     F.lit(".example.com")).alias("website"),
            F.col("c_mktsegment").alias("city"),
            (F.col("o_orderkey").cast("string") if partner_id is None else partner_id).alias("partner_id"),
            F.format_string("%d users", F.col("o_custkey")).alias("average_project_size"),
            F.col("o_orderpriority").alias("large_project_size"),
            experts.alias("certified_experts"),
            F.coalesce(F.col("n_refs"), F.lit(0)).cast("string").alias("reference_count_listed"),
            certs.alias("certifications"), F.col("n_name").alias("country"),
            F.concat(kept.cast("string"), F.lit("%")).alias("customer_retention")]


def _partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(n, c.c_nationkey == n.n_nationkey, "left"))


def partner_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partners, one flat row per order (the dashboards' partner table) + seq.

    A partner is an order; its reference count is the number of its lines. No
    arrays are built, so nothing grows with a hot order.
    """
    counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_refs"))
    base = _partners(spark, sf_dir)
    return (base.join(counts, base.o_orderkey == counts.l_orderkey, "left")
            .select(*_partner_columns(), F.col("o_orderkey").alias("seq")))


REFS_PER_PAGE = 5


def partner_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detailed partner records (PARTNER_DETAILED + seq) as page-wise partial files.

    Like the partial files the original ingests, a partner appears in several records of at most
    ``REFS_PER_PAGE`` client references (its lines), and in one without references if it has no lines. The
    lines are in a total order (line number, part, supplier, quantity, price, ship date; line numbers repeat within an
    order), and ``seq`` is (order, page). A client is the part's type, so the same client
    recurs within a partner and the last-wins dedup has work to do. No record grows with the data.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    # lines, pages and orders meet by the partner's id, never null here, so that the rows of one partner stay together
    # through the flattening and the last-wins dedup that follow without being dealt out again
    lines = Window.partitionBy("__partner")
    ref = F.struct(F.col("p_type").alias("client_name"),
                   F.concat_ws(" ", F.col("p_name"), F.lower(F.col("p_type"))).alias("description"),
                   F.array(F.col("p_name"), F.col("p_type")).alias("modules_implemented"),
                   F.format_string("qty %.0f", F.col("l_quantity")).alias("outcomes"))
    refs = (_line_refs(spark, sf_dir).where(F.col("l_orderkey").isNotNull())
            .withColumn("__partner", F.coalesce(F.col("l_orderkey").cast("string"), F.lit("")))
            .select("__partner", "p_name", "p_type", "l_quantity",
                    F.row_number().over(lines.orderBy(*order)).alias("n"), F.count(F.lit(1)).over(lines).alias("n_refs"))
            .select("__partner", ref.alias("ref"), "n", "n_refs"))
    # one pass over the lines of an order gives both its pages and their number
    pages = (refs.groupBy("__partner", F.floor((F.col("n") - 1) / REFS_PER_PAGE).alias("page"))
             .agg(F.max("n_refs").alias("n_refs"), F.sort_array(F.collect_list(F.struct("n", "ref"))).alias("refs")))
    none = F.array().cast(T.ArrayType(refs.schema["ref"].dataType))
    base = _partners(spark, sf_dir).withColumn("partner_id", F.coalesce(F.col("o_orderkey").cast("string"), F.lit("")))
    return (base.join(pages, base.partner_id == pages["__partner"], "left")
            .select(*_partner_columns(F.col("partner_id")), F.coalesce(F.col("refs.ref"), none).alias("client_references_detailed"),
                    F.struct(F.col("o_orderkey").alias("p"), F.coalesce("page", F.lit(0)).alias("k0")).alias("seq")))


def entity_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three entities that quality rules are declared for: clients are customers, with their market segment
    as industry (its standard name, or none), and references are the lines of their orders."""
    from ..sources import io
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("client_id"), F.col("c_name").alias("client_name"),
        F.col("c_nationkey").cast("string").alias("provider_id"), F.col("c_mktsegment").alias("industry"))
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    references = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left").select(
        F.col("o_custkey").cast("string").alias("client_id"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.col("o_orderpriority")).alias("description"))
    return {"providers": provider_view(spark, sf_dir),
            "clients": io.normalize_term_join(customer, "industry", io.dictionary_frames(spark)["industry_keys"]),
            "references": references}


SITE = "https://directory.example.com"


def directory_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directory pages (page_id, url, html), made of all turns of ``conversations``.

    Every turn is a listing page; a user's turn lists a provider, whose detail page holds the
    turn's text. A listing page leads to the next turn's, unless its turn is a long answer (the last
    page; some links lead nowhere, as on real sites). Short answers carry a block marker.
    """
    t = table(spark, sf_dir, "conversations")
    place = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    following = F.concat_ws("/", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string"))
    text = F.coalesce("text", F.lit(""))
    shown = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    answer = F.col("role") == "assistant"
    listing = F.concat(
        F.lit("<html><body><script>var a=1;</script><h1>List "), place, F.lit("</h1>"),
        F.when(answer & (F.length(text) < 400), F.lit("<p>Access Denied</p>")).otherwise(F.lit("")),
        F.when(F.col("role") == "user", F.concat(F.lit('<a class="provider-link" href="/providers/'), place, F.lit('">p</a>')))
        .otherwise(F.lit("")),
        F.when(answer & (F.length(text) > 1500), F.lit(""))
        .otherwise(F.concat(F.lit('<a rel="next" class="next-page" href="/list/'), following, F.lit('">next</a>'))),
        F.lit("</body></html>"))
    detail = F.concat(F.lit('<html><body><h1 class="company-name"> Partner '), place, F.lit(' </h1><div class="about-section">'),
                      shown, F.lit('</div><ul class="services-list"><li>'), F.col("role"), F.lit("</li><li>turn</li></ul></body></html>"))
    key = F.col("conv_id") * 2_000_000 + F.col("turn") * 2
    lists = t.select(key.alias("page_id"), F.concat(F.lit(SITE + "/list/"), place).alias("url"), listing.alias("html"))
    details = t.where(F.col("role") == "user").select((key + 1).alias("page_id"), F.concat(F.lit(SITE + "/providers/"), place).alias("url"),
                                                      detail.alias("html"))
    return lists.unionByName(details)
