"""Page-extraction jobs over a ``pages(page_id, url, html)`` table.

Fetching is replaced by data: a "visit" is a join on ``pages.url``. Parsing
is the only Python step: one ``mapInPandas`` pass per partition parses each
page once and emits every field the job needs. Only the needed columns cross
the Arrow boundary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_BLOCK_MARKERS, MAX_LISTING_PAGES
from ..session import cut, ship_package
from . import htmlsel

LINK_SCHEMA = "page_id long, link string"


def blocked(html="html", markers: Sequence[str] = DEFAULT_BLOCK_MARKERS) -> Column:
    """page contains any block marker."""
    col = F.col(html) if isinstance(html, str) else html
    cond = F.lit(False)
    for m in markers:
        cond = cond | col.contains(m)
    return F.coalesce(cond, F.lit(False))


def _links_fn(selector: str, fallback: str | None, base: str | None, attr: str = "href"):
    def run(batches):
        for pdf in batches:
            ids, out = [], []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                doc = htmlsel.parse(html)
                nodes = htmlsel.select(doc, selector)
                if not nodes and fallback:
                    nodes = htmlsel.select(doc, fallback)
                b = (base if base is not None else url) or ""
                links = dict.fromkeys(urljoin(b, n.attrs[attr]) for n in nodes if n.attrs.get(attr))
                ids += [pid] * len(links)
                out += links
            yield pd.DataFrame({"page_id": pd.Series(ids, dtype="int64"),
                                "link": pd.Series(out, dtype="object")})
    return run


def extract_links(pages: DataFrame, selector: str = "a", base_url: str | None = None,
                  fallback: str | None = None) -> DataFrame:
    """H1 (+H6, F6): (page_id, absolute link) for every match with a non-empty href,
    distinct per page row. Links resolve against ``base_url`` (the target's base) or,
    when not given, against the page's own URL."""
    ship_package(pages.sparkSession)
    fn = _links_fn(selector, fallback, base_url)
    return pages.select("page_id", "url", "html").mapInPandas(fn, LINK_SCHEMA)


def link_filter(links: DataFrame, include: str = "/partners/",
                exclude: Sequence[str] = ("country", "grade"), col: str = "link") -> DataFrame:
    """keep links containing ``include`` and none of ``exclude``."""
    cond = F.col(col).contains(include)
    for x in exclude:
        cond = cond & ~F.col(col).contains(x)
    return links.where(cond)


def link_counts(pages: DataFrame, links: DataFrame) -> DataFrame:
    """links per page (0 for pages with none) and the empty-page flag."""
    n = links.groupBy("page_id").agg(F.count(F.lit(1)).alias("links"))
    return (pages.select("page_id").join(n, "page_id", "left")
            .select("page_id", F.coalesce(F.col("links"), F.lit(0)).cast("bigint").alias("links"))
            .withColumn("empty_page", F.col("links") == 0))


RECORD_FIELDS = ["name", "tier", "location", "website", "description", "services", "references"]
RECORD_SCHEMA = ("page_id long, url string, name string, tier string, location string, "
                 "website string, description string, services array<string>, "
                 "client_references array<string>")


def _records_fn(sel: Mapping[str, str]):
    def run(batches):
        for pdf in batches:
            rows = []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                doc = htmlsel.parse(html)
                rows.append({
                    "page_id": pid, "url": url,
                    "name": htmlsel.first_text(doc, sel.get("name", "")),
                    "tier": htmlsel.first_text(doc, sel.get("tier", "")),
                    "location": htmlsel.first_text(doc, sel.get("location", "")),
                    "website": htmlsel.first_attr(doc, sel.get("website", ""), "href"),
                    "description": htmlsel.first_text(doc, sel.get("description", "")),
                    "services": htmlsel.all_text(doc, sel.get("services", "")),
                    "client_references": htmlsel.all_text(doc, sel.get("references", "")),
                })
            yield pd.DataFrame(rows, columns=["page_id", "url", "name", "tier", "location", "website",
                                              "description", "services", "client_references"])
    return run


def extract_records(pages: DataFrame, selectors: Mapping[str, str], country_code: str = "XX") -> DataFrame:
    """H2-H5: one provider record per page from a selector config (PROVIDER_RAW shape)."""
    ship_package(pages.sparkSession)
    recs = pages.select("page_id", "url", "html").mapInPandas(_records_fn(dict(selectors)), RECORD_SCHEMA)
    return recs.select(
        F.lit("").alias("provider_id"), "name", F.lit(country_code).alias("country"), "location", "tier",
        "website", "description", "services", "client_references",
        F.col("url").alias("source_url"), F.col("page_id").alias("seq"))


def _next_links(pages: DataFrame, selector: str, base_url: str | None) -> DataFrame:
    """(page_id, url, link) of the pages that have a next page; the parser hands the page's own URL on."""
    def run(batches):
        for pdf in batches:
            ids, urls, out = [], [], []
            for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                href = htmlsel.first_attr(htmlsel.parse(html), selector, "href")
                if href:
                    ids.append(pid)
                    urls.append(url)
                    out.append(urljoin(base_url if base_url is not None else url, href))
            yield pd.DataFrame({"page_id": pd.Series(ids, dtype="int64"), "url": pd.Series(urls, dtype="object"),
                                "link": pd.Series(out, dtype="object")})
    ship_package(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(run, "page_id long, url string, link string")


def next_page_links(pages: DataFrame, selector: str, base_url: str | None = None) -> DataFrame:
    """H7: (page_id, next_url) from the first match of the next-page selector."""
    return _next_links(pages, selector, base_url).select("page_id", "link")


def page_chain(starts: DataFrame, edges: DataFrame, max_pages: int = MAX_LISTING_PAGES) -> DataFrame:
    """H8: follow next links from each start URL: at most ``max_pages`` pages,
    stopping at a missing link or a self-link.

    ``starts(start_url)``, ``edges(url, next_url)`` -> (start_url, depth, url).
    Pointer doubling: a jump table of 1, 2, 4, ... links, each the join of the one before with itself, extends
    all chains found so far at once, so ten pages take four joins of the chains and three of the tables.
    Each is cut, so none is computed again.
    """
    out = starts.select("start_url", F.lit(1).alias("depth"), F.col("start_url").alias("url"))
    jump = cut(edges.select("url", "next_url").where(F.col("next_url").isNotNull() & (F.col("next_url") != F.col("url"))))
    step = 1
    while step < max_pages:
        far = (out.where(F.col("depth") + step <= max_pages).join(jump, "url")
               .select("start_url", (F.col("depth") + step).alias("depth"), F.col("next_url").alias("url")))
        out = cut(out.unionByName(far))
        step *= 2
        if step < max_pages:
            on = jump.select(F.col("url").alias("next_url"), F.col("next_url").alias("end_url"))
            jump = cut(jump.join(on, "next_url").select("url", F.col("end_url").alias("next_url")))
    return out


def collect_target(pages: DataFrame, target: Mapping, start_urls: DataFrame | None = None,
                   max_pages: int = MAX_LISTING_PAGES) -> DataFrame:
    """H9: listing chain (H8, minus blocked pages F3) -> provider links (H1) ->
    detail pages joined by URL -> records (H2) with the target's country code."""
    base = target["base_url"]
    listing, detail = target.get("listing", {}), target.get("detail", {})
    if start_urls is None:
        start_urls = pages.sparkSession.createDataFrame([(base,)], "start_url string")
    # a blocked page is never parsed, so the chain stops there
    open_pages = pages.where(~blocked("html"))
    edges = _next_links(open_pages, listing.get("next_page", ""), base).select("url", F.col("link").alias("next_url"))
    chain = page_chain(start_urls, edges, max_pages)
    listing_pages = (pages.join(chain.select("url").distinct(), "url", "left_semi")
                     .where(~blocked("html")))
    links = extract_links(listing_pages, listing.get("provider_link", ""), base)
    detail_pages = pages.join(links.select(F.col("link").alias("url")).distinct(), "url", "left_semi")
    return extract_records(detail_pages, detail, target.get("country_code", "XX"))
