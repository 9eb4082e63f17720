"""Selector subset and page jobs (FIXTURES.md §6)."""
from dirlens.operators import htmlsel as H
import json

import pytest

from dirlens.config import DEFAULT_TARGETS, load_targets, target_named
from dirlens.operators.pages import collect_target, extract_links, extract_records


def test_selectors():
    doc = H.parse('<h1 class="company-name"> Acme <b>Ltd</b></h1><ul class="services-list"><li> a </li><li></li></ul>'
                  '<a class="website-link" href="https://a.com">w</a><div data-testid="gig-card-1"><a href="/p">x</a></div>')
    assert H.first_text(doc, "h1.company-name") == "AcmeLtd"
    assert H.all_text(doc, ".services-list li") == ["a", ""]
    assert H.first_attr(doc, "a.website-link", "href") == "https://a.com"
    assert H.first_attr(doc, "div[data-testid^='gig-card'] a[href^='/']", "href") == "/p"
    assert H.first_text(doc, ".missing") == "" and H.all_text(doc, "") == []
    assert [n.tag for n in H.select(doc, "ul > li")] == ["li", "li"]


def test_sources_are_no_text():
    doc = H.parse("<article>Hi<script>var x=1;</script><style>p{}</style> you</article><script>y()</script>")
    assert H.first_text(doc, "article") == "Hiyou"
    assert H.first_text(doc, "script") == "var x=1;"


def test_links_and_records(spark):
    html = '<a href="/p/1">a</a><a href="/p/1">b</a><a href="https://o.com/z">c</a><h1>T &amp; U</h1>'
    pages = spark.createDataFrame([(1, "https://e.com/l", html)], "page_id long, url string, html string")
    links = sorted(r.link for r in extract_links(pages, "a").collect())
    assert links == ["https://e.com/p/1", "https://o.com/z"]
    rec = extract_records(pages, {"name": "h1", "services": "a"}).first()
    assert rec.name == "T & U" and rec.services == ["a", "b", "c"] and rec.country == "XX"


def test_targets_by_name(tmp_path):
    path = tmp_path / "targets.json"
    path.write_text(json.dumps({"peru": {"base_url": "https://e.com/pe", "country_code": "PE"}}))
    targets = load_targets(str(path))
    assert target_named("peru", targets)["country_code"] == "PE"
    assert target_named("bangladesh") == DEFAULT_TARGETS["bangladesh"]
    with pytest.raises(ValueError, match="unknown target 'chile'.*peru"):
        target_named("chile", targets)


def test_collect_target_stops_at_a_blocked_page(spark):
    def listing(provider, nxt, extra=""):
        return f'<a class="provider-link" href="/p/{provider}">x</a><a class="next-page" href="{nxt}">n</a>{extra}'

    pages = spark.createDataFrame([
        (1, "https://e.com/l1", listing("a", "/l2")), (2, "https://e.com/l2", listing("b", "/l3", "Access Denied")),
        (3, "https://e.com/l3", listing("c", "/l3")), (4, "https://e.com/p/a", '<h1 class="company-name">A</h1>'),
        (5, "https://e.com/p/b", '<h1 class="company-name">B</h1>'), (6, "https://e.com/p/c", '<h1 class="company-name">C</h1>')],
        "page_id long, url string, html string")
    target = dict(DEFAULT_TARGETS["bangladesh"], base_url="https://e.com/")

    def names(start):
        starts = spark.createDataFrame([(start,)], "start_url string")
        return [(r.seq, r.name, r.country) for r in collect_target(pages, target, starts).collect()]

    assert names("https://e.com/l1") == [(4, "A", "BD")]          # its second page is blocked
    assert names("https://e.com/l3") == [(6, "C", "BD")]          # a page that leads to itself ends the chain
