"""The corpus pipeline stage by stage against plain Python, and on odd and empty tables."""
import re
from collections import Counter

import pytest

import corpus_pipeline as P
from dirlens.llm import token_counts
from dirlens.llm.common import table
from test_operators import brute_components

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def released(spark):
    # a cache left behind would stand in for the table in every later plan of the session
    yield
    spark.catalog.clearCache()


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents").cache()
    columns = docs.columns
    stage = dict(P.STAGES)

    lang = stage["language_id"](spark, docs, SF).cache()
    assert {r.doc_id for r in lang.collect()} == {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}

    exact = stage["exact_dedup"](spark, lang, SF).cache()
    last = {}
    for r in lang.collect():
        key = r.text.translate(LOWER)
        last[key] = max(last.get(key, -1), r.doc_id)
    assert {r.doc_id for r in exact.collect()} == set(last.values())

    near = stage["minhash_near_dedup"](spark, exact, SF).cache()
    groups = brute_components([(r.doc_id, r.text) for r in exact.collect()], 5)
    assert {r.doc_id for r in near.collect()} == {i for i, (_, c) in groups.items() if c == i}

    mixed = stage["source_mix"](spark, near, SF).cache()
    text = {r.doc_id: r for r in near.collect()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(text) and max(copies.values()) <= 3
    assert all(tuple(r) == tuple(text[r.doc_id]) for r in mixed.collect())
    for df in (lang, exact, near, mixed):
        assert df.columns == columns

    packed = stage["best_fit_packing"](spark, mixed, SF).collect()
    size = Counter()
    for r in packed:
        size[r.doc_id] += r.length
    encode = token_counts.encoder().encode_ordinary
    assert all(size[i] == n * len(encode(text[i].text)) for i, n in copies.items())


def test_stages_on_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, "some english words of the text", "en", None, 1), (1, "some english words of the text", "en", None, 1),
           (None, "das ist ein text", "de", "a", None), (3, None, None, None, None), (4, "", "en", "a", 0), (5, "1 2 3", "en", "b", 5)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in P.STAGES:
            docs = stage(spark, docs, SF)
            docs.collect()
        assert bool(docs.count()) == bool(rows)


def test_run(spark):
    assert P.ORACLE_SQL is None
    assert P.run(spark, SF).count() > 0
