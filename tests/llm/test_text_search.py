"""Phrase collocations, ranked search and benchmark passages against brute force and on odd tables."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dirlens.llm import collocations, decontamination, lexical
from dirlens.llm.queries import REG
from dirlens.llm.terms import terms

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empties, ties, repeated rows, a very long text, clashing columns."""
    rows = [(1, "Same Text here now", "en", "a", 1), (2, "same text HERE now", "en", "a", None),
            (2, "same text HERE now", "en", "a", None), (3, None, None, None, None), (4, "", "en", "b", 0),
            (None, "same text, of no id", None, "b", 3), (None, "same text, of no id", None, "b", 3), (6, " \t\n", None, "a", 3),
            (7, "Été ÉTÉ", "fr", "b", 7), (9, "12 34 !! \x00\x1c 12", "en", "c", 8), (10, "word " * 60_000 + "same end", "en", "a", 0)]
    df = spark.createDataFrame(rows, DOCS)
    for name in ("n", "k", "phrase", "f", "part", "item", "score", "rank", "terms", "spans", "items", "n_words", "at", "block"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_terms():
    rng = random.Random(3)
    for _ in range(300):
        t = "".join(rng.choice("aZ09 _-.\x00\t\n@[`{~éÉ中 😀") for _ in range(30))
        assert [w.decode() for w in terms(t)] == plain_terms(t)
    assert terms(None) == []


# ------------------------------------------------------------------ collocations
def brute_collocations(rows, least, max_words, top, extension=50):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        beyond = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    beyond[p[i:i + m]] = max(beyond[p[i:i + m]], a)
        found = []
        for p, a in cand.items():
            if 100 * beyond[p] >= extension * a:
                continue
            score, _, left, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, r))
        for rank, (s, a, p, left, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, r, n[lang], -s))
    return out


def as_rows(df):
    return {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_collocations_against_brute_force(spark):
    rng = random.Random(11)
    vocab = ["aa", "Bb", "é", "new", "york", "city", "hall", "x y", "\x1c", "of", "the"] + [f"w{i}" for i in range(25)]
    rows = []
    for i in range(150):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice([["New", "York", "city"], ["new", "york", "city", "hall"], ["of", "the"], ["aa", "aa", "aa"]])
        text = "".join(x + rng.choice([" "] * 12 + ["\t", ". ", ",", "\n", ";", "  ", "!"]) for x in w)
        rows.append((i, text, rng.choice(["en", "en", "de", None]), "a", 0))
    docs = spark.createDataFrame(rows, DOCS)
    plain = [(r[2], r[1]) for r in rows]
    for least, max_words, chunk, part_bytes in ((10, 3, 2_000_000, 8 << 20), (4, 3, 37, 500), (3, 4, 101, 4000), (2, 2, 5, 900)):
        got = as_rows(collocations.collocations(docs.repartition(3), least, max_words, 40, chunk=chunk, part_bytes=part_bytes))
        assert got == brute_collocations(plain, least, max_words, 40)


def test_collocations_scores_pass_64_bits(spark):
    # a * a * 1000000 and l * r beyond 64 bits, by counts given as such
    rows = [(3_000_000_007, 3_500_000_011, 4_000_000_007), (10, 3_000_000_000_000, 4_000_000_000_000)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    a = F.col("a").cast("decimal(16,0)")
    got = df.select((F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)")).alias("s"),
                    (F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")).alias("b")).selectExpr("s div b AS x")
    assert [r.x for r in got.collect()] == [1_000_000 * a * a // (left * r) for a, left, r in rows]


def test_collocations_odd(spark, odd, none):
    got = as_rows(collocations.collocations(odd, least=2))
    rows = [(r.lang, r.text) for r in odd.select("lang", "text").collect()]
    assert got == brute_collocations(rows, 2, 3, 2000)
    assert {r[0] for r in got} == {"en", "und"}
    assert collocations.collocations(none).count() == 0
    assert collocations.collocations(odd.where("text IS NULL")).count() == 0


# ------------------------------------------------------------------ ranked search
def brute_search(docs, items, k):
    tf = [(i, Counter(plain_terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, length = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tf:
            n = sum(c.values())
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m))
                        for w in plain_terms(text) if c[w])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def test_search_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(300)]
    pick = lambda n: " ".join(vocab[min(299, int(rng.expovariate(0.03)))] for _ in range(n))
    rows = [(i, pick(rng.randint(0, 60)), "en", "a", 0) for i in range(700)]
    rows += [(1000 + i, rows[5][1], "en", "a", 0) for i in range(30)]          # ties beyond the tenth
    items = [(i, pick(rng.randint(1, 25))) for i in range(15)] + [(3, rows[5][1]), (None, rows[5][1]), (77, ""), (78, None), (79, "unseen")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    asked = spark.createDataFrame(items, ITEMS)
    want = brute_search([r[:2] for r in rows], items, 10)
    for docs_at_once, short, first, chars in ((32_768, 0.25, 256, 10 ** 6), (64, 0.9, 8, 300), (50, 0.0, 3, 10 ** 6)):
        monkeypatch.setattr(lexical, "DOCS", docs_at_once)
        monkeypatch.setattr(lexical, "SHORT", short)
        monkeypatch.setattr(lexical, "FIRST", first)
        got = Counter(tuple(r) for r in lexical.search(docs, asked, 10, block_chars=chars).collect())
        assert got == want


def test_search_drops_without_looking():
    # the iterators that cannot reach the k-th score are never candidates, and no result changes
    rng = np.random.default_rng(1)
    lists = []
    for size, bound in ((40, 900), (3000, 50), (4000, 20), (5000, 5)):
        d = np.sort(rng.choice(6000, size, replace=False))
        s = rng.integers(1, bound + 1, size)
        lists.append((d, s, int(s.max())))
    whole = np.zeros(6000, np.int64)
    for d, s, _ in lists:
        whole[d] += s
    for k in (1, 5, 50):
        d, s = lexical.best(lists, 6000, k, 1)
        want = np.lexsort((np.arange(6000), -whole))[:k]
        assert d.tolist() == want.tolist() and s.tolist() == whole[want].tolist()
    assert lexical.best([], 10, 3, 1)[0].size == 0


def test_search_odd(spark, odd, none):
    items = spark.createDataFrame([(1, "same text"), (1, "same text"), (2, "ÉtÉ 12"), (None, "word"), (4, None)], ITEMS).withColumn("at", F.lit("x"))
    got = Counter(tuple(r) for r in lexical.search(odd, items, 10).collect())
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got == brute_search(rows, [(r.item_id, r.text) for r in items.collect()], 10)
    assert lexical.search(none, items).count() == 0 and lexical.search(odd, items.limit(0)).count() == 0


# ------------------------------------------------------------------ benchmark passages
def brute_passages(docs, items, window=10):
    pats = defaultdict(set)
    for item, text in items:
        w = plain_terms(text)
        if w:
            m = min(window, len(w))
            for i in range(len(w) - m + 1):
                pats[tuple(w[i:i + m])].add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, named = plain_terms(text), set(), set()
        for m in {len(p) for p in pats}:
            for at in range(len(w) - m + 1):
                if (p := tuple(w[at:at + m])) in pats:
                    hit.update(range(at, at + m))
                    named |= pats[p]
        out.append((i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def digests(found):
    hit = decontamination.n_hit(F.col("spans"))
    rows = found.select("doc_id", "n_words", hit, F.size("items"), F.sha2(F.array_join("items", ","), 256), hit > 0)
    return Counter(tuple(r) for r in rows.collect())


def test_passages_against_brute_force(spark):
    rng = random.Random(9)
    vocab = ["a", "b", "c", "é", "d1"]
    pick = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, pick(rng.choice([0, 1, 2, 5, 9, 10, 11, 30]) + (8 if i % 5 else 0))) for i in range(60)] + [(None, pick(14)), (7, pick(12))]
    items = [x for x in items if len(x[1]) != 1]
    docs = []
    for i in range(200):
        w = pick(rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(w))
            w[at:at] = rng.choice(items)[1]
        docs.append((i, rng.choice([" ", "-", ". ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    items = [(i, " ".join(w)) for i, w in items] + [(500, None)]
    df = spark.createDataFrame([(*d, "en", "a", 0) for d in docs], DOCS).repartition(3)
    asked = spark.createDataFrame(items, ITEMS)
    for window in (10, 4):
        want = brute_passages(docs, items, window)
        assert digests(decontamination.passages(df, asked, window)) == want
        assert digests(decontamination.passages(df, asked, window, postings=40 if window == 10 else 200)) == want   # several passes


def test_patterns_find_every_occurrence():
    words = [b"a", b"a", b"a", b"b", b"a", b"a", b"a", b"a", b"b", b"a"]
    for m in (1, 2, 3, 4):
        pats = {tuple(words[i:i + m]) for i in range(2, 6)}
        for block in (1, 2, 3):
            got = sorted(decontamination.Patterns(pats, m, block).find(words))
            assert got == [(i, tuple(words[i:i + m])) for i in range(len(words) - m + 1) if tuple(words[i:i + m]) in pats]


def test_passages_odd(spark, odd, none):
    items = spark.createDataFrame([(1, "Text here NOW"), (1, "same end"), (None, "été été"), (3, ""), (4, None)], ITEMS).withColumn("window", F.lit("x"))
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    assert digests(decontamination.passages(odd, items)) == brute_passages(rows, asked)
    clean = decontamination.passages(odd, items.limit(0))
    assert digests(clean) == brute_passages(rows, [])
    assert decontamination.passages(none, items).count() == 0


def test_queries_run_on_whole_tables(spark):
    for name in ("op11_phrase_collocations", "op12_ranked_search", "op13_benchmark_decontamination"):
        assert REG[name](spark, "/root/testdata/sf0.001").count() > 0
