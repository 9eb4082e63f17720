"""The numbered operators against brute force, round trips and odd inputs (nulls, empty and long
texts, repeated rows, empty tables, clashing extra columns)."""
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dirlens.llm import (ann, components, exact_dedup, lang_id, mixing, near_dup, packing, token_binary,
                         token_counts, toxicity, url_filter)
from dirlens.llm.common import n_words, table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empties, ties, repeated rows, one very long text, clashing columns."""
    rows = [(1, "Same Text here now", "en", "a", 1), (2, "same text HERE now", "en", "a", None),
            (2, "same text HERE now", "en", "a", None), (3, None, None, None, None), (4, "", "en", "b", 0),
            (None, "no id at all", "en", "b", 3), (None, "no id at all", "en", "b", 3), (6, " \t\n", None, "a", 3),
            (7, "Été ÉTÉ", "fr", "b", 7), (8, "été ÉTÉ", "fr", "b", 7), (9, "12 34 !!", "en", "c", 8),
            (10, "word " * 60_000 + "end", "en", "a", 0)]
    df = frame(spark, rows)
    for name in ("size", "kept", "node", "label", "digest", "taken", "shard", "score"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


# ------------------------------------------------------------------ exact dedup
def test_exact_dedup_odd(odd, none):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(odd).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    same = sha("same text here now")
    assert (got[1, same].keep_id, got[1, same].group_size, got[1, same].kept) == (2, 3, False)
    assert got[2, same].kept
    assert got[3, sha("")].keep_id == 4 and got[4, sha("")].group_size == 2
    assert got[None, sha("no id at all")].kept and got[None, sha("no id at all")].group_size == 2
    assert got[7, sha("Été ÉtÉ")].group_size == 1          # only A-Z are folded
    assert exact_dedup.exact_dedup(odd).count() == odd.count()
    stay = exact_dedup.drop_duplicates(odd)
    assert stay.columns == odd.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter([2, 4, None, 6, 7, 8, 9, 10])
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.drop_duplicates(none).count() == 0


def test_exact_dedup_compares_content(spark):
    rows = [(i, f"text {i % 5}", "en", "a", 0) for i in range(60)]
    weak = exact_dedup.exact_dedup(frame(spark, rows), salts=3, digest=lambda t: F.lit("x"))
    for r in weak.collect():
        assert (r.keep_id, r.group_size) == (55 + r.doc_id % 5, 12)


# ------------------------------------------------------------------ near duplicates
def brute_components(rows, k, threshold=80):
    sets = {}
    for i, text in rows:
        w = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = words(w)
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, base, share):
    out = list(base)
    for _ in range(max(0, int(len(base) * share))):
        out[rng.randrange(len(out))] = f"n{rng.random()}"
    return " ".join(out)


def test_near_dup_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 600)             # several blocks a bucket
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for size, copies in ((3, 4), (30, 12), (120, 60), (200, 15)):
        base = [rng.choice(vocab) for _ in range(size)]
        rows += [edited(rng, base, rng.choice([0, 0.01, 0.02, 0.03, 0.05, 0.08])) for _ in range(copies)]
    rows += [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    rows += ["", None, " \n ", "one", "ONE", "one two three", "One two Three"]
    rows = list(enumerate(rows))
    for k in (4, 5):
        want = brute_components(rows, k)
        got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shingle=k)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
        assert got == want


def test_near_dup_documents_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert got == want


def test_near_dup_odd(odd, none):
    got = near_dup.near_duplicates(odd, shingle=4).collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert by[1][0].component_id == 1 and {r.component_id for r in by[2]} == {1} and not by[2][0].kept
    assert by[3][0].n_shingles == 0 and by[3][0].kept and by[6][0].kept
    assert {(r.component_id, r.kept) for r in by[None]} == {(None, True)}
    assert by[10][0].n_shingles == 2                        # a long text of one word and an end
    assert near_dup.drop_near_duplicates(odd).columns == odd.columns
    assert near_dup.near_duplicates(none).count() == 0


def test_near_dup_null_and_repeated_ids(spark):
    words = [f"w{i}" for i in range(60)]
    one, two, other = " ".join(words), " ".join(words[:-1] + ["zz"]), "some quite different text of eight words here"
    rows = [(None, one), (7, one), (5, two), (5, other), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept, r.class_size) for r in near_dup.near_duplicates(docs).collect()}
    assert got == {(None, 56, 5, False, 2), (7, 56, 5, False, 2), (5, 56, 5, True, 1), (5, 4, 5, True, 1),
                   (None, 0, None, True, 1)}
    stay = sorted(map(tuple, near_dup.drop_near_duplicates(docs).collect()), key=str)
    assert stay == sorted([(5, two), (5, other), (None, None), (None, "")], key=str)
    # an id that is given twice goes where its text is a near copy of a smaller one
    again = spark.createDataFrame([(3, one), (5, two), (5, other), (None, two)], "doc_id long, text string")
    assert sorted(map(tuple, near_dup.drop_near_duplicates(again).collect())) == [(3, one), (5, other)]
    # without any other id a null one stands for its group, once
    none = spark.createDataFrame([(None, one), (None, two)], "doc_id long, text string")
    assert near_dup.drop_near_duplicates(none).count() == 1


def test_estimate_matches_similarity():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64))
    for keep in (0.5, 0.8, 0.95):
        b = np.unique(np.concatenate([a[:int(len(a) * keep)], rng.integers(0, 2**63, int(len(a) * (1 - keep))).astype(np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sa, sb = near_dup.packed(near_dup.minima(a)), near_dup.packed(near_dup.minima(b))
        assert abs(near_dup._estimates(sa[None], sb)[0] - true) < 0.12


def test_components_of_a_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1002), (1001, 1002)], "a long, b long")
    got = dict(components.connected_components(edges).collect())
    assert {got[i] for i in range(n + 1)} == {0} and got[1002] == 1000 and len(got) == n + 4


# ------------------------------------------------------------------ language
def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = lang_id.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_mixture_and_odd(spark, odd, none):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = lang_id.learned(docs)
    one = {r.lang: r.text for r in docs.where("length(text) between 1500 and 2500").collect()}
    mixed = lang_id.mixtures([one["en"] + "\n" + one["de"], one["fr"], None, "", "12 !!", one["es"] * 400], model)
    assert set(np.argsort(-mixed[0])[:2]) == {model.langs.index("en"), model.langs.index("de")} and mixed[0].min() == 0
    assert mixed[2] is None and mixed[3] is None and mixed[4] is None
    assert model.langs[mixed[5].argmax()] == "es"
    got = {r.doc_id: r for r in lang_id.identify_documents(odd).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[6].lang_pred == got[9].lang_pred == "und" and got[3].score == 0
    assert lang_id.identify_documents(odd).count() == odd.count()
    assert {r.doc_id for r in lang_id.keep_identified(odd).collect()} == {1, 2, 7, 8, 10, None}
    assert lang_id.identify_documents(none).count() == 0
    unlabelled = frame(spark, [(1, "some text", None, None, None)])
    assert lang_id.identify_documents(unlabelled).first().lang_pred == "und"


def test_small_language_of_a_very_long_text(spark):
    model = lang_id.learned(table(spark, "/root/testdata/sf0.01", "documents"))
    text = defaultdict(list)
    for r in table(spark, "/root/testdata/sf0.01", "documents").where("lang IS NOT NULL").orderBy("doc_id").collect():
        text[r.lang].extend(re.findall(r"[^\W\d_]+", r.text or ""))
    langs = lambda t: {model.langs[i] for i in np.flatnonzero(lang_id.mixtures([t], model)[0])}
    main = " ".join(text["en"][:30_000])
    alone = langs(main)
    assert "en" in alone and len(alone) < len(model.langs)
    for small in ("fr", "es"):
        assert langs(main + " " + " ".join(text[small][:150])) == alone | {small}


def brute_mixture(text, model, penalty=lang_id.PENALTY):
    """Languages of the best of all non-empty sets, each fitted on its own by plain loops, and their shares."""
    def cell(tri):
        x = (ord(tri[0]) * 0x9E3779B1 + ord(tri[1]) * 0x85EBCA6B + ord(tri[2]) * 0xC2B2AE35) & 0xFFFFFFFF
        x = ((x ^ x >> 15) * 0x2C1B3C6D) & 0xFFFFFFFF
        return x >> 16
    spaced = "".join(c if c.isalpha() else " " for c in text.lower())
    scores = [[sum(float(model.logp[cell(f" {w} "[i:i + 3])][k]) for i in range(len(w))) for k in range(len(model.langs))]
              for w in spaced.split()]
    best = None
    for r in range(1, len(model.langs) + 1):
        for held in itertools.combinations(range(len(model.langs)), r):
            share = dict.fromkeys(held, 1 / r)
            for _ in range(60):
                new = dict.fromkeys(held, 0.0)
                for s in scores:
                    part = {k: share[k] * math.exp(s[k] - max(s)) for k in held}
                    whole = sum(part.values()) or 1e-300
                    for k in held:
                        new[k] += part[k] / whole / len(scores)
                share = new
            value = sum(math.log(sum(share[k] * math.exp(s[k] - max(s)) for k in held) or 1e-300) for s in scores)
            value -= penalty * r * math.log1p(len(scores))
            if best is None or value > best[0]:
                best = (value, share)
    return {model.langs[k]: v for k, v in best[1].items()}


def test_language_sets_against_all_sets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = lang_id.learned(docs)
    rows = docs.where("lang IS NOT NULL AND length(text) > 200").orderBy("doc_id").limit(24).collect()
    texts = [" ".join(r.text.split()[:25]) for r in rows]
    texts += [" ".join(a.split()[:14] + b.split()[:9]) for a, b in zip(texts, texts[1:])]      # two languages, often
    got = [{model.langs[k]: v for k, v in enumerate(x) if v > 0} for x in lang_id.mixtures(texts, model)]
    want = [brute_mixture(t, model) for t in texts]
    assert all(max(a, key=a.get) == max(b, key=b.get) for a, b in zip(got, want))
    same = [set(a) == set(b) for a, b in zip(got, want)]
    assert sum(same) >= 0.95 * len(same) and any(len(b) > 1 for b in want)
    assert all(abs(a[k] - b[k]) < 0.05 for a, b, ok in zip(got, want, same) if ok for k in b)


def test_texts_of_no_learned_language_are_rejected(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    strange = ["\u043f\u0440\u0438\u0432\u0435\u0442 \u043a\u0430\u043a \u0434\u0435\u043b\u0430 \u043c\u043e\u0439 \u0434\u0440\u0443\u0433",
               "\u4eca\u5929\u5929\u6c14\u5f88\u597d" * 9, "xqzvk jwqpx zzkqv wqxjz vvkqj", "zqx" * 50_000]
    clean = ["This is a clean short sentence of words.", "Hello", "Das Haus ist gross und sch\u00f6n."]
    more = frame(spark, [(10_000_000 + i, t, None, "a", 0) for i, t in enumerate(clean)]
                 + [(20_000_000 + i, t, None, "a", 0) for i, t in enumerate(strange)])
    every = docs.select(*more.columns).unionByName(more)
    kept = {r.doc_id for r in lang_id.keep_identified(every).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.where("text rlike '\\\\p{L}'").collect()} | {10_000_000 + i for i in range(len(clean))}


def test_em_reaches_the_known_proportions():
    rng = np.random.default_rng(1)
    like = np.where(rng.random((2000, 1)) < 0.7, [[1.0, 1e-6, 1e-6]], [[1e-6, 1.0, 1e-6]])
    share, _ = lang_id._fit(like, np.array([0]), np.full((1, 3), 1 / 3), 30)
    assert np.allclose(share[0], [(like[:, 0] == 1).mean(), (like[:, 1] == 1).mean(), 0], atol=1e-3)


# ------------------------------------------------------------------ token counts and shards
def test_histogram_against_brute_force(spark, odd, none):
    for docs in (table(spark, SF, "documents"), odd):
        n = [len(token_counts.encoder().encode_ordinary(r.text or "")) for r in docs.select("text").collect()]
        sums = token_counts.suffix_sums(token_counts.histogram(docs))
        rows = {r.n_tokens: r for r in sums.collect()}
        assert {k: r.n_docs for k, r in rows.items()} == Counter(n)
        for k, r in rows.items():
            assert (r.docs_ge, r.tokens_ge) == (sum(x >= k for x in n), sum(x for x in n if x >= k))
            assert (r.docs_le, r.truncated) == (sum(x <= k for x in n), sum(min(x, k) for x in n))
        for r in token_counts.at_limits(sums, [0, 7, 512, 4096, 10**7]).collect():
            assert (r.docs_truncated, r.tokens) == (sum(x > r.limit for x in n), sum(min(x, r.limit) for x in n))
        for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
            assert r.n_tokens == sorted(n)[max(0, math.ceil(r.share * len(n)) - 1)]
    empty = token_counts.suffix_sums(token_counts.histogram(none))
    assert empty.count() == 0
    assert token_counts.at_limits(empty, [5]).first().tokens == 0


def test_permutation_is_one_to_one():
    for size in (1, 2, 3, 17, 1000, 4096, 5001):
        got = token_binary.permute(np.arange(size, dtype=np.uint64), size)
        assert sorted(got.tolist()) == list(range(size))
    assert (token_binary.permute(np.arange(1000, dtype=np.uint64), 1000, 1)
            != token_binary.permute(np.arange(1000, dtype=np.uint64), 1000, 2)).any()


def test_shards_round_trip(spark, odd, none, tmp_path):
    docs = table(spark, SF, "documents")
    for name, df, length in (("docs", docs, 128), ("odd", odd, 64)):
        rows = token_binary.materialise(df, str(tmp_path / name), length=length, shard_bytes=1 << 15).cache()
        n = rows.count()
        got = token_binary.read_slots(rows, 0, n, length)
        order = rows.orderBy("slot").collect()
        assert [r.slot for r in order] == list(range(n)) and len(got) == n
        found = defaultdict(Counter)
        for r, ids in zip(order, got):
            assert not ids[r.n_tokens:].any()
            found[r.doc_id, r.seq][tuple(ids[:r.n_tokens].tolist())] += 1
        want = defaultdict(Counter)
        for r in df.select("doc_id", "text").collect():
            ids = token_counts.encoder().encode_ordinary(r.text or "")
            for j, k in enumerate(range(0, len(ids), length)):
                want[r.doc_id, j][tuple(ids[k:k + length])] += 1
        assert found == want
    again = token_binary.materialise(docs.repartition(7), str(tmp_path / "again"), length=128, shard_bytes=1 << 15)
    first = token_binary.materialise(docs, str(tmp_path / "first"), length=128, shard_bytes=1 << 15)
    assert again.select("slot", "doc_id", "seq").exceptAll(first.select("slot", "doc_id", "seq")).count() == 0
    assert token_binary.materialise(none, str(tmp_path / "none")).count() == 0
    far = frame(spark, [(-2**62, "left end", "en", "a", 1), (2**62, "right end", "en", "a", 1)])
    assert token_binary.materialise(far, str(tmp_path / "far")).count() == 2


# ------------------------------------------------------------------ nearest neighbours
def test_ann_recall(spark):
    e = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = e.collect()
    x = {r.vec_id: np.array(r.embedding, float) for r in rows}
    got = defaultdict(list)
    for r in ann.nearest(e, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hit = 0
    for q, found in got.items():
        best = sorted(((-float(x[q] @ v), i) for i, v in x.items() if i != q))[:20]
        hit += len({i for _, i in best} & {r.vec_id for r in found})
        assert [r.rank for r in found] == list(range(1, 21))
        assert all(abs(r.score - float(x[q] @ x[r.vec_id])) < 1e-12 for r in found)
    assert len(got) == sum(i % 20 == 0 for i in x) and hit >= 0.95 * 20 * len(got)


def test_ann_probing_part_of_the_lists_keeps_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True) * rng.uniform(0.5, 2, (6000, 1))
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in ann.nearest(e, F.col("vec_id") % 100 == 0, k=10).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:10].tolist()) & found)
    assert hit >= 0.9 * 10 * len(got)


def test_ann_probes_few_lists_of_clustered_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 16)) * 4
    x = np.repeat(centres, 200, axis=0) + rng.standard_normal((8000, 16)) * 0.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    vectors = ann.valid_vectors(e)
    index = ann.Index(vectors)
    rows = index.assigned(vectors).cache()
    few, all_of_them = index.lists_for(rows, 10), index.lists_for(rows, 10, target=1.0)
    radius = {r["list"]: r["r"] for r in rows.groupBy("list").agg(F.max("off").alias("r")).collect()}
    sizes = {r["list"]: r["count"] for r in rows.groupBy("list").count().collect()}
    assert few <= all_of_them and few <= len(index.centres) / 4
    # no row of a list is nearer than its gap
    for p in index.probes(vectors.where("id < 8000 AND id % 1000 = 0"), sizes, radius, 10, len(index.centres)).collect():
        q = np.array(p["v"])
        for r in rows.where(F.col("list") == p["list"]).limit(5).collect():
            d2 = q @ q + index.top ** 2 - 2 * (q @ np.array(r["v"]))
            assert math.sqrt(max(d2, 0)) >= p["gap"] - 1e-6
        if p["nearness"] > 3:
            break
    rows.unpersist()
    got = defaultdict(set)
    for r in ann.nearest(e, F.col("vec_id") % 100 == 0, k=10).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:10].tolist()) & found)
    assert len(got) == 80 and hit >= 0.95 * 10 * len(got)


def test_ann_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (20, [1.0, 0.0], "x"), (20, [1.0, 0.0], "x"), (3, [0.0, 1.0], None), (4, None, "x"),
            (5, [0.0, 0.0], "x"), (6, [nan, 1.0], "x"), (7, [inf, 1.0], "x"), (8, [None, 1.0], "x"), (9, [1.0], "x"),
            (None, [1.0, 1.0], "x"), (2, [1.0, 0.0], "x")]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").withColumn("rank", F.lit(1))
    got = sorted(tuple(r) for r in ann.nearest(e, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 2, 1.0), (0, 2, 20, 1.0), (0, 3, 3, 0.0), (20, 1, 0, 1.0), (20, 2, 2, 1.0), (20, 3, 3, 0.0)]
    assert ann.nearest(e.where("false"), F.col("vec_id") % 20 == 0).count() == 0


# ------------------------------------------------------------------ mixing
def test_mix_odd(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and mixing.mix(none).count() == 0
    assert {r.size for r in rows if r.doc_id in (3, 4, 6)} == {0}
    assert all(r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in rows)
    assert mixing.training_order(odd).columns == odd.columns
    assert mixing.training_order(none).count() == 0
    copies = Counter()
    for r in rows:
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixing.training_order(odd).collect()) == +copies


def test_mix_reaches_targets_and_repeats(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    source = dict(docs.select("doc_id", "source").collect())
    rows = mixing.mix(docs).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) < 0.01 * t for s, t in target.items())
    again = mixing.mix(docs.repartition(9)).collect()
    key = lambda r: (r.doc_id, r.taken, r.positions)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_caps_and_shares_the_excess(spark):
    rows = [(i, "w " * 10, "en", "small", 0) for i in range(2)] + [(10 + i, "w " * 10, "en", "tiny", 0) for i in range(1)]
    rows += [(100 + i, "w " * 10, "en", "big", 0) for i in range(97)]
    got = {r.source: r for r in mixing.targets(mixing._sized(frame(spark, rows), "doc_id", "text", "source")).collect()}
    assert got["small"].target == 60 and got["tiny"].target == 30 and got["big"].target == 910


def test_curriculum_positions(spark):
    rows = [(i, "w " * 10, "en", s, 0) for i, s in enumerate(["a", "b"] * 200)]
    schedule = spark.createDataFrame([("a", 0.0, 3.0), ("b", 0.0, 1.0), ("a", 0.5, 1.0), ("b", 0.5, 3.0)],
                                     "source string, start double, weight double")
    got = [(r.doc_id % 2, p) for r in mixing.mix(frame(spark, rows), schedule).collect() for p in r.positions]
    assert len(got) == 400
    early = Counter(s for s, p in got if p < 0.5)
    assert early[0] == 150 and early[1] == 50
    order = [r.source for r in mixing.training_order(frame(spark, rows), schedule).collect()]
    assert Counter(order[:200])["a"] == 150


def test_mix_carries_the_room_on_to_later_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 10)
    for long_id in (1000, 1003):                           # in one bucket or another
        rows = [(i, "w " * 10, "en", "a", 0) for i in range(60)] + [(long_id, "w " * 450, "en", "a", 0)]
        rows += [(2000 + i, "w " * 7, "en", "b", 0) for i in range(100)]
        got = mixing.mix(frame(spark, rows), cycle=(3, 5)).collect()
        for mine in ([r for r in got if r.doc_id < 2000], [r for r in got if r.doc_id >= 2000]):
            room = math.floor(mine[0].target + 0.5) - sum(r.taken for r in mine)
            least = min(r.copies for r in mine)
            assert 0 <= room < min(r.size for r in mine if r.copies == least)
        spots = [p for r in got if r.doc_id < 2000 for p in r.positions]
        assert sum(p < 0.5 for p in spots) > 0 and len(set(spots)) > len(spots) // 2


def brute_mix(rows, bucket, cycle, epochs=3):
    """Copies of each (doc_id, text, source): the stated rule by plain loops."""
    size = {i: len(words(t)) for i, t, _ in rows}
    by = defaultdict(list)
    for i, t, s in rows:
        h = int(hashlib.md5(f"{i}:{size[i]}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:8], 16)
        by[s].append((h, i))
    names = sorted(by)
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(names)}
    total = {s: sum(size[i] for _, i in by[s]) for s in names}
    target, left, open_ = {}, sum(total.values()), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= epochs * total[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = epochs * total[s]
            left -= target[s]
        open_ -= full
    copies = {}

    def fill(order, room):
        out = set()
        for i in order:
            if size[i] <= room:
                out.add(i)
                room -= size[i]
        return out

    def buckets(members, n):
        held = defaultdict(list)
        for h, i in sorted(members):
            held[h * n >> 32].append((h, i))
        return [held[k] for k in sorted(held)]

    for s in names:
        goal = math.floor(target[s] + 0.5)
        whole, part = divmod(goal, total[s]) if total[s] else (0, 0)
        n, took, before = -(-len(by[s]) // bucket), set(), 0
        for b in buckets(by[s], n):
            here = sum(size[i] for _, i in b)
            if before + here <= part:
                took |= {i for _, i in b}
            elif before < part:
                room, within, order = part - before, 0, []
                for h, i in b:
                    late = 4 * (within + size[i]) > 3 * room
                    order.append((late, -size[i] if late else 0, h, i))
                    within += size[i]
                took |= fill([x[-1] for x in sorted(order)], room)
            before += here
        rest = [(h, i) for h, i in by[s] if i not in took and size[i]]
        while True:
            room = part - sum(size[i] for i in took)
            rest = [(h, i) for h, i in rest if i not in took and size[i] <= room]
            if not rest:
                break
            before = 0
            for b in buckets(rest, n):
                here = sum(size[i] for _, i in b)
                if before + here <= room:
                    took |= {i for _, i in b}
                elif before < room:
                    took |= fill([i for _, _, i in sorted((-size[i], h, i) for h, i in b)], room - before)
                before += here
        copies.update({i: whole + (i in took) for _, i in by[s]})
    return copies


def test_mix_of_many_buckets_against_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    carried = 0
    for bucket, trial in ((4, 0), (9, 1), (25, 2)):
        monkeypatch.setattr(mixing, "BUCKET", bucket)
        rows = [(i, "w " * rng.choice((0, 1, 3, 8, 20, rng.randint(100, 900))), rng.choice("aaabc")) for i in range(160)]
        cycle = ((1, 2, 3), (5, 1, 2), (2, 3, 1))[trial]
        want = brute_mix(rows, bucket, cycle)
        docs = frame(spark, [(i, t, "en", s, 0) for i, t, s in rows])
        assert {r.doc_id: r.copies for r in mixing.mix(docs, cycle=cycle).collect()} == want
        with monkeypatch.context() as m:          # without the carry something is left: the rule acts here
            m.setattr(mixing, "_carry", lambda first, plan: first.withColumn("last", F.col("offset")))
            carried += {r.doc_id: r.copies for r in mixing.mix(docs, cycle=cycle).collect()} != want
    assert carried


# ------------------------------------------------------------------ packing
def test_best_fit_finds_the_tightest_compatible_bin():
    rng = random.Random(5)
    pieces = sorted(((rng.randint(1, 60), rng.randint(0, 6), rng.randint(0, 40)) for _ in range(400)), reverse=True)
    bins, want = [], []
    for length, source, cluster in pieces:
        fit = [(b["room"], i) for i, b in enumerate(bins)
               if b["room"] >= length and source not in b["s"] and cluster not in b["c"]]
        if fit:
            room, i = min(fit)
        else:
            room, i = 100, len(bins)
            bins.append({"s": set(), "c": set()})
        want.append((i, 100 - room))
        bins[i]["room"] = room - length
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
    assert packing.best_fit(pieces, 100) == want


def test_pack_keeps_everything_and_no_conflicts(spark, odd, none):
    for docs, shard in ((table(spark, SF, "documents"), 64), (odd, 4096)):
        got = packing.pack(docs, capacity=256, shard_rows=shard).collect()
        size = defaultdict(int)
        bins = defaultdict(list)
        for r in got:
            size[r.doc_id] += r.length
            if r.bin_id is None:
                assert r.length == 0
            else:
                bins[r.bin_id].append(r)
        want = defaultdict(int)
        for r in docs.collect():
            want[r.doc_id] += len(words(r.text))
        assert size == want
        for b in bins.values():
            assert len({r.source for r in b}) == len({r.cluster for r in b}) == len(b)
            at = sorted((r.start, r.length) for r in b)
            assert at[0][0] == 0 and all(x[0] + x[1] == y[0] for x, y in zip(at, at[1:])) and sum(at[-1]) <= 256
    assert packing.pack(none).count() == 0


def test_pack_by_tokens(spark, odd):
    encode = token_counts.encoder().encode_ordinary
    docs = odd.unionByName(frame(spark, [(50, "\u4eca\u5929\u5929\u6c14\u5f88\u597d" * 200, "zh", "b", 0)]), allowMissingColumns=True)
    got = packing.pack(docs, capacity=512, length=token_counts.token_length(F.col("text"))).collect()
    size, fill = Counter(), Counter()
    for r in got:
        size[r.doc_id] += r.length
        if r.bin_id is not None:
            fill[r.bin_id] += r.length
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(encode(r.text or ""))
    assert size == want and max(fill.values()) <= 512 and size[50] > 1024


# ------------------------------------------------------------------ toxicity
def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    labels = table(spark, d, "labels")
    rows = toxicity.score_toxicity(table(spark, d, "documents"), labels)
    assert rows.count() == 1000
    got = rows.join(labels, "doc_id").where("held_out").collect()
    pos, neg = [r.score for r in got if r.toxic == 1], [r.score for r in got if r.toxic == 0]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc > 0.85 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, None, 1), (2, 0, 0), (2, 0, 1), (None, 0, 1), (7, 1, None), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(odd, labels)
    assert got.count() == odd.count() and got.where("score is null or predicted is null").count() == 0
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert toxicity.score_toxicity(odd, labels.where("false")).where("score != 0").count() == 0


def test_toxicity_features():
    lex = {"idiot": 5.0}
    f = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT!! an 1d10t, an i.d.i.o.t and idiooot", lex)))
    assert f["hits"] == 1 and f["near_person"] == 1 and f["hidden"] == 3 and f["shouting"] > 0
    assert toxicity.features(None, lex) == toxicity.features("", lex) == [0.0] * len(toxicity.FEATURES)


# ------------------------------------------------------------------ URL filter
def test_url_filter_against_brute_force(spark):
    rng = random.Random(2)
    day = lambda h: datetime(2024, 1, 1 + h // 24, h % 24)
    hosts = ["a.example.com", "b.a.example.com", "other.org"]
    urls = [f"https://{h}/{p}" for h in hosts for p in ("x", "x/y", "z/", "")] + ["HTTP://A.example.COM:80/x?q=1#f"]
    captures = [(i, rng.choice(urls), day(rng.randrange(240))) for i in range(120)]
    captures += [(900, None, day(3)), (901, urls[0], None), (902, "", day(3)), (0, *captures[0][1:])]
    pats = [("host", "a.example.com"), ("domain", "example.com"), ("prefix", "a.example.com/x"), ("url", "a.example.com/x"),
            ("host", None), ("domain", "org")]
    entries = [(i, rng.choice(["block", "block", "allow"]), *rng.choice(pats), rng.choice(["add", "remove"]),
                day(rng.randrange(240))) for i in range(60)] + [(99, "block", "domain", "org", "add", None)]
    c = spark.createDataFrame(captures, "capture_id long, url string, fetched timestamp").withColumn("kind", F.lit("k"))
    e = spark.createDataFrame(entries, "entry_id long, list string, kind string, pattern string, action string, at timestamp")

    def norm(u):
        u = re.sub(r"[?#].*$", "", re.sub(r"^[A-Za-z]+://", "", u or ""))
        host, _, path = u.partition("/")
        host = re.sub(r":\d*$", "", host).lower()
        return host + ("/" + path if path else "").rstrip("/") if host else None

    def active(u, at):
        state = {}
        for i, lst, kind, pat, action, t in sorted((x for x in entries if x[5] and x[3]), key=lambda x: (x[5], x[4], x[0])):
            if t <= at:
                state[lst, kind, pat] = action
        host = u.split("/")[0]
        match = {"url": lambda p: p == u, "host": lambda p: p == host, "domain": lambda p: ("." + host).endswith("." + p),
                 "prefix": lambda p: u == p or u.startswith(p + "/")}
        return [k for k, a in state.items() if a == "add" and match[k[1]](k[2])]

    want = Counter()
    for i, u, at in captures:
        n = norm(u)
        hit = active(n, at) if n and at else []
        order = {"url": 4, "prefix": 3, "host": 2, "domain": 1}
        top = max(hit, key=lambda k: (order[k[1]], len(k[2]), k[0] == "allow"), default=None)
        want[i, bool(top) and top[0] == "block", len(hit)] += 1
    got = Counter((r.capture_id, r.blocked, r.n_active) for r in url_filter.filter_urls(c, e).collect())
    assert got == want and any(k[1] for k in got) and any(k[2] and not k[1] for k in got)
    assert url_filter.filter_urls(c, e.where("false")).where("blocked").count() == 0
    assert url_filter.filter_urls(c.where("false"), e).count() == 0


def test_url_filter_of_a_hot_host(spark):
    # many entries of one host in one hour, held over years, ties of time, lists and actions that are null
    rng = random.Random(3)
    start = datetime(1969, 12, 31, 23)
    at = lambda s: start + timedelta(milliseconds=round(s * 1000))
    times = [rng.randrange(0, 9000) / 2 for _ in range(400)] + [4e8 + rng.randrange(0, 9000) for _ in range(50)]
    entries = [(i, rng.choice(["block", "allow", None]), "host", "h.org", rng.choice(["add", "remove", None]), at(s))
               for i, s in enumerate(times)]
    asked = [rng.randrange(-2000, 20_000) / 2 for _ in range(300)] + [2e8, 4e8 - 1, 4e8 + 20_000, 9e8] + times[:20]
    c = spark.createDataFrame([(i, "http://h.org/", at(s)) for i, s in enumerate(asked)], "capture_id long, url string, fetched timestamp")
    e = spark.createDataFrame(entries, "entry_id long, list string, kind string, pattern string, action string, at timestamp")
    want = {}
    for i, s in enumerate(asked):
        state = {}
        for x in sorted((x for x in entries if x[5] <= at(s)), key=lambda x: (x[5], x[4] or "")):
            state[x[1]] = x[4] == "add"
        on = {k for k, v in state.items() if v}
        want[i] = ("block" in on and "allow" not in on, len(on))
    got = url_filter.filter_urls(c, e)
    assert {r.capture_id: (r.blocked, r.n_active) for r in got.collect()} == want
    assert {n for _, n in want.values()} == {0, 1, 2, 3} and {b for b, _ in want.values()} == {True, False}
    # a capture meets the entries in the order of time: no join pairs it with all of a pattern's entries of a day
    joins = re.findall(r"Join .*", got._jdf.queryExecution().optimizedPlan().toString())
    assert joins and not any(re.search(r"[<>]=? ", x.replace("<=>", "=")) for x in joins)


def test_url_query_has_both_outcomes(spark):
    from dirlens.llm import queries
    rows = queries.op2(spark, "/root/testdata/sf0.01").collect()
    assert {r.blocked for r in rows} == {True, False} and any(r.n_active and not r.blocked for r in rows)


# ------------------------------------------------------------------ own columns
def test_own_columns_keep_their_values(spark):
    rows = [(1, "one two three four", "en", "a", 0), (2, "ONE two three four", "en", "a", 0), (3, "drei vier acht elf", "de", "b", 0)]
    names = ("own", "key", "place", "found", "size", "twin", "at", "lists", "words", "plan_id", "id", "__size", "__key", "__found",
             "__id", "__th", "__won", "__at", "node", "th")
    docs = frame(spark, rows)
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name + " of "), F.col("doc_id").cast("string")))
    for drop in (exact_dedup.drop_duplicates, lang_id.keep_identified, near_dup.drop_near_duplicates, mixing.training_order):
        got = drop(docs)
        assert got.columns == docs.columns
        stay = got.collect()
        assert stay
        for r in stay:
            assert all(r[name] == f"{name} of {r.doc_id}" for name in names), drop


def test_word_counts(spark):
    texts = ["", None, " ", "a", " a ", "a  b", "\ta\x0bb\x0c\rc\n", "é x y", "a" * 50_000, "x " * 40_000, " a", "\x1ca\x1c b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in docs.select(n_words(F.col("text"))).collect()] == [len(words(t)) for t in texts]


def test_dyadic_ranges(spark):
    from dirlens.llm.url_filter import ranges, ranges_of_day
    rows = [(a, b) for a in range(0, 21) for b in range(a, 21)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = df.select("a", "b", ranges(F.col("a"), F.col("b"), F.lit(5)).alias("r")).collect()
    for r in got:
        days = [d for x in r.r for d in range(x.node << x.level, (x.node + 1) << x.level)]
        assert sorted(days) == list(range(r.a, r.b + 1))                  # all days, none twice
        assert len(r.r) <= 2 * math.log2(r.b - r.a + 2)
    for r in spark.range(21).select("id", ranges_of_day(F.col("id").cast("int"), F.lit(5)).alias("r")).collect():
        assert [(x.level, x.node) for x in r.r] == [(v, r.id >> v) for v in range(6)]


def test_shards_by_few_writers(spark, tmp_path):
    docs = table(spark, SF, "documents").limit(60)
    many = token_binary.materialise(docs, str(tmp_path / "many"), length=128, shard_bytes=1 << 13).collect()
    few = token_binary.materialise(docs, str(tmp_path / "few"), length=128, shard_bytes=1 << 13, writers=3).collect()
    key = lambda rows: sorted((r.slot, r.doc_id, r.seq, r.shard, r.offset) for r in rows)
    assert key(many) == key(few) and len({r.shard for r in few}) > 3
    assert [r.slot for r in sorted(few, key=lambda r: r.slot)] == list(range(len(few)))


def test_mix_of_many_rows_without_an_id(spark):
    # one size, no ids, texts that differ: they spread over the buckets and a target is met
    rows = [(None, f"w{i} x y z", "en", "a", 0) for i in range(6000)] + [(i, "one two three", "en", "b", 0) for i in range(2000)]
    got = mixing.mix(frame(spark, rows)).groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("goal")).collect()
    assert len(got) == 2 and all(abs(r.t - r.goal) <= 0.01 * r.goal for r in got)


def test_no_labels_lose_no_documents(spark):
    docs = frame(spark, [(1, "some text", None, "a", 0), (2, "1 2 3", None, "a", 0), (3, None, None, "a", 0), (4, "\u00e9", None, "b", 0)])
    assert sorted(r.doc_id for r in lang_id.keep_identified(docs).collect()) == [1, 4]
