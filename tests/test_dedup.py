"""Goldens, a sequential reference loop on random strings, invariants."""
import random
from collections import Counter

from pyspark.sql import functions as F

from dirlens.functions.text import bigrams
from dirlens.operators import dedup
from dirlens.operators.dedup import dedup_fuzzy, dedup_last, similar_pairs


def shares(a, b, t):
    """Whether two lower-cased names count as duplicates, from the definition: equal names do; others
    by the share of the bigrams of either that both have. Blank names match nothing."""
    grams_a, grams_b = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    common, either = len(grams_a.keys() & grams_b.keys()), len(grams_a.keys() | grams_b.keys())
    return bool(a) and (a == b or (common > 0 and common >= t * either))


def sequential(names, t):
    """Positions that a first-wins scan keeps."""
    kept = {}
    for at, name in enumerate(n.lower() if n else "" for n in names):
        if not any(shares(name, other, t) for other in kept.values()):
            kept[at] = name
    return list(kept)


def run(spark, names, t, parts=None, first_block=4096):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "seq long, name string")
    if parts:
        df = df.repartition(parts)
    return sorted(r.seq for r in dedup_fuzzy(df, "name", "seq", t, first_block=first_block).collect())


GOLD = ["Acme Consulting", "ACME consulting", "Acme Consulting Ltd", "Acme Consultings", "", "", "x", "X", "y"]


def test_golden(spark):
    assert run(spark, GOLD, 0.85) == [0, 2, 4, 5, 6, 8]
    rev = list(reversed(GOLD))
    assert sorted(8 - i for i in run(spark, rev, 0.85)) == [2, 3, 4, 5, 7, 8]


def test_random_against_loop(spark):
    rnd = random.Random(7)
    for alphabet, t in (("abcd", 0.5), ("ab\U0001F600c", 0.6), ("ab", 0.85)):
        names = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(150)]
        want = sequential(names, t)
        assert run(spark, names, t) == want
        assert run(spark, names, t, parts=7) == want


def test_chain_needs_many_rounds(spark):
    # each name is similar to its neighbours only: a chain, the adversarial order
    names = ["ab" * 3 + "x" * i for i in range(1, 20)]
    assert run(spark, names, 0.6) == sequential(names, 0.6)


def test_bigrams_of_characters_beyond_the_basic_plane(spark):
    df = spark.createDataFrame([("a\U0001F600b",), ("\U0001F600\U0001F601",), ("ab",)], "s string")
    got = [r[0] for r in df.select(bigrams(F.col("s"))).collect()]
    assert got == [["a\U0001F600", "\U0001F600b"], ["\U0001F600\U0001F601"], ["ab"]]


def test_pairs_exact(spark):
    rnd = random.Random(3)
    names = sorted({"".join(rnd.choice("abcde") for _ in range(rnd.randint(2, 8))) for _ in range(120)})
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "seq long, name string")
    got = {(r.src_k, r.dst_k) for r in similar_pairs(df, "name", "seq", 0.5, with_keys=True).collect()}
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if shares(a, b, 0.5)}
    assert got == want


def test_blocks_audit_and_split_groups(spark, monkeypatch):
    # small blocks of the order, small groups and small tasks: the same rows, and the first kept match of each dropped one
    monkeypatch.setattr(dedup, "MEMBERS", 7)
    monkeypatch.setattr(dedup, "TASK_ROWS", 200)
    rnd = random.Random(5)
    names = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 9))) for _ in range(120)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "seq long, name string")
    kept, audit = dedup_fuzzy(df, "name", "seq", 0.5, with_audit=True, first_block=20)
    keep = sequential(names, 0.5)
    assert sorted(r.seq for r in kept.collect()) == keep
    got = {r.dropped_seq: (r.matched_seq, round(r.similarity, 9)) for r in audit.collect()}
    want = {}
    for i, n in enumerate(names):
        if i not in keep:
            j = next(j for j in keep if j < i and shares(n.lower(), names[j].lower(), 0.5))
            a, b = (set(zip(x, x[1:])) for x in (n, names[j]))
            want[i] = (j, 1.0 if n == names[j] else round(len(a & b) / len(a | b), 9))
    assert got == want


def test_more_tokens_than_the_bitset_holds(spark, monkeypatch):
    monkeypatch.setattr(dedup.token_vectors, "__defaults__", (64,))
    rnd = random.Random(8)
    names = sorted({"".join(rnd.choice("abcdefghijklm") for _ in range(rnd.randint(2, 9))) for _ in range(150)})
    names += [n + rnd.choice("abc") for n in names[:60]]
    assert run(spark, names, 0.6) == sequential(names, 0.6)


def test_no_names(spark):
    assert run(spark, [], 0.85) == [] and run(spark, ["", None], 0.85) == [0, 1] and run(spark, ["a", "b", "A"], 0.85) == [0, 1]


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 10, 0), (1, "b", 20, 1), (1, "a", 30, 2)],
                               "k long, c string, v long, seq long")
    got = sorted(tuple(r) for r in dedup_last(df, ["k", "c"], "seq").collect())
    assert got == [(1, "a", 30, 0), (1, "b", 20, 1)]


def test_documents_whole_text_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", F.col("doc_id").alias("seq"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = [rows[i][0] for i in sequential([t for _, t in rows], 0.85)]
    got = sorted(r.doc_id for r in dedup_fuzzy(docs, "text", "seq", 0.85).collect())
    assert got == want


def test_dense_index(spark):
    from dirlens.operators.dedup import dense_index
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("v"))
    got = [(r.v, r.id) for r in dense_index(df, F.desc("v")).orderBy("id").collect()]
    vals = sorted((r.v for r in df.collect()), reverse=True)
    assert [i for _, i in got] == list(range(len(vals)))
    assert [v for v, _ in got] == vals


def test_a_set_moves_for_blocks_not_for_shared_bigrams(spark, monkeypatch):
    def counting(t, cross):
        def rows_met(table):
            import numpy as np
            import pyarrow as pa
            at = table.column("at").to_numpy()
            return pa.table({"src": at, "dst": at, "sim": np.random.default_rng().random(len(at))})
        return rows_met
    monkeypatch.setattr(dedup, "_compared", counting)
    rnd = random.Random(4)
    names = ["".join(rnd.choice("abcdefgh") for _ in range(80)) for _ in range(60)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "seq long, name string")
    assert similar_pairs(df, "name", "seq", 0.85).count() <= 2 * len(names)


def test_blocks_of_many_sizes_against_loop(spark, monkeypatch):
    # one size with more sets than a block holds, and sizes that are far apart
    monkeypatch.setattr(dedup, "MEMBERS", 5)
    monkeypatch.setattr(dedup, "TASK_ROWS", 8)
    monkeypatch.setattr(dedup, "LAST_BLOCK", 40)
    rnd = random.Random(9)
    names = ["".join(rnd.choice("abc") for _ in range(rnd.choice((2, 5, 5, 5, 5, 9, 30)))) for _ in range(150)]
    assert run(spark, names, 0.7, first_block=20) == sequential(names, 0.7)


def test_a_round_is_a_few_jobs_of_few_tasks(spark):
    # a chain: every second one is dropped, one a round; its edges come in many partitions
    sc, n = spark.sparkContext, 40
    edges = spark.range(n, numPartitions=24).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).checkpoint()
    sc.setJobGroup("rounds", "rounds")
    try:
        dropped, rounds = dedup.greedy_dropped(edges, few_nodes=True)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.node for r in dropped.collect()) == list(range(1, n + 1, 2)) and rounds == n // 2
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("rounds")]
    tasks = sum(info.numTasks for j in jobs for i in j.stageIds if (info := tracker.getStageInfo(i)))
    assert rounds <= len(jobs) <= 10 * rounds and tasks <= 20 * rounds
    assert sorted(r.node for r in dedup.greedy_dropped(edges.unionByName(edges))[0].collect()) == list(range(1, n + 1, 2))


def test_texts_without_a_supplier_are_not_shuffled(spark, tmp_path):
    from dirlens.plans.bindings import provider_view
    d = str(tmp_path)
    for name, rows, schema in (
            ("supplier", [(1, "a", 0, 5.0), (1, "a", 0, 5.0), (2, "b", None, 9.0), (None, "c", 0, 1.0)],
             "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
            ("nation", [(0, "X", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            ("lineitem", [(1, 7)], "l_suppkey long, l_partkey long"),
            ("part", [(7, "T", "B")], "p_partkey long, p_type string, p_brand string"),
            ("documents", [(1, "one"), (1, "uno"), (None, "none")] + [(i, "rest") for i in range(3, 50)], "doc_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    view = provider_view(spark, d)
    got = Counter((r.provider_id, r.description) for r in view.collect())
    assert got == {("1", "one"): 2, ("1", "uno"): 2, ("2", None): 1, (None, None): 1}
    plan = view._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan


def test_groups_far_apart_are_not_compared(monkeypatch):
    # three alphabets of sets: all links by brute force, in a block, between two, with bigrams beyond the bitset
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(6)
    width, sets = 512, []
    for i in range(900):
        low = 160 * (i % 3)
        s = set((low + rng.choice(160, rng.integers(30, 90), replace=False)).tolist())
        if i % 4 == 0 and sets:                # a near copy of an earlier one, also in what has no bit
            s = set(sets[rng.integers(len(sets))]) ^ {int(low + rng.integers(160)), int(1000 + rng.integers(5))}
        sets.append(s)
    flags = np.zeros((len(sets), width), np.uint8)
    for i, s in enumerate(sets):
        flags[i, [x for x in s if x < width]] = 1
    asked = []
    apart = dedup._apart
    monkeypatch.setattr(dedup, "_apart", lambda x, y, words: asked.append(x.shape[1] * y.shape[1]) or apart(x, y, words))
    monkeypatch.setattr(dedup, "_enough", lambda *a: 3)

    def table(left):
        return pa.table({"at": pa.array(range(len(sets))), "n": pa.array([len(s) for s in sets], pa.int32()), "left": pa.array(left),
                         "bits": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
                         "rare": pa.array([[x for x in s if x >= width] for s in sets], pa.list_(pa.int64()))})

    for t in (0.3, 0.85, 1.0):
        sim = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(sets)) for j in range(i)}
        links = {(j, i): x for (i, j), x in sim.items() if x >= t}
        for left in ([True] * 900, [i % 2 == 0 for i in range(900)], [i < 400 for i in range(900)]):
            want = {k: x for k, x in links.items() if all(left) or left[k[0]] != left[k[1]]}
            asked.clear()
            got = dedup._compared(t, False)(table(left)).to_pylist()
            assert {(r["src"], r["dst"]): r["sim"] for r in got} == want and len(got) == len(want)
            if t == 0.85:
                assert want and sum(asked) < 0.6 * (810_000 if all(left) else sum(left) * (900 - sum(left)))
        first = {}
        for j, i in sorted(want):
            first.setdefault(i, j)
        got = dedup._compared(t, True)(table(left)).to_pylist()
        assert {r["dst"]: r["src"] for r in got} == first


def test_blocks_grow_while_links_are_few(spark, monkeypatch):
    rnd = random.Random(12)
    names = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 7))) for _ in range(160)]
    greedy, blocks = dedup.greedy_dropped, []
    monkeypatch.setattr(dedup, "greedy_dropped", lambda edges, **kw: blocks.append(1) or greedy(edges, **kw))
    took = {}
    for few in (10 ** 6, 0):
        monkeypatch.setattr(dedup, "FEW_LINKS", few)
        blocks.clear()
        assert run(spark, names, 0.5, first_block=20) == sequential(names, 0.5)
        took[few] = len(blocks)
    n = len(set(names))
    assert took[0] == -(-n // 20) and took[10 ** 6] == 3 + (n > 140)
