"""Page chains, the term index, the ledger, the newest input, bounded files, the epoch log."""
import contextlib
import glob
import io as text_io
import json
import os
import random
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dirlens.operators import termindex
from dirlens.operators.ledger import Ledger
from dirlens.operators.nested import name_terms
from dirlens.operators.pages import page_chain
from dirlens.schemas import PROVIDER_RAW
from dirlens.sources import io
from dirlens.streaming import ingest

SF = "/root/testdata/sf0.001"


def plan(df):
    buf = text_io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def walked(starts, nxt, pages):
    out = []
    for s in starts:
        at, depth = s, 1
        while at is not None and depth <= pages:
            out.append((s, depth, at))
            at, depth = (nxt[at] if nxt.get(at) != at else None) if at in nxt else None, depth + 1
    return sorted(out)


def test_page_chain_against_walking(spark):
    rnd = random.Random(4)
    # long chains, self-links, cycles, dead ends, a start without a page
    nxt = {f"c{i}": f"c{i + 1}" for i in range(30)} | {"s": "s", "x": "y", "y": "z", "z": "x", "d": "e"}
    nxt |= {f"r{i}": f"r{rnd.randrange(40)}" for i in range(40)}
    starts = ["c0", "c25", "s", "x", "d", "nowhere"] + [f"r{i}" for i in range(0, 40, 3)]
    edges = spark.createDataFrame([*nxt.items(), ("gone", None)], "url string, next_url string")
    asked = spark.createDataFrame([(s,) for s in starts], "start_url string")
    for pages in (1, 2, 7, 10, 16):
        got = sorted(tuple(r) for r in page_chain(asked, edges, pages).collect())
        assert got == walked(starts, nxt, pages), pages


def test_term_index(spark, tmp_path):
    rnd = random.Random(6)
    vocab = [f"t{i}" for i in range(30)]
    rows = [(i, [rnd.choice(vocab) for _ in range(rnd.randint(0, 8))]) for i in range(300)] + [(300, None), (301, [None, "t1"])]
    rows += [(i, ["all"]) for i in range(400, 500)]
    df = spark.createDataFrame(rows, "id long, words array<string>")
    path = str(tmp_path / "index")
    termindex.write_index(df, path, "id", F.col("words"), buckets=8, splits=3)
    index = termindex.TermIndex(spark, path, buckets=8)
    keys = lambda found: sorted(r.key for r in found.collect())
    for asked in (["t1"], ["t1", "t2"], ["t3", "t3", "t7", "t9"], ["all", "t1"], ["t1", "unseen"], ["unseen"], []):
        sets = [(i, set(w or [])) for i, w in rows]
        assert keys(index.find_any(asked)) == sorted(i for i, w in sets if w & set(asked)), asked
        assert keys(index.find_all(asked)) == sorted(i for i, w in sets if asked and w >= set(asked)), asked
    # the asked terms' folders alone, and their rows by the sorted column's bounds
    p = plan(index.find_any(["t1"]))
    assert "PartitionFilters: [isnotnull(bucket" in p and "In(term" in p or "EqualTo(term,t1)" in p
    read = index._of(index.postings, ["t1"]).select("key", "bucket").select(F.input_file_name().alias("f")).distinct().collect()
    assert {os.path.basename(os.path.dirname(r.f)) for r in read} == {f"bucket={spark.range(1).select(termindex._bucket(F.lit('t1'), 8)).first()[0]}"}


def test_term_index_on_names(spark, tmp_path):
    part = spark.read.parquet(f"{SF}/part.parquet")
    termindex.write_index(part, str(tmp_path / "i"), "p_partkey", name_terms("p_name"))
    got = {r.key for r in termindex.TermIndex(spark, str(tmp_path / "i")).find_all(["red"]).collect()}
    assert got == {r.p_partkey for r in part.collect() if "red" in r.p_name.lower().split()}


def test_ledger_processes_each_key_once(spark, tmp_path):
    rnd = random.Random(2)
    for bits in (1 << 16, 64):            # the second filter knows nearly every key: the table decides
        ledger = Ledger(spark, str(tmp_path / str(bits)), bits=bits, buckets=4)
        seen, times = set(), {}
        for _ in range(4):
            keys = [rnd.randrange(400) for _ in range(150)] + [None]
            df = spark.createDataFrame([(k, "x") for k in keys], "k long, v string")
            fresh = ledger.pending(df, "k")
            got = [r.k for r in fresh.collect()]
            assert sorted(k for k in got if k is not None) == sorted(k for k in keys if k is not None and k not in seen)
            assert got.count(None) == 1
            ledger.record(fresh, "k")
            for k in set(got) - {None}:
                times[k] = times.get(k, 0) + 1
            seen |= set(keys) - {None}
        assert set(times.values()) == {1}
        assert ledger.keys().count() == len(seen)


def test_newest_input_opens_no_other(spark, tmp_path):
    df = spark.range(20).select(F.col("id"), (F.col("id") % 2).alias("half"))
    old, new = str(tmp_path / "runs" / "a"), str(tmp_path / "runs" / "b")
    df.where("half = 0").repartition(2).write.parquet(old)
    time.sleep(1.1)
    df.where("half = 1").repartition(3).write.parquet(new)
    got = io.read_newest(spark, str(tmp_path / "runs"), df.schema, by="folder")
    assert sorted(r.id for r in got.collect()) == list(range(1, 20, 2))
    assert got.inputFiles() and all("/runs/b/" in f for f in got.inputFiles())
    one = sorted(glob.glob(new + "/*.parquet"))[0]
    later = time.time() + 60
    os.utime(one, (later, later))
    assert [f.rsplit("/", 1)[1] for f in io.read_newest(spark, str(tmp_path / "runs"), df.schema).inputFiles()] == [os.path.basename(one)]


def test_files_are_bounded_in_bytes(spark, tmp_path):
    rows = [(i, "é" * (i % 50) + '"\n', None if i % 3 else "b") for i in range(300)] + [(999, "x" * 5000, "long")]
    df = spark.createDataFrame(rows, "id long, text string, other string")
    io.write_envelope(df.repartition(2), str(tmp_path / "env"), "gigs", {"source": "é"}, bytes_per_file=2000)
    io.write_lists(df.repartition(2), str(tmp_path / "lists"), rows_per_file=40, bytes_per_file=1 << 20)
    env, lists = (glob.glob(str(tmp_path / d / "**" / "*.txt"), recursive=True) for d in ("env", "lists"))
    assert sum(os.path.getsize(f) > 2200 for f in env) == 1                    # the one record that is longer
    assert all(json.load(open(f, encoding="utf-8"))["metadata"] == {"source": "é"} for f in env)
    assert max(len(json.load(open(f, encoding="utf-8"))) for f in lists) == 40
    for path in ("env", "lists"):
        back = io.read_mixed(spark, str(tmp_path / path), "gigs", df.schema)
        assert sorted(tuple(r) for r in back.drop("seq").collect()) == sorted(rows, key=lambda r: r[0])


def test_epoch_log_is_compacted(spark, tmp_path):
    src, work = str(tmp_path / "in"), str(tmp_path / "work")
    schema = "k long, v long, seq long"
    want = {}
    for e in range(25):
        rows = [(k, e * 100 + k, e * 10 + i) for i, k in enumerate(random.Random(e).sample(range(30), 5))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        for k, v, s in rows:
            want[k] = (v, min(want.get(k, (0, s))[1], s))
    df = ingest.stream_last_wins(spark, src, spark.read.parquet(src).schema, ["k"], "seq", work, max_files_per_trigger=1)
    newest = {}
    for r in spark.read.parquet(src).orderBy("seq").collect():
        newest[r.k] = (r.v, min(newest.get(r.k, (0, r.seq))[1], r.seq))
    assert {r.k: (r.v, r.seq) for r in df.collect()} == newest
    epochs = len(glob.glob(work + "/table/log/__epoch=*"))
    assert epochs == 25 and len(glob.glob(work + "/table/snapshots/__upto=*")) == 2
    # one snapshot and the epochs after it
    read = {os.path.basename(os.path.dirname(r.f)) for r in ingest._versions(spark, work + "/table").select(F.input_file_name().alias("f")).collect()}
    assert read == {"__upto=19"} | {f"__epoch={e}" for e in range(20, 25)}


def test_malformed_files_come_out_of_the_stream(spark, tmp_path):
    base = tmp_path / "in"
    base.mkdir()
    (base / "good.json").write_text(json.dumps({"providers": [{"name": "A"}, {"name": "B"}]}))
    (base / "broken.json").write_text('{"providers": [{"name": ')
    (base / "other.json").write_text('{"clients": []}')
    good, bad = ingest.provider_stream(spark, str(base), record=PROVIDER_RAW, with_quarantine=True)
    ingest.run_append(good, str(tmp_path / "out"), str(tmp_path / "c1"))
    ingest.run_append(bad, str(tmp_path / "bad"), str(tmp_path / "c2"))
    assert sorted(r.name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["A", "B"]
    files = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted(os.path.basename(r.file) for r in files) == ["broken.json", "other.json"]
    assert any("name" in (r._corrupt_record or "") for r in files)


def test_sketches_merge_and_stay_close(spark):
    from dirlens.operators import stats as A
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 2).alias("kind"), (F.col("id") % 20_011).alias("v"))
    parts = A.distinct_sketches(df, ["kind", "day"], "v")
    exact = {r.kind: r.n for r in df.groupBy("kind").agg(F.count_distinct("v").alias("n")).collect()}
    got = {r.kind: r["distinct"] for r in A.merge_sketches(parts, ["kind"]).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
    assert abs(A.merge_sketches(parts, []).first()[0] - 20_011) <= 0.05 * 20_011


def test_pipeline_reports_what_cannot_be_cleaned(spark, tmp_path):
    from dirlens.plans.pipelines import run_documents, run_pipeline
    base = tmp_path / "in"
    base.mkdir()
    (base / "a.json").write_text(json.dumps({"metadata": {"country_code": "BD", "total_records": 4},
                                             "providers": [{"name": "Acme"}, None, {"name": "ACME"}, {"name": "Zeta", "website": "z.com"}]}))
    (base / "b.json").write_text(json.dumps({"metadata": {"country_code": "PE", "total_records": 2}, "providers": [{"name": "Other"}, {}]}))
    raw = io.read_envelope(spark, str(base), "providers", PROVIDER_RAW, with_metadata=True)
    out = run_pipeline(raw)
    m = out["metrics"].first()
    assert (m.original_count, m.cleaned_count, m.unique_count) == (6, 4, 3)
    bad = out["quarantine"].collect()
    assert sorted((os.path.basename(r.seq.file), r.seq.pos, r.quarantine_reason) for r in bad) == [
        ("a.json", 1, "not a record"), ("b.json", 1, "not a record")]
    runs = {r.country_code: (r.total_records, r.original_count, r.cleaned_count, r.unique_count)
            for r in run_documents(out["metrics"], raw).collect()}
    assert runs == {"BD": (4, 6, 4, 3), "PE": (2, 6, 4, 3)}


def test_nested_references_golden(spark):
    from dirlens.operators.nested import flatten_dedup_sort, flatten_references
    from dirlens.schemas import PARTNER_DETAILED

    def partner(name, tier, pid, refs):
        return (name, tier, None, None, pid, None, None, None, None, None, refs)
    refs = [("x", "Retail shop", ["CRM", "HR"], None), ("x", "health app", [], "done"), ("y", None, None, "kept")]
    rows = [(*partner("A", "Gold", "1", refs), 0), (*partner("B", "Bronze", "2", []), 1), (*partner("C", "Gold", "3", None), 2)]
    df = spark.createDataFrame(rows, T.StructType([*PARTNER_DETAILED.fields, T.StructField("seq", T.LongType())]))
    assert flatten_references(df).count() == 5
    got = [(r["Partner Name"], r["Client Name"], r["Client Industry"], r["Modules Implemented"], r["Key Outcomes"])
           for r in flatten_dedup_sort(df).collect()]
    assert got[0] == ("A", "x", "Healthcare", "", "done") and got[1][:2] == ("A", "y") and got[1][3:] == ("", "kept")
    assert got[2:] == [("C", "N/A", "N/A", "", ""), ("B", "N/A", "N/A", "", "")]


def test_missing_paths_and_dictionary(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from dirlens.config import load_dictionary
    for read in (lambda p: io.read_envelope(spark, p, "providers", PROVIDER_RAW), lambda p: io.read_mixed(spark, p, "providers", PROVIDER_RAW),
                 lambda p: io.read_table(spark, p, PROVIDER_RAW)):
        with pytest.raises(AnalysisException) as e:
            read(str(tmp_path / "nowhere")).count()
        assert e.value.getCondition() == "PATH_NOT_FOUND"
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"countries": {"PE": {"name": "Peru", "full_name": "Republic of Peru", "region": "LatAm"}},
                                "industries": {"normalization_map": {"shops": "Retail"}},
                                "service_modules": {"module_aliases": {"crm": "CRM"}},
                                "data_quality_rules": {"mandatory_fields": {"providers": ["name"]},
                                                       "completeness_weights": {"providers": {"name": 1.0}}}}))
    d, rules = load_dictionary(str(path))
    frames = io.dictionary_frames(spark, d)
    assert [tuple(r) for r in frames["countries"].collect()] == [("PE", "Peru", "Republic of Peru", "LatAm")]
    assert {r.key: r.code for r in frames["country_keys"].collect()}["peru"] == "PE"
    assert d.industry_aliases == {"shops": "Retail"} and d.module_aliases == {"crm": "CRM"}
    assert rules.mandatory == ["name"] and rules.weights == {"name": 1.0}
    assert rules.entities["providers"] == ["name"] and rules.entities["references"] == ["client_id", "description"]
    assert {r.key: r.name for r in frames["module_keys"].collect()}["crm"] == "CRM"
    assert {r.key: r.name for r in frames["industry_keys"].collect()}["shops"] == "Retail"
    assert "Retail" in {r.name for r in frames["industries"].collect()}


def test_terms_by_lookup_and_rules_of_every_entity(spark):
    import pytest

    from dirlens.config import QualityRules
    from dirlens.operators.quality import check_entity, mandatory_report
    keys = io.dictionary_frames(spark)["industry_keys"]
    rows = [(1, " building\n"), (2, "IT & technology"), (3, "Mining"), (4, ""), (5, None), (6, "RETAIL"), (7, "shop")]
    got = dict(io.normalize_term_join(spark.createDataFrame(rows, "id int, name string"), "name", keys).collect())
    assert got == {1: "Construction", 2: "IT & Technology", 3: None, 4: None, 5: None, 6: "Retail", 7: "Retail"}

    clients = spark.createDataFrame([("x", "1", "Retail"), ("", "1", None), (None, None, "Retail")], "client_name string, provider_id string, industry string")
    assert [r.ok for r in clients.select(check_entity(clients, "clients").alias("ok")).collect()] == [1, 0, 0]
    bare = clients.drop("industry").limit(1)
    found = {(r.entity, r.field): (r.n_rows, r.n_missing)
             for r in mandatory_report({"clients": clients, "references": clients.limit(0)}).collect()}
    assert found == {("clients", None): (3, 2), ("clients", "client_name"): (3, 2), ("clients", "provider_id"): (3, 1),
                     ("clients", "industry"): (3, 1), ("references", None): (0, 0), ("references", "client_id"): (0, 0),
                     ("references", "description"): (0, 0)}
    assert {r.n_missing for r in mandatory_report({"clients": bare}).where("field = 'industry'").collect()} == {1}
    with pytest.raises(ValueError, match="no rules for 'shops'"):
        check_entity(clients, "shops", QualityRules())


def _counted_texts(spark):
    """Twenty texts behind a function that counts its calls."""
    ran = spark.sparkContext.accumulator(0)

    def text(i):
        ran.add(1)
        return f"alpha beta w{i % 5}x w{i % 3}y"
    return spark.range(20).select("id", F.udf(text, "string")("id").alias("t")), ran


def test_tfidf_splits_each_text_once(spark):
    from dirlens.operators.textml import tfidf
    df, ran = _counted_texts(spark)
    assert tfidf(df, "id", "t", stop_words=[]).count() == 80 and ran.value == 20


def test_tfidf_vectors_are_read_without_the_texts(spark):
    from dirlens.operators.textml import tfidf_vectors
    df, ran = _counted_texts(spark)
    vectors, _ = tfidf_vectors(df, "id", "t", stop_words=[])
    before = ran.value
    assert vectors.count() == 20 and len(vectors.collect()) == 20 and ran.value == before
