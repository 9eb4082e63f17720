"""Readers/writers round trips, streaming last-wins, KMeans invariants."""
import os
import tempfile

from pyspark.sql import functions as F

from dirlens.operators import textml as M
from dirlens.sources import io
from dirlens.streaming.ingest import stream_last_wins

SF = "/root/testdata/sf0.001"


def test_envelope_and_mixed(spark):
    base = tempfile.mkdtemp(prefix="dirlens-io-")
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    io.write_envelope(cust.where(F.col("c_acctbal") > 0), base + "/env", "providers", rows_per_file=7)
    io.write_lists(cust.where(~(F.col("c_acctbal") > 0)), base + "/lists", rows_per_file=7)
    with open(os.path.join(base, "broken.json"), "w") as f:
        f.write("{oops")
    good, bad = io.read_mixed(spark, base, "providers", cust.schema, with_quarantine=True)
    assert good.count() == cust.count()
    assert sorted(r.c_custkey for r in good.collect()) == sorted(r.c_custkey for r in cust.collect())
    assert bad.count() == 1
    lists, rejected = io.read_lists(spark, base + "/lists", cust.schema)
    assert lists.count() == cust.where(~(F.col("c_acctbal") > 0)).count() and rejected.count() == 0
    # positions are stable within a file and start at 0
    assert good.agg(F.min("seq.pos")).first()[0] == 0


def test_envelope_keeps_metadata_and_malformed_files(spark):
    from dirlens.schemas import PROVIDER_RAW
    base = tempfile.mkdtemp(prefix="dirlens-env-")
    good = '{"metadata": {"country_code": "BD", "total_records": 2}, "providers": [{"name": "A"}, {"name": "B"}]}'
    for name, text in (("good", good), ("broken", '{"providers": [{"name": '), ("other", '{"clients": []}')):
        with open(os.path.join(base, f"{name}.json"), "w") as f:
            f.write(text)
    rows, bad = io.read_envelope(spark, base, "providers", PROVIDER_RAW, with_metadata=True, with_quarantine=True)
    assert sorted((r.name, r.metadata.country_code, r.metadata.total_records, r.seq.pos) for r in rows.collect()) == [
        ("A", "BD", 2, 0), ("B", "BD", 2, 1)]
    assert sorted(os.path.basename(r.file) for r in bad.collect()) == ["broken.json", "other.json"]
    assert [r.name for r in io.read_envelope(spark, base, "providers", PROVIDER_RAW).orderBy("seq").collect()] == ["A", "B"]


def test_flat_csv_and_empty(spark):
    base = tempfile.mkdtemp(prefix="dirlens-csv-")
    df = spark.createDataFrame([("a", ["x", "y"])], "k string, v array<string>")
    assert io.to_flat_csv(df, base + "/out")
    back = io.read_table(spark, base + "/out", io.flatten_lists(df).schema).first()
    assert back.v == "x; y"
    assert not io.to_flat_csv(df.where(F.lit(False)), base + "/empty")
    assert not os.path.exists(base + "/empty")


def test_stream_last_wins(spark):
    work = tempfile.mkdtemp(prefix="dirlens-stream-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = stream_last_wins(spark, SF, ev.schema, ["user_id", "event_type"], "event_id", work,
                           file_glob="events.parquet")
    want = (ev.groupBy("user_id", "event_type")
            .agg(F.max_by("value", "event_id").alias("value"), F.min("event_id").alias("event_id")))
    got = sorted(tuple(r) for r in out.select("user_id", "event_type", "value", "event_id").collect())
    assert got == sorted(tuple(r) for r in want.collect())


def test_kmeans_invariants(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("lang") == "en")
    n = docs.count()
    vecs, vocab = M.tfidf_vectors(docs.select("doc_id", "text"), "doc_id", "text", 200)
    assert 0 < len(vocab) <= 200
    model, k = M.cluster(vecs, k=4, seed=42, n_init=2, max_iter=20)
    pred = model.transform(vecs)
    assert pred.count() == n
    assert pred.where((F.col("cluster") < 0) | (F.col("cluster") >= k)).count() == 0
    labels = M.label_clusters(M.top_terms(model, vocab, spark, 3))
    assert labels.count() <= k


def test_provider_stream_and_observed(spark):
    from dirlens.plans.bindings import provider_view
    from dirlens.plans.pipelines import observed
    from dirlens.operators.clean_records import clean_providers
    from dirlens.operators.quality import score_providers
    from dirlens.streaming.ingest import provider_stream, run_append

    base = tempfile.mkdtemp(prefix="dirlens-pstream-")
    raw = provider_view(spark, SF).drop("seq")
    io.write_envelope(raw, base + "/in", "providers", rows_per_file=3)
    run_append(provider_stream(spark, base + "/in"), base + "/out", base + "/_ckpt")
    got = spark.read.parquet(base + "/out")
    want = score_providers(clean_providers(raw, keep=()))
    cols = ["provider_id", "name", "country", "data_completeness_score", "data_quality_score"]
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(tuple(r) for r in want.select(cols).collect())

    df, obs = observed(raw, "raw")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == raw.count()


def test_flat_csv_asks_the_source_whether_there_are_rows(spark, tmp_path):
    from pyspark.sql import functions as F
    from dirlens.sources import io
    ran = spark.sparkContext.accumulator(0)

    def seen(x):
        ran.add(1)
        return x
    df = spark.range(3).select(F.udf(seen, "long")("id").alias("v")).orderBy("v")
    assert not io.to_flat_csv(df, str(tmp_path / "none"), source=spark.range(0)) and ran.value == 0
    assert not (tmp_path / "none").exists()
    assert io.to_flat_csv(df, str(tmp_path / "some"), source=spark.range(1), compression="gzip")
    back = spark.read.option("header", True).csv(str(tmp_path / "some"))
    assert sorted(r.v for r in back.collect()) == ["0", "1", "2"]
