"""Cascading deletes: what is left, and which files are written anew."""
import glob
import os

from dirlens.operators.cascade import cascade_delete
from dirlens.operators.quality import orphans


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def table(spark, path, rows):
    df = spark.createDataFrame(rows, "id int, provider string, country string, year int")
    df.write.mode("overwrite").partitionBy("country", "year").parquet(path)
    return df


def left(spark, path):
    return sorted((r["id"], r["provider"], r["country"], r["year"]) for r in spark.read.parquet(path).collect())


def test_only_partitions_with_orphans_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "refs")
    rows = [(1, "a", "BD", 2020), (2, "gone", "BD", 2020), (3, "b", "US", 2020), (4, "b", "US", 2021), (5, "gone", "FR", 2021),
            (6, "gone", "FR", 2021), (7, None, "DE", 2020), (8, "a", None, 2020), (9, "gone", None, 2020), (10, "a", "x/y=z", 2020),
            (11, "gone", "x/y=z", 2020), (12, "gone", "a b+c%", 2022)]
    table(spark, path, rows)
    before = files(path)
    parents = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "provider_id string")
    out = cascade_delete(spark, path, ["country", "year"], "provider", parents, "provider_id")
    assert sorted(((r["country"] or ""), r["year"], r["deleted"], r["kept"]) for r in out.collect()) == [
        ("", 2020, 1, 1), ("BD", 2020, 1, 1), ("FR", 2021, 2, 0), ("a b+c%", 2022, 1, 0), ("x/y=z", 2020, 1, 1)]
    assert left(spark, path) == sorted(((r for r in rows if r[1] != "gone")), key=lambda r: r[0])
    after = files(path)
    for same in ("country=US/year=2020", "country=US/year=2021", "country=DE/year=2020"):
        mine = {f: t for f, t in before.items() if same in f}
        assert mine and mine == {f: t for f, t in after.items() if same in f}
    assert orphans(spark.read.parquet(path).where("provider IS NOT NULL"), parents, "provider", "provider_id").count() == 0
    again = cascade_delete(spark, path, ["country", "year"], "provider", parents, "provider_id")
    assert again.collect() == [] and files(path) == after


def test_a_hot_partition_is_many_files_and_no_row_is_lost(spark, tmp_path):
    path = str(tmp_path / "refs")
    rows = [(i, "gone" if i % 7 == 0 else "a", "BD", 2020) for i in range(2000)]
    table(spark, path, rows + rows)
    out = cascade_delete(spark, path, ["country", "year"], "provider", spark.createDataFrame([("a",)], "p string"), "p",
                         rows_per_file=300).first()
    assert (out["deleted"], out["kept"]) == (572, 3428)
    assert left(spark, path) == sorted(r for r in rows + rows if r[1] == "a")
    assert len(files(path)) > 1


def test_no_parents(spark, tmp_path):
    path = str(tmp_path / "refs")
    table(spark, path, [(1, "a", "BD", 2020), (2, None, "BD", 2020), (3, "b", "US", 2020)])
    cascade_delete(spark, path, ["country", "year"], "provider", spark.createDataFrame([], "p string"), "p")
    assert left(spark, path) == [(2, None, "BD", 2020)]
