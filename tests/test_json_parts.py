"""Big JSON files read in parts, held against the standard library's parser."""
import json
import random

import pytest
from pyspark.sql import types as T

from dirlens.sources import json_parts
from dirlens.sources.json_parts import read_parts

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("tags", T.ArrayType(T.StringType()))])
ODD = ['plain', 'quote " inside', 'back\\slash', 'ends with \\', 'many \\\\\\\\ and \\"', '[{,}]', '"providers": [', '',
       'line\nbreak', 'ünïcödé ✓', 'x' * 700, '\\' * 90 + '"', '}, {"id": 9', '"']


def made(rng, n):
    return [{"id": i, "name": rng.choice(ODD), "tags": [rng.choice(ODD) for _ in range(rng.randrange(3))]} for i in range(n)]


def written(rng, value):
    return json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1, 3]),
                      separators=rng.choice([(",", ":"), (" , ", " : ")]))


def rows(df):
    return sorted((r["seq"]["file"].rsplit("/", 1)[1], r["seq"]["pos"], r["id"], r["name"], tuple(r["tags"] or ()))
                  for r in df.collect())


def expected(files):
    return [(name, r["id"], r["name"], tuple(r["tags"])) for name, recs in sorted(files.items()) for r in recs]


@pytest.mark.parametrize("part_bytes", [7, 61, 400, 1 << 20])
def test_parts_of_any_size_give_the_same_records(spark, tmp_path, part_bytes):
    rng, files = random.Random(5), {}
    for i in range(4):
        recs = made(rng, 2 if part_bytes == 7 else 30)
        head = {"metadata": {"note": rng.choice(ODD), "providers": [1, 2], "more": [[{"id": 1}]]}}
        value = recs if i == 0 else {**head, "providers": recs} if i < 3 else {"providers": recs, **head, "other": [{"id": 7}]}
        (tmp_path / f"f{i}.json").write_text(written(rng, value), encoding="utf-8-sig" if i == 2 else "utf-8")
        files[f"f{i}.json"] = recs
    good, bad = read_parts(spark, str(tmp_path), RECORD, "providers", part_bytes)
    got = rows(good)
    assert [(g[0], *g[2:]) for g in got] == expected(files)      # in file order by position
    assert len({g[:2] for g in got}) == len(got)
    assert bad.collect() == []


@pytest.mark.parametrize("part_bytes", [16, 4096])
def test_quarantine(spark, tmp_path, part_bytes):
    texts = {"cut.json": '{"providers": [{"id": 1, "name": "a"}, {"id"', "text.json": "{not json", "blank.json": "  \n ",
             "scalar.json": "17", "other.json": '{"clients": [{"id": 1}]}', "object.json": '{"providers": {"id": 1}}',
             "empty.json": '{"providers": [ ]}', "list.json": "[]",
             "mixed.json": '[{"id": 1, "name": "a", "tags": []}, null, 5, {"id": "x"}, [1], {"id": 2, "name": "b", "tags": null}]'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    good, bad = read_parts(spark, str(tmp_path), RECORD, "providers", part_bytes)
    assert [g[2] for g in rows(good)] == [1, 2]
    found = {(b["file"].rsplit("/", 1)[1], b["reason"], b["_corrupt_record"]) for b in bad.collect()}
    assert found == {("cut.json", "unreadable", None), ("text.json", "unreadable", None), ("blank.json", "empty", None),
                     ("scalar.json", "not a list", None), ("other.json", "no list", None),
                     ("object.json", "no list", None), ("mixed.json", "no record", "5"),
                     ("mixed.json", "no record", '{"id": "x"}'), ("mixed.json", "no record", "[1]")}


def test_lists_alone_and_no_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}]')
    (tmp_path / "b.json").write_text('{"providers": [{"id": 2}]}')
    good, bad = read_parts(spark, str(tmp_path), RECORD)
    assert [g[2] for g in rows(good)] == [1]
    assert [b["reason"] for b in bad.collect()] == ["not a list"]
    (tmp_path / "none").mkdir()
    good, bad = read_parts(spark, str(tmp_path / "none"), RECORD)
    assert good.count() == 0 and bad.count() == 0


def test_a_part_holds_its_own_bytes_and_one_element_more(tmp_path, monkeypatch):
    """One long file: no read is larger than a part and what finishes its last element."""
    recs = [{"id": i, "name": "n" * 100, "tags": []} for i in range(3000)]
    path = tmp_path / "big.json"
    path.write_text(json.dumps({"providers": recs}))
    size, sizes = path.stat().st_size, []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def read_at(self, n, at):
            sizes.append(n)
            return self.f.read_at(n, at)
    plain = json_parts._open
    monkeypatch.setattr(json_parts, "_open", lambda p: Counted(plain(p)))
    monkeypatch.setattr(json_parts, "READ_ON", 512)
    import pyarrow as pa
    key, got, step = json_parts._key_before("providers"), [], 8192
    for start in range(0, size, step):
        text = path.read_bytes()[:start]
        quotes = len(json_parts.marks(text, 0)[2])
        at, n, _ = json_parts.marks(text, 0)
        depth = int(json_parts._STEP[[text[a] for a, k in zip(at, n) if k % 2 == 0]].sum()) if start else 0
        row = {"file": str(path), "start": start, "stop": min(size, start + step), "size": size, "inside": quotes % 2,
               "depth": depth, "listed": depth > 1, "shape": "{"}
        for batch in json_parts._cut_out(key)(iter([pa.RecordBatch.from_pylist([row])])):
            got += [json.loads(v) for v in batch["value"].to_pylist() if v is not None]
    assert got == recs
    assert max(sizes) <= step + json_parts.CONTEXT
