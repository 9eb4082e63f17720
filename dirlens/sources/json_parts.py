"""S1-S3 for big files: one JSON document is read in byte parts, by many tasks.

A multi-line JSON file cannot be split at any byte, as a part alone does not say whether it begins inside a string
or how deep it stands. So the files are read twice:

1. *Outline*: each part counts its unescaped quotes and follows its brackets under both assumptions (it begins outside
   or inside a string). Running sums over the parts of a file then tell every part its true beginning: inside a string
   or not, its depth, and whether the list of records is open. A part leaves one small row.
2. *Elements*: each part, knowing its beginning, cuts out the elements of the list that begin in it and reads on past
   its end only to finish the last one. Their texts are parsed by ``from_json`` against the explicit schema.

Memory: a part, and an element where that is longer. Work: the bytes, twice. Nothing is collected.

Defined results: ``seq`` = (file, byte at which the element's text begins), in file order as the positions of
``io.read_envelope`` are. A file that is neither shape, is cut short or has unbalanced brackets is quarantined whole; an
element that is no record of the schema alone, with its text. ``null`` elements, empty lists and blank files give no
rows (a blank file is quarantined, as it is no document; one of no bytes is not in Spark's listing). An envelope's list is the array under ``field`` at the top level; of
several all count. Between its key, colon and bracket at most ``CONTEXT`` bytes may stand, and blanks before the document
must end in the first part. Files are UTF-8, with or without a byte order mark, and lie where ``pyarrow.fs`` reads them (file, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import cut, ship_package

PART_BYTES = 16 << 20
CONTEXT = 4096
ROWS_BYTES = 4 << 20
READ_ON = 1 << 20
LEAST_TASK = 64 << 10

QUOTE, BACKSLASH, COMMA = 0x22, 0x5C, 0x2C
_STEP = np.zeros(256, np.int64)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[COMMA] = True
BLANK = b" \t\r\n"
BOM = b"\xef\xbb\xbf"


def _open(path: str):
    from pyarrow import fs
    system, name = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1)
                                          if path.startswith("file:") else "file://" + os.path.abspath(path))
    return system.open_input_file(name)


def _slashes_before(f, start: int) -> int:
    """How many backslashes stand right before a byte of the file."""
    n = 0
    while start > 0:
        size = min(CONTEXT, start)
        block = f.read_at(size, start - size)
        run = size - len(block.rstrip(b"\\"))
        n += run
        if run < size:
            break
        start -= size
    return n


def marks(data: bytes, slashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets and commas, the number of unescaped quotes before each, and the places of these quotes."""
    buf = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(buf == QUOTE)
    run = np.zeros(len(quotes), np.int64)
    slash = np.flatnonzero(buf == BACKSLASH)
    if len(quotes) and len(slash):
        begins = slash[np.concatenate([[True], np.diff(slash) > 1])]
        after = np.flatnonzero((quotes > 0) & (buf[quotes - 1] == BACKSLASH))
        first = begins[np.searchsorted(begins, quotes[after]) - 1]
        run[after] = quotes[after] - first + np.where(first == 0, slashes, 0)
    if len(quotes) and quotes[0] == 0:
        run[0] = slashes
    quotes = quotes[run % 2 == 0]
    at = np.flatnonzero(_MARK[buf])
    return at, np.searchsorted(quotes, at), quotes


def _key_before(field: str | None) -> re.Pattern | None:
    """The list's key right before its bracket, however its letters may be written."""
    if field is None:
        return None
    forms = {json.dumps(field), json.dumps(field, ensure_ascii=False)}
    return re.compile(rb"(?<!\\)(?:" + b"|".join(re.escape(f.encode()) for f in sorted(forms)) + rb")\s*:\s*\Z")


def _opens_list(data: bytes, at: int, key: re.Pattern | None) -> bool:
    """Whether the bracket at that place opens the list of an envelope."""
    return key is not None and data[at:at + 1] == b"[" and bool(key.search(data[max(0, at - CONTEXT):at]))


OUTLINE = ("file string, part long, start long, stop long, quotes long, delta array<long>, low array<long>, "
           "opened array<boolean>, shape string")


def _outline(key: re.Pattern | None):
    def one(file, part, start, stop):
        with _open(file) as f:
            lead = min(CONTEXT, start)
            data = f.read_at(stop - start + lead, start - lead)
            at, before, quotes = marks(data[lead:], _slashes_before(f, start))
        step = _STEP[np.frombuffer(data, np.uint8)[at + lead]]
        delta, low, opened = [], [], []
        for inside in (0, 1):
            out = before % 2 == inside
            place = at[out]
            depth = np.concatenate([[0], np.cumsum(step[out])])
            delta.append(int(depth[-1]))
            low.append(int(depth.min()))
            # the bracket that leaves the lowest depth, or the one above it, for the last time in this part
            for level in (low[-1], low[-1] + 1):
                last = np.flatnonzero(depth <= level)[-1]
                opened.append(bool(last < len(place) and _opens_list(data, int(place[last]) + lead, key)))
        head = data.removeprefix(BOM).lstrip(BLANK)[:1].decode("latin-1") if part == 0 else None
        return file, part, start, stop, len(quotes), delta, low, opened, head

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, one(**row)))], schema=schema)
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                        ("quotes", pa.int64()), ("delta", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                        ("opened", pa.list_(pa.bool_())), ("shape", pa.string())])
    return run


def elements(data: tuple[bytes, bytes], slashes: int, inside: int, depth: int, level: int, listed: bool, own: int,
             key: re.Pattern | None) -> tuple[list[tuple[int, bytes]], bool, bool]:
    """(place, text) of the list elements whose bracket or comma is among the first ``own`` bytes after the context, whether
    all of them end in ``data``, and whether a list begins here. ``data`` is (context, bytes of the part and on)."""
    context, body = data
    at, before, _ = marks(body, slashes)
    out = before % 2 == inside
    at = at[out]
    step = _STEP[np.frombuffer(body, np.uint8)[at]]
    after = depth + np.cumsum(step)
    opening = (step == 1) & (after == level)
    event = opening | ((step == 0) & (after == level)) | ((step == -1) & (after == level - 1))
    at, step, opening = at[event], step[event], opening[event]
    found, whole, begins = [], True, False
    both = context + body
    for i in range(int(np.searchsorted(at, own))):
        if opening[i]:
            listed = key is None or _opens_list(both, int(at[i]) + len(context), key)
            begins |= listed
        elif step[i] == -1:
            listed = False
        if not listed:
            continue
        if i + 1 == len(at):
            whole = False
            break
        text = body[at[i] + 1:at[i + 1]]
        kept = text.strip(BLANK)
        if kept or not (opening[i] and step[i + 1] == -1):       # blank: an empty list, or an element left out
            found.append((int(at[i]) + 1 + len(text) - len(text.lstrip(BLANK)), kept))
    return found, whole, begins


def _cut_out(key: re.Pattern | None):
    schema = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("value", pa.binary())])

    def one(file, start, stop, size, inside, depth, listed, shape):
        level = 1 if shape == "[" else 2
        own_key = None if shape == "[" else key
        with _open(file) as f:
            lead = min(CONTEXT, start)
            context, slashes = f.read_at(lead, start - lead), _slashes_before(f, start)
            data, more = f.read_at(stop - start, start), READ_ON
            while True:
                found, whole, begins = elements((context, data), slashes, inside, depth, level, listed, stop - start, own_key)
                if whole or start + len(data) >= size:
                    break
                data += f.read_at(min(more, size - start - len(data)), start + len(data))
                more *= 2
        if begins:
            yield -1, None
        for place, text in found:
            yield start + place, text

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                pos, texts, held = [], [], 0
                for place, text in one(**row):
                    pos.append(place)
                    texts.append(text)
                    held += len(text or b"")
                    if held >= ROWS_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([row["file"]] * len(pos)), pa.array(pos, pa.int64()),
                                                          pa.array(texts, pa.binary())], schema=schema)
                        pos, texts, held = [], [], 0
                if pos:
                    yield pa.RecordBatch.from_arrays([pa.array([row["file"]] * len(pos)), pa.array(pos, pa.int64()),
                                                      pa.array(texts, pa.binary())], schema=schema)
    return run


def parts(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(file, part, start, stop) of the byte ranges of all files below ``path``, from the listing alone."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.col("path").alias("file"), F.col("length").alias("size")))
    last = F.greatest(F.ceil(F.col("size") / F.lit(part_bytes)) - 1, F.lit(0))
    return files.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("part")).select(
        "file", "part", (F.col("part") * part_bytes).alias("start"),
        F.least((F.col("part") + 1) * part_bytes, F.col("size")).alias("stop"))


def _spread(df: DataFrame, total: int, part_bytes: int) -> DataFrame:
    """About one task for ``part_bytes`` of files: small files share a task, big ones are many."""
    return df.repartition(max(1, min(1 << 16, -(-total // max(part_bytes, LEAST_TASK)))))


def read_parts(spark: SparkSession, path: str, record: T.StructType, field: str | None = None,
               part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """Records and quarantine of the JSON files below ``path``: bare lists, and with ``field`` also envelopes
    ``{..., field: [records]}``. The records have ``seq`` = (file, pos); the quarantine is (file, pos, reason,
    _corrupt_record), with a null pos where a whole file is left out."""
    if part_bytes < 1:
        raise ValueError("part_bytes must be positive")
    ship_package(spark)
    key = _key_before(field)
    ranges = cut(parts(spark, path, part_bytes))
    total = ranges.agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0
    outline = _spread(ranges, total, part_bytes).mapInArrow(_outline(key), OUTLINE)
    so_far = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    before = F.coalesce(F.sum("quotes").over(so_far), F.lit(0))
    seen = outline.withColumn("inside", F.pmod(before, F.lit(2)).cast("int"))
    seen = seen.withColumn("depth", F.coalesce(F.sum(F.get("delta", F.col("inside"))).over(so_far), F.lit(0)))
    # depth 1 against the lowest depth of the part: passed by, reached, or gone below
    above = F.lit(1) - F.col("depth") - F.get("low", F.col("inside"))
    seen = (seen.withColumn("open", F.when(above < 0, F.lit(None)).when(above > 1, F.lit(False))
                            .otherwise(F.get("opened", (2 * F.col("inside") + above).cast("int"))))
            .withColumn("own_delta", F.get("delta", F.col("inside"))).withColumn("own_low", F.get("low", F.col("inside"))))
    known = seen.select(
        "file", "start", "stop", F.max("stop").over(whole).alias("size"), "inside", F.col("depth").cast("long").alias("depth"),
        F.max("shape").over(whole).alias("shape"),
        F.coalesce(F.last("open", ignorenulls=True).over(so_far), F.lit(False)).alias("open"),
        (F.pmod(F.sum("quotes").over(whole), F.lit(2)) + F.abs(F.sum("own_delta").over(whole))
         + F.abs(F.min(F.col("depth") + F.col("own_low")).over(whole))).alias("odd"))
    known = cut(known)                                             # a row for each part
    shapes = ["["] if field is None else ["[", "{"]
    sound = (F.col("odd") == 0) & F.coalesce(F.col("shape").isin(shapes), F.lit(False))
    listed = F.when(F.col("shape") == "[", F.col("depth") > 0).otherwise(F.col("open"))
    texts = (_spread(known.where(sound).select("file", "start", "stop", "size", "inside", "depth", listed.alias("listed"),
                                               "shape"), total, part_bytes)
             .mapInArrow(_cut_out(key), "file string, pos long, value binary")
             .select("file", "pos", F.col("value").cast("string").alias("value")))
    corrupt = "_corrupt_record"
    schema = T.StructType([*record.fields, T.StructField(corrupt, T.StringType())])
    parsed = texts.where("pos >= 0 AND value <> 'null'").select(
        "file", "pos", "value", F.from_json("value", schema, {"columnNameOfCorruptRecord": corrupt}).alias("rec"))
    fits = F.col("rec").isNotNull() & F.col(f"rec.{corrupt}").isNull() & F.col("value").startswith("{")
    fits = F.coalesce(fits, F.lit(False))
    good = parsed.where(fits).select(*[F.col("rec").getField(n).alias(n) for n in record.names],
                                     F.struct("file", "pos").alias("seq"))
    files = known.groupBy("file").agg(F.first("shape").alias("shape"), F.first("odd").alias("odd"))
    reason = (F.when(F.coalesce(F.col("shape"), F.lit("")) == "", F.lit("empty"))
              .when(~F.col("shape").isin(shapes), F.lit("not a list")).when(F.col("odd") != 0, F.lit("unreadable"))
              .otherwise(F.lit("no list")))
    none = files.join(texts.where("pos = -1").select("file").distinct(), "file", "left_anti")
    bad = (none.select("file", F.lit(None).cast("long").alias("pos"), reason.alias("reason"),
                       F.lit(None).cast("string").alias(corrupt))
           .unionByName(parsed.where(~fits).select("file", "pos", F.lit("no record").alias("reason"),
                                                   F.col("value").alias(corrupt))))
    return good, bad
