"""Training-order materialisation of token ids as fixed-stride binary shards.

1. Every whole text is encoded and cut into sequences of ``LENGTH`` ids; the last one of a text is
   padded. A sequence's number is (doc_id - smallest doc_id) * most + its place in the text, ``most``
   being a bound on a text's sequences (a byte-level vocabulary makes at most one id of a byte).
2. A keyed Feistel network permutes the numbers; cycle-walking keeps the result inside their domain.
   So every sequence gets its slot from its number and the key alone: no sort, no shared counter,
   and the same slot in every run.
3. Sequences are dealt to shards by ranges of slots, and ranges of shards to at most ``WRITERS`` tasks, straight from the tasks that encoded them (the
   texts are encoded once, the ids shuffled once). A shard's task sorts its sequences and streams
   them into one file of fixed-stride records: little-endian ids, ``LENGTH`` of them. The file gets its
   name only when complete, so a retried task or a resumed job finds whole shards or none.

The permuted slots are unique but leave gaps where a text has fewer sequences than ``most``. A table
of shard sizes closes them: ``slot`` in the result counts from 0 without gaps, and the record of a slot
stands in the shard whose range holds it, at (slot - first slot of the shard) * stride.

Defined results: null and empty texts have no sequences. A null doc_id is numbered after the
largest. Rows with the same doc_id share slots before the gaps are closed; ties go by a hash of the
text. Ids too far apart for 62 bits are numbered by their hash instead, with the same tie rule.
Empty input writes no shard and gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path, ship_package
from .common import written
from .token_counts import PATTERN, VOCABULARY, encoder

LENGTH = 512
SHARD_BYTES = 32 << 20       # text bytes that make one shard, on average
WRITERS = 4096               # tasks that write, each a range of shards one after the other
ROUNDS = 4
KEY = 20240607


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _keys(key: int) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{key}/{r}".encode(), digest_size=8).digest(), "little") for r in range(ROUNDS)]


def feistel(x: np.ndarray, bits: int, key: int) -> np.ndarray:
    """Keyed permutation of [0, 4**bits)."""
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for k in _keys(key):
        left, right = right, left ^ (_round(right, k) & mask)
    return (left << np.uint64(bits)) | right


def permute(x: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """Keyed permutation of [0, size): the network on the next power of four, walked along its cycle
    until the value is back inside."""
    bits = max(1, ((size - 1).bit_length() + 1) // 2)
    out = feistel(x.astype(np.uint64), bits, key)
    far = np.flatnonzero(out >= size)
    while len(far):
        out[far] = feistel(out[far], bits, key)
        far = far[out[far] >= size]
    return out


def _folder(spark: SparkSession, path: str | None) -> str:
    path = path or scratch_path(spark, "token-shards")
    return re.sub(r"^file:/+", "file:///", path)


def _open(folder: str):
    from pyarrow import fs

    if "://" not in folder:
        folder = "file://" + os.path.abspath(folder)
    return fs.FileSystem.from_uri(folder)


def materialise(docs: DataFrame, path: str | None = None, length: int = LENGTH, key: int = KEY,
                shard_bytes: int = SHARD_BYTES, writers: int = WRITERS, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Writes the shards under ``path`` (default: the shared folder; any address that pyarrow reads) and
    returns one row per sequence: slot, doc_id, seq, n_tokens, shard, offset, file."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = _folder(spark, path)
    store, place = _open(folder)
    store.create_dir(place, recursive=True)
    size = F.octet_length(text_col)
    s = docs.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"), F.max(size).alias("most"), F.sum(size).alias("all")).first()
    lo, hi = s["lo"] or 0, s["hi"] or 0
    most = max(1, -(-(s["most"] or 0) // length))
    wide = (hi - lo + 2) * most >= 1 << 62
    domain = 1 << 62 if wide else (hi - lo + 2) * most
    shards = max(1, -(-(s["all"] or 0) // shard_bytes))
    width = -(-domain // shards)
    kind = docs.schema[id_col].dataType.simpleString()
    dtype = np.dtype("<u2")

    def encode(batches):
        tokens = encoder(vocabulary, pattern).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, seq, n, ids, base = [], [], [], [], []
                for i, (doc, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1))):
                    text = text.as_py()
                    if not text:
                        continue
                    t = np.array(tokens(text), dtype)
                    number = hi - lo + 1 if doc is None else doc - lo
                    number = (number * 0x9E3779B97F4A7C15) % (domain // most) if wide else number
                    for j, k in enumerate(range(0, len(t), length)):
                        row.append(i), seq.append(j), n.append(min(length, len(t) - k))
                        ids.append(t[k:k + length].tobytes()), base.append(number * most + j)
                if not row:
                    continue
                slot = permute(np.array(base, np.uint64), domain, key)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slot // np.uint64(width)).astype(np.int32)), pa.array(slot.astype(np.int64)),
                     part.column(0).take(take), part.column(2).take(take), pa.array(seq, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["shard", "virtual", "doc_id", "tie", "seq", "n_tokens", "ids"])

    def write(batches):
        store, place = _open(folder)
        out, name, count = None, None, 0
        unique = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"

        def close():
            out.close()
            store.move(f"{place}/.{name}.{unique}", f"{place}/{name}")

        for batch in batches:
            shard, ids = batch.column(0).to_pylist(), batch.column(6)
            inside = []
            for s, x in zip(shard, ids):
                if name != f"shard-{s:06d}.bin":
                    if out:
                        close()
                    name, count = f"shard-{s:06d}.bin", 0
                    out = store.open_output_stream(f"{place}/.{name}.{unique}")
                out.write(x.as_py().ljust(length * dtype.itemsize, b"\0"))
                inside.append(count)
                count += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(inside, pa.int64()), batch.column(2),
                                              batch.column(4), batch.column(5)],
                                             names=["shard", "inside", "doc_id", "seq", "n_tokens"])
        if out:
            close()

    encoded = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                          F.xxhash64(text_col).alias("tie")).mapInArrow(
        encode, f"shard int, virtual long, doc_id {kind}, tie long, seq long, n_tokens long, ids binary")
    writers = min(writers, shards)
    writer = F.floor(F.col("shard") * F.lit(writers) / F.lit(shards)).cast("int")
    ordered = (encoded.repartitionById(writers, writer)
               .sortWithinPartitions("shard", "virtual", "doc_id", "tie", "seq"))
    done = written(ordered.mapInArrow(write, f"shard int, inside long, doc_id {kind}, seq long, n_tokens long"), "token-shards-rows")
    sizes = done.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    # a row for each shard, summed within the writers' ranges and then over the writers
    sizes = sizes.withColumn("writer", writer)
    inside = F.sum("n").over(Window.partitionBy("writer").orderBy("shard")) - F.col("n")
    before = sizes.groupBy("writer").agg(F.sum("n").alias("m"))
    before = before.select("writer", (F.sum("m").over(Window.orderBy("writer")) - F.col("m")).alias("before"))
    starts = sizes.withColumn("at", inside).join(before, "writer").select("shard", (F.col("before") + F.col("at")).alias("first"))
    return done.join(starts, "shard").select(
        (F.col("first") + F.col("inside")).alias("slot"), "doc_id", "seq", "n_tokens", "shard",
        (F.col("inside") * F.lit(length * dtype.itemsize)).alias("offset"),
        F.format_string(f"{folder}/shard-%06d.bin", "shard").alias("file"))


def read_slots(rows: DataFrame, first: int, count: int, length: int = LENGTH) -> list[np.ndarray]:
    """``count`` sequences from slot ``first`` on, read by seeking (padding included): how a trainer
    resumes. Only these rows of the slot table come to the driver."""
    out = []
    picked = rows.where((F.col("slot") >= first) & (F.col("slot") < first + count)).orderBy("slot")
    for r in picked.select("file", "offset").collect():
        store, path = _open(r["file"])
        with store.open_input_file(path) as f:
            f.seek(r["offset"])
            out.append(np.frombuffer(f.read(length * 2), "<u2"))
    return out
