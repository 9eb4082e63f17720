"""Conflict-constrained best-fit packing of documents into sequences of fixed capacity.

A document longer than the capacity is cut into full pieces, each a bin of its own, and a last piece.
The last pieces are dealt over shards of about ``SHARD`` pieces by a hash of (doc_id, copy), and each
shard is packed best-fit decreasing: open bins stand ordered by residual capacity and carry a bitmap
of their sources and one of their duplicate clusters. For a piece, the search starts at the tightest
bin that has room and goes on to the next larger residual until it finds the tightest one whose
bitmaps hold neither the piece's source nor its cluster; only then a new bin is opened. So no bin
holds two documents of one source or two copies of one text.

Only narrow rows (id, source, cluster, length) are shuffled, and a shard has a bounded number of them
whatever source or cluster they come from: a hot source is spread over all shards.

Defined results: a null or word-free text has length 0 and comes back in no bin (bin_id null). A null
source is a source of its own. Rows that repeat whole are copies, dealt and packed one by one. Ties
go by length, doc_id, cluster, copy. Empty input gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .common import fold, n_words

CAPACITY = 2048
SHARD = 4096


def best_fit(pieces: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(bin, start) for each (length, source, cluster), in the given order. A null cluster conflicts
    with nothing."""
    sources: dict = {}
    times: dict = {}
    for _, _, c in pieces:
        times[c] = times.get(c, 0) + 1
    bits: dict = {}
    for c, n in times.items():
        if n > 1 and c is not None:              # a cluster met once conflicts with nothing
            bits[c] = 1 << len(bits)
    open_bins: list[tuple[int, int]] = []        # (residual, bin), ordered
    held: list[list[int]] = []                   # bin -> [source bitmap, cluster bitmap]
    out = []
    for length, source, cluster in pieces:
        s = sources.setdefault(source, 1 << len(sources))
        c = bits.get(cluster, 0)
        i = bisect_left(open_bins, (length, -1))
        while i < len(open_bins):
            a, b = held[open_bins[i][1]]
            if not (a & s or b & c):
                break
            i += 1
        if i < len(open_bins):
            residual, at = open_bins.pop(i)
        else:
            residual, at = capacity, len(held)
            held.append([0, 0])
        out.append((at, capacity - residual))
        held[at][0] |= s
        held[at][1] |= c
        if residual > length:
            insort(open_bins, (residual - length, at))
    return out


def content_cluster(text: Column) -> Column:
    """Duplicate cluster of equal texts (A-Z folded)."""
    return F.xxhash64(fold(text))


def pack(docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", length: Column | None = None,
         cluster: Column | None = None) -> DataFrame:
    """One row per piece: bin_id, doc_id, copy, piece, start (place in the bin), length, source, cluster.

    ``length`` (default: words) and ``cluster`` (default: equal texts) are columns of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    length = n_words(F.col(text_col)) if length is None else length.cast("long")
    cluster = content_cluster(F.col(text_col)) if cluster is None else cluster.cast("long")
    kind = docs.schema[id_col].dataType.simpleString()
    same = (docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), cluster.alias("cluster"),
                        F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).alias("length"))
            .groupBy("doc_id", "source", "cluster", "length").agg(F.count(F.lit(1)).alias("copies")))
    rows = cut(same.select("doc_id", "source", "cluster", "length",
                           F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")))
    size = F.lit(capacity).cast("long")
    none = rows.where("length = 0").select(F.lit(None).cast("string").alias("bin_id"), "doc_id", "copy",
                                           F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("start"),
                                           "length", "source", "cluster")
    whole = (rows.where(F.col("length") >= size)
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"length div {capacity}") - 1)).alias("piece"))
             .select(F.concat_ws("-", F.lit("d"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                                 F.hex(F.xxhash64("source", "cluster", "length")),
                                 F.col("copy").cast("string"), F.col("piece").cast("string")).alias("bin_id"),
                     "doc_id", "copy", "piece", F.lit(0).cast("long").alias("start"),
                     F.lit(capacity).cast("long").alias("length"), "source", "cluster"))
    last = (rows.where(F.col("length") % size > 0)
            .select("doc_id", "copy", F.expr(f"length div {capacity}").alias("piece"),
                    (F.col("length") % size).alias("length"), "source", "cluster"))
    shards = max(1, -(-last.count() // shard_rows))
    last = last.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy", "cluster"), F.lit(shards)).cast("int"))

    def run(rows: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.slice(0, 0)
        order = sorted(zip(*(rows[c].to_pylist() for c in ("length", "source", "cluster", "doc_id", "copy", "piece", "shard"))),
                       key=lambda x: (-x[0], x[3] is None, x[3] if x[3] is not None else 0, x[2] or 0, x[4], x[5]))
        found = best_fit([(x[0], x[1], x[2]) for x in order], capacity)
        cols = list(zip(*order))
        return pa.table({"bin_id": pa.array([f"s{x[6]}-{b}" for x, (b, _) in zip(order, found)], pa.string()),
                         "doc_id": pa.array(cols[3], rows.schema.field("doc_id").type),
                         "copy": pa.array(cols[4], pa.int64()), "piece": pa.array(cols[5], pa.int64()),
                         "start": pa.array([s for _, s in found], pa.int64()), "length": pa.array(cols[0], pa.int64()),
                         "source": pa.array(cols[1], rows.schema.field("source").type),
                         "cluster": pa.array(cols[2], pa.int64())})

    source_kind = docs.schema[source_col].dataType.simpleString()
    packed = last.groupBy("shard").applyInArrow(
        run, f"bin_id string, doc_id {kind}, copy long, piece long, start long, length long, "
             f"source {source_kind}, cluster long")
    return packed.unionByName(whole).unionByName(none)
