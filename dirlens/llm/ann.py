"""Approximate nearest neighbours: an inverted-list index scanned dimension block by block.

*Index*. Largest inner product becomes smallest distance by one more dimension, sqrt(M^2 - |x|^2),
with M the largest norm (a query has 0 there). Centres come from k-means on a sample of at most
``FIT`` vectors by a hash of their id; every vector is assigned to its nearest centre, and lists are
cut into blocks of about ``BLOCK`` rows, so that a list with a third of all rows is many blocks.

*Adaptive scan*. Vectors are turned by a random orthogonal matrix and stand in column blocks of
``COLUMNS`` dimensions. After each column block a hypothesis test compares the partial distance, scaled
to all dimensions, with the query's current k-th distance: a candidate beyond it by the factor
(1 + EPSILON / sqrt(d))^2 is abandoned, and only the others read the next block. A query scans its
nearest list first, then a quarter of its other lists, then the rest; the k-th distance after a round is the
threshold of the next, and lists that lie beyond it as a whole (centre's distance less radius) are left out.

*Lists probed*. How many lists, nearest first, is measured: a sample of ``SAMPLE`` rows by a hash of their id is
searched exactly in one pass over all vectors, and the least number of lists is taken that holds the share ``TARGET``
of their true neighbours (``probe`` fixes a share of the lists instead). Always as many are probed as hold
``HELD`` times the neighbours asked for. The score is the exact inner product of the original vectors in double
precision.

Defined results: vectors that are null, all zero, or hold a null or a non-finite component take no part,
nor do vectors of another dimension than most have, nor rows without an id. Rows with one id count
once, with the smallest of their vectors. A query's own id is no candidate. Ties go to the smaller
id. Fewer neighbours are returned only when fewer candidates exist. Empty input gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut, ship_package

FIT = 20_000
BLOCK = 4096
COLUMNS = 16
EPSILON = 2.1
TARGET = 0.97
SAMPLE = 64
MAX_LISTS = 4096
HELD = 100


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, v (array<double>) of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (table.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), bad.alias("bad"))
            .where("id IS NOT NULL AND v IS NOT NULL AND NOT bad").where(F.exists("v", lambda x: x != 0))
            .groupBy("id").agg(F.min("v").alias("v")))
    rows = cut(rows)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 10) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(steps):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)[:, None]
        c = np.where(n > 0, total / np.maximum(n, 1), c)
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (c * c).sum(1) - 2 * (x @ c.T)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i:i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column (array or chunked) of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _raised(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(top * top - (x * x).sum(1), 0))[:, None]])


def adaptive_scan(rows: np.ndarray, query: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and squared distances of up to k rows (dims x n, turned) near the query, where those
    beyond ``limit`` may be left out."""
    dims, n = rows.shape
    live, part = np.arange(n), np.zeros(n)
    for d in range(0, dims, COLUMNS):
        stop = min(d + COLUMNS, dims)
        diff = rows[d:stop, live] - query[d:stop, None]
        part = part + (diff * diff).sum(0)
        if stop < dims and math.isfinite(limit):
            go = part * (dims / stop) <= limit * (1 + EPSILON / math.sqrt(stop)) ** 2
            live, part = live[go], part[go]
    if len(live) > k:
        # everything as near as the k-th stays, for ties
        go = part <= np.partition(part, k - 1)[k - 1] * (1 + 1e-9) + 1e-12
        live, part = live[go], part[go]
    return live, part


class Index:
    """Centres, rotation and list sizes, all small, for a table of valid vectors."""

    def __init__(self, vectors: DataFrame, seed: int = 6):
        rng = np.random.default_rng(seed)
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        row = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).first()
        self.n, self.top = row["n"], row["top"] or 0.0
        if not self.n:
            return
        fit = vectors.orderBy(F.xxhash64("id"), "id").limit(FIT).select("v").toArrow()
        x = _raised(_matrix(fit["v"]), self.top)
        lists = int(min(MAX_LISTS, max(1, math.sqrt(self.n) / 4), len(x)))
        self.centres = _kmeans(x, lists, rng)
        self.turn = np.linalg.qr(rng.standard_normal((x.shape[1],) * 2))[0]

    def assigned(self, vectors: DataFrame) -> DataFrame:
        """id, v, list, turned (array<double>), off (distance from the list's centre)."""
        top, centres, turn = self.top, self.centres, self.turn

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _raised(_matrix(batch.column(1)), top)
                near = _nearest(x, centres)
                off = np.sqrt(((x - centres[near]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)),
                     pa.array(list(x @ turn), pa.list_(pa.float64())), pa.array(off)],
                    names=["id", "v", "list", "turned", "off"])
        return vectors.select("id", "v").mapInArrow(
            run, "id long, v array<double>, list int, turned array<double>, off double")

    def lists_for(self, rows: DataFrame, k: int, target: float = TARGET, sample: int = SAMPLE) -> int:
        """The least number of lists, nearest first, that holds ``target`` of the true k neighbours of sampled rows."""
        asked = rows.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample).select("id", "v").toArrow()
        own, v = asked["id"].to_numpy(), _matrix(asked["v"])

        def run(batches):
            best = [np.zeros((0, 2))] * len(own)                   # score, list of a task's nearest rows
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, lists = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                score = _matrix(batch.column(1)) @ v.T
                for q in range(len(own)):
                    other = np.flatnonzero(ids != own[q])
                    top = other[np.argsort(-score[other, q], kind="stable")[:k]]
                    both = np.vstack([best[q], np.column_stack([score[top, q], lists[top]])])
                    best[q] = both[np.argsort(-both[:, 0], kind="stable")[:k]]
            at = np.repeat(np.arange(len(own)), [len(b) for b in best])
            found = np.vstack(best) if len(at) else np.zeros((0, 2))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[:, 1].astype(np.int32)),
                                              pa.array(found[:, 0])], names=["q", "list", "score"])
        each = rows.select("id", "v", "list").mapInArrow(run, "q int, list int, score double")
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "list"))
        found = each.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "list").toArrow()   # sample x k rows
        if not len(found):
            return 1
        order = np.argsort(_distances(np.hstack([v, np.zeros((len(v), 1))]), self.centres), axis=1, kind="stable")
        place = np.argsort(order, axis=1)[found["q"].to_numpy(), found["list"].to_numpy()]
        return 1 + int(np.sort(place)[math.ceil(target * len(place)) - 1])

    def probes(self, queries: DataFrame, sizes: dict[int, int], radius: dict[int, float], k: int, least: int) -> DataFrame:
        """query, v, list, nearness (0: nearest list), round (0, 1, 2), gap (no row of the list is nearer)."""
        centres = self.centres
        count = np.array([sizes.get(i, 0) for i in range(len(centres))])
        reach = np.array([radius.get(i, 0.0) for i in range(len(centres))])

        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = _matrix(batch.column(1))
                x = np.hstack([v, np.zeros((len(v), 1))])
                away = _distances(x, centres)
                order = np.argsort(away, axis=1, kind="stable")
                away = np.sqrt(np.maximum(away + (v * v).sum(1)[:, None], 0))
                held = np.cumsum(count[order], axis=1)
                need = np.maximum(least, 1 + (held < min(HELD * k + 1, count.sum())).sum(1))
                of = np.repeat(np.arange(len(v)), need)
                rank = np.concatenate([np.arange(m) for m in need])
                lists = order[of, rank]
                when = np.where(rank == 0, 0, np.where(rank <= np.ceil(need[of] / 4), 1, 2))
                of_a = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of_a), batch.column(1).take(of_a), pa.array(lists.astype(np.int32)),
                     pa.array(rank.astype(np.int32)), pa.array(when.astype(np.int32)),
                     pa.array(np.maximum(away[of, lists] - reach[lists], 0))],
                    names=["query", "v", "list", "nearness", "round", "gap"])
        return queries.select("id", "v").mapInArrow(
            run, "query long, v array<double>, list int, nearness int, round int, gap double")


def _scan(k: int, turn: np.ndarray):
    """Cogroup function: the k nearest rows of one block for each query that comes to it."""
    names = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if rows.num_rows and asks.num_rows:
            ids = rows["id"].to_numpy()
            order = np.argsort(ids)
            ids, original = ids[order], _matrix(rows["v"])[order]
            columns = np.ascontiguousarray(_matrix(rows["turned"])[order].T)
            v = _matrix(asks["v"])
            turned = np.hstack([v, np.zeros((len(v), 1))]) @ turn
            for q, t, own, far in zip(asks["query"].to_pylist(), turned, v, asks["far"].to_pylist()):
                at, _ = adaptive_scan(columns, t, k + 1, math.inf if far is None else far)
                at = at[ids[at] != q]
                score = original[at] @ own
                best = np.lexsort((ids[at], -score))[:k]
                out_q += [q] * len(best)
                out_v += ids[at][best].tolist()
                out_s += score[best].tolist()
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())],
                        schema=names)
    return run


def _meet(rows: DataFrame, asks: DataFrame, sizes: DataFrame, k: int, turn: np.ndarray) -> DataFrame:
    """Blocks of a list meet blocks of its queries; both sides of a group are bounded."""
    ask_sizes = asks.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("ask_blocks"))
    counts = F.broadcast(sizes.join(ask_sizes, "list"))          # a row for each list: at most MAX_LISTS
    left = (rows.join(counts, "list").withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("ask_blocks") - 1))))
    right = (asks.join(counts, "list").withColumn("c", F.pmod(F.xxhash64("query"), F.col("ask_blocks")).cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (left.select("list", "b", "c", "id", "v", "turned").groupBy("list", "b", "c")
            .cogroup(right.select("list", "b", "c", "query", "v", "far").groupBy("list", "b", "c"))
            .applyInArrow(_scan(k, turn), "query long, vec_id long, score double"))


def nearest(table: DataFrame, queries: Column, k: int = 20, probe: float | None = None, id_col: str = "vec_id",
            vec_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that the condition ``queries`` (on the id) selects. Each query probes
    the lists that ``target`` asks for, or the share ``probe`` of them."""
    ship_package(table.sparkSession)
    vectors = valid_vectors(table, id_col, vec_col)
    index = Index(vectors)
    if not index.n:
        return vectors.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                              F.lit(0.0).alias("score")).where("false")
    rows = cut(index.assigned(vectors))
    least = index.lists_for(rows, k, target) if probe is None else math.ceil(probe * len(index.centres))
    sizes = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"),
                                     F.count(F.lit(1)).alias("n"), F.max("off").alias("radius"))
    sizes = cut(sizes)
    known = sizes.collect()                                       # at most MAX_LISTS rows
    sizes = sizes.drop("n", "radius")
    asks = cut(index.probes(vectors.withColumnRenamed("id", id_col).where(queries).withColumnRenamed(id_col, "id"),
                            {r["list"]: r["n"] for r in known}, {r["list"]: r["radius"] for r in known}, k, least))
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    found = None
    for turn in range(3):
        ask = asks.where(F.col("round") == turn)
        if found is None:
            ask = ask.withColumn("far", F.lit(None).cast("double"))
        else:
            # |q - x|^2 = |q|^2 + M^2 - 2 q.x: the k-th score so far is the distance to beat
            kth = found.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
            far = square + F.lit(index.top ** 2) - 2 * F.col("kth")
            ask = (ask.join(kth, "query", "left").withColumn("far", far)
                   .where(F.col("far").isNull() | (F.col("gap") * F.col("gap") <= F.col("far") * (1 + 1e-9) + 1e-9)))
        met = _meet(rows, ask, sizes, k, index.turn)
        met = met if found is None else found.drop("rank").union(met)
        found = met.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select(
            "query", "vec_id", "score", "rank")
        found = cut(found) if turn < 2 else found
    return found.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
