"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

Items are a stated query set and go to the tasks in blocks of about ``BLOCK_CHARS`` characters; each
block is one search over all documents.

1. *Forward rows*: one pass over the whole texts writes, for every document, its number of terms and the
   counts of those terms that the block's items ask for. The collection's figures (documents, terms,
   document frequencies) are sums over these rows.
2. *Search*: each task inverts its forward rows, up to ``DOCS`` documents or ``ENTRIES`` postings at once, and runs
   every item over them, keeping the item's best ``k`` throughout. Short lists are summed term at a time into
   accumulators, a sorted list of (document, partial score) that is from there on one iterator with one bound.
   The long lists and that iterator go on document at a time, in windows of documents: iterators whose
   bounds together stay below the k-th score so far give no candidates, windows without candidates are
   skipped, and a candidate is dropped as soon as its partial score and the bounds that are left cannot reach
   the k-th score. Bounds are compared with < alone, so ties are never lost.
3. *Merge*: the tasks' best rows are ranked per item.

Score: the sum over an item's terms, repeats included, of w * ((1000000000 * tf) div (1000 * tf + 8 * m)), in
64-bit integers; w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))) and m = 25 + (75 * n * N) div L.

Defined results: null and empty texts have no terms and are never found; items without terms find nothing.
Each row of the items is an item of its own, also with a null or repeated item_id, and each row of the documents
is a document of its own; equal scores stand by ascending doc_id, null last. Very long texts are read whole.
Other columns of either table, whatever their names, take no part. An empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType
from pyspark.sql.window import Window

from ..session import cut, ship_package
from .common import written
from .terms import terms

K = 10
BLOCK_CHARS = 4_000_000
DOCS, ENTRIES = 32_768, 4_000_000
#: Accumulators may hold this share of the documents that a task has inverted.
SHORT = 0.25
FIRST, WIDEST = 256, 8192


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms in the whole text), terms and tfs (of those in the vocabulary, by number)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = (StructType().add("doc_id", rows.schema["doc_id"].dataType).add("n", LongType())
              .add("terms", ArrayType(IntegerType())).add("tfs", ArrayType(IntegerType())))

    def run(batches):
        get = vocabulary.get
        for batch in batches:
            n, known, counts = [], [], []
            for t in batch.column(1).to_pylist():
                words = terms(t)
                n.append(len(words))
                pairs = sorted((at, c) for at, c in ((get(w), c) for w, c in Counter(words).items()) if at is not None)
                known.append([p[0] for p in pairs])
                counts.append([p[1] for p in pairs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(known, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    return rows.mapInArrow(run, schema)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _norms(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    if len(n) and 75 * int(n.max()) * docs >= 1 << 63:
        return np.array([25 + 75 * int(x) * docs // length for x in n], np.int64)
    return 25 + 75 * n * docs // length


class Inverted:
    """Posting lists of one batch of documents, in document order, with every posting's score."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray,
                 docs: int, length: int):
        self.n_docs = len(n)
        doc = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(term, kind="stable")
        term, self.docs, tf = term[order], doc[order], tf[order].astype(np.int64)
        m = _norms(n, docs, length)[self.docs]
        self.scores = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        self.terms, start = np.unique(term, return_index=True)
        self.starts = np.append(start, len(term))
        self.bounds = np.maximum.reduceat(self.scores, start) if len(start) else np.empty(0, np.int64)

    def lists(self, asked: np.ndarray, times: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """(documents, scores, bound) of each asked term that the batch holds, shortest first."""
        at = np.searchsorted(self.terms, asked)
        out = []
        for i, t, q in zip(at, asked, times):
            if i < len(self.terms) and self.terms[i] == t and self.bounds[i] > 0:
                part = slice(self.starts[i], self.starts[i + 1])
                out.append((self.docs[part], self.scores[part] * q, int(self.bounds[i] * q)))
        return sorted(out, key=lambda x: len(x[0]))


def accumulated(lists: list, budget: int) -> tuple[list, list]:
    """(iterators, the long lists): the shortest lists, up to ``budget`` postings, summed into one iterator."""
    used = n = 0
    for n, x in enumerate(lists):
        if used + len(x[0]) > budget:
            break
        used += len(x[0])
    else:
        n = len(lists)
    if n < 2:
        return [], lists
    docs = np.concatenate([x[0] for x in lists[:n]])
    order = np.argsort(docs, kind="stable")
    docs, start = np.unique(docs[order], return_index=True)
    sums = np.add.reduceat(np.concatenate([x[1] for x in lists[:n]])[order], start)
    return [(docs, sums, int(sums.max()))], lists[n:]


def best(lists: list, n_docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the k best at ``least`` or above, by score and then document."""
    short, long_ = accumulated(lists, max(1024, int(n_docs * SHORT)))
    its = sorted(short + long_, key=lambda x: x[2])
    cum = np.cumsum([x[2] for x in its])
    top_d, top_s = np.empty(0, np.int64), np.empty(0, np.int64)
    at, width = 0, FIRST
    while its and at < n_docs:
        first = int(np.searchsorted(cum, least))        # the iterators before this one cannot reach it together
        if first == len(its):
            break
        heads = [(d, int(np.searchsorted(d, at))) for d, _, _ in its[first:]]
        at = min((int(d[i]) for d, i in heads if i < len(d)), default=n_docs)
        stop = at + width
        cand = [d[i:int(np.searchsorted(d, stop))] for d, i in heads]
        docs = np.unique(np.concatenate(cand))
        score, left = np.zeros(len(docs), np.int64), int(cum[-1])
        for d, s, bound in reversed(its):
            alive = score + left >= least
            if not alive.all():
                docs, score = docs[alive], score[alive]
            if not len(docs):
                break
            i = np.searchsorted(d, docs)
            i[i == len(d)] = 0
            score += np.where(d[i] == docs, s[i], 0)
            left -= bound
        good = score >= least
        if good.any():
            top_d, top_s = np.concatenate([top_d, docs[good]]), np.concatenate([top_s, score[good]])
            order = np.lexsort((top_d, -top_s))[:k]
            top_d, top_s = top_d[order], top_s[order]
            if len(top_s) == k:
                least = max(least, int(top_s[-1]))
        at, width = stop, min(2 * width, WIDEST)
    return top_d, top_s


def _key(found: tuple[int, object]) -> tuple:
    return -found[0], found[1] is None, found[1] if found[1] is not None else 0


def _searched(forward: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, n_docs: int,
              length: int, k: int) -> DataFrame:
    """item (its number), doc_id and score of each task's best k."""
    schema = (StructType().add("item", IntegerType()).add("doc_id", forward.schema["doc_id"].dataType)
              .add("score", LongType()))

    def run(batches):
        kept: list[list] = [[] for _ in items]
        id_type = None

        def search(held: list[pa.RecordBatch]):
            t = pa.Table.from_batches(held)
            ids = t.column(0).to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
            t = t.take(pa.array(order, pa.int64())).combine_chunks()
            ids = [ids[i] for i in order]
            known, tfs = t.column(2).combine_chunks(), t.column(3).combine_chunks()
            inv = Inverted(t.column(1).to_numpy(), np.diff(known.offsets.to_numpy()), known.flatten().to_numpy(),
                           tfs.flatten().to_numpy(), weights, n_docs, length)
            for j, (asked, times) in enumerate(items):
                least = kept[j][-1][0] if len(kept[j]) == k else 1
                d, s = best(inv.lists(asked, times), inv.n_docs, k, max(1, least))
                if len(d):
                    kept[j] = sorted(kept[j] + [(int(x), ids[i]) for x, i in zip(s, d)], key=_key)[:k]

        held, docs, entries = [], 0, 0
        for batch in batches:
            id_type = batch.schema.field(0).type
            held.append(batch)
            docs += batch.num_rows
            entries += len(batch.column(2).flatten())
            if docs >= DOCS or entries >= ENTRIES:
                search(held)
                held, docs, entries = [], 0, 0
        if held:
            search(held)
        rows = [(j, i, s) for j, found in enumerate(kept) for s, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
                 pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc_id", "score"])
    return forward.mapInArrow(run, schema)


def _block(docs: DataFrame, rows: list[Row], k: int, id_col: str, text_col: str) -> DataFrame | None:
    asked = [Counter(terms(r["text"])) for r in rows]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*asked)))} if asked else {}
    if not vocabulary:
        return None
    forward = written(forward_rows(docs, vocabulary, id_col, text_col), "forward")
    n_docs, length = forward.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weights[r["t"]] = weight(n_docs, r["count"])
    lists = []
    for c in asked:
        at = sorted((vocabulary[w], q) for w, q in c.items())
        lists.append((np.array([a for a, _ in at], np.int64), np.array([q for _, q in at], np.int64)))
    found = _searched(forward, lists, weights, n_docs, length, k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    ship_package(spark)
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = cut(asked.withColumn("at", F.monotonically_increasing_id()))
    chars = asked.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // block_chars))
    id_type, item_type = docs.schema[id_col].dataType, asked.schema["item_id"].dataType
    names = StructType().add("item", IntegerType()).add("item_id", item_type)
    out = spark.createDataFrame([], StructType().add("item_id", item_type).add("rank", IntegerType())
                                .add("doc_id", id_type).add("score", LongType()))
    for b in range(blocks):
        rows = asked.where(F.pmod("at", F.lit(blocks)) == b).collect()
        found = _block(docs, rows, k, id_col, text_col)
        if found is None:
            continue
        name = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], names)
        found = found.join(F.broadcast(name), "item").select("item_id", "rank", "doc_id", "score")
        out = out.union(cut(found) if blocks > 1 else found)
    return out
