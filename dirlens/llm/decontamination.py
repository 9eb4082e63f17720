"""Benchmark passages in documents, by Wu and Manber's multi-pattern search over words.

1. *Patterns*: every window of ``WINDOW`` consecutive words of an item; an item of fewer words, but not
   none, is one window. Windows of one length share one set of tables.
2. *Shift table*: for each block of ``BLOCK`` consecutive words, how far the search may move on when the
   text's current block is this one: the block's least distance from the end of a window. A block that
   no window holds moves it by nearly a whole window, so most words of a text are never looked up.
3. *Buckets*: a shift of 0 means that some window ends in this block. The windows that end in it, told
   apart by their first block and in order, are the test strings; binary search picks one, and comparing it
   word by word with the text confirms the occurrence.

Documents are read once for each ``POSTINGS`` (window, item) pairs: that many go to every task, an
unbounded list never does. Each pass adds to what the ones before found, and the passes' rows are
written to the shared checkpoint folder in between. A benchmark below that size is one pass, with no shuffle
of documents.

Defined results: null and empty texts have no words and are clean; an item without words has no window.
Items with one item_id are one item; a null item_id is named by the empty text. Rows with repeated or null
doc_ids are documents of their own, and a very long text is searched whole. Other columns of either table,
whatever their names, take no part. An empty benchmark leaves every document clean; empty documents give no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ..session import cut, ship_package
from .common import written
from .terms import terms

WINDOW = 10
BLOCK = 3
POSTINGS = 100_000

Words = tuple[bytes, ...]
_SPAN = StructType().add("start", LongType()).add("stop", LongType())


class Patterns:
    """Search tables of windows that have one length."""

    def __init__(self, windows: Iterable[Words], length: int, block: int = BLOCK):
        self.length, self.block = length, min(block, length)
        self.far = length - self.block + 1
        self.shift: dict[Words, int] = {}
        self.buckets: dict[Words, dict[Words, list[Words]]] = defaultdict(dict)
        for w in windows:
            for end in range(self.block, length + 1):
                b = w[end - self.block:end]
                self.shift[b] = min(length - end, self.shift.get(b, self.far))
            self.buckets[w[-self.block:]].setdefault(w[:self.block], []).append(w)
        for by_first in self.buckets.values():
            for tests in by_first.values():
                tests.sort()

    def find(self, words: list[bytes]) -> Iterator[tuple[int, Words]]:
        """(start, window) of every occurrence."""
        n, b, m, far, shift = len(words), self.block, self.length, self.far, self.shift
        end = m
        while end <= n:
            block = tuple(words[end - b:end])
            move = shift.get(block, far)
            if not move:
                start = end - m
                tests = self.buckets[block].get(tuple(words[start:start + b]))
                if tests:
                    here = tuple(words[start:end])
                    at = bisect_left(tests, here)
                    if at < len(tests) and tests[at] == here:
                        yield start, here
                move = 1
            end += move


def item_windows(words: list[bytes], window: int = WINDOW) -> set[Words]:
    if not words:
        return set()
    width = min(window, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans joined where they overlap or touch, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _postings(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct (item, window), the window's words joined by spaces."""
    def run(batches):
        for batch in batches:
            item, text = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, t in zip(item, text):
                found = [b" ".join(w).decode() for w in item_windows(terms(t), window)]
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.string()), pa.array(found, pa.string())],
                                                 names=["item", "window"])
    name = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    return (items.select(name.alias("item"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "item string, window string").distinct())


def _searcher(pairs: list[tuple[str, str]]):
    """A function from a list of words to (spans, items) over one block of (item, window) pairs."""
    of: dict[Words, list[str]] = defaultdict(list)
    for item, window in pairs:
        of[tuple(window.encode().split(b" "))].append(item)
    lengths: dict[int, list[Words]] = defaultdict(list)
    for w in of:
        lengths[len(w)].append(w)
    tables = [Patterns(ws, m) for m, ws in lengths.items()]

    def search(words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        spans, items, seen = [], set(), set()
        for t in tables:
            for start, w in t.find(words):
                spans.append((start, start + t.length))
                if w not in seen:
                    seen.add(w)
                    items.update(of[w])
        return spans, items
    return search


def _pass(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``rows`` (doc_id, text, n_words, spans, items) with what these pairs add."""
    def run(batches):
        search = _searcher(pairs)
        for batch in batches:
            spans, items, counts = [], [], []
            for t, s, known in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                words = terms(t)
                found, named = search(words)
                counts.append(len(words))
                if found:
                    s = [{"start": a, "stop": b} for a, b in _merged(found + [(x["start"], x["stop"]) for x in s])]
                    known = sorted(named.union(known))
                spans.append(s)
                items.append(known)
            schema = batch.schema
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, schema.field(2).type),
                 pa.array(spans, schema.field(3).type), pa.array(items, schema.field(4).type)], schema=schema)
    return rows.mapInArrow(run, rows.schema)


def passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, postings: int = POSTINGS, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, spans (start and stop of the word ranges inside windows, joined and in
    order) and items (names of the items with a window in it, sorted)."""
    ship_package(docs.sparkSession)
    pairs = cut(_postings(items, window, item_col, item_text))
    blocks = max(1, -(-pairs.count() // postings))
    block = F.pmod(F.xxhash64("item", "window"), F.lit(blocks))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.lit(0).cast("long").alias("n_words"), F.array().cast(ArrayType(_SPAN)).alias("spans"),
                       F.array().cast(ArrayType(StringType())).alias("items"))
    for b in range(blocks):
        some = [(r["item"], r["window"]) for r in pairs.where(block == b).collect()]
        rows = _pass(written(rows, "decontamination") if b else rows, some)
    return rows.drop("text")


def n_hit(spans: Column) -> Column:
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
