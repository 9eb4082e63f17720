"""Phrase collocations by sorted count streams, merged in lockstep.

Texts are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words at spaces and tabs; A-Z count as a-z.

1. *Runs*: a task counts the phrases of 1 to ``max_words`` words of up to ``CHUNK`` words at a time. Words are numbered
   in the order of their text, so the counted phrases come out sorted by their words; a run goes out in
   compressed slices, one for each part of the phrase space, not as a row for each phrase.
2. *Streams*: a part (all phrases with one hash range, whatever their words, so no frequent word or phrase makes a
   part large) adds up its slices and keeps the phrases counted ``least`` times or more. As every part of such a
   phrase is counted at least as often, all later counts are found among these.
3. *Lockstep joins*: every cut of a candidate gives its first and its last words. In prefix order, and then in
   suffix order, the cuts are merged with the count stream, which is sorted by phrase (sort-merge joins, no
   hash tables). The lowest-scoring cut counts.
4. *Extensions*: the counts of the candidates one word longer, to the left and to the right, are merged the same way.
   A longer phrase is never counted more often than one inside it, so those decide for all longer ones.

Defined results: null and empty texts have no words; a null language is ``und``. Rows are all counted, also repeated
ones and those without an id. A very long text is read whole and cut into runs between words, with the phrases across
the cut counted once. Other columns, whatever their names, take no part. Ties between cuts go to the shortest first
part, equal phrases cannot tie. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship_package
from .common import written

LEAST = 10
MAX_WORDS = 3
TOP = 2000
CHUNK = 1_000_000
#: Bytes of text whose phrases share a part.
PART_BYTES = 4 << 20
EXTENSION = 50                  # per cent
SCALE = 1_000_000

_UPPER = range(0x41, 0x5B)
_END = b"."
#: A-Z become a-z, tabs become spaces, and every sign that ends a piece becomes a full stop.
_TABLE = bytes(ord(_END) if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if b in _UPPER else b
               for b in range(256))
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def tokens(text: str | None) -> list[bytes]:
    """The words in order; a full stop, which no word holds, stands between pieces."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).replace(_END, b" . ").split()


def counted(ids: np.ndarray, own: int, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For 1, 2, ... words: (number of each phrase's first part among the phrases one word shorter, its last word,
    count), in order of the words. ``ids`` are word numbers, 0 ends a piece; phrases that start in the first
    ``own`` places count."""
    top = int(ids.max(initial=0)) + 1
    live = ids > 0
    at = np.flatnonzero(live[:own])
    counts = np.bincount(ids[at], minlength=top)
    found = np.flatnonzero(counts)
    yield np.zeros(len(found), np.int64), found, counts[found]
    place = np.zeros(top, np.int64)
    place[found] = np.arange(len(found))
    number = place[ids[at]]                                     # of the phrase that starts at ``at``
    for m in range(2, max_words + 1):
        inside = at + m - 1 < len(ids)
        at, number = at[inside], number[inside]
        inside = live[at + m - 1]
        at, number = at[inside], number[inside]
        code = number * top + ids[at + m - 1]
        if m < max_words:
            code, number, n = np.unique(code, return_inverse=True, return_counts=True)
        else:
            code, n = np.unique(code, return_counts=True)
        yield code // top, code % top, n


def _slices(words: _Numbers, ids: np.ndarray, own: int, lang: str, parts: int, max_words: int) -> dict[int, list]:
    """part -> [text of the phrases, each ended by a line feed; counts] of one run of one language."""
    used = np.unique(ids)
    names = list(words)
    here = sorted(names[i] for i in used if i)
    rank = np.zeros(len(names), np.int64)
    rank[[words[w] for w in here]] = np.arange(1, len(here) + 1)
    seed = xxhash.xxh64_intdigest(lang.encode())
    word_hash = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in here), np.uint64, len(here))
    name, ended = pa.array(here, pa.large_binary()), pa.array([w + b"\n" for w in here], pa.large_binary())
    space = pa.scalar(b" ", pa.large_binary())
    out: dict[int, list] = {}
    shorter = hashes = None
    for m, (first, last, n) in enumerate(counted(rank[ids], own, max_words), 1):
        last = last - 1
        if m == 1:
            hashes = word_hash[last]
        else:
            hashes = (hashes[first] ^ (hashes[first] >> np.uint64(29))) * _MUL + word_hash[last]
        mixed = (hashes ^ (hashes >> np.uint64(32))) * _MUL
        part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        lines = ended.take(pa.array(last[order]))
        if m > 1:
            lines = pc.binary_join_element_wise(shorter.take(pa.array(first[order])), lines, space)
        if m < max_words:
            tail = name.take(pa.array(last))
            shorter = tail if m == 1 else pc.binary_join_element_wise(shorter.take(pa.array(first)), tail, space)
        offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
        data = memoryview(lines.buffers()[2]) if len(lines) else memoryview(b"")
        n = n[order].astype(np.int64)
        found, start = np.unique(part[order], return_index=True)
        for p, a, b in zip(found.tolist(), start.tolist(), [*start[1:].tolist(), len(order)]):
            slot = out.setdefault(p, [[], []])
            slot[0].append(data[offsets[a]:offsets[b]])
            slot[1].append(n[a:b].tobytes())
    return out


def _runs(docs: DataFrame, parts: int, max_words: int, chunk: int) -> DataFrame:
    def run(batches):
        def fresh():
            numbers = _Numbers()
            numbers[_END] = 0
            return numbers, {}

        def flush(over_lang: str, over: int):
            pack = zstandard.ZstdCompressor(level=1).compress
            rows = []
            for lang, ids in streams.items():
                own = len(ids) - (over if lang == over_lang else 0)
                for p, (text, n) in _slices(words, np.array(ids, np.int64), own, lang, parts, max_words).items():
                    rows.append((p, lang, pack(b"".join(text)), pack(b"".join(n))))
            columns = list(zip(*rows)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.binary()))],
                names=["part", "lang", "phrases", "counts"])

        words, streams = fresh()
        held, lang = 0, ""
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, row = lang.as_py(), tokens(text.as_py())
                at = 0
                while at < len(row):
                    stop = min(len(row), at + chunk - held)
                    # of a text that goes on in the next run, the words that phrases of this one reach into
                    over = row[stop:stop + max_words - 1]
                    ids = streams.setdefault(lang, [])
                    ids += map(words.__getitem__, row[at:stop])
                    ids += map(words.__getitem__, over) if over else (0,)
                    held += stop - at
                    at = stop
                    if held >= chunk:
                        yield flush(lang, len(over))
                        words, streams = fresh()
                        held = 0
                        pa.default_memory_pool().release_unused()
        if held:
            yield flush(lang, 0)
    return docs.mapInArrow(run, "part long, lang string, phrases binary, counts binary")


def _added(least: int):
    """Adds up the slices of a part: (lang, phrase, f) of the phrases counted ``least`` times or more, and a row without
    a phrase for all words of the part."""
    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        langs = np.array(table.column("lang").to_pylist(), object)
        texts, numbers = table.column("phrases"), table.column("counts")
        out = []
        for lang in sorted(set(langs)):
            rows = np.flatnonzero(langs == lang).tolist()
            data = b"".join(unpack(texts[i].as_py()) for i in rows)
            n = np.frombuffer(b"".join(unpack(numbers[i].as_py()) for i in rows), np.int64)
            ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
            offsets = np.concatenate([np.zeros(1, np.int64), ends])
            lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            t = pa.table({"p": lines, "f": pa.array(n)}).group_by("p").aggregate([("f", "sum")])
            single = pc.invert(pc.match_substring(t.column("p"), b" "))
            whole = pc.sum(t.column("f_sum").filter(single)).as_py() or 0
            t = t.filter(pc.greater_equal(t.column("f_sum"), least))
            phrases = [x[:-1].decode() for x in t.column("p").to_pylist()]
            out.append(pa.table({"lang": pa.array([lang] * (len(phrases) + 1), pa.string()),
                                 "phrase": pa.array([None, *phrases], pa.string()),
                                 "f": pa.array([whole, *t.column("f_sum").to_pylist()], pa.int64())}))
        return pa.concat_tables(out)
    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS, text_col: str = "text",
                  lang_col: str = "lang", chunk: int = CHUNK, part_bytes: int = PART_BYTES) -> DataFrame:
    """lang, phrase, f of every phrase of 1 to ``max_words`` words that is counted ``least`` times or more; rows
    without a phrase add up to a language's number of words."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))
    return _runs(rows, parts, max_words, chunk).groupBy("part").applyInArrow(
        _added(least), "lang string, phrase string, f long")


def _words(phrase: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def collocations(docs: DataFrame, least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP, extension: int = EXTENSION,
                 text_col: str = "text", lang_col: str = "lang", chunk: int = CHUNK, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words by score: lang, rank, phrase, a, l, r, n, score."""
    every = written(phrase_counts(docs, least, max_words, text_col, lang_col, chunk, part_bytes), "phrases")
    counts = every.where("phrase IS NOT NULL")
    words = F.size(F.split("phrase", " "))
    cand = counts.where(F.contains("phrase", F.lit(" "))).select("lang", "phrase", F.col("f").alias("a"), words.alias("m"))

    # every cut, merged with the count stream by its first words and then by its last words
    k = F.col("k")
    cuts = (cand.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
            .select("lang", "phrase", "a", "m", "k", _words(F.col("phrase"), F.lit(1), k).alias("head"),
                    _words(F.col("phrase"), k + 1, F.col("m") - k).alias("tail")))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads.hint("merge"), ["lang", "head"]).join(tails.hint("merge"), ["lang", "tail"])
    a, both = F.col("a").cast("decimal(16,0)"), F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.withColumn("square", F.lit(SCALE).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)")).withColumn("both", both)
    scored = (cuts.withColumn("score", F.expr("square div both"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")))

    # the counts of what is one word longer, on either side
    longer = cand.where("m > 2")
    ends = F.explode(F.array(_words(F.col("phrase"), F.lit(1), F.col("m") - 1), _words(F.col("phrase"), F.lit(2), F.col("m") - 1)))
    inside = longer.select("lang", "a", ends.alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("beyond"))
    kept = (scored.join(inside.hint("merge"), ["lang", "phrase"], "left")
            .where(F.coalesce(100 * F.col("beyond") < extension * F.col("a"), F.lit(True))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = (kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
              .withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top))
    totals = every.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
