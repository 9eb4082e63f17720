"""Deduplication: last-wins on keys (D1), bigram-Jaccard similarity join (D3),
greedy first-wins fuzzy dedup (D4), its audit trail (D5) and distinct (D6).

D3 is an exact set-similarity self-join: packed sets in blocks of bounded size and neighbouring set sizes, every
pair of blocks whose sizes allow a link compared in a task of its own. What moves are sets, a few times each,
and what leaves a task are links, not candidates. No pair is dropped and there is no cap.

D4 is the sequential "keep unless similar to an earlier kept record" scan, in blocks of the order that
double in size. A block is first matched against the kept names alone, so a dropped name never pairs
again; only what is left of a block is compared with itself, and the lexicographically-first maximal
independent set of its similarity graph (what the scan keeps) is found in rounds of joins. Every
block's and round's state is checkpointed to the shared checkpoint folder, so a lost executor costs a
recompute from the last one. D5 falls out of the same matches.
"""

from __future__ import annotations

import functools
import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_dir, cut, ship_package

log = logging.getLogger(__name__)


def dedup_last(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """One row per key holding the values of the LAST row by ``seq``; the row's
    ``seq`` becomes the key's FIRST position (a dict keeps the first insertion slot)."""
    others = [c for c in df.columns if c not in keys and c != seq]
    payload = F.struct(*[F.col(c) for c in others]) if others else F.lit(None)
    agg = (df.groupBy(*keys)
           .agg(F.max_by(payload, F.col(seq)).alias("__last"), F.min(seq).alias(seq)))
    return agg.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in others], seq).select(df.columns)


def _keyed(df: DataFrame, key: str, seq: str) -> DataFrame:
    """(k, digest, seq): the lower-cased non-empty keys and their SHA-256. Keys can be whole texts, so they are told
    apart by their digest and only the digest is shuffled."""
    k = F.lower(F.col(key))
    return (df.select(k.alias("k"), F.col(seq).alias("seq")).where(F.col("k").isNotNull() & (F.col("k") != ""))
            .select("k", F.unhex(F.sha2("k", 256)).alias("digest"), "seq"))


def dense_index(df: DataFrame, *order) -> DataFrame:
    """Add ``id`` = 0-based position of each row in the global order, without an
    RDD or a single-partition window: a range-partitioned sort is checkpointed
    (fixing order and partitioning), then id = rows in earlier partitions + the
    row's position in its partition. The per-partition offset table has one
    row per partition."""
    ordered = cut(df.orderBy(*order))
    mid = F.monotonically_increasing_id()
    tagged = ordered.select("*", F.spark_partition_id().alias("__pid"), (mid % F.lit(1 << 33)).alias("__pos"))
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.sum("__n").over(Window.orderBy("__pid")) - F.col("__n")).alias("__off"))
    return (tagged.join(F.broadcast(offsets), "__pid")
            .select(*df.columns, (F.col("__off") + F.col("__pos")).alias("id")))


DENSE_TOKENS = 4096   # most frequent bigrams kept as a bitset (64 longs) per key


def _grams(text: str) -> np.ndarray:
    """The distinct bigrams of a text, each packed into a long (two code points of 21 bits)."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.unique((c[:-1] << 21) | c[1:])


def _gram_counts(batches):
    for batch in batches:
        found = [_grams(k.as_py()) for k in batch.column(0)]
        if found:
            tok, df = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tok), pa.array(df.astype(np.int64))], names=["tok", "df"])


def _packer(vocab: np.ndarray):
    """Packs the bigrams of each key: a bit for each one of ``vocab``, the longs of the others."""
    order = np.argsort(vocab)
    ranked, width = vocab[order], max(1, -(-len(vocab) // 64)) * 64

    def run(batches):
        for batch in batches:
            n, bits, rare = [], [], []
            for k in batch.column(0):
                g = _grams(k.as_py())
                flags, at = np.zeros(width, np.uint8), np.searchsorted(ranked, g)
                known = at < len(ranked)
                known[known] = ranked[at[known]] == g[known]
                flags[order[at[known]]] = 1
                n.append(len(g))
                bits.append(np.packbits(flags).tobytes())
                rare.append(g[~known])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int32()), pa.array(bits, pa.binary()),
                                              pa.array(rare, pa.list_(pa.int64()))], names=["digest", "n", "bits", "rare"])
    return run


def token_vectors(keyed: DataFrame, dense_tokens: int = DENSE_TOKENS) -> DataFrame:
    """(digest, n, bits, rare): the distinct bigrams of every key of ``keyed(k, digest)``, one row a digest, as an exact
    compact set: a bitset over the most frequent bigrams and the rest as longs. Keys without a bigram are not in it.

    The bigrams are counted over all rows; at most ``dense_tokens`` of them reach the driver. Which ones have a
    bit is a matter of space alone.
    """
    ship_package(keyed.sparkSession)
    counts = keyed.select("k").mapInArrow(_gram_counts, "tok long, df long").groupBy("tok").agg(F.sum("df").alias("df"))
    vocab = [r["tok"] for r in counts.orderBy(F.desc("df"), F.asc("tok")).limit(dense_tokens).collect()]
    packed = keyed.select("k", "digest").mapInArrow(_packer(np.array(vocab, np.int64)),
                                                    "digest binary, n int, bits binary, rare array<bigint>")
    return packed.where(F.col("n") > 0).dropDuplicates(["digest"])


MEMBERS = 2048        # sets of a block, at least
TASK_ROWS = 32_768    # sets of a block, at most: two blocks meet in one task
TILE = 256, 2048      # sets that are held against each other at once
PIVOTS = 16           # sets of a block that the others are grouped by
HEAD = 128            # bytes of the bitset, the most frequent bigrams, that a group's telling bits are taken from
SPARE = 1e-6          # keeps rounding from excluding a pair


def _rows_of(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """The bitsets of a binary column as rows of bytes."""
    return np.frombuffer(b"".join(x.as_py() for x in column.combine_chunks()), np.uint8).reshape(n, -1)


def _differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bits differ between each row of longs and the one row ``y``."""
    out = np.empty(len(x), np.int32)
    for i in range(0, len(x), 4096):
        out[i:i + 4096] = np.bitwise_count(x[i:i + 4096] ^ y).sum(1, dtype=np.int32)
    return out


def _pivots(longs: np.ndarray) -> list[int]:
    """Up to PIVOTS rows far from each other."""
    some = np.linspace(0, len(longs) - 1, min(len(longs), 256)).astype(np.int64)
    chosen = [int(some[0])]
    far = _differ(longs[some], longs[chosen[0]])
    while len(chosen) < PIVOTS and far.max() > 0:
        chosen.append(int(some[far.argmax()]))
        far = np.minimum(far, _differ(longs[some], longs[chosen[-1]]))
    return chosen


def _telling(bits: np.ndarray, members: np.ndarray) -> np.ndarray:
    """The (at most 256) bits that are set in nearest to half of the members, best first."""
    some = members[:: max(1, len(members) // 1024)]
    share = np.unpackbits(bits[some, :HEAD], axis=1).mean(0, dtype=np.float32)
    return np.argsort(np.abs(share - 0.5), kind="stable")[:256]


def _words(bits: np.ndarray, rows: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """The telling bits of the rows as longs, a row for each 64 bits."""
    out = np.zeros((len(rows), -(-len(telling) // 64) * 8), np.uint8)
    for i in range(0, len(rows), 4096):
        packed = np.packbits(np.unpackbits(bits[rows[i:i + 4096], :HEAD], axis=1)[:, telling], axis=1)
        out[i:i + 4096, :packed.shape[1]] = packed
    return np.ascontiguousarray(out.view(np.uint64).T)


def _apart(x: np.ndarray, y: np.ndarray, words: int) -> np.ndarray:
    """Matrix of how many of the first bits differ. Over 255 it wraps to 0, which only leaves a pair to be confirmed."""
    out = np.bitwise_count(x[0][:, None] ^ y[0][None])
    for w in range(1, words):
        out += np.bitwise_count(x[w][:, None] ^ y[w][None])
    return out


def _enough(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, wide: float) -> int:
    """How many longs of telling bits are worth comparing, by some of the pairs."""
    i, j = (np.linspace(0, len(m) - 1, min(len(m), k)).astype(np.int64) for m, k in ((nx, 64), (ny, 256)))
    most = wide * (nx[i][:, None] + ny[j][None])
    cost = [0.9 * w + 80 * (_apart(x[:, i], y[:, j], w) <= most).mean() for w in range(1, len(x) + 1)]
    return int(np.argmin(cost)) + 1


def _candidates(bits: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, t: float, alone: bool):
    """Yields index arrays (u, v) with all pairs of ``a`` and ``b`` that can reach t and some others.

    Sets with Jaccard >= t differ in at most (1 - t) / (1 + t) of their sizes' sum, and so in no more of any bits. Their numbers of
    differences to any third set (a pivot) lie as near (triangle inequality): this excludes whole groups. Then the bits
    that tell a group's sets apart best are compared."""
    wide, longs = (1 - t) / (1 + t), bits.view(np.uint64)
    near = np.stack([_differ(longs, longs[a[p]]) for p in _pivots(longs[a])], 1)
    group = near.argmin(1)
    order = np.lexsort((n[a], group[a]))
    a = a[order]
    place = np.empty(len(n), np.int64)
    place[a] = np.arange(len(a))               # of a pair within a block, the one with the lower place comes first
    starts = np.append(np.flatnonzero(np.diff(group[a], prepend=-1)), len(a))
    for start, stop in zip(starts[:-1], starts[1:]):
        own = a[start:stop]                    # a group, by size
        telling = _telling(bits, own)
        with_ = b[(n[b] >= t * n[own[0]] - SPARE) & (n[b] <= n[own[-1]] / t + SPARE)]
        if alone:
            with_ = with_[place[with_] >= start]
        with_ = with_[_within(near, n, own, with_, wide)]
        if not len(with_):
            continue
        x, y = _words(bits, own, telling), _words(bits, with_, telling)
        words = _enough(x, y, n[own], n[with_], wide)
        for i in range(0, len(own), TILE[0]):
            p = own[i:i + TILE[0]]
            lo = np.searchsorted(n[with_], t * n[p[0]] - SPARE)
            hi = np.searchsorted(n[with_], n[p[-1]] / t + SPARE, "right")
            some = lo + np.flatnonzero(_within(near, n, p, with_[lo:hi], wide))
            for j in range(0, len(some), TILE[1]):
                k = some[j:j + TILE[1]]
                q = with_[k]
                apart = _apart(x[:, i:i + TILE[0]], y[:, k], words)
                u, v = np.divmod(np.flatnonzero(apart.ravel() <= min(255, int(wide * (n[p[-1]] + n[q[-1]]) + SPARE))), len(q))
                left = apart[u, v] <= wide * (n[p[u]] + n[q[v]]) + SPARE
                u, v = p[u[left]], q[v[left]]
                if alone:
                    once = place[u] < place[v]
                    u, v = u[once], v[once]
                yield u, v


def _within(near: np.ndarray, n: np.ndarray, p: np.ndarray, q: np.ndarray, wide: float) -> np.ndarray:
    """Which of ``q`` can be linked to one of ``p`` by their differences to the pivots."""
    reach = wide * (n[p].max() + n[q]) + SPARE
    lo, hi, own = near[p].min(0), near[p].max(0), near[q]
    return ((own >= lo - reach[:, None]) & (own <= hi + reach[:, None])).all(1)


def _compared(t: float, cross: bool):
    """Compares the two blocks of a pair of blocks, or a block with itself; see ``linked``."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        at, n, left = (table.column(c).to_numpy() for c in ("at", "n", "left"))
        n = n.astype(np.int64)
        bits = _rows_of(table.column("bits"), len(at))
        longs = bits.view(np.uint64)
        rare = table.column("rare").combine_chunks()
        has_rare = len(rare.flatten()) > 0
        a = np.flatnonzero(left)
        b = np.flatnonzero(~left)
        alone = not len(b) and not cross       # a block with itself comes once
        a, b = a[np.argsort(n[a], kind="stable")], b[np.argsort(n[b], kind="stable")]
        b = a if alone else b
        src, dst, sim = [], [], []
        for u, v in _candidates(bits, n, a, b, t, alone) if len(a) and len(b) else []:
            for s in range(0, len(u), 65_536):
                c, d = u[s:s + 65_536], v[s:s + 65_536]
                both = np.bitwise_count(longs[c] & longs[d]).sum(1, dtype=np.int64)
                if has_rare:
                    rest = np.minimum(*(n[e] - np.bitwise_count(longs[e]).sum(1, dtype=np.int64) for e in (c, d)))
                    most = both + rest
                    for w in np.flatnonzero((rest > 0) & (most / (n[c] + n[d] - most) >= t)):
                        both[w] += len(set(rare[int(c[w])].as_py()).intersection(rare[int(d[w])].as_py()))
                jaccard = both / (n[c] + n[d] - both)
                good = jaccard >= t
                src.append(np.minimum(at[c], at[d])[good])
                dst.append(np.maximum(at[c], at[d])[good])
                sim.append(jaccard[good])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        src, dst, sim = join(src, np.int64), join(dst, np.int64), join(sim, np.float64)
        if cross:                              # only the first match of each new set leaves the task
            order = np.lexsort((src, dst))
            src, dst, sim = src[order], dst[order], sim[order]
            first = np.append(True, dst[1:] != dst[:-1])[:len(dst)]
            src, dst, sim = src[first], dst[first], sim[first]
        return pa.table({"src": src, "dst": dst, "sim": sim})
    return run


def _blocks(sizes: list[tuple[int, int]], first: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Blocks of neighbouring set sizes from (size, number of sets): what a size maps to, as (size, its first block, over
    how many), and the blocks as (block, smallest size, largest size)."""
    most = min(max(-(-sum(c for _, c in sizes) // 8), MEMBERS), TASK_ROWS)
    cells, blocks, held = [], [], 0
    for n, c in sorted(sizes):
        parts = -(-c // most)
        if parts > 1 or not held or held + c > most:
            at = first + len(blocks)
            blocks += [(at + i, n, n) for i in range(parts)]
            held = c if parts == 1 else 0
        else:
            blocks[-1] = (blocks[-1][0], blocks[-1][1], n)
            held += c
        cells.append((n, blocks[-1][0] - parts + 1, parts))
    return cells, blocks


def linked(sets: DataFrame, t: float, cross: bool = False) -> DataFrame:
    """(src, dst, sim), src < dst, of all pairs of ``sets(at, n, bits, rare, old)`` with Jaccard >= t; with ``cross`` only
    of an old and a new one (old ones come first), and of these at least each new set's first.

    The sizes of a pair lie within a factor t. The sets are cut into blocks of neighbouring sizes, and every pair of blocks
    whose sizes allow it is compared in one task: differences to a few pivots, then those in the bits that tell a group's
    sets apart best, leave the pairs that can still reach t, and these are confirmed on the whole sets. A set moves once
    for each block it meets, however many bigrams it shares. What reaches the driver is the number of sets of each size.
    """
    spark = sets.sparkSession
    sizes = {False: [], True: []}
    for r in sets.groupBy("old", "n").agg(F.count(F.lit(1)).alias("c")).collect():
        sizes[r["old"] and cross].append((r["n"], r["c"]))
    cells, blocks = _blocks(sizes[False], 0)
    old_cells, old_blocks = _blocks(sizes[True], len(blocks))
    fits = lambda x, y: x[1] * t <= y[2] * (1 + 1e-9) and y[1] * t <= x[2] * (1 + 1e-9)
    pairs = ([(x[0], y[0]) for x in old_blocks for y in blocks if fits(x, y)] if cross
             else [(x[0], y[0]) for i, x in enumerate(blocks) for y in blocks[i:] if fits(x, y)])
    if not pairs:
        return spark.createDataFrame([], "src long, dst long, sim double")
    places = [(x, i, True) for i, (x, _) in enumerate(pairs)] + [(y, i, False) for i, (x, y) in enumerate(pairs) if x != y]
    cell = spark.createDataFrame([(False, *c) for c in cells] + [(True, *c) for c in old_cells],
                                 "__old boolean, __n int, first int, parts int")
    place = spark.createDataFrame(places, "block int, pair int, left boolean")
    met = (sets.join(F.broadcast(cell), (F.col("n") == F.col("__n")) & ((F.col("old") & F.lit(cross)) == F.col("__old")))
           .withColumn("block", F.col("first") + F.pmod(F.xxhash64("at"), F.col("parts")).cast("int"))
           .join(F.broadcast(place), "block"))
    return (met.select("pair", "left", "at", "n", "bits", "rare").repartition(len(pairs), "pair").groupBy("pair")
            .applyInArrow(_compared(t, cross), "src long, dst long, sim double"))


def _names(df: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(digest, seq, at) of the distinct keys, ``at`` counting them in the order of their first ``seq``, and the keyed rows."""
    keyed = _keyed(df, key, seq)
    distinct = keyed.groupBy("digest").agg(F.min("seq").alias("seq"))
    return cut(dense_index(distinct, F.col("seq"), F.col("digest")).withColumnRenamed("id", "at")), keyed


def _sets(names: DataFrame, keyed: DataFrame) -> DataFrame:
    return cut(token_vectors(keyed).join(names.select("digest", "at"), "digest").drop("digest"))


def similar_pairs(df: DataFrame, key: str, seq: str = "seq", t: float = 0.85, with_keys: bool = False) -> DataFrame:
    """D3: all pairs of distinct lower-cased keys with bigram Jaccard >= t (exact).

    Returns (src, dst, sim), src being the earlier key's first seq, plus (src_k, dst_k) when ``with_keys`` (keys
    can be whole texts, so they are attached only on request).
    """
    checkpoint_dir(df.sparkSession)
    names, keyed = _names(df, key, seq)
    sets = _sets(names, keyed).withColumn("old", F.lit(False))
    if with_keys:
        names = names.join(keyed.select("digest", "k").dropDuplicates(["digest"]), "digest")
    own = ["seq"] + ["k"] * with_keys
    side = lambda name: names.select(F.col("at").alias(f"{name}_at"), *[
        F.col(c).alias(name if c == "seq" else f"{name}_{c}") for c in own])
    pairs = linked(sets, t).withColumnsRenamed({"src": "src_at", "dst": "dst_at"})
    return (pairs.join(side("src"), "src_at").join(side("dst"), "dst_at")
            .select("src", "dst", "sim", *(["src_k", "dst_k"] if with_keys else [])))


def _ckpt(df: DataFrame) -> DataFrame:
    return cut(df)


COMPACT = 16          # rounds whose dropped nodes are kept apart
TASK_EDGES = 262_144  # edges of a task: what is left of them shrinks fast, and so does the number of tasks


def greedy_dropped(edges: DataFrame, max_rounds: int | None = None, few_nodes: bool = False) -> tuple[DataFrame, int]:
    """Nodes the sequential first-wins scan drops, given directed edges src<dst, which are read several times.

    Round: undecided nodes with no undecided earlier neighbour are kept; their
    later neighbours are dropped; edges touching decided nodes are removed. An edge of a kept node always
    leads to a dropped one, so the dropped nodes alone tell which edges go. A round
    checkpoints once: the edges left, and the nodes dropped as edges without src. With
    ``few_nodes`` (the caller bounds the number of nodes) the nodes are broadcast and no edge is shuffled to meet them.
    First-in-order maximal independent sets are P-complete, so an adversarial
    order (a long chain) needs as many rounds as half its length.
    """
    checkpoint_dir(edges.sparkSession)
    near = F.broadcast if few_nodes else lambda nodes: nodes
    active = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    gone = []
    rounds = 0
    while remaining := active.count():
        rounds += 1
        if max_rounds is not None and rounds > max_rounds:
            raise RuntimeError(f"fuzzy dedup did not converge in {max_rounds} rounds")
        active = active.coalesce(-(-remaining // TASK_EDGES))
        later = active.select(F.col("dst").alias("node")).distinct()
        drop_now = active.join(near(later), F.col("src") == F.col("node"), "left_anti").select(F.col("dst").alias("node")).distinct()
        left = (active.join(near(drop_now), F.col("dst") == F.col("node"), "left_anti")
                .join(near(drop_now), F.col("src") == F.col("node"), "left_anti"))
        state = _ckpt(left.unionByName(drop_now.select(F.lit(None).cast("long").alias("src"), F.col("node").alias("dst"))))
        active = state.where(F.col("src").isNotNull())
        gone.append(state.where(F.col("src").isNull()).select(F.col("dst").alias("node")))
        if len(gone) == COMPACT:
            gone = [_ckpt(functools.reduce(DataFrame.unionByName, gone).coalesce(1 if few_nodes else COMPACT))]
    log.info("fuzzy dedup: %d distributed rounds", rounds)
    if not gone:
        return active.select(F.col("src").alias("node")).limit(0), rounds
    return _ckpt(functools.reduce(DataFrame.unionByName, gone)), rounds


FIRST_BLOCK = 4096    # names of the first block; each next one holds twice as many,
LAST_BLOCK = 262_144  # up to this many,
FEW_LINKS = 4_000_000  # and only while a block had fewer links among its own: what they take on disk does not grow with the table


def _first_match(pairs: DataFrame) -> DataFrame:
    return (pairs.groupBy("dst").agg(F.min_by(F.struct("src", "sim"), F.col("src")).alias("m"))
            .select("dst", F.col("m.src").alias("src"), F.col("m.sim").alias("sim")))


def decided(sets: DataFrame, n: int, t: float, first_block: int = FIRST_BLOCK) -> DataFrame:
    """(dst, src, sim): every dropped name of ``sets`` (``at`` below ``n``) with the first kept one it matches.

    At most the pairs of kept names with one block's names, and of what is left of a block with itself, are
    ever stored; of the former only each name's first. All sets are read once a block. What is
    broadcast are places of one block's names."""
    kept = matches = None
    lo, size = 0, first_block
    while lo < n:
        rest = sets if not lo and size >= n else cut(sets.where((F.col("at") >= lo) & (F.col("at") < lo + size)))
        if kept is not None:
            both = kept.withColumn("old", F.lit(True)).unionByName(rest.withColumn("old", F.lit(False)))
            hit = cut(_first_match(linked(both, t, cross=True)))
            rest = cut(rest.join(F.broadcast(hit.select(F.col("dst").alias("at"))), "at", "left_anti"))
            matches = hit if matches is None else matches.unionByName(hit)
        edges = cut(linked(rest.withColumn("old", F.lit(False)), t))
        dropped, _ = greedy_dropped(edges, few_nodes=True)
        near = cut(_first_match(edges.join(F.broadcast(dropped.withColumnRenamed("node", "dst")), "dst", "left_semi")
                                .join(F.broadcast(dropped.withColumnRenamed("node", "src")), "src", "left_anti")))
        matches = near if matches is None else matches.unionByName(near)
        lo, size = lo + size, max(size, min(2 * size, LAST_BLOCK)) if edges.count() < FEW_LINKS else size
        if lo < n:
            stay = _ckpt(rest.join(F.broadcast(dropped.withColumnRenamed("node", "at")), "at", "left_anti"))
            kept = stay if kept is None else kept.unionByName(stay)
    return matches


def dedup_fuzzy(df: DataFrame, key: str = "name", seq: str = "seq", t: float = 0.85,
                with_audit: bool = False, first_block: int = FIRST_BLOCK):
    """Keep a row iff no earlier KEPT row has bigram Jaccard(lower(key)) >= t.

    Empty keys are always kept; equal keys (case-insensitive) collapse to their
    first row. Returns the kept rows (and the D5 audit when ``with_audit``).
    """
    checkpoint_dir(df.sparkSession)
    names, keyed = _names(df, key, seq)
    n = names.count()
    if not n:
        matches = df.sparkSession.createDataFrame([], "dst long, src long, sim double")
    else:
        matches = _ckpt(decided(_sets(names, keyed), n, t, first_block))
    first = (names.join(matches.select(F.col("dst").alias("at")), "at", "left_anti")
             .select(F.col("seq").alias("__first")))
    # decided by seq and whether the key is blank: blank keys spread over their rows' seq, and no text is shuffled for it
    kept = (df.withColumn("__blank", F.coalesce(F.col(key) == "", F.lit(True)))
            .join(first, F.col(seq) == F.col("__first"), "left")
            .where(F.col("__first").isNotNull() | F.col("__blank"))
            .drop("__first", "__blank"))
    if not with_audit:
        return kept
    return kept, dedup_audit(df, key, seq, names, matches)


def dedup_audit(df: DataFrame, key: str, seq: str, names: DataFrame, matches: DataFrame) -> DataFrame:
    """Every dropped row with the first kept row it matched and the similarity. Rows find their name by
    its digest, not by its text."""
    place = names.select("at", F.col("seq").alias("first"), "digest")
    rows = (df.where(F.col(key).isNotNull() & (F.col(key) != ""))
            .select(F.col(seq).alias("dropped_seq"), F.unhex(F.sha2(F.lower(F.col(key)), 256)).alias("digest")))
    near = (matches.join(names.select(F.col("at").alias("src"), F.col("seq").alias("matched_seq")), "src")
            .select(F.col("dst").alias("at"), "matched_seq", "sim"))
    found = rows.join(place, "digest").join(near, "at", "left")
    # a kept name's later copies match that name itself
    return (found.where(F.col("sim").isNotNull() | (F.col("dropped_seq") != F.col("first")))
            .select("dropped_seq", F.coalesce("matched_seq", "first").alias("matched_seq"),
                    F.coalesce("sim", F.lit(1.0)).alias("similarity")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-NULL values of a column."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()
