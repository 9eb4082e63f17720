"""Near duplicates by b-bit MinHash, with every link confirmed on full shingle sets.

1. *Signatures* (Arrow batches): a text's distinct word shingles give ``PERMS`` minima. The low
   ``BITS`` bits of each are kept, bit-sliced and packed into 64-bit words; ``BANDS`` bands of
   ``ROWS`` minima give candidate keys. Documents with one and the same shingle set form a class
   and go on as one node, so a text copied by a third of the rows is one node.
2. *Candidates*: each band bucket elects a hub by a hash of (node, key), so a large group has a
   different hub in every band, and each member is paired with its bucket's hub alone: as many
   pairs as members, never all pairs of a group.
3. *Estimate*: the share of equal b-bit minima, counted with XOR and ``bit_count`` and corrected
   for chance collisions, drops pairs below ``FLOOR`` (five standard errors below the
   threshold). The others are confirmed on the full sets, and linked nodes form components.
4. *The rest, exactly*: a bucket that still holds several components can hide a link between two
   members neither of which is the hub. Such buckets go, in blocks of bounded size, to a task
   that tests the pairs across components by the same estimate and then on full sets, each pair
   in the first band that its members share. It returns the links that join components.

A pair at the threshold 0.8 shares no band with probability (1 - 0.8^ROWS)^BANDS = 3e-6 and fails
the floor with probability below 1e-6; nothing is capped.

Defined results: null, empty and word-free texts have an empty set (n_shingles 0), link with
nothing and are kept, as their own component. A text of fewer words than a shingle has one
shingle, its whole word sequence. Rows with a null doc_id can be linked; a component is named by
its smallest non-null doc_id (null if it has none), and ``kept`` is null-safe equality.
``drop_near_duplicates`` leaves one (doc_id, text) of each component, a null doc_id only where there
is no other; a row repeated whole is that document again and stays with it. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .common import written
from .components import connected_components

PERMS, BITS, ROWS, BANDS = 256, 4, 5, 32
SLICES = PERMS // 64            # 64-bit words of one bit plane
BLOCK = 400_000                 # shingles of a bucket's members that stand in one block
THRESHOLD = 80                  # per cent

_rng = np.random.default_rng(20240229)
_MUL = _rng.integers(0, 2**32, PERMS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, PERMS, dtype=np.uint32)
_WORD = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles (bytes.lower folds A-Z only and
    bytes.split separates at ASCII white space only)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    m, width = (n - k + 1, k) if n >= k else (1, n)
    s = np.full(m, width, np.uint64)
    for j in range(width):
        s = _mix(s * _WORD[0] + h[j:j + m] * _WORD[1])
    return np.unique(s)


def minima(sets: np.ndarray) -> np.ndarray:
    """The PERMS minima of a non-empty set, in blocks that stay in cache."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = None
    for i in range(0, len(x), 1024):
        v = (_MUL[:, None] * x[i:i + 1024] + _ADD[:, None]).min(1)
        out = v if out is None else np.minimum(out, v)
    return out


def packed(mins: np.ndarray) -> np.ndarray:
    """Low bits of the (re-mixed) minima, plane by plane, as 64-bit words."""
    low = (_mix(mins.astype(np.uint64)) >> np.uint64(8)).astype(np.uint8)
    planes = np.stack([(low >> b) & 1 for b in range(BITS)]).astype(np.uint8)
    return np.packbits(planes, axis=1).reshape(-1).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    bands = mins[:ROWS * BANDS].reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _WORD[2]
    for r in range(ROWS):
        key = _mix(key * _WORD[3] + bands[:, r])
    return key.view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected Jaccard similarity of two packed signatures."""
    differ = None
    for s in range(SLICES):
        bits = None
        for p in range(BITS):
            x = a.getItem(p * SLICES + s).bitwiseXOR(b.getItem(p * SLICES + s))
            bits = x if bits is None else bits.bitwiseOR(x)
        n = F.bit_count(bits)
        differ = n if differ is None else differ + n
    chance = 2.0 ** -BITS
    return ((F.lit(PERMS) - differ) / PERMS - chance) / (1 - chance)


def floor(threshold: int = THRESHOLD) -> float:
    """Five standard errors of the estimate below the threshold."""
    t, chance = threshold / 100, 2.0 ** -BITS
    p = t + (1 - t) * chance
    return t - 5 * math.sqrt(p * (1 - p) / PERMS) / (1 - chance)


def _estimates(sig: np.ndarray, row: np.ndarray) -> np.ndarray:
    x = (sig ^ row).reshape(len(sig), BITS, SLICES)
    # as unsigned words: numpy counts the bits of a negative number by its absolute value
    differ = np.bitwise_count(np.bitwise_or.reduce(x, axis=1).view(np.uint64)).sum(1, dtype=np.int64)
    chance = 2.0 ** -BITS
    return ((PERMS - differ) / PERMS - chance) / (1 - chance)


def _similar(a, b, threshold: int) -> bool:
    inter = len(a & b) if isinstance(a, frozenset) else len(np.intersect1d(a, b, assume_unique=True))
    return 100 * inter >= threshold * (len(a) + len(b) - inter)


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row: doc_id, th (hash of the text), n, cls (16-byte digest of the set), sig, keys."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, th bigint, n bigint, cls binary, sig array<bigint>, keys array<bigint>"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, cls, sig, keys = [], [], [], []
                for text in part.column(2):
                    s = shingle_set(text.as_py(), k)
                    n.append(len(s))
                    if not len(s):
                        cls.append(None), sig.append(None), keys.append(None)
                        continue
                    m = minima(s)
                    cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sig.append(packed(m))
                    keys.append(band_keys(m))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(sig, longs), pa.array(keys, longs)],
                    names=["doc_id", "th", "n", "cls", "sig", "keys"])

    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def _confirm(pairs: DataFrame, k: int, threshold: int) -> DataFrame:
    """The pairs (a, b, text_a, text_b) whose full sets are similar enough."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ok = [_similar(shingle_set(x.as_py(), k), shingle_set(y.as_py(), k), threshold)
                      for x, y in zip(part.column(2), part.column(3))]
                yield part.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return pairs.mapInArrow(run, "a bigint, b bigint")


def _across(rows: pa.Table, k: int, threshold: int) -> pa.Table:
    """Links that join components within one block pair of one bucket."""
    n = rows.num_rows
    node, label = rows["node"].to_pylist(), rows["label"].to_numpy().copy()
    block = rows["block"].to_numpy()
    same = rows["i"][0].as_py() == rows["j"][0].as_py()
    band = rows["band"][0].as_py()
    sig = rows["sig"].combine_chunks().flatten().to_numpy().reshape(n, -1)
    keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(n, -1)[:, :band]
    size = rows["n"].to_numpy()
    sets: dict[int, frozenset] = {}

    def full(i):
        if i not in sets:
            sets[i] = frozenset(shingle_set(rows["text"][i].as_py(), k).tolist())
        return sets[i]

    low, a, b = floor(threshold), [], []
    for i in range(n - 1):
        rest = np.arange(i + 1, n)
        if not same:
            rest = rest[block[i + 1:] != block[i]]
        rest = rest[label[rest] != label[i]]
        if not len(rest):
            continue
        rest = rest[100 * np.minimum(size[rest], size[i]) >= threshold * np.maximum(size[rest], size[i])]
        rest = rest[_estimates(sig[rest], sig[i]) >= low]
        rest = rest[~(keys[rest] == keys[i]).any(1)]          # an earlier band has this pair
        for j in rest.tolist():
            if label[i] != label[j] and _similar(full(i), full(j), threshold):
                a.append(node[i]), b.append(node[j])
                label[label == label[j]] = label[i]           # one component from now on
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int,
              threshold: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, th, n, cls) and, for every class, its component's label: cls, least_id, heir,
    class_size, label."""
    ship_package(docs.sparkSession)
    signed = written(signatures(docs, id_col, text_col, shingle), "minhash")

    # a node per distinct shingle set; the written table fixes the node numbers
    nodes = (signed.where("cls IS NOT NULL").groupBy("cls")
             .agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.min("doc_id").alias("least_id"),
                  F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("heir"),
                  F.count(F.lit(1)).alias("class_size"),
                  F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys")))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "cls", "rep.*", "least_id", "heir",
                                 "class_size", "n", "sig", "keys"), "minhash-nodes")

    # buckets with company, and each one's hub
    bands = nodes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    hubs = (bands.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", "key"), "node")).alias("hub"),
                                     F.count(F.lit(1)).alias("members"))
            .where("members > 1").select("key", F.col("hub.node").alias("hub"), "members"))
    shared = cut(bands.join(hubs, "key"))
    pairs = (shared.where("node != hub")
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())

    light = nodes.select("node", "n", "sig")
    left = light.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = light.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    likely = (pairs.join(left, "a").join(right, "b")
              .where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
              .where(estimate(F.col("sa"), F.col("sb")) >= floor(threshold)).select("a", "b"))
    likely = cut(likely)

    # whole texts of the nodes that share a bucket, one for each node
    asked = (nodes.join(shared.select("node").distinct(), "node", "left_semi")
             .select("node", F.col("doc_id").alias("__id"), F.col("th").alias("__th")))
    have = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    texts = written(have.join(asked, (have["th"] == asked["__th"]) & have["id"].eqNullSafe(asked["__id"]))
                    .select("node", "text"), "minhash-texts")
    links = cut(_confirm(likely.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
                         .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
                         .select("a", "b", "text_a", "text_b"), shingle, threshold))
    first = cut(connected_components(links))

    # buckets that still hold several components, beside the hub whose pairs are tested
    rest = (shared.where("node != hub").join(first, "node", "left")
            .select("key", "band", "node", "n", F.coalesce("label", "node").alias("label")))
    mixed = (rest.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                     F.sum("n").alias("load")).where("lo != hi"))
    blocks = F.ceil(F.col("load") / F.lit(BLOCK)).cast("int")
    rest = (rest.join(mixed.select("key", blocks.alias("blocks")), "key")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", "band", "node", "label", "block", F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j")))
    rest = (rest.join(nodes.select("node", "n", "sig", "keys"), "node")
            .join(texts.groupBy("node").agg(F.first("text").alias("text")), "node"))
    more = cut(rest.groupBy("key", "i", "j").applyInArrow(lambda t: _across(t, shingle, threshold),
                                                          "a bigint, b bigint"))

    # components of components
    joined = connected_components(
        more.join(first.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
        .join(first.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
        .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    classes = (nodes.select("node", "cls", "least_id", "heir", "class_size").join(first, "node", "left")
               .withColumn("label", F.coalesce("label", "node"))
               .join(joined.select(F.col("node").alias("label"), F.col("label").alias("last")), "label", "left")
               .select("cls", "least_id", "heir", "class_size", F.coalesce("last", "label").alias("label")))
    return signed.select("doc_id", "th", "n", "cls"), classes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, class_size."""
    rows, classes = _labelled(docs, id_col, text_col, shingle, threshold)
    named = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    where = classes.select("cls", "class_size", "label").join(named, "label").drop("label")
    linked = rows.join(where, "cls").select("doc_id", "n", "component_id", "class_size")
    alone = rows.where("cls IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"),
                                             F.lit(1).cast("bigint").alias("class_size"))
    return linked.union(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "class_size")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                         threshold: int = THRESHOLD) -> DataFrame:
    """The documents that stay (one of each component), with the columns they came with."""
    rows, classes = _labelled(docs, id_col, text_col, shingle, threshold)
    heirs = classes.groupBy("label").agg(F.min("heir").alias("heir")).select("heir.doc_id", "heir.th")
    stay = (heirs.union(rows.where("cls IS NULL").select("doc_id", "th")).distinct()
            .select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")))
    return docs.join(stay, docs[id_col].eqNullSafe(stay["__id"])
                     & (F.xxhash64(docs[text_col]) == stay["__th"]), "left_semi")
