"""Language identification as multilingual mixture inference.

*Model*: for every learned language, smoothed probabilities of hashed letter trigrams, counted by
Spark over labelled rows (an expected ``SAMPLE`` rows a language, chosen by a hash of the id).

*Inference*, in Arrow batches over whole texts: each run of letters is a word; its likelihood
under a language is the product of its trigrams' probabilities. A document is a mixture of
languages over its words, and expectation-maximisation estimates the proportions. The language set
is selected by penalised likelihood: starting from all languages, the one whose removal costs least
likelihood is removed and the mixture is refitted, down to one language, and the set with the best
log-likelihood minus ``PENALTY`` log(words) for each language wins. The prediction is the language
with the largest proportion, and the score is that proportion.

*Rejection* (``known``): all likelihoods are measured against a model that knows no language, under which every
trigram is equally likely. A text is of none of the learned languages when that model beats the best mixture clearly:
by more than a factor of e for each letter, and of e to the ``CLEAR`` in all. With few rows to learn from nothing is clear.

Defined results: a null text or one without a letter is ``und`` with score 0 and no languages; so
is every text when nothing could be learned. Ties go to the alphabetically first language. Rows
repeat as given; lang, source and id are never read for a prediction. Very long texts are read whole,
piece by piece. An empty table gives no rows. Other columns, whatever their names, stay as they came.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import carried, own_columns

CELLS = 1 << 16          # hashed trigrams
SMOOTH = 0.5
SAMPLE = 4000            # expected labelled rows a language
PENALTY = 2.0
STEPS = 12
CHUNK = 400_000          # characters handled at a time
CLEAR = 30.0             # nats by which the model without a language must win to reject a text

SCHEMA = "lang_pred string, score double, langs array<string>, shares array<double>, known boolean"


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    logp: np.ndarray         # CELLS x languages: log-likelihood over that of equally likely cells


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-case code points, with a space for anything that is no letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.where(_letters()[np.minimum(c, 0x10FFFF)], c, np.uint32(32))


def _trigrams(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the letters, and the cell of the trigram around each."""
    at = np.flatnonzero(c != 32)
    p = np.concatenate(([np.uint32(32)], c, [np.uint32(32)]))
    x = p[at] * np.uint32(0x9E3779B1) + p[at + 1] * np.uint32(0x85EBCA6B) + p[at + 2] * np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return at, (x >> np.uint32(16)).astype(np.int64)


def _pieces(text: str):
    """The text in pieces of about CHUNK characters, cut between words where there is a space."""
    start = 0
    while start < len(text):
        stop = start + CHUNK
        if stop < len(text):
            cut = text.rfind(" ", start + 1, stop)
            stop = cut if cut > start else stop
        yield text[start:stop]
        start = stop


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample: int = SAMPLE) -> Model:
    """Learn from the rows with a text and a label. The languages are few: one cell row each goes to
    the driver."""
    ship_package(labelled.sparkSession)
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model((), np.zeros((CELLS, 0), np.float32))
    langs = tuple(sorted(counts))
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(sample / counts[k]))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    at = {k: i for i, k in enumerate(langs)}

    def count(batches):
        total = np.zeros((len(langs), CELLS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for piece in _pieces(text.as_py()):
                    total[at[lang]] += np.bincount(_trigrams(_codes(piece))[1], minlength=CELLS)
        i, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(cell), pa.array(total[i, cell])],
                                         names=["lang", "cell", "n"])

    got = (rows.where(draw < share).select("lang", "text").mapInArrow(count, "lang bigint, cell bigint, n bigint")
           .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros((CELLS, len(langs)))
    table[got["cell"].to_numpy(), got["lang"].to_numpy()] = got["n"].to_numpy()
    return Model(langs, np.log((table + SMOOTH) * CELLS / (table.sum(0) + SMOOTH * CELLS)).astype(np.float32))


def _word_scores(text: str, logp: np.ndarray) -> tuple[np.ndarray, int]:
    """Log-likelihood of each word under each language, and the number of letters."""
    out, letters = [], 0
    for piece in _pieces(text):
        at, cells = _trigrams(_codes(piece))
        if len(at):
            first = np.flatnonzero(np.diff(at, prepend=at[0] - 2) > 1)
            out.append(np.add.reduceat(logp[cells], first, axis=0))
            letters += len(at)
    return np.concatenate(out) if out else np.empty((0, logp.shape[1]), np.float32), letters


def _fit(like: np.ndarray, start: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents at once. like: words x languages (each row's largest is 1); start: first
    word of each document; share: documents x languages, zero where a language is left out."""
    length = np.diff(np.append(start, len(like)))
    for _ in range(steps):
        r = like * np.repeat(share, length, axis=0)
        r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
        share = np.add.reduceat(r, start, axis=0) / length[:, None]
    mass = (like * np.repeat(share, length, axis=0)).sum(1)
    return share, np.add.reduceat(np.log(np.maximum(mass, 1e-300)), start)


def _without(like: np.ndarray, start: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log-likelihood of each document without each language of its set, the others' shares scaled up to
    1 but not refitted (a language that is not in the set: minus infinity)."""
    length = np.diff(np.append(start, len(like)))
    rest = 1.0 - np.eye(like.shape[1])
    mass = (like * np.repeat(share, length, axis=0)) @ rest
    ll = np.add.reduceat(np.log(np.maximum(mass, 1e-300)), start)
    return np.where(share > 0, ll - length[:, None] * np.log(np.maximum(share @ rest, 1e-100)), -np.inf)


def inferred(texts: list[str | None], model: Model, penalty: float = PENALTY) -> list[tuple[np.ndarray, bool] | None]:
    """Each text's language proportions, and whether it is of the learned languages (None: no letter)."""
    out: list[tuple[np.ndarray, bool] | None] = [None] * len(texts)
    if not model.langs:
        return out
    scores = [_word_scores(t, model.logp) if t else None for t in texts]
    which = [i for i, s in enumerate(scores) if s is not None and s[1]]
    if not which:
        return out
    length = np.array([len(scores[i][0]) for i in which])
    start = np.append(0, np.cumsum(length)[:-1])
    like = np.concatenate([scores[i][0] for i in which]).astype(np.float64)
    top = like.max(1, keepdims=True)
    like = np.exp(np.maximum(like - top, -300))
    k = like.shape[1]
    share, ll = _fit(like, start, np.full((len(which), k), 1.0 / k), STEPS)
    best, value, gain = share.copy(), ll - penalty * (share > 0).sum(1) * np.log1p(length), ll.copy()
    live = np.arange(len(which))
    while len(live):
        many = (share > 0).sum(1) > 1
        live, share = live[many], share[many]
        if not len(live):
            break
        words = np.concatenate([np.arange(start[d], start[d] + length[d]) for d in live])
        first = np.append(0, np.cumsum(length[live])[:-1])
        some = like[words]
        share[np.arange(len(live)), _without(some, first, share).argmax(1)] = 0
        share /= share.sum(1, keepdims=True)
        share, ll = _fit(some, first, share, STEPS // 2)
        now = ll - penalty * (share > 0).sum(1) * np.log1p(length[live])
        better = now > value[live]
        best[live[better]], value[live[better]], gain[live[better]] = share[better], now[better], ll[better]
    gain += np.add.reduceat(top[:, 0], start)
    for j, i in enumerate(which):
        out[i] = best[j], bool(gain[j] >= -max(CLEAR, scores[i][1]))
    return out


def mixtures(texts: list[str | None], model: Model, penalty: float = PENALTY) -> list[np.ndarray | None]:
    """Each text's language proportions (None: no letter)."""
    return [x and x[0] for x in inferred(texts, model, penalty)]


def _batches(texts: list[str | None]):
    """Slices of the list with about CHUNK characters in all."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def identify(text: Column, model: Model, penalty: float = PENALTY) -> Column:
    """A struct column (SCHEMA) for the text column: prediction, score, the selected languages by
    falling proportion, the proportions, and whether the text is of the learned languages."""
    def run(column: pa.Array) -> pa.Array:
        rows = []
        for part in _batches(column.to_pylist()):
            for found in inferred(part, model, penalty):
                if found is None:
                    rows.append({"lang_pred": "und", "score": 0.0, "langs": [], "shares": [], "known": False})
                    continue
                share, known = found
                order = [i for i in np.argsort(-share, kind="stable") if share[i] > 0]
                rows.append({"lang_pred": model.langs[order[0]], "score": min(1.0, float(share[order[0]])),
                             "langs": [model.langs[i] for i in order], "shares": [float(share[i]) for i in order],
                             "known": known})
        return pa.array(rows, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                                         ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64())),
                                         ("known", pa.bool_())]))
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, SCHEMA)(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    return train(docs.where(~held_out(id_col)), text_col, lang_col, id_col)


def identify_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang") -> DataFrame:
    """One row per row: doc_id, held_out, lang_pred, score, langs (joined by +)."""
    found = identify(F.col(text_col), learned(docs, id_col, text_col, lang_col))
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), found.alias("x"))
            .select("doc_id", "held_out", "x.lang_pred", "x.score", F.array_join("x.langs", "+").alias("langs")))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows with a text of the learned languages (``known``), with the columns they came with. Where no row has a
    label to learn from, nothing can be told apart and every text with a letter stays."""
    model = learned(docs, id_col, text_col, lang_col)
    if not model.langs:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    found = identify(F.col(text_col), model)
    return own_columns(carried(docs, found.alias("found")).where("found.known"))
