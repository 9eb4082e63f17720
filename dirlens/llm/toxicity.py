"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

*Lexicon*: words that labelled toxic rows hold far more often than the others (log odds of document
frequency), learned by Spark from labelled rows; at most ``LEXICON`` words.

*Features* of a whole text, in Arrow batches (``FEATURES``): lexicon densities, plain and weighted;
hits close to a second-person word; words that match the lexicon only after obfuscation (digits and
signs for letters, separators, repeated letters) is undone; rates of capitals, of whole words in
capitals, of punctuation, of exclamation and question marks, of words mixing letters with digits or
signs; the text's length.

*Model*: Spark ML trees on labelled rows, and an isotonic regression on a part of them that the
trees have not seen turns their margin into a probability.

Both learn from an expected ``SAMPLE`` labelled rows, chosen by a hash of the id among those that are
not held out. Defined results: null and empty texts have features of 0 and get the score of such a
text; a very long text is read whole. Other columns, whatever their names, take no part, and an empty
table gives no rows. A label is 1 if any row of its doc_id says so; rows without an id or a label teach nothing.
When the labels have fewer than two classes, every score is the share of toxic labels.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package

SAMPLE = 20_000
LEXICON = 256
TREES, DEPTH = 30, 3
FEATURES = ("hits", "hit_rate", "weight_rate", "top_weight", "near_person", "near_person_rate", "hidden", "hidden_rate",
            "capitals", "shouting", "punctuation", "marks", "mixed", "log_words")

#: Words of address, in the four languages of the corpus.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie "
                          "tu te ti tus tuyo usted ustedes vos toi ton ta tes vous votre vos".split())
#: Signs and digits that stand for letters.
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")

_word = re.compile(r"[^\W\d_]+")
_token = re.compile(r"\S+")
_odd = re.compile(r"[^\W\d_][\d@$!|*._\-]+[^\W\d_]|[\d@$|]+[^\W\d_]{2}")
_repeat = re.compile(r"(.)\1{2,}")
_not_letter = re.compile(r"[\W\d_]+")
NEAR = 5


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    text = text or ""
    words = _word.findall(text)
    lower = [w.lower() for w in words]
    n = len(words)
    at = [i for i, w in enumerate(lower) if w in lexicon]
    weights = [lexicon[lower[i]] for i in at]
    near = sum(any(w in SECOND_PERSON for w in lower[max(0, i - NEAR):i + NEAR + 1]) for i in at)
    hidden = mixed = 0
    if n:
        for m in _token.finditer(text):
            t = m.group()
            if _odd.search(t):
                mixed += 1
                plain = _not_letter.sub("", t.lower().translate(LOOKALIKE))
                bare = _not_letter.sub("", t.lower())
                hidden += (plain in lexicon or bare in lexicon) and not any(w.lower() in lexicon for w in _word.findall(t))
            elif len(t) > 4 and _repeat.search(t):
                hidden += _repeat.sub(r"\1", _not_letter.sub("", t.lower())) in lexicon
    letters = max(1, sum(map(len, words)))
    capitals = sum(map(str.isupper, text)) if n else 0
    shout = sum(len(w) > 1 and w.isupper() for w in words)
    signs = len(text) - letters - text.count(" ") - text.count("\n") if n else 0
    marks = text.count("!") + text.count("?")
    d = max(1, n)
    return [float(len(at)), len(at) / d, sum(weights) / d, max(weights, default=0.0), float(near), near / d,
            float(hidden), hidden / d, capitals / letters, shout / d, signs / max(1, len(text)), marks / d, mixed / d,
            math.log1p(n)]


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    def run(column: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py(), lexicon) for t in column], pa.list_(pa.float64()))
    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "array<double>")(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, y of the rows to learn from. Their ids are at most some ``sample`` rows, which is
    what the join broadcasts."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
             .groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("y")))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = known.where(draw < F.lit(sample / max(n, 1)))
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")


def learn_lexicon(rows: DataFrame, size: int = LEXICON, least: int = 5) -> dict[str, float]:
    """Words whose smoothed log odds of occurring in toxic rows are high, and the log odds."""
    totals = rows.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in totals}
    toxic, clean = n.get(1.0, 0), n.get(0.0, 0)
    if not toxic or not clean:
        return {}
    words = F.array_distinct(F.split(F.lower("text"), r"[\P{L}]+"))
    seen = (rows.select("y", F.explode(words).alias("w")).where("w != ''").groupBy("w")
            .agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where(F.col("t") >= least))
    odds = (F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (clean - F.col("c") + 0.5)))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    top = (seen.select("w", odds.alias("odds"), (odds / error).alias("z")).where("z > 4 AND odds > 1")
           .orderBy(F.desc("z"), "w").limit(size).collect())
    return {r["w"]: float(r["odds"]) for r in top}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(lexicon, tree model, isotonic model, share of toxic labels); no models for under two classes."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    ship_package(docs.sparkSession)
    # the sample's texts once, by all tasks that scan; everything below works on these rows alone
    rows = cut(labelled(docs, labels, sample))
    lexicon = learn_lexicon(rows)
    part = F.pmod(F.xxhash64("doc_id", F.lit(19)), F.lit(4)) == 0
    # narrow rows, as many as the sample: a few partitions spare the trees hundreds of tiny tasks
    rows = cut(rows.select("y", part.alias("late"), feature_column(F.col("text"), lexicon).alias("f")).repartition(6))
    rows = rows.withColumn("features", array_to_vector("f"))
    kinds = rows.groupBy("late", "y").count().collect()
    total = sum(r["count"] for r in kinds)
    share = sum(r["count"] for r in kinds if r["y"] == 1.0) / total if total else 0.0
    if len({r["y"] for r in kinds if not r["late"]}) < 2 or not any(r["late"] for r in kinds):
        return lexicon, None, None, share
    trees = GBTClassifier(labelCol="y", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=9,
                          maxBins=64).fit(rows.where("NOT late"))
    late = trees.transform(rows.where("late")).select(
        "y", vector_to_array("rawPrediction").getItem(1).alias("margin"))
    level = IsotonicRegression(labelCol="y", featuresCol="margin", predictionCol="score").fit(late)
    return lexicon, trees, level, share


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, lexicon_hits."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    lexicon, trees, level, share = fit(docs, labels, sample)
    rows = docs.select("doc_id", held_out().alias("held_out"), feature_column(F.col("text"), lexicon).alias("f"))
    if trees is None:
        rows = rows.withColumn("score", F.lit(float(share)))
    else:
        rows = trees.transform(rows.withColumn("features", array_to_vector("f")))
        rows = level.transform(rows.withColumn("margin", vector_to_array("rawPrediction").getItem(1)))
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return rows.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                       F.col("f").getItem(0).cast("long").alias("lexicon_hits"))
