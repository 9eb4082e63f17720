"""Text mining and clustering (M1-M6).

Two forms of TF-IDF:
* a relational form (explode -> counts -> joins) that is checkable against SQL;
* an ML form (CountVectorizerModel -> IDF -> ElementwiseProduct -> Normalizer
  -> KMeans) that stays JVM-side and feeds clustering.

The idf is smoothed, ``ln((1+n)/(1+df)) + 1``, and rows are L2-normalised.
Spark's IDF lacks the ``+1``, so the ML form scales tf by (idf + 1).
What reaches the driver is bounded by the vocabulary size (≤ max_features
terms) and k×vocab centroids, never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import KeywordRules
from ..functions.classify import classify_multi
from ..functions.clean import PY_WORD, clean_price, clean_title, round_half_up, title_case
from ..session import cut


def default_stop_words() -> list[str]:
    from pyspark.ml.feature import StopWordsRemover
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(c) -> Column:
    """M1 tokenizer: lower-case runs of 2+ word characters (the \\b\\w\\w+\\b pattern)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(col), F.lit(f"[{PY_WORD}]{{2,}}"), 0)


def term_counts(df: DataFrame, doc: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(doc, term, tf) for every non-stop-word token."""
    sw = default_stop_words() if stop_words is None else stop_words
    t = df.select(F.col(doc).alias("doc"), F.explode(tokens(text)).alias("term"))
    if sw:
        t = t.where(~F.col("term").isin(sw))
    return t.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocab(tc: DataFrame, max_features: int = 1000) -> DataFrame:
    """M1: the ``max_features`` terms with the highest corpus count (ties by term),
    with their corpus count and document frequency."""
    stats = tc.groupBy("term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    return stats.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)


def tfidf(df: DataFrame, doc: str, text: str, max_features: int = 1000,
          stop_words: list[str] | None = None, digits: int = 6) -> DataFrame:
    """M2 (relational form): (doc, term, weight) with smoothed idf and L2 norm.

    The vocabulary is at most ``max_features`` rows, so it is broadcast by a
    proven size bound; the per-document norm is a window over one document's
    terms (bounded by the vocabulary).
    """
    tc = cut(term_counts(df, doc, text, stop_words))   # read twice, but each text is split into words once
    n_docs = float(df.count())   # one scalar
    vocab = fit_vocab(tc, max_features).select("term", "df")
    w = (tc.join(F.broadcast(vocab), "term")
         .select("doc", "term",
                 (F.col("tf") * (F.log(F.lit(n_docs + 1.0) / (F.col("df") + 1.0)) + 1.0)).alias("w")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return w.select("doc", "term", round_half_up(F.col("w") / norm, digits).alias("weight"))


def tfidf_vectors(df: DataFrame, doc: str, text: str, max_features: int = 1000,
                  stop_words: list[str] | None = None):
    """M2 (ML form): (doc, features) sparse L2-normalised TF-IDF vectors + vocabulary list."""
    from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    sw = default_stop_words() if stop_words is None else stop_words
    toks = df.select(F.col(doc).alias("doc"),
                     F.filter(tokens(text), lambda t: ~t.isin(sw) if sw else F.lit(True)).alias("tokens"))
    tc = toks.select("doc", F.explode("tokens").alias("term")).groupBy("doc", "term").agg(
        F.count(F.lit(1)).alias("tf"))
    vocab = [r["term"] for r in fit_vocab(tc, max_features).collect()]   # ≤ max_features terms
    if not vocab:
        vocab = ["__empty__"]
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="tokens", outputCol="tf")
    tf = cut(cv.transform(toks).select("doc", "tf"))   # the idf and every later pass read counts, not texts
    idf_model = IDF(inputCol="tf", outputCol="_idf", minDocFreq=0).fit(tf)
    scale = Vectors.dense([x + 1.0 for x in idf_model.idf.toArray()])   # vocabulary-sized
    weighted = ElementwiseProduct(scalingVec=scale, inputCol="tf", outputCol="raw").transform(tf)
    feats = Normalizer(p=2.0, inputCol="raw", outputCol="features").transform(weighted)
    return feats.select("doc", "features"), vocab


def cluster(vectors: DataFrame, k: int = 8, seed: int = 42, n_init: int = 10, max_iter: int = 300):
    """M3: KMeans with restarts; keeps the fit with the lowest training cost.

    k falls back to max(1, n // 2) when there are fewer rows than clusters.
    The input is persisted once for all restarts.
    """
    from pyspark import StorageLevel
    from pyspark.ml.clustering import KMeans

    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    n = vectors.count()
    if n < k:
        k = max(1, n // 2)
    best, best_cost = None, None
    for i in range(max(1, n_init)):
        km = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="features",
                    predictionCol="cluster", initMode="k-means||")
        model = km.fit(vectors)
        cost = model.summary.trainingCost
        if best_cost is None or cost < best_cost:
            best, best_cost = model, cost
    vectors.unpersist()
    return best, k


def top_terms(model, vocab: list[str], spark, n: int = 3) -> DataFrame:
    """M4: (cluster, rank, term) — the n heaviest centroid terms per cluster.
    Centroids are k × vocabulary numbers (model state, not data)."""
    rows = [(ci, float(v), int(j)) for ci, center in enumerate(model.clusterCenters())
            for j, v in enumerate(center.tolist())]
    df = spark.createDataFrame(rows, "cluster int, v double, j int")
    vocab_df = spark.createDataFrame(list(enumerate(vocab)), "j int, term string")
    w = Window.partitionBy("cluster").orderBy(F.desc("v"), F.asc("j"))
    return (df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .join(F.broadcast(vocab_df), "j").select("cluster", "rank", "term"))


def label_clusters(terms: DataFrame) -> DataFrame:
    """M5: cluster -> 'Term1, Term2, Term3' in title case."""
    joined = (terms.groupBy("cluster")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))),
                                            lambda s: s["term"]), ", ").alias("t")))
    return joined.select("cluster", title_case(F.col("t")).alias("Category"))


def market_base(gigs: DataFrame, rules: KeywordRules | None = None) -> DataFrame:
    """M6 inputs: numeric price (C11), cleaned title (C12) and service match."""
    r = rules or KeywordRules()
    price = clean_price(F.col("price")) if "price" in gigs.columns else F.lit(0.0)
    return gigs.withColumns({"price_numeric": price, "title_clean": clean_title(F.col("title")),
                             "Service_Match": classify_multi(F.col("title"), r.services)})


def market_services(gigs: DataFrame, rules: KeywordRules | None = None, digits: int | None = None) -> DataFrame:
    """M6 service-gap table (does not depend on the clustering)."""
    from .stats import service_stats
    return service_stats(market_base(gigs, rules), "Service_Match", "price_numeric", digits)


def market_summary(gigs: DataFrame, digits: int | None = None) -> DataFrame:
    """M6 executive summary (does not depend on the clustering)."""
    from .stats import executive_summary
    return executive_summary(market_base(gigs), "price_numeric", digits)


def analyze_market(gigs: DataFrame, rules: KeywordRules | None = None, k: int = 8, seed: int = 42,
                   n_init: int = 10, max_features: int = 1000, digits: int | None = None) -> dict[str, DataFrame]:
    """M6: price and title cleaning -> TF-IDF -> KMeans -> cluster names ->
    service match -> summary, category, service and raw tables."""
    from .stats import category_stats, executive_summary, service_stats

    base = market_base(gigs, rules).withColumn("__doc", F.monotonically_increasing_id())
    base = cut(base)   # pin the ids used to join clusters back
    vecs, vocab = tfidf_vectors(base, "__doc", "title_clean", max_features)
    model, k = cluster(vecs, k, seed, n_init)
    assigned = model.transform(vecs).select(F.col("doc").alias("__doc"), "cluster")
    names = label_clusters(top_terms(model, vocab, gigs.sparkSession, 3))
    tagged = base.join(assigned, "__doc").join(F.broadcast(names), "cluster", "left")
    raw_cols = ["title", "seller_name", "price", "price_numeric", "Category", "Service_Match", "link"]
    return {
        "executive_summary": executive_summary(base, "price_numeric", digits),
        "category_analysis": category_stats(tagged, "Category", "price_numeric", digits),
        "service_gaps": service_stats(tagged, "Service_Match", "price_numeric", digits),
        "raw_data": tagged.select([c for c in raw_cols if c in tagged.columns]),
        "assignments": tagged.select("__doc", "cluster", "Category"),
    }
