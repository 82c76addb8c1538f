"""Text classification as a batch job (E2): train on labelled documents, score all of them.

Spark ML end to end (tokenise, hashed term counts, IDF, logistic regression);
training aggregates are distributed tree aggregates, scoring is a per-row map.
Output follows the reference's ``{label, score}`` contract: the top class and its
probability.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vocab import one_row, split_words


def fit_text_classifier(docs: DataFrame, labels: DataFrame, label_col: str, text_col: str = "text",
                        id_col: str = "doc_id", num_features: int = 1 << 18, max_iter: int = 20):
    train = docs.join(labels.select(id_col, F.col(label_col).cast("double").alias("label")), id_col)
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="words", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter),
    ])
    return pipe.fit(train)


def score(docs: DataFrame, model, id_col: str = "doc_id") -> DataFrame:
    """``(id, label, score)`` with score = probability of the predicted class."""
    out = model.transform(docs)
    probs = vector_to_array("probability")
    return out.select(id_col, F.col("prediction").cast("int").alias("label"), F.array_max(probs).alias("score"))


def naive_bayes_weights(docs: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """E2, exact form: ``(token, weight, prior)`` of a two-class multinomial model over all words (V1).

    ``weight`` is the add-one smoothed log ratio of the word's share in class 1 and class 0, ``prior``
    the log ratio of the classes' rows.  Words are counted per class with a map-side partial sum.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select("doc_id", F.col(label_col).alias("_y"))
    rows = docs.select("doc_id", "text").join(known, "doc_id")
    counts = rows.select("_y", F.explode(split_words(F.col("text"))).alias("token")).groupBy("token").agg(
        F.sum("_y").alias("c1"), F.sum(1 - F.col("_y")).alias("c0"))
    totals = counts.agg(F.sum("c1").alias("n1"), F.sum("c0").alias("n0"), F.count(F.lit(1)).alias("v"))
    prior = rows.agg(F.log(F.sum("_y") / F.sum(1 - F.col("_y"))).alias("prior"))
    one = one_row(totals, prior).withColumn("_k", F.lit(1))
    share = lambda c, n: F.log((F.col(c) + 1) / (F.col(n) + F.col("v")))
    return counts.withColumn("_k", F.lit(1)).join(F.broadcast(one), "_k").select(
        "token", (share("c1", "n1") - share("c0", "n0")).alias("weight"), "prior")


def naive_bayes_log_odds(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``(doc_id, log_odds)`` of every document; words the model has not seen count nothing.

    Words are counted within the document first, so a frequent word comes once per document.
    """
    words = docs.select("doc_id", F.explode(split_words(F.col("text"))).alias("token")).groupBy("doc_id", "token").agg(
        F.count(F.lit(1)).alias("n"))
    sums = words.join(weights.select("token", "weight"), "token").groupBy("doc_id").agg(
        F.sum(F.col("n") * F.col("weight")).alias("_s"))
    prior = weights.agg(F.max("prior").alias("prior")).withColumn("_k", F.lit(1))
    return docs.select("doc_id").withColumn("_k", F.lit(1)).join(F.broadcast(prior), "_k").join(
        sums, "doc_id", "left").select("doc_id", (F.col("prior") + F.coalesce("_s", F.lit(0.0))).alias("log_odds"))
