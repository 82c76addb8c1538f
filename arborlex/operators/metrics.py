"""Classification results and evaluation metrics.

Pairs table: ``(item_id, pred, gold)`` plus optional group columns.  Every metric
is an aggregate with a map-side partial step, so a hot group costs no more than
its share of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ten topic labels of the classification task, in id order.
TOPIC_LABELS = (
    "Society & Culture", "Science & Mathematics", "Health", "Education & Reference",
    "Computers & Internet", "Sports", "Business & Finance", "Entertainment & Music",
    "Family & Relationships", "Politics & Government",
)
# Accuracy thresholds (one point each, >=) and loss thresholds (two points each, <=).
ACCURACY_THRESHOLDS = (0.30, 0.35, 0.50)
LOSS_THRESHOLDS = (3.0,)
TOLERANCE = 1e-3


def centroid_scores(df: DataFrame, vec_col: str, label_col: str, n_labels: int) -> DataFrame:
    """``df`` with ``scores``: for labels 0 to ``n_labels - 1``, the softmax of minus the squared distance
    to the label's mean vector, over all places of the vector; a label without rows scores 0.

    The means are one row of ``n_labels`` vectors, which is all that is broadcast.
    """
    means = df.select(F.col(label_col).alias("_l"), F.posexplode(vec_col).alias("_i", "_x")).groupBy("_l", "_i").agg(
        F.avg(F.col("_x").cast("double")).alias("_m"))
    rows = means.groupBy("_l").agg(F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias("_v"))
    table = rows.where(F.col("_l").between(0, n_labels - 1)).agg(
        F.map_from_entries(F.collect_list(F.struct("_l", F.col("_v._m").alias("_v")))).alias("_c")).withColumn("_k", F.lit(1))
    labels = F.array(*[F.lit(i) for i in range(n_labels)])
    far = F.transform(labels, lambda i: F.aggregate(
        F.zip_with(F.col(vec_col), F.element_at("_c", i), lambda x, m: (x.cast("double") - m) * (x.cast("double") - m)),
        F.lit(0.0), lambda a, x: a + x))
    out = df.withColumn("_k", F.lit(1)).join(F.broadcast(table), "_k").withColumn("_far", far)
    share = F.transform("_far", lambda x: F.coalesce(F.exp(F.array_min("_far") - x), F.lit(0.0)))
    out = out.withColumn("_e", share)
    total = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return out.select(*df.columns, F.transform("_e", lambda x: x / total).alias("scores"))


def top1_of_array(df: DataFrame, scores: str = "scores") -> DataFrame:
    """E1 inside the row: ``label`` and ``score`` of the best entry of an array of scores; ties go to
    the smallest label.  Nothing is shuffled."""
    best = F.array_max(scores)
    return df.withColumn("label", (F.array_position(scores, best) - 1).cast("int")).withColumn("score", best)


def top1(scores: DataFrame, id_col: str = "item_id") -> DataFrame:
    """Best ``(label, score)`` per item; ties go to the smallest label."""
    best = F.min_by(F.struct("label", "score"), F.struct((-F.col("score")).alias("s"), F.col("label").alias("l")))
    return scores.groupBy(id_col).agg(best.alias("b")).select(id_col, "b.label", "b.score")


def label_names(df: DataFrame, label_col: str = "label", names: tuple[str, ...] = TOPIC_LABELS) -> DataFrame:
    """Decode class ids with a fixed-size (broadcast) dimension table."""
    dim = df.sparkSession.createDataFrame(list(enumerate(names)), "label_id int, label_name string")
    return df.join(F.broadcast(dim), df[label_col] == dim.label_id, "left").drop("label_id")


def prediction_contract(preds: DataFrame, names: tuple[str, ...] = TOPIC_LABELS) -> DataFrame:
    """Counts of predictions with a label outside the allowed set or a score outside [0, 1]."""
    allowed = F.col("label_name").isin(*names)
    bad_score = F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1)
    return preds.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(~F.coalesce(allowed, F.lit(False))).cast("bigint").alias("bad_label"),
        F.count_if(bad_score).cast("bigint").alias("bad_score"),
    )


def accuracy(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """E5: share of pairs with pred = gold."""
    g = pairs.groupBy(*(by or []))
    return g.agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col("pred") == F.col("gold")).cast("bigint").alias("n_correct"),
        F.avg((F.col("pred") == F.col("gold")).cast("double")).alias("accuracy"),
    )


def per_class_f1(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-class F1 over the union of predicted and gold labels (absent class -> 0)."""
    by = by or []
    rows = pairs.select(*by, F.explode(F.array(
        F.struct(F.col("pred").alias("label"), F.lit(1).alias("np"), F.lit(0).alias("ng"),
                 (F.col("pred") == F.col("gold")).cast("int").alias("tp")),
        F.struct(F.col("gold").alias("label"), F.lit(0).alias("np"), F.lit(1).alias("ng"), F.lit(0).alias("tp")),
    )).alias("r")).select(*by, "r.*")
    c = rows.groupBy(*by, "label").agg(F.sum("tp").alias("tp"), F.sum("np").alias("np"), F.sum("ng").alias("ng"))
    return c.withColumn("f1", 2.0 * F.col("tp") / (F.col("np") + F.col("ng")))


def macro_f1(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean per-class F1."""
    return per_class_f1(pairs, by).groupBy(*(by or [])).agg(F.avg("f1").alias("macro_f1"))


def threshold_points(value: Column, thresholds: tuple[float, ...], higher_is_better: bool = True,
                     weight: int = 1) -> Column:
    """``weight`` points per threshold met (>= for scores, <= for losses)."""
    ts = F.array(*[F.lit(float(t)) for t in thresholds])

    def step(acc, t):
        met = (value >= t) if higher_is_better else (value <= t)
        return acc + F.when(met, F.lit(weight)).otherwise(F.lit(0))

    return F.aggregate(ts, F.lit(0), step)


def failure_example(pairs: DataFrame, id_col: str = "item_id", by: list[str] | None = None) -> DataFrame:
    """The last (largest id) mistaken pair."""
    wrong = pairs.where(F.col("pred") != F.col("gold"))
    return wrong.groupBy(*(by or [])).agg(F.max_by(F.struct(id_col, "pred", "gold"), F.col(id_col)).alias("f")).select(
        *(by or []), "f.*")


def within_tolerance(actual: Column, expected: Column, tol: float = TOLERANCE) -> Column:
    """E11."""
    return F.abs(actual - expected) <= F.lit(tol)


def rounded(c: Column, places: int) -> Column:
    """E12."""
    return F.round(c, places)


def seeded_sample(df: DataFrame, key_col: str, k: int, seed: str = "42") -> DataFrame:
    """K rows without replacement, chosen by a seeded hash draw (a top-k: bounded)."""
    from ..functions.columns import uniform
    u = uniform(seed, F.col(key_col))
    return df.withColumn("u", u).orderBy(F.col("u"), F.col(key_col)).limit(k)
