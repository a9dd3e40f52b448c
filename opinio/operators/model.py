"""Fake-review model: feature vector, self-training loop, models (M2, M4-M7).

Training data stays distributed; only fitted models and metrics reach the
driver. The loop is a driver loop of at most ``iterations`` Spark jobs;
each round's training set is written to the shared checkpoint folder
(reliable storage), so lineage stays short and a lost executor only costs
recomputation of the current round. It is written by ``materialise``: an eager
``checkpoint()`` works its rows out twice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.operators.forest import Forest
from opinio.operators.sampling import train_test_split
from opinio.operators.similarity import materialise

# The numeric model inputs left after dropping ids, time,
# text, label and restaurant rating.
FEATURES = [
    "rating", "friend_count", "review_count", "useful_count", "cool_count",
    "funny_count", "review_length", "rating_deviation", "maximum_review_per_user", "cos_sim",
]
LABELS = ["N", "Y"]  # index 0 / 1


def assemble(df: DataFrame, label: str = "flagged") -> DataFrame:
    """M2: features vector + numeric label (Y -> 1.0, N -> 0.0).

    Nulls stay nulls: a row that lacks a feature has no vector and is left out
    (:func:`incomplete` gives those rows), never scored as if it were 0.
    """
    va = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="error")
    out = va.transform(df.select("review_id", *FEATURES, label).na.drop("any", subset=FEATURES))
    return out.withColumn("label", F.when(F.col(label) == "Y", 1.0).otherwise(0.0))


def incomplete(df: DataFrame) -> DataFrame:
    """The rows that lack a feature."""
    lacks = F.lit(False)
    for c in FEATURES:
        lacks = lacks | F.col(c).isNull()
    return df.where(lacks)


def random_forest(num_trees: int = 500, max_depth: int = 14, seed: int = 42):
    """M5: entropy forest, sqrt feature subsets, its trees grown side by side.

    Where Spark ML fits a larger training set, rows keep the node that they
    have reached in each tree, so that the trees are not sent anew with each pass.
    """
    return Forest(impurity="entropy", maxDepth=max_depth, numTrees=num_trees,
                  featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)


def gaussian_nb():
    """M6: Gaussian naive Bayes."""
    return NaiveBayes(modelType="gaussian")


def gaussian_nb_stats(df: DataFrame, label: str = "flagged") -> DataFrame:
    """M6 statistics as one aggregation: prior, per-feature mean and variance per class."""
    total = df.where(F.col(label).isNotNull()).agg(F.count(F.lit(1))).scalar()
    aggs = [(F.count(F.lit(1)) / total).alias("prior")]
    for f in FEATURES:
        c = F.col(f).cast("double")
        aggs += [F.avg(c).alias(f"{f}_mean"), F.var_pop(c).alias(f"{f}_var")]
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(*aggs)


@dataclass
class SelfTrainingResult:
    model: object
    scores: DataFrame          # original test rows: review_id, label, prediction, probability
    rounds: int
    promoted: int


def _predicted(df: DataFrame) -> DataFrame:
    return (df.withColumn("p_max", F.array_max(vector_to_array("probability")))
              .withColumn("pred_label", F.when(F.col("prediction") == 1.0, "Y").otherwise("N")))


def self_training(df: DataFrame, estimator, threshold: float = 0.8, iterations: int | None = 40,
                  test_size: float = 0.25, seed: int = 42, label: str = "flagged") -> SelfTrainingResult:
    """M4: fit, move confident pool rows (any class probability > threshold) into
    training with their predicted label, repeat until the pool is empty, a round
    moves no row (the next fit would be the same) or the round cap (``None``: no
    cap); then score all original test rows with the last model.
    """
    data = materialise(assemble(df, label), "rows")
    train, test = train_test_split(data, "review_id", test_size, seed)
    train = materialise(train.select("review_id", "features", "label"), "train")
    pool = materialise(test.select("review_id", "features"), "pool")
    model, rounds, promoted = None, 0, 0
    while iterations is None or rounds < iterations:
        rounds += 1
        model = estimator.fit(train)
        scored = materialise(_predicted(model.transform(pool)).select(
            "review_id", "features", F.col("prediction").alias("label"), "p_max"), "scored")
        confident = scored.where(F.col("p_max") > F.lit(threshold)).drop("p_max")
        n_conf = confident.count()
        promoted += n_conf
        if n_conf:
            train = materialise(train.unionByName(confident), "train")
            pool = scored.where(F.col("p_max") <= F.lit(threshold)).select("review_id", "features")
        if not n_conf or pool.isEmpty():
            break
    scores = _predicted(model.transform(test)).select(
        "review_id",
        F.when(F.col("label") == 1.0, "Y").otherwise("N").alias("label"),
        F.col("pred_label").alias("prediction"),
        F.col("p_max").alias("probability"))
    return SelfTrainingResult(model, scores, rounds, promoted)


# --- Gaussian naive Bayes by mergeable moments ---------------------------------------

#: Share of the largest feature variance that is added to every variance.
VARIANCE_FLOOR = 1e-9


@dataclass
class Moments:
    """Per class: rows, and each feature's mean and summed squared deviation.

    Two sets of rows have the moments of their union without another look at
    the rows (:meth:`merged`).
    """

    n: list[float]                 # by class
    mean: list[list[float]]        # by class and feature
    dev: list[list[float]]

    def merged(self, other: Moments) -> Moments:
        n, mean, dev = [], [], []
        for c in range(len(self.n)):
            a, b = self.n[c], other.n[c]
            both = a + b
            n.append(both)
            shift = [y - x for x, y in zip(self.mean[c], other.mean[c])]
            mean.append([x + d * b / both if both else 0.0 for x, d in zip(self.mean[c], shift)])
            dev.append([p + q + (d * d * a * b / both if both else 0.0)
                        for p, q, d in zip(self.dev[c], other.dev[c], shift)])
        return Moments(n, mean, dev)

    def variances(self) -> list[list[float]]:
        """Population variances by class and feature, lifted by a share of the largest variance of all rows."""
        whole = Moments([self.n[0]], [self.mean[0]], [self.dev[0]])
        for c in range(1, len(self.n)):
            whole = whole.merged(Moments([self.n[c]], [self.mean[c]], [self.dev[c]]))
        lift = VARIANCE_FLOOR * max((d / whole.n[0] for d in whole.dev[0]), default=0.0) if whole.n[0] else 0.0
        return [[d / n + lift if n else 0.0 for d in row] for n, row in zip(self.n, self.dev)]


def class_moments(df: DataFrame, label: str = "label", features: Sequence[str] = FEATURES) -> Moments:
    """Moments of rows without nulls, by label 0 and 1: one aggregate, one row per class."""
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for k, f in enumerate(features):
        aggs += [F.avg(f).alias(f"m{k}"), F.var_pop(f).alias(f"v{k}")]
    found = {int(r[0]): r for r in df.groupBy(F.col(label).cast("int")).agg(*aggs).collect()}
    out = Moments([], [], [])
    for c in range(len(LABELS)):
        r = found.get(c)
        out.n.append(r.n if r else 0.0)
        out.mean.append([r[f"m{k}"] if r else 0.0 for k in range(len(features))])
        out.dev.append([r[f"v{k}"] * r.n if r else 0.0 for k in range(len(features))])
    return out


def nb_scores(df: DataFrame, moments: Moments, features: Sequence[str] = FEATURES) -> DataFrame:
    """``df`` with ``prediction`` (the first class of the highest probability)
    and ``probability`` (that one), as expressions. A class without rows is never predicted."""
    total, joints = sum(moments.n), []
    for n, mean, var in zip(moments.n, moments.mean, moments.variances()):
        joint = F.lit(math.log(n / total) if n else -math.inf)
        for f, m, v in zip(features, mean, var):
            if n and v:
                d = F.col(f).cast("double") - F.lit(m)
                joint = joint - d * d / F.lit(2 * v) - F.lit(0.5 * math.log(2 * math.pi * v))
        joints.append(joint)
    rows = df.withColumn("_joint", F.array(*joints)).withColumn("_top", F.array_max("_joint"))
    odds = F.aggregate(F.transform("_joint", lambda x: F.exp(x - F.col("_top"))), F.lit(0.0), lambda acc, x: acc + x)
    return (rows.withColumn("prediction", F.array_position("_joint", F.col("_top")).cast("double") - 1.0)
            .withColumn("probability", 1.0 / odds).drop("_joint", "_top"))


@dataclass
class MomentTrainingResult:
    moments: Moments
    scores: DataFrame          # original test rows: review_id, label, prediction, probability
    rounds: int
    promoted: list[int]        # rows by round


def self_training_nb(df: DataFrame, threshold: float = 0.8, iterations: int = 40, test_size: float = 0.25,
                     seed: int = 42, label: str = "flagged", features: Sequence[str] = FEATURES) -> MomentTrainingResult:
    """M4 with M6 and no refits: the loop of :func:`self_training` for Gaussian
    naive Bayes.

    The training rows are aggregated once. A round scores the pool by
    expressions, writes what it finds, and adds the moments of the promoted
    rows to the model's, so its work is that of the pool, not of the training
    set, and only moments reach the driver.
    """
    data = (df.select("review_id", *features, label).na.drop("any", subset=list(features))
            .withColumn("label", F.when(F.col(label) == "Y", 1.0).otherwise(0.0)).drop(label))
    train, test = train_test_split(materialise(data, "nb_rows"), "review_id", test_size, seed)
    moments = class_moments(train, features=features)
    test = materialise(test, "nb_test")
    pool, promoted = test.drop("label"), []
    used = moments
    while len(promoted) < iterations:
        used = moments
        scored = materialise(nb_scores(pool, moments, features), "nb_pool")
        sure = F.col("probability") > F.lit(threshold)
        new = class_moments(scored.where(sure), "prediction", features)
        promoted.append(int(sum(new.n)))
        if promoted[-1]:
            moments = moments.merged(new)
        # Rows without a probability (no training rows at all) stay in the pool.
        pool = scored.where(~F.coalesce(sure, F.lit(False))).drop("prediction", "probability")
        if not promoted[-1] or pool.isEmpty():
            break
    name = lambda c: F.when(F.col(c) == 1.0, LABELS[1]).otherwise(LABELS[0]).alias(c)
    scores = nb_scores(test, used, features).select("review_id", name("label"), name("prediction"), "probability")
    return MomentTrainingResult(used, scores, len(promoted), promoted)
