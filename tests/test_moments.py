import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from opinio.operators import model as mdl
from opinio.operators.sampling import train_test_split

SCHEMA = "review_id string, " + ", ".join(f"{f} double" for f in mdl.FEATURES) + ", flagged string"


def frame(spark, n=240, seed=1, noise=1.6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.random() < 0.4
        rows.append((f"r{i}", *[rnd.gauss(k * (0.5 if y else 0.2), noise * (1 + k)) for k in range(len(mdl.FEATURES))],
                     "Y" if y else "N"))
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def labelled(df):
    return df.withColumn("label", F.when(F.col("flagged") == "Y", 1.0).otherwise(0.0))


def test_merged_moments_are_those_of_the_union(spark):
    df = labelled(frame(spark)).cache()
    parts = [df.where(F.crc32("review_id") % 3 == k) for k in range(3)] + [df.limit(0), df.where("label = 1").limit(1)]
    parts[0] = parts[0].exceptAll(parts[4])
    parts[1], parts[2] = parts[1].exceptAll(parts[4]), parts[2].exceptAll(parts[4])
    merged = mdl.class_moments(parts[0])
    for p in parts[1:]:
        merged = merged.merged(mdl.class_moments(p))
    whole = mdl.class_moments(df)
    assert merged.n == whole.n
    for a, b in ((merged.mean, whole.mean), (merged.dev, whole.dev)):
        for x, y in zip(a, b):
            assert x == pytest.approx(y, rel=1e-9)


def test_scores_match_the_library(spark):
    train, pool = frame(spark), frame(spark, 100, seed=2)
    mine = mdl.nb_scores(pool, mdl.class_moments(labelled(train)))
    model = mdl.gaussian_nb().fit(mdl.assemble(train))
    theirs = model.transform(mdl.assemble(pool)).select("review_id", "prediction", F.array_max(
        vector_to_array("probability")).alias("p"))
    want = {r.review_id: (r.prediction, r.p) for r in theirs.collect()}
    for r in mine.collect():
        assert r.prediction == want[r.review_id][0] and r.probability == pytest.approx(want[r.review_id][1], abs=1e-9)


@pytest.mark.parametrize("threshold", [0.7, 0.9])
def test_rounds_promote_what_full_refits_promote(spark, threshold):
    df = frame(spark, 300, seed=3)
    res = mdl.self_training_nb(df, threshold=threshold, iterations=6)
    # Brute force: the library's model fitted anew on all rows in each round.
    train, test = train_test_split(mdl.assemble(df), "review_id", 0.25, 42)
    train = train.select("review_id", "features", "label").cache()
    pool = test.select("review_id", "features").cache()
    promoted, model = [], None
    while len(promoted) < 6:
        model = mdl.gaussian_nb().fit(train)
        scored = mdl._predicted(model.transform(pool)).select(
            "review_id", "features", F.col("prediction").alias("label"), "p_max").cache()
        sure = scored.where(F.col("p_max") > threshold).drop("p_max")
        promoted.append(sure.count())
        if not promoted[-1]:
            break
        train = train.unionByName(sure).cache()
        pool = scored.where(F.col("p_max") <= threshold).select("review_id", "features").cache()
        if pool.isEmpty():
            break
    assert res.promoted == promoted and len(promoted) > 1
    want = {r.review_id: (r.pred_label, r.p_max) for r in mdl._predicted(model.transform(test)).collect()}
    got = res.scores.collect()
    assert len(got) == len(want) == 75
    for r in got:
        assert r.prediction == want[r.review_id][0] and r.probability == pytest.approx(want[r.review_id][1], abs=1e-9)


def test_a_missing_class_and_no_rows(spark):
    df = frame(spark, 20).withColumn("flagged", F.lit("N"))
    res = mdl.self_training_nb(df, threshold=0.8)
    assert {(r.prediction, r.probability) for r in res.scores.collect()} == {("N", 1.0)}
    assert mdl.self_training_nb(df.limit(0)).scores.count() == 0


def test_constant_features(spark):
    df = frame(spark, 60).withColumn("rating", F.lit(3.0)).withColumn("cos_sim", F.lit(0.0))
    got = mdl.nb_scores(df, mdl.class_moments(labelled(df))).collect()
    assert all(0.5 <= r.probability <= 1 and not math.isnan(r.probability) for r in got)
