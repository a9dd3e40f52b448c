from pyspark.sql import functions as F

from opinio.operators import sampling as smp
from opinio.operators import summaries as summ


def test_under_sample_exact(spark):
    df = spark.createDataFrame([(str(i), "Y" if i < 2 else "N") for i in range(7)], "review_id string, flagged string")
    out = smp.under_sample(df)
    counts = dict(out.groupBy("flagged").count().collect())
    assert counts == {"Y": 2, "N": 2}


def test_selection_narrowing_matches_sort(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("review_id"))
    order = [r.review_id for r in df.orderBy(smp.hash_rank("review_id"), "review_id").collect()]
    for k in (0, 1, 777, 3000):
        got = {r.review_id for r in smp.take_lowest(df, "review_id", k, buckets=64).collect()}
        assert got == set(order[:k])


def test_null_and_repeated_ids(spark):
    ids = ["a"] * 5 + [None] * 4 + ["b", "c", "d"]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "review_id string, n int").repartition(3)
    for k in (1, 3, 6, 11):
        assert smp.take_lowest(df, "review_id", k, buckets=8).count() == k
    train, test = smp.train_test_split(df)
    got = [r.n for r in train.collect()] + [r.n for r in test.collect()]
    assert sorted(got) == list(range(12)) and test.count() == 3
    assert smp.train_test_split(df.limit(0))[1].count() == 0
    labelled = df.withColumn("flagged", F.when(F.col("n") < 4, "Y").when(F.col("n") < 11, "N"))
    counts = dict(smp.under_sample(labelled).groupBy("flagged").count().collect())
    assert counts == {"Y": 4, "N": 4}


def test_split_disjoint_complete(spark):
    df = spark.range(101).select(F.col("id").cast("string").alias("review_id"))
    train, test = smp.train_test_split(df)
    a = {r.review_id for r in train.collect()}
    b = {r.review_id for r in test.collect()}
    assert len(b) == 26 and not (a & b) and len(a | b) == 101


def test_metrics_zero_denominators(spark):
    df = spark.createDataFrame([("N", "N"), ("N", "N")], "label string, prediction string")
    m = summ.classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (1.0, 0.0, 0.0, 0.0)
    assert {(r.label, r.prediction, r.n) for r in summ.confusion_matrix(df).collect()} == {("N", "N", 2)}


def test_describe_quartiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4]], "m double")
    r = summ.describe(df, "m").first()
    assert (r["count"], r.mean, r.min, r.p25, r.p50, r.p75, r.max) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_describe_matches_the_built_in(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 1.0, 2.5, rnd.random() * 9])) for _ in range(400)]
    df = spark.createDataFrame(rows, "c string, m double").repartition(5)
    for by in ((), ("c",)):
        got = {(r.c if by else 0): (r.p25, r.p50, r.p75, r["count"]) for r in summ.describe(df, "m", *by).collect()}
        want = df.groupBy(*by).agg(*[F.percentile("m", q) for q in (0.25, 0.5, 0.75)], F.count("m")).collect()
        assert len(got) == len(want)
        for r in want:
            assert all(abs(x - y) < 1e-9 for x, y in zip(got[r.c if by else 0], tuple(r)[-4:]))
    assert "percentile" not in summ.describe(df, "m", "c")._jdf.queryExecution().toString()


def test_rows_without_a_feature_are_left_out(spark):
    from opinio.operators import model as mdl
    cols = ["review_id string", *[f"{c} double" for c in mdl.FEATURES], "flagged string"]
    df = spark.createDataFrame([("a", *[1.0] * 10, "Y"), ("b", None, *[1.0] * 9, "N")], ", ".join(cols))
    assert [r.review_id for r in mdl.assemble(df).collect()] == ["a"]
    assert [r.review_id for r in mdl.incomplete(df).collect()] == ["b"]


def test_self_training_loop_ends(spark):
    from opinio.operators import model as mdl
    rows = []
    for i in range(80):
        y = "Y" if i % 2 else "N"
        base = 5.0 if y == "Y" else 1.0
        rows.append((str(i), base + (i % 3) * 0.1, 1, 1, 1, 1, 1, 10 + i % 5, base / 4, 0.5, 0.1 * (i % 4), y))
    schema = ("review_id string, rating double, friend_count long, review_count long, useful_count long, "
              "cool_count long, funny_count long, review_length long, rating_deviation double, "
              "maximum_review_per_user double, cos_sim double, flagged string")
    df = spark.createDataFrame(rows, schema)
    res = mdl.self_training(df, mdl.gaussian_nb(), threshold=0.7, iterations=3)
    assert 1 <= res.rounds <= 3
    assert res.scores.count() == 20
    m = summ.classification_metrics(res.scores).first()
    assert m.accuracy > 0.9


def test_features_are_worked_out_once(spark, monkeypatch):
    """Neither the reviewers' similarity nor the model's rows are left as a plan that each reader works out anew."""
    from opinio.operators import similarity as sim
    from opinio.plans import queries
    df = spark.createDataFrame([("u", "1", "aa bb"), ("u", "2", "aa cc")],
                               "reviewer_id string, review_id string, review_content string")
    plan = sim.reviewer_similarity(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "entries" not in plan and plan.count("Join") == 1
    made = []
    real = sim.materialise
    monkeypatch.setattr(sim, "materialise", lambda df, name="vectors": made.append(name) or real(df, name))
    monkeypatch.setattr(queries, "_model_frame", lambda *_: spark.createDataFrame(
        [(f"{i}", "YN"[i % 2], *[float(i * k % 7) for k in range(1, 11)]) for i in range(20)],
        ["review_id", "flagged", *queries.mdl.FEATURES]))
    assert queries.QUERIES["gaussian_nb_stats"](spark, "").count() == 2
    assert "model" in made


def test_a_forest_does_not_send_its_trees_with_each_pass(spark):
    from opinio.operators import model as mdl

    assert mdl.random_forest().getCacheNodeIds()


class _SureOf:
    """A model that is sure of the pool's first row (``some``) or of none."""

    def __init__(self, some):
        self.some = some

    def fit(self, train):
        return self

    def transform(self, rows):
        from pyspark.ml.functions import array_to_vector
        first = F.col("review_id") == rows.agg(F.min("review_id")).scalar() if self.some else F.lit(False)
        p = F.when(first, 0.9).otherwise(0.6)
        return rows.withColumn("probability", array_to_vector(F.array(1 - p, p))).withColumn("prediction", F.lit(1.0))


def test_self_training_goes_on_until_no_row_moves(spark, monkeypatch):
    from opinio.plans import queries
    monkeypatch.setattr(queries, "_model_frame", lambda *_: spark.createDataFrame(
        [(f"{i:02d}", "YN"[i % 2], *[float(i * k % 7) for k in range(1, 11)]) for i in range(20)],
        ["review_id", "flagged", *queries.mdl.FEATURES]))
    res = queries._self_train(spark, "", _SureOf(True))
    assert (res.rounds, res.promoted, res.scores.count()) == (5, 5, 5)
    res = queries._self_train(spark, "", _SureOf(False))
    assert (res.rounds, res.promoted, res.scores.count()) == (1, 0, 5)


def _made_rows(spark, n, seed=7):
    from opinio.operators import model as mdl
    import random
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = [float(rnd.randint(0, 4)), *[float(rnd.randint(0, 50)) for _ in range(5)], *[rnd.random() for _ in range(4)]]
        y = x[0] + 3 * x[7] + rnd.random() > 4
        rows.append((str(i), *x, "Y" if y else "N"))
    return mdl.assemble(spark.createDataFrame(rows, ["review_id", *mdl.FEATURES, "flagged"]))


def _shares(model, rows):
    from pyspark.ml.functions import vector_to_array
    return {r[0]: (r[1], r[2]) for r in model.transform(rows).select(
        "review_id", F.get(vector_to_array("probability"), 1), "prediction").collect()}


def test_a_forest_grows_without_passes_over_its_rows(spark):
    """The jobs of a fit do not follow the trees' depth, and its draws not the rows' partitions."""
    from opinio.operators import model as mdl
    rows = _made_rows(spark, 300).cache()
    found = []
    for parts in (1, 5):
        dealt, jobs = mdl.materialise(rows.repartition(parts), "rows"), []
        for depth in (2, 12):
            spark.sparkContext.setJobGroup(f"forest-{parts}-{depth}", "fit")
            model = mdl.random_forest(num_trees=20, max_depth=depth).fit(dealt)
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest-{parts}-{depth}")))
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert 0 < jobs[0] == jobs[1]
        found.append(_shares(model, rows))
    assert found[0] == found[1] and len(found[0]) == 300


def test_a_forest_is_that_of_the_library(spark, monkeypatch):
    from opinio.operators import forest, model as mdl
    rows, new = _made_rows(spark, 400).cache(), _made_rows(spark, 200, seed=8).cache()
    own = _shares(mdl.random_forest(num_trees=150, max_depth=6).fit(rows), new)
    monkeypatch.setattr(forest, "FOREST_ROWS", 399)
    model = mdl.random_forest(num_trees=150, max_depth=6).fit(rows)
    assert model.getNumTrees == 150  # the library's own fit, above the bound
    library = _shares(model, new)
    assert own.keys() == library.keys()
    assert sum(abs(own[k][0] - library[k][0]) for k in own) / 200 < 0.04
    assert sum(own[k][1] == library[k][1] for k in own) > 185


def test_a_tree_splits_where_the_classes_part():
    import numpy as np
    import pyarrow as pa
    from opinio.operators import forest
    assert list(forest.split_points(np.array([3.0, 1.0, 1.0, 2.0]), 32)) == [1.5, 2.5]
    assert len(forest.split_points(np.arange(1000.0), 32)) == 31
    table = pa.table({"x": [[float(i), 1.0] for i in range(40)], "label": [float(i >= 25) for i in range(40)]})
    rows = forest._Rows(table, 32)
    tree = forest.grow(rows, 42, 0, 5, 2)
    assert tree["feature"].tolist() == [0, -1, -1] and 20 < tree["threshold"][0] < 30
    x = np.array([[0.0, 1.0], [39.0, 1.0]])
    assert forest.shares([tree, tree], x).tolist() == [0.0, 1.0]
    bags = {tuple(forest.grow(rows, 42, k, 5, 2)["threshold"]) for k in range(30)}
    assert len(bags) > 1  # every tree has its own sample
