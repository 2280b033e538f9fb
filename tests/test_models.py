"""Invariants of fitted models, and metrics against worked results."""

import pytest
from conftest import SMALL, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.models import bayes, clusters, linear, metrics, recommend, trees
from millrace.operators import features
from millrace.plans import stocks

QUERIES = entry.queries()


def test_linear_recovers_a_line(spark):
    df = spark.range(200).select((F.col("id") / 10).alias("x"), (F.col("id") * 0.3 + 2).alias("y"))
    model = linear.fit_linear(df, ["x"], "y")
    terms = {r["term"]: r["value"] for r in linear.coefficients(df, model, ["x"]).collect()}
    assert terms["x"] == pytest.approx(3.0) and terms["intercept"] == pytest.approx(2.0)
    scored = linear.residuals(linear.score(df, model, ["x"]), "y")
    assert scored.agg(F.max(F.abs("residual"))).first()[0] < 1e-9
    assert metrics.regression_metrics(scored, "y", "prediction").first()["r2"] == pytest.approx(1.0)


def test_null_rows_are_skipped_or_kept_as_told(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert features.assemble(df, ["x"], invalid="skip").count() == 1
    assert features.assemble(df, ["x"], invalid="keep").count() == 2
    with pytest.raises(Exception):
        features.assemble(df, ["x"]).collect()


def test_assembled_vector(spark):
    df = spark.createDataFrame(
        [(7, 3, 2.5, Vectors.dense([4.0, 0.0]), 0.0)], ["key", "depth", "width", "parts", "target"]
    )
    vector = features.assemble(df, ["width", "parts", "depth"]).first()["features"]
    assert vector.toArray().tolist() == [2.5, 4.0, 0.0, 3.0]


def test_classification_metrics_equal_mllib(spark):
    data = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 6 + [(1.0, 2.0)] + [(2.0, 0.0)] * 3
    df = spark.createDataFrame(data, "label double, prediction double")
    ours = metrics.classification_metrics(df, "label", "prediction").first()
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "weightedPrecision"), ("recall", "weightedRecall")):
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df))


def test_hard_auc_equals_mllib(spark):
    data = [(1, 1.0)] * 7 + [(1, 0.0)] * 3 + [(0, 1.0)] * 4 + [(0, 0.0)] * 6
    df = spark.createDataFrame(data, "label int, prediction double")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="prediction")
    assert metrics.auc_hard(df, "label", "prediction").first()["auc"] == pytest.approx(evaluator.evaluate(df))
    assert metrics.auc(df, "label", "prediction").first()["auc"] == pytest.approx(evaluator.evaluate(df))


def test_splits(spark):
    df = spark.range(1000)
    train, test = features.key_split(df, "id")
    assert train.count() == 700 and test.count() == 300 and train.intersect(test).count() == 0
    a, b = features.random_split(df, [0.7, 0.3], seed=7)
    again = features.random_split(df, [0.7, 0.3], seed=7)[0]
    assert a.count() + b.count() == 1000 and rows(a) == rows(again)


@pytest.mark.parametrize("name", ["logistic_scores", "tree_scores", "forest_scores", "gbt_scores"])
def test_scores_are_probabilities(spark, name):
    scored = QUERIES[name](spark, SMALL)
    low, high, n, labels = scored.agg(F.min("p1"), F.max("p1"), F.count("p1"), F.count_distinct("prediction")).first()
    assert 0 <= low <= high <= 1 and n == scored.count() > 0 and labels <= 2


def test_trees_find_the_deciding_feature(spark):
    df = spark.range(600).select(
        F.pmod("id", F.lit(7)).cast("double").alias("noise"),
        F.pmod("id", F.lit(10)).cast("double").alias("signal"),
        F.when(F.pmod("id", F.lit(10)) > 4, 1.0).otherwise(0.0).alias("label"),
    )
    for fit in (trees.fit_tree, trees.fit_forest):
        model = fit(df, ["noise", "signal"], "label", seed=1)
        shares = {r["feature"]: r["importance"] for r in trees.importances(df, model, ["noise", "signal"]).collect()}
        assert shares["signal"] > 0.8 and sum(shares.values()) == pytest.approx(1.0)
    train, test = df.filter("noise < 5"), df.filter("noise >= 5")
    compared = trees.compare_models(train, test, ["noise", "signal"], "label", seed=1)
    assert {r["model"]: r["accuracy"] for r in compared.collect()} == {"tree": 1.0, "forest": 1.0, "gbt": 1.0}


def test_kmeans(spark):
    data = [(i, [0.1 * i, 0.1 * i]) for i in range(3)] + [(i, [9.0 + 0.1 * i] * 2) for i in range(3, 6)]
    df = clusters.array_features(spark.createDataFrame(data, "id int, v array<double>"), "v")
    model = clusters.fit_kmeans(df, "features", 2, seed=1)
    assigned = clusters.assign(df, model)
    assert sorted(r["count"] for r in clusters.cluster_sizes(assigned).collect()) == [3, 3]
    cost = clusters.wssse(assigned, "features", "prediction").first()["cost"]
    assert cost == pytest.approx(model.summary.trainingCost)
    sweep = [r["cost"] for r in clusters.kmeans_sweep(df, "features", [2, 3, 4], seed=1).orderBy("k").collect()]
    assert sweep[0] + 1e-9 >= sweep[1] >= sweep[2] - 1e-9
    assert clusters.centers(df, model).count() == 2


def test_every_point_gets_one_cluster(spark, tables):
    assigned = QUERIES["kmeans_assign"](spark, SMALL)
    assert assigned.count() == assigned.select("vec_id").distinct().count() == tables.embeddings.count()


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(15) if (u + i) % 3]
    return spark.createDataFrame(data, "u long, i long, r double")


def test_ratings_are_averaged_and_complete(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (1, None, 5.0)], "u long, i long, r double")
    assert rows(recommend.ratings_table(df, F.col("u"), F.col("i"), F.col("r"))) == [(1, 1, 3.0)]


def test_als(spark, ratings):
    table = recommend.with_int_ids(recommend.ratings_table(ratings, F.col("u"), F.col("i"), F.col("r")))
    model = recommend.fit_als(table, seed=3)
    scored = recommend.predict(model, table)
    assert scored.count() == table.count()
    assert metrics.rmse(scored, "rating", "prediction").first()["rmse"] < 1.0
    top = recommend.recommend(scored, 3)
    assert top.groupBy("user").count().agg(F.max("count"), F.count("user")).first() == (3, 12)
    users = table.filter("user = 4").select("user_id").distinct()
    assert recommend.recommend_unseen(model, users, 3).count() == 3


def test_wide_ids_are_renumbered(spark, ratings):
    wide = ratings.withColumn("i", F.col("i") + 10**13)
    table = recommend.with_int_ids(recommend.ratings_table(wide, F.col("u"), F.col("i"), F.col("r")))
    assert dict(table.dtypes)["item_id"] == "int"
    assert table.agg(F.min("item_id"), F.max("item_id"), F.count_distinct("item_id")).first() == (0, 14, 15)
    assert table.count() == ratings.count()


@pytest.mark.parametrize("kind", ["string", "double"])
def test_ids_of_any_type_stay_apart(spark, kind):
    data = [("1.2", "a", 1.0), ("1.9", "b", 2.0), ("7", "a", 3.0)]
    df = spark.createDataFrame(data, "u string, i string, r double").withColumn("u", F.col("u").cast(kind))
    table = recommend.with_int_ids(recommend.ratings_table(df, F.col("u"), F.col("i"), F.col("r")))
    assert table.select("user_id").distinct().count() == 3 and table.select("item_id").distinct().count() == 2


def test_pairs_unseen_in_the_fit_stay(spark, ratings):
    table = recommend.with_int_ids(recommend.ratings_table(ratings, F.col("u"), F.col("i"), F.col("r")))
    scored = recommend.predict(recommend.fit_als(table.filter("user < 11"), seed=3), table)
    assert scored.count() == table.count()
    unseen = scored.filter("user = 11")
    assert unseen.count() > 0 and unseen.filter("prediction is not null").count() == 0
    assert recommend.recommend(scored, 3).filter("user = 11").count() == 3


def test_rows_with_missing_features_stay_unscored(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    holes = df.unionAll(spark.createDataFrame([(None, 1.0)], "x double, y double"))
    for model in (linear.fit_linear(df, ["x"], "y"), linear.fit_logistic(df, ["x"], "y"), trees.fit_tree(df, ["x"], "y", seed=1)):
        scored = linear.score(holes, model, ["x"])
        assert scored.count() == 101
        assert [r["x"] for r in scored.filter("prediction is null").collect()] == [None]
    assert linear.probabilities(scored).filter("p1 is null").count() == 1
    compared = trees.compare_models(df, holes, ["x"], "y", seed=1)
    assert all(r["accuracy"] < 1 for r in compared.collect())


def test_the_logistic_fit_ends_by_itself(spark, tables):
    from millrace.queries.models import LINE, _status

    model = linear.fit_logistic(_status(tables), LINE, "label")
    assert model.summary.totalIterations < model.getMaxIter() == 100


def test_naive_bayes_equals_mllib(spark):
    texts = [(0, "a b b c", 0), (1, "a a c", 0), (2, "d d b", 1), (3, "d e", 1), (4, "e a", 1)]
    df = spark.createDataFrame(texts, "id int, text string, label int").withColumn("words", F.split("text", " "))
    weights = df.select("id", F.explode("words").alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    ours = bayes.classify(bayes.score_terms(bayes.fit_terms(weights, df, "id"), weights, df, "id"), "id")
    vectors = CountVectorizer(inputCol="words", outputCol="f").fit(df).transform(df)
    theirs = trees.fit_naive_bayes(vectors, "f", "label").transform(vectors)
    expected = {r["id"]: (r["prediction"], max(r["probability"])) for r in theirs.collect()}
    got = {r["id"]: (r["prediction"], r["probability"]) for r in ours.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert all(got[k][1] == pytest.approx(expected[k][1], abs=1e-9) for k in got)


def test_text_stages_need_a_bound():
    from millrace.plans.text_classes import text_stages

    with pytest.raises(ValueError):
        text_stages()
    assert len(text_stages(buckets=16)) == len(text_stages(vocab_size=10)) == 6


def test_stock_answers(spark):
    data = [("2012-01-03", 10.0, 60.0, 9.0, 50.0, 100), ("2012-02-03", 10.0, 90.0, 9.0, 70.0, 300),
            ("2013-01-03", 10.0, 90.0, 9.0, 80.0, 200)]
    prices = spark.createDataFrame(data, "Date string, Open double, High double, Low double, Close double, Volume int")
    prices = prices.withColumn("Date", F.col("Date").cast("date"))
    assert str(stocks.peak_day(prices).first()[0]) == "2012-02-03"
    assert stocks.percent_above(prices, 80).first()[0] == pytest.approx(200 / 3)
    assert stocks.days_below(prices, 60).first()[0] == 1
    assert stocks.volume_range(prices).first() == (300, 100)
    assert rows(stocks.by_year(prices, "Date", F.max("High").alias("m"))) == [(2012, 90.0), (2013, 90.0)]
    assert [tuple(r) for r in stocks.by_month(prices, "Date", F.avg("Close").alias("m")).collect()] == [(1, 65.0), (2, 70.0)]
    assert stocks.high_volume_ratio(prices).count() == 3
    assert stocks.described(prices).count() == 5
    assert stocks.mean_close(prices).first()[0] == pytest.approx(200 / 3)
    assert -1 <= stocks.high_volume_corr(prices).first()[0] <= 1
