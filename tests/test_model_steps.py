"""Half steps, histogram trees, boosting, Newton fits, sweeps and comparisons against MLlib's fits and plain numpy."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from millrace.models import clusters, factors, logistic, recommend, splits, trees
from millrace.models.metrics import classification_metrics
from millrace.operators.features import assemble
from millrace.queries.models import _RULES, BINNED, _binned, _lines, _status, _stored_ratings


# --- factorisation ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ratings(tables):
    return recommend.with_int_ids(_stored_ratings(tables)).persist()


@pytest.fixture(scope="module")
def fitted(ratings):
    return recommend.fit_als(ratings, seed=3, rank=4)


def _table(factor_rows, key):
    return factor_rows.select(F.col("id").alias(key), F.col("features").cast("array<double>").alias("factors"))


def test_fitted_factors_satisfy_the_half_step(ratings, fitted):
    """MLlib's last half step solved the users from the items; ours gives the same users."""
    items, users = _table(fitted.itemFactors, "item_id"), _table(fitted.userFactors, "user_id")
    ours = factors.half_step(ratings, items, on="item_id", solve="user_id", rank=4, reg=0.01)
    both = ours.join(users.withColumnRenamed("factors", "theirs"), "user_id").collect()
    assert len(both) == users.count() > 0
    for r in both:
        assert np.allclose(r["factors"], r["theirs"], rtol=2e-3, atol=2e-3)


def test_blocks_of_a_fit_hold_a_bounded_number_of_ratings(ratings, monkeypatch):
    """Ten blocks as MLlib's until they would be too large, then more (F1); either way the fit is MLlib's of those blocks."""
    few = ratings.filter("user_id < 8")
    n = few.count()
    for most, blocks in ((-(-n // 10), 10), (-(-n // 12), 13)):
        monkeypatch.setattr(recommend, "BLOCK_RATINGS", most)
        model = recommend.fit_als(few, seed=3, rank=2)
        assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == blocks
        plain = ALS(userCol="user_id", itemCol="item_id", ratingCol="rating", rank=2, maxIter=5, regParam=0.01, seed=3, numUserBlocks=blocks, numItemBlocks=blocks)
        same = plain.fit(few)
        for ours, theirs in ((model.userFactors, same.userFactors), (model.itemFactors, same.itemFactors)):
            ours, theirs = ({r["id"]: r["features"] for r in x.collect()} for x in (ours, theirs))
            assert ours.keys() == theirs.keys() and all(np.allclose(ours[k], theirs[k], rtol=1e-3, atol=1e-3) for k in ours)


@pytest.mark.parametrize("rank", [1, 3])
def test_half_steps_solve_least_squares(spark, rank):
    chance = np.random.default_rng(rank)
    given = {i: chance.standard_normal(rank).tolist() for i in range(9)}
    data = [(u, i, float(chance.standard_normal())) for u in range(5) for i in range(9) if chance.random() < 0.6] + [(0, 99, 1.0)]
    table = spark.createDataFrame(data, "u int, i int, rating double")
    fixed = spark.createDataFrame(list(given.items()), "i int, factors array<double>")
    for reg in (0.3, 0.0):
        found = {r["u"]: r["factors"] for r in factors.half_step(table, fixed, on="i", solve="u", rank=rank, reg=reg).collect()}
        for u, got in found.items():
            own = [(given[i], r) for w, i, r in data if w == u and i in given]
            v, r = np.array([x for x, _ in own]), np.array([y for _, y in own])
            assert np.allclose(got, np.linalg.pinv(v.T @ v + reg * len(own) * np.eye(rank)) @ v.T @ r)


def test_rounds_lower_the_loss_and_forget_nothing(spark, ratings):
    table = ratings.select("user", "item", "rating")
    losses = []
    for n in (1, 2, 4):
        users, items = factors.alternate(table, rank=2, rounds=n, reg=0.05, seed=5)
        losses.append(factors.loss(table, users, items, reg=0.05).first()["loss"])
    assert losses[0] > losses[1] > losses[2]
    assert users.count() == table.select("user").distinct().count() and items.count() == table.select("item").distinct().count()
    again, _ = factors.alternate(table.repartition(7), rank=2, rounds=1, reg=0.05, seed=5)
    first, _ = factors.alternate(table, rank=2, rounds=1, reg=0.05, seed=5)
    a, b = ({r["user"]: r["factors"] for r in x.collect()} for x in (again, first))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_pairs_without_factors_stay(spark):
    users = spark.createDataFrame([(1, [2.0, 1.0])], "user int, factors array<double>")
    items = spark.createDataFrame([(7, [3.0, 4.0])], "item int, factors array<double>")
    pairs = spark.createDataFrame([(1, 7), (1, 8), (2, 7)], "user int, item int")
    assert rows(factors.score_pairs(pairs, users, items)) == [(1, 7, 10.0), (1, 8, None), (2, 7, None)]


def test_lists_of_the_whole_catalogue(spark, monkeypatch):
    """Several blocks a side, scores that tie, keys of text: as ranking every pair."""
    monkeypatch.setattr(factors, "BLOCK_ROWS", 7)
    chance = np.random.default_rng(2)
    u = {f"u{i}": chance.integers(-2, 3, 2).astype(float).tolist() for i in range(30)}
    v = {f"i{i:02d}": chance.integers(-2, 3, 2).astype(float).tolist() for i in range(40)}
    users, items = (spark.createDataFrame(list(x.items()), f"{k} string, factors array<double>") for x, k in ((u, "user"), (v, "item")))
    found = factors.top_items(users, items, 4)
    expected = []
    for name, f in u.items():
        ranked = sorted(((-(f[0] * w[0] + f[1] * w[1]), item) for item, w in v.items()))[:4]
        expected += [(name, item, -s, rank) for rank, (s, item) in enumerate(ranked, 1)]
    assert rows(found.select("user", "item", F.col("prediction") + 0.0, "rank")) == sorted(((a, b, c + 0.0, d) for a, b, c, d in expected), key=repr)
    assert factors.top_items(users, items.limit(3), 4).groupBy("user").count().agg(F.max("count")).first()[0] == 3
    assert factors.top_items(users, items.limit(0), 4).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lists_of_many_cells_broadcast_no_factors(spark, monkeypatch):
    """Blocks meet in cells of one block a side; whatever Spark may broadcast, copies of blocks never are (F1)."""
    monkeypatch.setattr(factors, "BLOCK_ROWS", 8)
    monkeypatch.setattr(factors, "USER_BLOCKS", 1)
    monkeypatch.setattr(factors, "ITEM_BLOCKS", 1)
    monkeypatch.setattr(factors, "SLICE_ITEMS", 3)
    chance = np.random.default_rng(8)
    u, v = chance.integers(-3, 4, (40, 3)).astype(float), chance.integers(-3, 4, (50, 3)).astype(float)
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user int, factors array<double>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item int, factors array<double>")
    found = factors.top_items(users, items, 5)
    scores = u @ v.T
    expected = [(i, j, scores[i, j] + 0.0, rank) for i in range(40) for rank, j in enumerate(np.argsort(-scores[i], kind="stable")[:5].tolist(), 1)]
    assert rows(found.select("user", "item", F.col("prediction") + 0.0, "rank")) == sorted(expected, key=repr)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_best_rows_of_slices_sort_few_scores(monkeypatch):
    """As sorting every score, NaN last, though later slices sort only what beats the list so far (F2)."""
    chance = np.random.default_rng(9)
    u, v = chance.standard_normal((30, 4)), chance.standard_normal((4000, 4))
    u[3], v[::50] = np.nan, np.nan
    v[100:200] = v[300:400]
    monkeypatch.setattr(factors, "SLICE_ITEMS", 100)
    sorted_scores, plain = [], np.lexsort
    monkeypatch.setattr(factors.np, "lexsort", lambda keys: sorted_scores.append(len(keys[0])) or plain(keys))
    at, best = factors._best_rows(u, v, 5)
    scores = u @ v.T
    assert (at == np.argsort(-scores, axis=1, kind="stable")[:, :5]).all()
    assert np.allclose(best, np.take_along_axis(scores, at, 1), equal_nan=True)
    assert 0 < sum(sorted_scores) < scores.size / 10


def _cell(keys, factor_rows, name):
    rows = pa.StructArray.from_arrays([pa.array(keys, pa.int32()), pa.array(factor_rows.tolist(), pa.list_(pa.float64()))], ["key", "factors"])
    half = len(keys) // 2
    return pa.table({name: pa.ListArray.from_arrays(pa.array([0, half, len(keys)], pa.int32()), rows)})


@pytest.mark.parametrize("odd", [0, 1, 2])
def test_cells_score_items_that_may_be_listed(monkeypatch, odd):
    """As ranking every pair, though items too short to be listed are not scored; ties, NaN and numbers out of range too (F1)."""
    monkeypatch.setattr(factors, "SLICE_ITEMS", 64)
    monkeypatch.setattr(factors, "SLICE_USERS", 16)
    chance = np.random.default_rng(12)
    u, v = (chance.integers(-9, 10, (k, 3)) * 2.0 ** chance.integers(0, 9, (k, 1)) for k in (100, 3000))
    v[1000:2000] = v[2000:3000]
    if odd:
        u[:6] = np.array([np.nan, np.inf, 0, -(2.0**600), 2.0**-1000, 2.0**1000])[:, None]
        u[6:30] *= 2.0 ** chance.choice([-600, 600], (24, 1))
        v[:20:10] = np.array([2.0**-1060, 0])[:, None]
    if odd == 2:
        v[20:40:10] = np.array([np.nan, -np.inf])[:, None]
        v[100:140] *= 2.0 ** chance.choice([-600, 600], (40, 1))
    scored, plain = [], factors._best_rows
    monkeypatch.setattr(factors, "_best_rows", lambda u, v, *rest: scored.append(len(u) * len(v)) or plain(u, v, *rest))
    schema = pa.schema([("user", pa.int32()), ("item", pa.int32()), ("prediction", pa.float64())])
    mixed = chance.permutation(len(v))
    with np.errstate(all="ignore"):
        found = factors._best(5, schema)(_cell(range(100), u, "users"), _cell(mixed, v[mixed], "items")).to_pydict()
        scores = u @ v.T
    listed = {}
    for user, item, score in zip(found["user"], found["item"], found["prediction"], strict=True):
        listed.setdefault(user, []).append((item, score))
    for user in range(100):
        expected = np.argsort(-scores[user], kind="stable")[:5]
        assert [x for x, _ in listed[user]] == expected.tolist()
        assert np.array_equal([x for _, x in listed[user]], scores[user][expected], equal_nan=True)
    assert odd == 2 or 0 < sum(scored) < scores.size / 2


def test_lists_of_floats_equal_those_of_doubles(spark):
    chance = np.random.default_rng(13)
    u, v = ([(i, x.tolist()) for i, x in enumerate(chance.standard_normal((k, 3)).astype(np.float32))] for k in (20, 50))
    floats, doubles = (
        rows(factors.top_items(spark.createDataFrame(u, f"user int, factors array<{kind}>"), spark.createDataFrame(v, f"item int, factors array<{kind}>"), 3))
        for kind in ("float", "double")
    )
    assert floats == doubles and len(floats) == 60


def test_lists_equal_those_of_mllib(fitted):
    users, items = _table(fitted.userFactors, "user"), _table(fitted.itemFactors, "item")
    ours = {(r["user"], r["rank"]): r["prediction"] for r in factors.top_items(users, items, 3).collect()}
    theirs = {r["user_id"]: [x["rating"] for x in r["recommendations"]] for r in fitted.recommendForAllUsers(3).collect()}
    assert len(ours) == sum(map(len, theirs.values())) > 0
    assert all(ours[u, i + 1] == pytest.approx(s, rel=1e-4, abs=1e-4) for u, listed in theirs.items() for i, s in enumerate(listed))


# --- trees -----------------------------------------------------------------------------------------

def _splits(nodes):
    return {(r["feature"], round(r["threshold"], 6), round(r["n"]), round(r["gain"], 8)) for r in nodes.collect() if r["feature"]}


@pytest.fixture(scope="module")
def binned(tables):
    return _binned(tables).persist()


def test_grown_trees_equal_the_fit(spark, tables):
    most = F.col("l_quantity") + 10 * F.col("l_linenumber") - 300 * F.col("l_tax") + F.pmod("l_orderkey", F.lit(13)) > 60
    binned = tables.lineitem.select(*BINNED, F.when(most, 1.0).otherwise(0.0).alias("label")).persist()
    points = splits.split_points(binned, BINNED, 64)
    for depth in (1, 3, 5):
        ours = splits.grow(binned, points, F.col("label"), depth=depth).table(binned)
        model = trees.fit_tree(binned, BINNED, "label", seed=1, maxDepth=depth, maxBins=64)
        theirs = _splits(trees.stored_nodes(model, spark, BINNED))
        assert theirs and theirs <= _splits(ours)  # MLlib joins leaves of one class again
        root = ours.filter("id = 1").first()
        stored = trees.stored_nodes(model, spark, BINNED).filter("id = 0").first()
        assert (root["feature"], root["threshold"]) == (stored["feature"], stored["threshold"])
        assert root["gain"] == pytest.approx(stored["gain"]) and root["mean"] == pytest.approx(stored["mean"]) and root["n"] == stored["n"]


def test_importances_equal_the_fitted_vector(spark, tables):
    lines = _lines(tables)
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    for fit, per_tree, params in (
        (trees.fit_tree, True, {}), (trees.fit_forest, True, {"numTrees": 7}), (trees.fit_gbt, False, {"maxIter": 4, "maxDepth": 3}),
    ):
        model = fit(lines, columns, "label", seed=2, **params)
        ours = {r["feature"]: r["importance"] for r in splits.importances(trees.stored_nodes(model, spark, columns), per_tree=per_tree).collect()}
        for r in trees.importances(lines, model, columns).collect():
            assert ours.get(r["feature"], 0.0) == pytest.approx(r["importance"], abs=1e-9)


def test_boosting_equals_the_fit(spark, binned):
    points = splits.split_points(binned, BINNED, 64)
    model = trees.fit_gbt(binned, BINNED, "label", seed=1, maxDepth=1, maxIter=4, maxBins=64, stepSize=0.1)
    ours = splits.boost(binned, points, F.col("label"), rounds=4)
    assert list(model.treeWeights) == pytest.approx(ours.weights)
    stored = trees.stored_nodes(model, spark, BINNED).collect()
    for i, tree in enumerate(ours.trees):
        own = {r["id"]: r for r in stored if r["tree"] == i}
        assert (own[0]["feature"], own[0]["threshold"]) == (tree.nodes[1]["feature"], tree.nodes[1]["threshold"])
        assert [own[1]["mean"], own[2]["mean"]] == pytest.approx([tree.nodes[2]["mean"], tree.nodes[3]["mean"]], rel=1e-9)
    scored = model.transform(assemble(binned, BINNED)).select("*", ours.probability().alias("ours"))
    assert scored.select(F.max(F.abs(F.col("ours") - vector_to_array("probability")[1]))).first()[0] < 1e-9


def test_weights_draw_rows(spark):
    data = [(float(i % 4), float(i % 4 > 1), i % 3) for i in range(40)]
    df = spark.createDataFrame(data, "x double, y double, w int")
    copies = df.filter("w > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), "w"))).drop("_i")
    points = splits.split_points(df, ["x"])
    a = splits.grow(df, points, F.col("y"), depth=2, weight=F.col("w"))
    b = splits.grow(copies, points, F.col("y"), depth=2)
    assert a.nodes == b.nodes and points == {"x": [0.5, 1.5, 2.5]}


def test_trees_of_little_data(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (None, 2.0, 0.0), (3.0, 1.0, 1.0), (4.0, 1.0, None)], "a double, b double, y double")
    points = splits.split_points(df, ["a", "b"])
    assert points == {"a": [2.0, 3.5], "b": [1.5]}
    tree = splits.grow(df, points, F.col("y"), depth=3)
    assert not tree.is_split(1) and tree.nodes[1]["mean"] == 1.0 and tree.nodes[1]["n"] == 2.0  # one class, and complete rows only
    scored = splits.predicted(df, [tree], ["a", "b"], "p")
    assert [r["p"] for r in scored.collect()] == [1.0, None, 1.0, 1.0]
    empty = df.limit(0)
    tree = splits.grow(empty, splits.split_points(empty, ["a"]), F.col("y"), depth=2)
    assert tree.nodes[1]["n"] == 0 and splits.split_gains(splits.histogram(empty, points, F.col("y")), points).count() == 0


def test_many_values_are_cut_by_quantiles(spark):
    df = spark.range(20_000).select((F.col("id") * 7 % 20_011).cast("double").alias("x"), F.lit(5.0).alias("c"))
    points = splits.split_points(df, ["x", "c"], 32)
    assert len(points["x"]) == 31 and points["c"] == []
    assert max(abs(p / 20_011 - (i + 1) / 32) for i, p in enumerate(points["x"])) < 0.01


def test_one_scan_a_level(spark, binned):
    points = splits.split_points(binned, BINNED, 64)
    plan = splits.best_splits(splits.split_gains(splits.histogram(binned, points, F.col("label")), points))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("InMemoryRelation") == 1


# --- logistic regression ---------------------------------------------------------------------------

def test_newton_equals_the_fit(spark, tables):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = _status(tables)
    ours = logistic.fit_newton(df, columns, "label")
    theirs = LogisticRegression(labelCol="label", tol=1e-12, maxIter=500).fit(assemble(df, columns))
    assert ours.converged and ours.steps < 10
    assert ours.intercept == pytest.approx(theirs.intercept, abs=1e-6)
    assert ours.coefficients == pytest.approx(theirs.coefficients.toArray().tolist(), rel=1e-4, abs=1e-8)
    x = np.array([[1.0, *r] for r in df.select(*columns).collect()])
    p = 1 / (1 + np.exp(-x @ [ours.intercept, *ours.coefficients]))
    errors = np.sqrt(np.diag(np.linalg.inv((x * (p * (1 - p))[:, None]).T @ x)))
    found = {r["term"]: r for r in logistic.summary(df, ours).collect()}
    assert [found[t]["std_error"] for t in ("intercept", *columns)] == pytest.approx(errors.tolist(), rel=1e-6)
    assert all(r["z"] == pytest.approx(r["coefficient"] / r["std_error"]) for r in found.values())


def test_newton_on_hard_data(spark):
    parted = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") > 20).cast("double").alias("y"))
    fit = logistic.fit_newton(parted, ["x"], "y", most=12)
    assert not fit.converged and logistic.score(parted, fit).filter("prediction <> y").count() == 0
    same = spark.range(60).select(F.lit(3.0).alias("x"), (F.col("id") % 4 == 0).cast("double").alias("y"))
    assert logistic.score(same, logistic.fit_newton(same, ["x"], "y")).agg(F.avg("p1")).first()[0] == pytest.approx(0.25)
    holes = spark.createDataFrame([(None, 1.0), (1.0, None), (2.0, 0.0), (3.0, 1.0), (2.0, 1.0), (3.0, 0.0)], "x double, y double")
    scored = logistic.score(holes, logistic.fit_newton(holes, ["x"], "y"))
    assert scored.count() == 6 and scored.filter("p1 IS NULL").count() == 1
    with pytest.raises(ValueError):
        logistic.fit_newton(holes.limit(0), ["x"], "y")


# --- clusters --------------------------------------------------------------------------------------

def test_a_sweep_ends_at_means_of_its_clusters(spark):
    chance = np.random.default_rng(1)
    middle = chance.uniform(-50, 50, (5, 3))
    data = [(x.tolist(),) for c in middle for x in c + chance.standard_normal((200, 3))]
    points = spark.createDataFrame(data, "point array<double>").repartition(5)
    found = clusters.sweep(points, "point", range(2, 8), seed=3, rounds=60)
    x = np.array([d[0] for d in data])
    for k, (centres, cost) in found.items():
        apart = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        assert cost == pytest.approx(apart.min(axis=1).sum())
        own = apart.argmin(axis=1)
        assert all(np.abs(centres[i] - x[own == i].mean(axis=0)).max() < 1e-3 for i in range(k) if (own == i).any())
    costs = [found[k][1] for k in range(2, 8)]
    assert costs == sorted(costs, reverse=True)
    vectors = points.select(array_to_vector("point").alias("features"))
    theirs = KMeans(k=5, seed=3).fit(vectors).summary.trainingCost
    assert found[5][1] <= 1.05 * theirs
    again = clusters.sweep(points.repartition(2), "point", range(2, 8), seed=3, rounds=60)
    assert all(again[k][1] == pytest.approx(found[k][1]) for k in found)


def test_a_sweep_of_few_and_equal_points(spark):
    points = spark.createDataFrame([([1.0, 1.0],)] * 500 + [([5.0, 5.0],)] * 3, "point array<double>")
    found = clusters.sweep(points, "point", [1, 2, 4], seed=1)
    assert found[2][1] == 0 and found[4][1] == 0 and len(found[4][0]) == 2 and found[1][1] == pytest.approx(3 * 32 * 500 / 503)
    assert clusters.sweep(points.limit(0), "point", [2], seed=1) == {}


def test_nearest_centres_by_columns(spark, monkeypatch):
    """As all distances at once, in slices of three points: ties go to the first centre, a missing value stays with it (F4)."""
    chance = np.random.default_rng(4)
    x, c = chance.integers(0, 4, (500, 3)).astype(float), chance.integers(0, 4, (6, 3)).astype(float)
    own, apart = clusters._nearest_centre(np.ascontiguousarray(x.T), c)
    every = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (own == every.argmin(axis=1)).all() and (apart == every.min(axis=1)).all()
    own, apart = clusters._nearest_centre(np.array([[np.nan, 1.0]]), np.array([[0.0], [1.0]]))
    assert own.tolist() == [0, 1] and np.isnan(apart[0]) and apart[1] == 0
    monkeypatch.setattr(clusters, "SLICE", 3)
    n, sums, cost = clusters.lloyd_sums(spark.createDataFrame([(r.tolist(),) for r in x], "point array<double>"), "point", {6: c})[6]
    near = every.argmin(axis=1)
    assert n.tolist() == np.bincount(near, minlength=6).tolist() and cost == every.min(axis=1).sum()
    assert np.allclose(sums, [x[near == j].sum(axis=0) for j in range(6)])


def test_a_sweep_takes_one_scan_a_round(spark, monkeypatch):
    calls = []
    plain = clusters.lloyd_sums
    monkeypatch.setattr(clusters, "lloyd_sums", lambda p, c, centres: calls.append(sorted(centres)) or plain(p, c, centres))
    points = spark.createDataFrame([([float(i % 17), float(i % 5)],) for i in range(300)], "point array<double>")
    clusters.sweep(points, "point", range(2, 9), seed=1, rounds=6)
    assert len(calls) <= 7 and calls[0] == list(range(2, 9))


# --- comparison ------------------------------------------------------------------------------------

def test_compared_predictions_are_counted(spark, tables):
    df = _lines(tables).select("label", *[F.when(F.expr(rule), 1.0).otherwise(0.0).alias(m) for m, rule in _RULES.items()])
    df = df.withColumn("tax", F.when(F.col("label") > 0, F.col("tax")))  # some rows without a prediction
    found = {r["model"]: r for r in trees.compare_predictions(df, list(_RULES)).collect()}
    for m in _RULES:
        one = classification_metrics(df, "label", m).first()
        assert found[m]["rows"] == df.count() and found[m]["unscored"] == df.filter(F.col(m).isNull()).count()
        assert all(found[m][c] == pytest.approx(one[c]) for c in ("accuracy", "precision", "recall", "f1"))


def test_models_are_scored_in_one_scan(spark, tables):
    columns = ["l_quantity", "l_extendedprice"]
    lines = _lines(tables)
    fits = trees.side_by_side({
        "tree": lambda: trees.fit_tree(lines, columns, "label", seed=1), "gbt": lambda: trees.fit_gbt(lines, columns, "label", seed=1, maxIter=2),
    })
    stored = trees.stored_predictions(lines, fits, columns, "label")
    assert stored.columns == ["label", "tree", "gbt"] and stored.count() == lines.count()
    for name, model in fits.items():
        alone = model.transform(assemble(lines, columns)).groupBy("label", "prediction").count()
        assert rows(stored.groupBy("label", name).count()) == rows(alone)


def test_compared_models_are_fitted_on_cells_and_equal_fits_on_rows(spark, monkeypatch):
    hashed = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) for i in range(4)]
    df = spark.range(30_000).select(  # more rows than MLlib draws its thresholds from: skewed, of few values, open, constant
        "id", F.exp(hashed[0] / 20).alias("skewed"), (F.pmod(hashed[1], F.lit(7)) - 3).cast("double").alias("few"),
        (hashed[2] + F.col("id") / 1e5).alias("open"), F.lit(2.0).alias("constant"),
        F.when(hashed[0] / 20 + hashed[1] % 7 * 5 + hashed[2] / 50 + hashed[3] / 100 > 60, 1.0).otherwise(0.0).alias("label"),
    )
    columns, params = ["skewed", "few", "open", "constant"], {"gbt": {"maxIter": 4}}
    train, test = df.filter("id % 10 < 7"), df.filter("id % 10 >= 7")
    data = assemble(train, columns).select("features", "label").persist()
    kinds = {"tree": trees.DecisionTreeClassifier, "forest": trees.RandomForestClassifier, "gbt": trees.GBTClassifier}
    fits = {name: kind(labelCol="label", seed=5, **params.get(name, {})).fit(data) for name, kind in kinds.items()}
    expected = trees.compare_predictions(trees.stored_predictions(test, fits, columns, "label"), list(kinds)).drop("rows", "unscored")
    read = {}
    for name, kind in kinds.items():
        monkeypatch.setattr(kind, "fit", lambda self, df, name=name, fit=kind.fit: read.update({name: df.count()}) or fit(self, df))
    found = trees.compare_models(train, test, columns, "label", seed=5, params=params)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}
    assert read["forest"] == 21_000 and read["tree"] == read["gbt"] < 15_000  # cells, at most 32 x 7 x 32 x 2


def test_categories_and_draws_of_rows_are_fitted_on_rows(spark, monkeypatch):
    df = spark.range(400).select((F.col("id") % 4).cast("double").alias("kind"), (F.col("id") % 2).cast("double").alias("label"))
    named = df.withColumn("kind", F.col("kind").alias("kind", metadata={"ml_attr": {"type": "nominal", "vals": list("abcd")}}))
    read = []
    fit = trees.GBTClassifier.fit
    monkeypatch.setattr(trees.GBTClassifier, "fit", lambda self, df: read.append(df.count()) or fit(self, df))
    for data, params in ((named, {"maxIter": 1}), (df, {"maxIter": 1, "subsamplingRate": 0.5}), (df, {"maxIter": 1})):
        found = trees.compare_models(data, data, ["kind"], "label", seed=1, params={"gbt": params})
        assert {r["model"] for r in found.collect()} == {"tree", "forest", "gbt"}
    assert read == [400, 400, 4]
