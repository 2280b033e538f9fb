"""Decision tree, random forest, gradient-boosted trees and naive Bayes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from math import isqrt
from operator import and_

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.models.metrics import classification_metrics
from millrace.operators.features import assemble
from millrace.workspace import fresh_path, materialize


def _fit(estimator, df: DataFrame, columns: Sequence[str], label: str):
    return estimator.fit(assemble(df.select(*columns, label), columns, invalid="skip"))


def fit_tree(df: DataFrame, columns: Sequence[str], label: str, *, seed: int, **params):
    return _fit(DecisionTreeClassifier(labelCol=label, seed=seed, **params), df, columns, label)


def fit_forest(df: DataFrame, columns: Sequence[str], label: str, *, seed: int, **params):
    return _fit(RandomForestClassifier(labelCol=label, seed=seed, **params), df, columns, label)


def fit_gbt(df: DataFrame, columns: Sequence[str], label: str, *, seed: int, **params):
    """Binary only; MLlib's default number of rounds unless ``maxIter`` says otherwise."""
    return _fit(GBTClassifier(labelCol=label, seed=seed, **params), df, columns, label)


def fit_naive_bayes(df: DataFrame, features: str, label: str, **params):
    """Multinomial naive Bayes on non-negative feature vectors."""
    return NaiveBayes(featuresCol=features, labelCol=label, **params).fit(df.select(features, label))


def importances(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """Share of each feature in a tree model's decisions: rows (feature, importance)."""
    rows = [(c, float(v)) for c, v in zip(columns, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def stored_nodes(model, spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """The nodes of a fitted tree, forest or boosted model as a table, read from its stored form.

    (tree, id, feature, threshold, gain, n, mean): ``n`` the weight of a node's rows in the fit, ``mean`` the share of class 1, or the
    value of a regression tree; ``feature``, ``threshold`` and ``gain`` are null for leaves.
    """
    path = fresh_path(spark, "model")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:  # an ensemble: a tree's number and its node
        nodes = nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        nodes = nodes.withColumn("tree", F.lit(0))
    split, stats = F.col("split"), F.col("impurityStats")
    classes = getattr(model, "numClasses", 0) and not hasattr(model, "getMaxIter")  # a boosted model's trees are regressions
    total = F.aggregate(stats, F.lit(0.0), lambda s, x: s + x)
    inner = F.col("leftChild") >= 0
    names = F.array(*map(F.lit, columns))
    return nodes.select(
        "tree", "id", F.when(inner, F.get(names, split["featureIndex"])).alias("feature"),
        F.when(inner, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"), F.when(inner, F.col("gain")).alias("gain"),
        (total if classes else F.get(stats, F.lit(0))).alias("n"), (F.get(stats, F.lit(1)) / (total if classes else F.get(stats, F.lit(0)))).alias("mean"),
    )


def side_by_side(fits: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """Results of independent fits, started together: their jobs share the executors instead of waiting for each other."""
    session = SparkSession.getActiveSession()

    def run(fit: Callable[[], object]) -> object:
        return fit()

    with ThreadPoolExecutor(len(fits)) as pool:
        started = {name: pool.submit(inheritable_thread_target(session)(run) if session else run, fit) for name, fit in fits.items()}
        return {name: future.result() for name, future in started.items()}


# --- fits on cells ---------------------------------------------------------------------------------

# Parameters that mean the same for counted cells as for their rows; a fit with any other one reads the rows.
CELL_PARAMS = {"maxDepth", "maxIter", "stepSize", "impurity", "minInfoGain", "minWeightFractionPerNode", "maxMemoryInMB", "cacheNodeIds", "checkpointInterval"}


def feature_values(data: DataFrame, label: str) -> tuple[DataFrame, list[str]] | None:
    """The label and the parts of ``features`` as plain columns, with their names; None if a feature is a category."""
    about = data.schema["features"].metadata["ml_attr"]
    if any(kind != "numeric" for kind in about.get("attrs", {})):
        return None
    names = [f"_v{i}" for i in range(about["num_attrs"])]
    parts = data.select(label, vector_to_array("features").alias("_v"))
    return parts.select(label, *[F.col("_v")[i].alias(name) for i, name in enumerate(names)]), names


def rank_among(value: Column, edges: Sequence[float]) -> Column:
    """Place among sorted ``edges``, the first at or below and the last at or above every value; linear between them."""

    def search(low: int, high: int) -> Column:
        if high - low <= 1:
            start, end = float(edges[low]), float(edges[high])
            return F.lit(float(low)) + (value - F.lit(start)) / F.lit(end - start if end > start else 1.0)
        middle = (low + high) // 2
        return F.when(value <= F.lit(float(edges[middle])), search(low, middle)).otherwise(search(middle, high))

    return search(0, len(edges) - 1)


def _placed(points: Sequence[float]):
    """Vectorised UDF: number of the bin between sorted ``points``, from 1; a point belongs to the bin below it, NaN to the last."""
    bounds = np.array(points, dtype=float)

    @F.pandas_udf("double")
    def place(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy(), side="left") + 1.0)

    return place


def candidate_points(values: DataFrame, names: Sequence[str], *, seed: int) -> dict[str, list[float]]:
    """The thresholds among which MLlib's trees choose if fitted to these rows with this seed, where rows lie on both sides.

    MLlib draws candidates from a sample that seed and partitions decide, alike for every kind of tree. A regression tree over one
    column, of a target that rises with it, splits at each of them in turn. The target is the rank among quantiles, so the
    tree is not much deeper than the logarithm of their number on skewed columns either.
    """
    shares = [i / 16 for i in range(1, 16)]
    edges = values.agg(*[F.concat(F.array(F.min(c)), F.percentile_approx(c, shares, 200), F.array(F.max(c))).alias(c) for c in names]).first()
    points = {}
    for c in names:
        known = sorted(set(edges[c] or [0.0]))
        one = assemble(values.select(c, rank_among(F.col(c), known).alias("_rank")), [c])
        fit = DecisionTreeRegressor(labelCol="_rank", maxDepth=30, seed=seed).fit(one)
        nodes = stored_nodes(fit, values.sparkSession, [c])
        points[c] = sorted({r["threshold"] for r in nodes.filter(F.col("feature").isNotNull()).select("threshold").collect()})
    return points


def bin_vector(df: DataFrame, points: Mapping[str, Sequence[float]], output: str) -> DataFrame:
    """Vector of the bins that the columns named by ``points`` lie in."""
    names = [f"{output}{i}" for i in range(len(points))]
    placed = df.select("*", *[_placed(p)(F.col(f"`{c}`")).alias(name) for name, (c, p) in zip(names, points.items())])
    return placed.withColumn(output, array_to_vector(F.array(*names))).drop(*names)


def fit_cells(
    values: DataFrame, label: str, points: Mapping[str, Sequence[float]], estimators: Mapping[str, type], *, seed: int, params: Mapping[str, dict],
) -> dict[str, object]:
    """Fits over ``values``, its rows counted by cell: bins of all features and label. The models read a ``bin_vector`` named ``bins``.

    A tree sees no more of a row than its bins, and rows of one cell have the same residual in every round of boosting, so a cell
    weighs as much as its rows and the fit is theirs (but for the rounding of sums of residuals). There are at most as many cells as rows, and
    at most as many as bins of the features multiplied, whatever the rows.
    """
    binned = values.select(label, *[_placed(p)(c).alias(c) for c, p in points.items()])
    cells = binned.groupBy(label, *points).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    cells = cells.select(label, "weight", array_to_vector(F.array(*points)).alias("bins")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = cells.count()
        tasks = min(count // 10_000 + 1, values.sparkSession.sparkContext.defaultParallelism)
        spread = cells if cells.rdd.getNumPartitions() >= tasks else cells.repartition(tasks)
        every = min(max(32, isqrt(count) + 1), 46_340)  # MLlib looks for thresholds in maxBins ** 2 rows: here in all cells
        return {
            name: kind(featuresCol="bins", labelCol=label, weightCol="weight", maxBins=every, seed=seed, **params.get(name, {})).fit(spread)
            for name, kind in estimators.items()
        }
    finally:
        cells.unpersist()


# --- comparison ------------------------------------------------------------------------------------

def stored_predictions(
    test: DataFrame, models: Mapping[str, object], columns: Sequence[str], label: str, points: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """(label, prediction of each model) of all rows of ``test``, stored: assembled once, scored by all models in one scan.

    A row with a missing feature has no prediction. ``points`` are those of models fitted on cells.
    """
    data = assemble(test.select(*columns, F.col(label).alias("label")), columns, invalid="keep")
    if points:
        parts = data.withColumn("_v", vector_to_array("features"))
        data = bin_vector(parts.select("*", *[F.col("_v")[i].alias(name) for i, name in enumerate(points)]), points, "bins")
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns])
    for name, model in models.items():
        named = model.copy({model.predictionCol: name, model.rawPredictionCol: "", model.probabilityCol: ""})
        data = named.transform(data)
    return materialize(data.select("label", *[F.when(complete, F.col(name)).alias(name) for name in models]), "predictions")


def compare_predictions(predictions: DataFrame, models: Sequence[str], label: str = "label") -> DataFrame:
    """(model, rows, unscored, accuracy, precision, recall, f1) from a table with a column of predictions for each model.

    One aggregate by model, label and prediction over the table; a row without a prediction is a miss.
    """
    long = predictions.select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).cast("double").alias("prediction")) for m in models
    ])).alias("_m")).select("label", "_m.*")
    counts = long.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction").isNull()).alias("unscored"))
    return counts.join(classification_metrics(long, "label", "prediction", ["model"]), "model")


def compare_models(
    train: DataFrame, test: DataFrame, columns: Sequence[str], label: str, *, seed: int,
    params: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Tree, forest and GBT on one split: rows (model, accuracy, precision, recall, f1).

    The training part is assembled and kept once. The forest draws rows, so it is fitted on them; beside it tree and GBT are fitted on
    the rows counted by cell, among the same thresholds (on the rows if features are categories, or ``params`` need them). The predictions are
    stored and the metrics counted from them. Every row of ``test`` counts; one with a missing feature has no
    prediction and is a miss.
    """
    params = params or {}
    kinds = {"tree": DecisionTreeClassifier, "forest": RandomForestClassifier, "gbt": GBTClassifier}
    data = assemble(train.select(*columns, label), columns, invalid="skip").select("features", label)
    plain = feature_values(data, label)
    counted = {name: kinds[name] for name in ("tree", "gbt") if plain and CELL_PARAMS.issuperset(params.get(name, {}))}
    if counted:
        values, names = plain
        values.persist(StorageLevel.MEMORY_AND_DISK)
        data = assemble(values, names).select("features", label)
    else:
        data.persist(StorageLevel.MEMORY_AND_DISK)
    points: dict[str, list[float]] = {}

    def on_cells() -> dict[str, object]:
        points.update(candidate_points(values, names, seed=seed))
        return fit_cells(values, label, points, counted, seed=seed, params=params)

    fits = {
        name: lambda kind=kind, own=params.get(name, {}): kind(labelCol=label, seed=seed, **own).fit(data)
        for name, kind in kinds.items() if name not in counted
    }
    try:
        found = side_by_side(fits | ({"cells": on_cells} if counted else {}))
    finally:
        (values if counted else data).unpersist()
    fitted = found | found.pop("cells", {})
    predictions = stored_predictions(test, {name: fitted[name] for name in kinds}, columns, label, points)
    return compare_predictions(predictions, list(kinds)).drop("rows", "unscored")
