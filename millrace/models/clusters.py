"""K-means clustering and its cost."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import one_per_key


def array_features(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    """Number array to vector."""
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def fit_kmeans(df: DataFrame, features: str, k: int, *, seed: int, **params) -> KMeansModel:
    # A frame of just the features is passed on as it is: if the caller keeps it
    # in memory, MLlib sees that and does not store it a second time.
    data = df if df.columns == [features] else df.select(features)
    return KMeans(featuresCol=features, k=k, seed=seed, **params).fit(data)


def assign(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Rows with the cluster they belong to, as ``prediction``."""
    return model.transform(df)


def centers(df: DataFrame, model: KMeansModel) -> DataFrame:
    """Cluster centres as rows (cluster, center)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return df.sparkSession.createDataFrame(rows, "cluster int, center array<double>")


def cluster_sizes(assigned: DataFrame, cluster: str = "prediction") -> DataFrame:
    return assigned.groupBy(cluster).count()


SLICE = 4096  # points measured at once
SAMPLE = 4096  # distinct points at most that starting centres are chosen from


def _starts(points: DataFrame, point: str, ks: Sequence[int], seed: int) -> dict[int, np.ndarray]:
    """Starting centres for each k, far apart, from one seeded point of each of ``SAMPLE`` hash classes.

    The classes are aggregated, so copies count once and the sample is the same whatever the partitions.
    """
    h = F.xxhash64(F.lit(seed), point)
    sample = points.groupBy(F.pmod(h, F.lit(SAMPLE)).alias("_class")).agg(F.min_by(point, h).alias("point")).orderBy("_class").collect()
    if not sample:
        return {}
    rows = np.array([r["point"] for r in sample])
    chance = np.random.default_rng(seed)
    chosen = [int(chance.integers(len(rows)))]
    apart = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(max(ks), len(rows)):
        share = apart / apart.sum() if apart.sum() else np.full(len(rows), 1 / len(rows))
        chosen.append(int(chance.choice(len(rows), p=share)))
        apart = np.minimum(apart, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return {k: rows[chosen[:k]] for k in ks}


def _nearest_centre(columns: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point (the first of equals) and the squared distance, by whole columns of a few points' worth of cache."""
    own, least = np.zeros(columns.shape[1], np.intp), None
    for j, centre in enumerate(centres):
        apart = np.zeros(columns.shape[1])
        for column, middle in zip(columns, centre):
            off = column - middle
            off *= off
            apart += off
        if least is None:
            least = apart
        else:
            np.putmask(own, apart < least, j)
            np.minimum(least, apart, out=least)
    return own, least


def lloyd_sums(points: DataFrame, point: str, centres: Mapping[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For each k, of its given centres: rows, sums of the points nearest to each (the first of equals), and the cost. One scan for all k.

    Tasks send a sum for each k, centre and dimension, whatever their rows.
    """
    models = {int(k): np.array(c, float) for k, c in centres.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in models.items()}  # then rows and cost
        for batch in batches:
            column = batch.column(0).drop_null()
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            if not len(x):
                continue
            for low in range(0, len(x), SLICE):
                columns = np.ascontiguousarray(x[low : low + SLICE].T)
                for k, c in models.items():
                    own, apart = _nearest_centre(columns, c)
                    for i, column in enumerate(columns):
                        sums[k][:, i] += np.bincount(own, column, len(c))
                    sums[k][:, -2] += np.bincount(own, minlength=len(c))
                    sums[k][:, -1] += np.bincount(own, apart, len(c))
        for k, found in sums.items():
            centre, at = np.indices(found.shape)
            yield pa.record_batch(
                [pa.array(np.full(found.size, k)), pa.array(centre.ravel()), pa.array(at.ravel()), pa.array(found.ravel())], ["k", "centre", "at", "value"]
            )

    parts = points.select(F.col(point).cast("array<double>")).mapInArrow(run, "k bigint, centre bigint, at bigint, value double")
    out = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in models.items()}
    for r in parts.groupBy("k", "centre", "at").agg(F.sum("value").alias("value")).collect():  # bounded by the centres
        out[r["k"]][r["centre"], r["at"]] = r["value"]
    return {k: (found[:, -2], found[:, :-2], float(found[:, -1].sum())) for k, found in out.items()}


def lloyd_step(found: tuple[np.ndarray, np.ndarray, float], centres: np.ndarray) -> np.ndarray:
    """The means of the points of each centre; one without points stays."""
    n, sums, _ = found
    return np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)


def sweep(points: DataFrame, point: str, ks: Sequence[int], *, seed: int, rounds: int = 20, tolerance: float = 1e-4) -> dict[int, tuple[np.ndarray, float]]:
    """Centres and cost for each k, all fitted side by side: one scan a round serves every k that still moves.

    A k is done when no centre moves by more than ``tolerance``, or after ``rounds``; its cost is that of its last centres.
    """
    centres = _starts(points, point, ks, seed)
    open_, costs = dict(centres), {}
    for i in range(rounds + 1):
        if not open_:
            break
        for k, found in lloyd_sums(points, point, open_).items():
            moved = lloyd_step(found, centres[k])
            costs[k] = found[2]
            if i == rounds or np.sqrt(((moved - centres[k]) ** 2).sum(axis=1)).max() <= tolerance:
                del open_[k]
            else:
                centres[k] = open_[k] = moved
    return {k: (centres[k], costs[k]) for k in centres}


def kmeans_sweep(df: DataFrame, features: str, ks: Sequence[int], *, seed: int) -> DataFrame:
    """Cost of a fit for each k: rows (k, cost). The points are kept for the rounds."""
    points = df.select(vector_to_array(F.col(features)).alias("point")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = [(int(k), cost) for k, (_, cost) in sweep(points, "point", list(ks), seed=seed).items()]
    finally:
        points.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def sweep_step(points: DataFrame, point: str, centres: Mapping[int, np.ndarray]) -> DataFrame:
    """(k, cost, next_cost): the cost of given centres for each k, and of the means of their clusters. Two scans for all k."""
    first = lloyd_sums(points, point, centres)
    moved = {k: lloyd_step(found, np.asarray(centres[k], float)) for k, found in first.items()}
    second = lloyd_sums(points, point, moved)
    return points.sparkSession.createDataFrame([(k, first[k][2], second[k][2]) for k in first], "k int, cost double, next_cost double")


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two number arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def wssse(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Sum of squared distances to the mean of each row's cluster, one row.

    Means come from mergeable partial sums, so a cluster may hold any share of
    the rows; the table of means has one row per cluster.
    """
    means = one_per_key(df, [cluster], vector_to_array(Summarizer.mean(F.col(features))).alias("_center"))
    distance = squared_distance(vector_to_array(F.col(features)), F.col("_center"))
    return df.join(means, cluster).agg(F.sum(distance).alias("cost"))


def means(points: DataFrame, group: str, point: str) -> DataFrame:
    """The mean point of each group: (cluster, centre array)."""
    parts = points.select(F.col(group).alias("cluster"), F.posexplode(point).alias("at", "value"))
    by_place = parts.groupBy("cluster", "at").agg(F.avg("value").alias("value"))
    placed = F.array_sort(F.collect_list(F.struct("at", "value")))
    return by_place.groupBy("cluster").agg(F.transform(placed, lambda p: p["value"]).alias("centre"))


def nearest(points: DataFrame, centres: DataFrame, point: str) -> DataFrame:
    """Rows with ``cluster`` and squared ``distance`` of the nearest of the given centres (the least cluster where two tie).

    The centres are a model's, a few rows, and travel as one scalar of the plan.
    """
    table = centres.agg(F.array_sort(F.collect_list(F.struct("cluster", "centre")))).scalar()

    def apart(centre: Column) -> Column:
        return F.aggregate(F.zip_with(point, centre, lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda s, x: s + x)

    measured = F.transform("_centres", lambda c: F.struct(apart(c["centre"]).alias("distance"), c["cluster"].alias("cluster")))
    return (
        points.withColumn("_centres", table).withColumn("_best", F.array_min(measured))
        .select(*points.columns, "_best.cluster", "_best.distance")
    )
