"""Whole-table order without a one-task window, against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from millrace.models.metrics import auc
from millrace.operators.features import dense_ids, index_category
from millrace.operators import ordering
from millrace.operators.ordering import exact_quantiles, global_row_number, running_total


def test_running_total_and_row_number(spark):
    rng = random.Random(1)
    data = [(i, rng.randint(-5, 50)) for i in rng.sample(range(10_000), 3000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    expected, total = {}, 0
    for position, (k, v) in enumerate(sorted(data), start=1):
        total += v
        expected[k] = (total, position)
    summed = running_total(df, [F.col("k")], F.col("v"), "total")
    assert {r["k"]: r["total"] for r in summed.collect()} == {k: t for k, (t, _) in expected.items()}
    numbered = global_row_number(df, [F.col("k")], "n")
    assert {r["k"]: r["n"] for r in numbered.collect()} == {k: n for k, (_, n) in expected.items()}
    down = global_row_number(df, [F.col("k").desc()], "n")
    assert down.filter("n = 1").first()["k"] == max(k for k, _ in data)


def test_exact_quantiles_with_a_hot_value(spark):
    rng = np.random.default_rng(2)
    a = np.where(rng.random(5000) < 0.4, 7.0, rng.normal(size=5000))  # two fifths are one value
    b = rng.integers(0, 9, 5000).astype(float)
    df = spark.createDataFrame(
        [(float(x), None if i % 10 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))], "a double, b double"
    ).repartition(5)
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], (0.0, 0.1, 0.25, 0.5, 0.99, 1.0)).collect()}
    kept = b[[i for i in range(5000) if i % 10 != 0]]
    for name, values in (("a", a), ("b", kept)):
        for p in (0.0, 0.1, 0.25, 0.5, 0.99, 1.0):
            assert abs(got[name, p] - np.quantile(values, p)) < 1e-12


def test_ranges_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_ROWS", 500)
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k"))
    sizes = [r["count"] for r in ordering._ranged(df, [F.col("k")], "test").groupBy("_part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 1000
    numbered = global_row_number(df, [F.col("k")], "n")
    assert numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 10_000, 10_000)


def test_quantiles_of_many_distinct_values_in_brackets(spark, monkeypatch):
    monkeypatch.setattr(ordering, "_FEW", 20)
    monkeypatch.setattr(ordering, "_BINS", 8)
    rng = np.random.default_rng(3)
    a = np.concatenate([rng.normal(size=3000), rng.normal(size=50) * 1e200, [1e308, -1e308]])
    df = spark.createDataFrame([(float(x), None) for x in a], "a double, empty double").repartition(4)
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "empty"], (0.0, 0.01, 0.5, 0.77, 1.0)).collect()}
    for p in (0.0, 0.01, 0.5, 0.77, 1.0):
        assert got["a", p] == pytest.approx(np.quantile(a, p), rel=1e-12)
        assert got["empty", p] is None


def test_index_category(spark):
    data = [("a",), ("b",), ("c",), ("a",), ("a",), ("c",), (None,)]
    df = spark.createDataFrame(data, "category string")
    got = {r[0]: r[1] for r in index_category(df, "category", "i").collect()}
    assert got == {"a": 0.0, "c": 1.0, "b": 2.0, None: None}
    model = StringIndexer(inputCol="category", outputCol="i", handleInvalid="skip").fit(df)
    assert {r[0]: r[1] for r in model.transform(df.na.drop()).select("category", "i").collect()} == {k: v for k, v in got.items() if k}


def test_dense_ids(spark):
    df = spark.createDataFrame([(10**12,), (5,), (5,), (-3,)], "k long")
    assert {r["k"]: r["id"] for r in dense_ids(df, "k", "id").collect()} == {-3: 0, 5: 1, 10**12: 2}


def test_auc_is_the_rank_statistic(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 1), rng.randint(0, 30) / 10) for _ in range(400)]
    pairs = [(p, n) for y, p in data if y == 1 for z, n in data if z == 0]
    expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    df = spark.createDataFrame(data, "label int, score double")
    assert abs(auc(df, "label", "score").first()["auc"] - expected) < 1e-12


@pytest.mark.parametrize("few,margin", [(10_000, 0.0015), (50, 0.0015), (50, 0.0), (10_000, 0.0), (1, 0.3)])
def test_quantiles_whatever_the_sketch_gives(spark, monkeypatch, few, margin):
    """Brackets too wide to list, or beside the rank, cost scans but no exactness."""
    monkeypatch.setattr(ordering, "_FEW", few)
    monkeypatch.setattr(ordering, "_MARGIN", margin)
    monkeypatch.setattr(ordering, "_BINS", 16)
    monkeypatch.setattr(ordering, "_SKETCH", 8)
    chance = np.random.default_rng(6)
    columns = {
        "plain": chance.standard_normal(5000), "ties": chance.integers(0, 7, 5000).astype(float), "wide": chance.choice([-1e308, 1e308, 0.0, 5e-324], 5000),
        "one": np.full(5000, 3.5), "heavy": np.where(chance.random(5000) < 0.9, 1.0, chance.standard_normal(5000)),
    }
    df = spark.createDataFrame(pd.DataFrame(columns)).withColumn("none", F.lit(None).cast("double")).withColumn("gaps", F.when(F.col("plain") > 0, F.col("plain")).otherwise(float("nan")))
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found, _ = ordering.quantile_values(df, [*columns, "none", "gaps"], probabilities)
    columns["gaps"] = columns["plain"][columns["plain"] > 0]
    for (c, p), value in found.items():
        if c == "none":
            assert value is None
            continue
        x, at = np.sort(columns[c]), p * (len(columns[c]) - 1)
        low, high = x[int(np.floor(at))], x[int(np.ceil(at))]
        assert value == low + (high - low) * (at - np.floor(at))


def test_quantiles_take_two_scans(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(50_000).select((F.col("id") * 7919 % 50_021).cast("double").alias("x"), F.pmod("id", F.lit(13)).cast("double").alias("y"))
    ordering.quantile_values(df.mapInArrow(counted, df.schema), ["x", "y"], (0.25, 0.5, 0.75))
    assert read.value == 2 * 50_000
