import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import aggregates, quality, relational

SALES = [
    ("GOOG", "Sam", 200.0), ("GOOG", "Charlie", 120.0), ("GOOG", "Frank", 340.0),
    ("MSFT", "Tina", 600.0), ("MSFT", "Amy", 124.0), ("MSFT", "Vanessa", 243.0),
    ("FB", "Carl", 870.0), ("FB", "Sarah", 350.0),
    ("APPL", "John", 250.0), ("APPL", "Linda", 130.0), ("APPL", "Mike", 750.0), ("APPL", "Chris", 350.0),
]


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, "company string, person string, sales double")


@pytest.fixture(scope="module")
def gaps(spark):
    data = [("emp1", "John", None), ("emp2", None, None), ("emp3", None, 345.0), ("emp4", "Cindy", 456.0)]
    return spark.createDataFrame(data, "id string, name string, sales double")


def test_group_aggregates(sales):
    assert rows(aggregates.group_all(sales, ["company"], "max")) == [
        ("APPL", 750.0), ("FB", 870.0), ("GOOG", 340.0), ("MSFT", 600.0)
    ]
    assert rows(aggregates.group_count(sales, "company")) == [("APPL", 4), ("FB", 2), ("GOOG", 3), ("MSFT", 3)]
    total = aggregates.aggregate(sales, {"sales": ["sum", "distinct", "avg"]}).first()
    assert total["sum_sales"] == 4327.0 and total["distinct_sales"] == 11
    assert round(total["avg_sales"], 2) == 360.58


def test_names_ignore_case(sales):
    assert sales.groupBy("Company").count().count() == 4


def test_null_group_counts(spark):
    df = spark.createDataFrame([(None,), (30,), (30,)], "age int")
    assert rows(aggregates.group_count(df, "age")) == [(30, 2), (None, 1)]
    assert rows(aggregates.group_count_nonnull(df, "age")) == [(30, 2), (None, 0)]


def test_drop_nulls(gaps):
    assert [r["id"] for r in quality.drop_nulls(gaps).collect()] == ["emp4"]
    assert quality.drop_nulls(gaps, "all").count() == 4
    assert rows(quality.drop_nulls(gaps, at_least=2).select("id")) == [("emp1",), ("emp3",), ("emp4",)]
    assert rows(quality.drop_nulls(gaps, subset=["sales"]).select("id")) == [("emp3",), ("emp4",)]


def test_fill_goes_by_type(gaps):
    assert [r["name"] for r in quality.fill(gaps, "FILL").orderBy("id").collect()] == ["John", "FILL", "FILL", "Cindy"]
    filled = quality.fill(gaps, 0).orderBy("id").collect()
    assert [r["sales"] for r in filled] == [0.0, 0.0, 345.0, 456.0] and filled[1]["name"] is None
    both = quality.fill(gaps, {"name": "x", "sales": 50.0}).orderBy("id").collect()
    assert (both[1]["name"], both[1]["sales"]) == ("x", 50.0)


def test_fill_mean(gaps, spark):
    assert [r["sales"] for r in quality.fill_mean(gaps, "sales").orderBy("id").collect()] == [400.5, 400.5, 345.0, 456.0]
    whole = spark.createDataFrame([(1,), (2,), (2,), (None,)], "n int")
    assert max(r["n"] for r in quality.fill_mean(whole, "n").filter("n <> 1 AND n <> 2").collect()) == pytest.approx(5 / 3)


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "b"), (1, "b"), (2, None)], "k int, v string")
    assert quality.duplicate_count(df).first()[0] == 3
    assert rows(quality.null_counts(df)) == [("k", 2), ("v", 1)]
    report = {(r["check"], r["column"]): r["value"] for r in quality.quality_report({"t": df}).collect()}
    assert report == {("rows", ""): 6, ("duplicates", ""): 3, ("nulls", "k"): 2, ("nulls", "v"): 1}
    empty = {r["check"]: r["value"] for r in quality.quality_report({"t": df.limit(0)}).collect()}
    assert empty["rows"] == 0 and empty["duplicates"] == 0


def test_report_on_names_with_dots(spark):
    df = spark.createDataFrame([("x", None)], "`a.b` string, `c d` int")
    assert rows(quality.null_counts(df)) == [("a.b", 0), ("c d", 1)]


def test_map_codes(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (9.0,)], "code double")
    labelled = relational.map_codes(df, "code", {1: "one", 2: "two"}, "label", missing="none")
    assert rows(labelled) == [(1.0, "one"), (2.0, "two"), (9.0, None), (None, "none")]
    table = spark.createDataFrame([(1, "one"), (2, "two")], "c int, name string")
    assert rows(relational.map_codes(df, "code", table, "label", missing="none")) == rows(labelled)


def test_percent_text_and_ratio(spark):
    df = spark.createDataFrame([(5, 0), (1, 3), (20000, 10)], "a long, b long")
    shown = df.select(relational.percent_text(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in shown] == [None, "33.33%", "200,000.00%"]


def test_grid_key(spark):
    df = spark.createDataFrame([(43.66, -79.41), (43.65, -79.4)], "lat double, lon double")
    keys = [r[0] for r in df.select(relational.grid_key(F.col("lat"), F.col("lon"))).collect()]
    assert keys == ["43Z7X79Z4", "43Z7X79Z4"]


def test_enrich_keeps_multiplicity_unless_told(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b")], "k int, f string")
    dimension = spark.createDataFrame([(1, "x"), (1, "y")], "k int, d string")
    assert rows(relational.enrich(fact, dimension, ["k"])) == [(1, "a", "x"), (1, "a", "y")]
    assert rows(relational.enrich(fact, dimension, ["k"], dedupe=True)) == [(1, "a", "x")]


def test_matched_only_does_not_multiply(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(relational.matched_only(left, right, ["k"])) == [(1, "a"), (1, "b")]


def test_argmax_and_top_n(sales):
    table = sales.withColumn("id", F.monotonically_increasing_id())
    assert relational.argmax_row(table, "sales", "id").first()["person"] == "Carl"
    top = relational.top_n_per_group(sales, ["company"], 1, F.col("sales").desc())
    assert rows(top.select("company", "person")) == [
        ("APPL", "Mike"), ("FB", "Carl"), ("GOOG", "Frank"), ("MSFT", "Tina")
    ]


def test_profiles(sales):
    row = aggregates.profile(sales, ["sales"]).first()
    assert row["count"] == 12.0 and row["min"] == 120.0 and row["max"] == 870.0
    shown = {r["summary"]: r["sales"] for r in aggregates.profile_formatted(sales, ["sales"]).collect()}
    assert shown["mean"] == "360.58" and shown["count"] == "12.00"
    whole = {r["summary"]: r["sales"] for r in aggregates.profile_formatted(sales, ["sales"], ["sales"]).collect()}
    assert whole["mean"] == "360"
    quartiles = aggregates.profile_quartiles(sales, ["sales"]).first()
    assert (quartiles["q25"], quartiles["q50"], quartiles["q75"]) == (182.5, 295.0, 412.5)


def test_corr_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0, -1.0), (2.0, 4.0, -2.0), (3.0, 6.0, -3.0)], "a double, b double, c double")
    matrix = {(r["x"], r["y"]): round(r["corr"], 9) for r in aggregates.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(matrix) == 9 and matrix["a", "b"] == 1.0 and matrix["c", "a"] == -1.0
