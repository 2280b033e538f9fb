"""Plans and hot keys: what must hold for the jobs to run on large, skewed data."""

from pathlib import Path

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.functions.text import tf_idf
from millrace.operators import relational, windows
from millrace.registry import all_queries

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan as adaptive execution ran it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name,pushed",
    [
        ("filter_equal", "EqualTo(l_suppkey,7)"),
        ("filter_compare", "GreaterThanOrEqual(o_totalprice,400000.0)"),
        ("filter_like_prefix", "StringStartsWith(p_type,ECON)"),
        ("year_max", "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)"),
        ("yoy_days_within", "LessThan(l_shipdate,1999-01-01T00:00)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize(
    "name,schema",
    [
        ("yoy_lag", "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>"),
        ("mean_text_length", "ReadSchema: struct<text:string,lang:string>"),
        ("top_n_per_group", "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, schema):
    assert schema in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["top_n_per_group", "als_top3", "stream_top_tags"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["sort_desc", "top_k_tokens", "first_n"])
def test_top_k_needs_no_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SMALL))


def test_argmax_needs_no_sort(spark):
    assert "Sort [" not in plan(QUERIES["argmax_row"](spark, SMALL))


def test_faithful_order_reads_the_fact_once(spark):
    assert "ReusedExchange" in final_plan(QUERIES["yoy_lag_faithful"](spark, SMALL))


def test_one_task_window_only_over_calendar_cuts(spark):
    """The single unpartitioned window of the faithful order sees one row per month||day and year."""
    text = plan(QUERIES["yoy_lag_faithful"](spark, SMALL))
    single = text.count("Exchange SinglePartition")
    assert single == 1 and "max_by(mean" in text.split("Exchange SinglePartition")[1]


def test_scalars_stay_in_the_plan(spark):
    """Both means come from one merged subquery, used twice."""
    text = final_plan(QUERIES["fill_mean"](spark, SMALL))
    assert "ReusedSubquery" in text and text.split("== Initial Plan ==")[0].count("partial_avg") == 2


@pytest.fixture
def shuffled_joins(spark):
    """Joins as at scale: nothing broadcast, and partitions of some kilobytes count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_join_key_is_split(spark, shuffled_joins):
    """A third of the fact on one key: its partition is split over several tasks."""
    dimension = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    joined = relational.enrich(hot(spark), dimension, ["k"])
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_hot_term_is_split(spark, shuffled_joins):
    """A term in every text is a skewed key of the tf-idf join."""
    texts = spark.range(20_000, numPartitions=8).select(
        "id", F.concat(F.lit("the t"), (F.col("id") % 3000).cast("string")).alias("text")
    )
    scored = tf_idf(texts, "id", F.split("text", " "))
    text = final_plan(scored)
    assert "skew=true" in text
    assert scored.count() == 40_000


def hot(spark, n=60_000):
    """A third of all rows on key 7."""
    return spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )


def test_hot_key_against_distinct_keys_is_split(spark, shuffled_joins):
    kept = relational.matched_only(hot(spark), hot(spark).select("k"), ["k"])
    assert "skew=true" in final_plan(kept)
    assert kept.count() == 60_000


def test_hot_key_against_a_deduplicated_dimension_is_split(spark, shuffled_joins):
    dimension = spark.range(1000).select((F.col("id") % 500).alias("k"), (F.col("id") * 2).alias("d"))
    joined = relational.enrich(hot(spark), dimension, ["k"], dedupe=True)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_hot_cluster_is_split(spark, shuffled_joins):
    from millrace.models.clusters import array_features, wssse

    points = hot(spark).withColumn("x", F.array(F.col("k").cast("double"), F.rand(1)))
    table = array_features(points, "x").select("k", "features")
    means = wssse(table, "features", "k")
    assert "skew=true" in final_plan(means)


def test_hot_customer_in_the_registered_join(spark, shuffled_joins):
    joined = QUERIES["join_inner_using"](spark, SMALL)
    assert joined.count() == 1500


def test_faithful_order_against_brute_force_when_one_city_dominates(spark):
    import random
    from datetime import date, timedelta

    rng = random.Random(5)
    data = [("hot", date(2020, 1, 1) + timedelta(i), float(rng.randint(0, 9))) for i in range(730)]
    data += [(f"c{i % 40}", date(2020, 1, 1) + timedelta(rng.randint(0, 729)), float(rng.randint(0, 9))) for i in range(400)]
    df = spark.createDataFrame(data, "city string, day date, value double").repartition(6)
    sums = {}
    for city, day, value in data:
        total, n = sums.get((city, day), (0.0, 0))
        sums[city, day] = (total + value, n + 1)
    ordered = sorted(
        (f"{d.month}{d.day}", d.year, c, d.month, d.day, t / n) for (c, d), (t, n) in sums.items()
    )
    expected, previous = {}, 0.0
    for _, year, city, month, day, mean in ordered:
        expected[city, date(year, month, day)] = previous
        previous = mean
    daily = windows.daily_mean(df, ["city"], F.col("day"), F.col("value"))
    got = windows.yoy_lag_faithful(daily, ["city"])
    assert {(r["city"], r["date"]): r["lag"] for r in got.collect()} == expected


def test_results_do_not_depend_on_partitioning(spark, tmp_path):
    """The same rows in many files give the same answers."""
    for name in ("lineitem", "supplier", "nation", "region", "orders", "customer", "documents", "conversations"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(5).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("yoy_lag", "yoy_lag_faithful", "profile_quartiles", "denormalize_star", "tf_idf", "vocabulary_counts",
                 "stream_word_count", "stream_tag_counts", "preamble_scan", "linear_fit"):
        assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, SMALL)), name


def test_the_library_does_not_lean_on_the_text_operators():
    """Nothing outside the subpackage imports it; the driver contract adds it only where it is present."""
    root = Path(entry.__file__).parent
    for path in root.glob("millrace/**/*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "millrace.llm" not in path.read_text(), path
    assert set(all_queries()) <= set(QUERIES)
    assert not [n for n in all_queries() if n == "pipeline" or n.startswith("op")]
