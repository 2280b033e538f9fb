"""Word, tag and window counts over streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import explode_terms, term_counts, words
from millrace.streaming.runs import run_to_table, stored_batches


def word_count(stream: DataFrame, text: str) -> DataFrame:
    """Words of each micro-batch on its own: batch_id, word, count. Nothing is carried over."""

    def count(batch: DataFrame) -> DataFrame:
        return term_counts(batch, words(F.col(text)), "word")

    path = run_to_table(
        stream.select(text), "word STRING, count BIGINT", mode="append", per_batch=count, label="word-count"
    )
    return stored_batches(stream.sparkSession, path, "word STRING, count BIGINT")


def batch_heads(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent words of each batch."""
    window = Window.partitionBy("batch_id").orderBy(F.col("count").desc(), "word")
    return counts.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def tags(df: DataFrame, text: str, time: str, prefix: str) -> DataFrame:
    """One row for each word that starts with ``prefix``, case ignored: time, tag."""
    word = F.lower(F.col("_word"))
    return (
        explode_terms(df, words(F.col(text)), time, term="_word")
        .select(time, word.alias("tag"))
        .filter(F.startswith(F.col("tag"), F.lit(prefix.lower())))
    )


def windowed_counts(
    stream: DataFrame, time: str, key: str, *, width: str, slide: str, watermark: str | None = None
) -> DataFrame:
    """Rows by sliding event-time window and key: window_start, key, count.

    Each micro-batch stores only the groups it changed (update mode), with their
    totals so far; the newest total of a group is its result. Without a
    ``watermark`` every late row counts and all windows stay in state; with one,
    windows behind it are closed and dropped from state.
    """
    spark = stream.sparkSession
    at: Column = F.col(time)
    if watermark is not None:  # watermarks need an instant, not a zone-less time
        stream = stream.withColumn(time, at.cast("timestamp")).withWatermark(time, watermark)
    counted = (
        stream.groupBy(F.window(time, width, slide).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), key, "count")
    )
    key_type = stream.schema[key].dataType.simpleString()
    schema = f"window_start TIMESTAMP_NTZ, `{key}` {key_type}, count BIGINT"
    path = run_to_table(counted, schema, mode="update", label="window-counts")
    return (
        stored_batches(spark, path, schema)
        .groupBy("window_start", key)
        .agg(F.max_by("count", "batch_id").alias("count"))
    )


def top_tags(counts: DataFrame, n: int = 10, view: str | None = None) -> DataFrame:
    """The n most frequent tags of each window, optionally under a queryable name."""
    window = Window.partitionBy("window_start").orderBy(F.col("count").desc(), "tag")
    top = counts.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
    if view is not None:
        top.createOrReplaceTempView(view)
    return top
