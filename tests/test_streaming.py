"""Streams of several micro-batches, late rows and restarts, against the batch result."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.scalars import json_field
from millrace.streaming import counts
from millrace.streaming.runs import run_append, run_to_table, stored_batches, stream_files, stream_lines

SCHEMA = "at TIMESTAMP_NTZ, text STRING"
FILES = [
    [("2024-01-01 00:00:01", "#Soccer is #fun"), ("2024-01-01 00:00:12", "no tags")],
    [("2024-01-01 00:00:14", "#soccer  #SOCCER\n#goal"), ("2024-01-01 00:00:33", "#fun")],
    [("2024-01-01 00:00:02", "#late #fun")],
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("messages")
    for i, messages in enumerate(FILES):
        (root / f"{i}.json").write_text("".join(json.dumps({"at": a, "text": t}) + "\n" for a, t in messages))
    return str(root)


def stream(spark, folder, max_files=1):
    schema = spark.createDataFrame([], SCHEMA).schema
    return stream_files(spark, folder, schema, fmt="json", max_files=max_files)


def batch(spark, folder):
    return spark.read.schema(SCHEMA).json(folder)


def test_state_is_kept_outside_the_heap(spark):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_word_count_has_no_memory(spark, folder):
    counted = counts.word_count(stream(spark, folder), "text")
    assert counted.select("batch_id").distinct().count() == 3
    whole = counted.groupBy("word").agg(F.sum("count").alias("count"))
    expected = {}
    for _, text in (m for f in FILES for m in f):
        for word in text.replace("\n", " ").split(" "):
            expected[word] = expected.get(word, 0) + 1
    assert {r["word"]: r["count"] for r in whole.collect()} == expected
    assert counts.batch_heads(counted, 1).count() == 3


def expected_windows(spark, folder):
    tagged = counts.tags(batch(spark, folder), "text", "at", "#")
    grouped = tagged.groupBy(F.window("at", "20 seconds", "10 seconds").alias("w"), "tag").count()
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "tag", "count")


def test_windows_over_many_batches_equal_one_batch(spark, folder):
    tagged = counts.tags(stream(spark, folder), "text", "at", "#")
    counted = counts.windowed_counts(tagged, "at", "tag", width="20 seconds", slide="10 seconds")
    assert rows(counted) == rows(expected_windows(spark, folder))
    soccer = counted.filter("tag = '#soccer'").agg(F.sum("count")).first()[0]
    assert soccer == 6  # three mentions, two windows each


def test_watermark_drops_only_what_is_too_late(spark, folder):
    tagged = counts.tags(stream(spark, folder), "text", "at", "#")
    wide = counts.windowed_counts(tagged, "at", "tag", width="20 seconds", slide="10 seconds", watermark="1 hour")
    assert rows(wide) == rows(expected_windows(spark, folder))


def test_live_table_of_top_tags(spark, folder):
    tagged = counts.tags(stream(spark, folder), "text", "at", "#")
    counted = counts.windowed_counts(tagged, "at", "tag", width="20 seconds", slide="10 seconds")
    counts.top_tags(counted, 1, view="live_tags")
    top = spark.sql("SELECT window_start, tag, count FROM live_tags ORDER BY window_start").collect()
    assert [(r["tag"], r["count"]) for r in top] == [("#fun", 2), ("#soccer", 3), ("#soccer", 2), ("#fun", 1), ("#fun", 1)]


def test_append_and_json_messages(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.txt").write_text('{"text": "soccer!"}\n{broken\n{"id": 1}\n')
    lines = stream_lines(spark, path=str(tmp_path / "in"))
    texts = lines.select(json_field(F.col("value"), "text", "STRING").alias("text")).filter("text IS NOT NULL")
    assert rows(run_append(texts)) == [("soccer!",)]


def test_empty_stream(spark, tmp_path):
    (tmp_path / "none").mkdir()
    empty = stream(spark, str(tmp_path / "none"))
    path = run_to_table(empty, SCHEMA, mode="append")
    assert stored_batches(spark, path, SCHEMA).count() == 0


def test_a_repeated_batch_replaces_its_first_try(spark, folder):
    """Rows stored by a try that failed half-way do not survive the retry."""
    tries = []

    def flaky(df):
        if not tries:
            tries.append(1)
            return df.union(df)
        return df

    path = run_to_table(stream(spark, folder, max_files=10), SCHEMA, mode="append", per_batch=flaky)
    assert stored_batches(spark, path, SCHEMA).count() == 10
    batch(spark, folder).write.mode("overwrite").parquet(f"{path}/batch_id=0")
    assert stored_batches(spark, path, SCHEMA).count() == 5
