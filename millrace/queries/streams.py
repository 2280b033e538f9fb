"""Streams over the tables' files, run until all of them are read."""

from pyspark.sql import functions as F

from millrace.functions.scalars import has_keyword
from millrace.registry import query
from millrace.streaming import counts
from millrace.streaming.runs import run_append, stream_files, stream_lines
from millrace.workspace import fresh_path


def _stream(t, name):
    return stream_files(t.spark, t.path(name), getattr(t, name).schema)


@query(
    "stream_word_count",
    """SELECT CAST(0 AS BIGINT) AS batch_id, word, count(*) AS count FROM
         (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM conversations) GROUP BY word""",
)
def stream_word_count(t):
    """All files make one micro-batch here, as no bound on a batch is set."""
    return counts.word_count(_stream(t, "conversations"), "text")


@query(
    "stream_line_words",
    """SELECT CAST(0 AS BIGINT) AS batch_id, word, count(*) AS count FROM
         (SELECT unnest(string_split(c_name || ' in ' || lower(c_mktsegment), ' ')) AS word FROM customer) GROUP BY word""",
)
def stream_line_words(t):
    """Words of a stream of text lines, one line a customer."""
    path = fresh_path(t.spark, "lines")
    t.customer.select(F.concat_ws(" ", "c_name", F.lit("in"), F.lower("c_mktsegment")).alias("value")).write.text(path)
    return counts.word_count(stream_lines(t.spark, path=path), "value")


_PARTS = 3


@query(
    "stream_word_batches",
    f"""SELECT CAST(conv_id % {_PARTS} AS BIGINT) AS batch_id, word, count(*) AS count FROM
         (SELECT conv_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM conversations)
       GROUP BY batch_id, word""",
)
def stream_word_batches(t):
    """Three arrivals of eight files each, in batches of eight files: one batch an arrival."""
    path = fresh_path(t.spark, "arrivals")
    for part in range(_PARTS):
        arrived = t.conversations.filter(F.pmod("conv_id", F.lit(_PARTS)) == part)
        arrived.repartition(8).write.mode("append").parquet(path)
    stream = stream_files(t.spark, f"{path}/part-*", t.conversations.schema, max_files=8)
    return counts.word_count(stream, "text")


@query(
    "stream_watermark_counts",
    """SELECT window_start, event_type, count(*) AS count FROM
         (SELECT event_type, make_timestamp(((epoch_us(ts) // 36000000000) - k) * 36000000000) AS window_start
          FROM events, (VALUES (0), (1)) AS s(k)) GROUP BY window_start, event_type""",
)
def stream_watermark_counts(t):
    """Days arrive in order, eight files a batch; windows two days behind the newest event are closed."""
    path = fresh_path(t.spark, "days")
    events = t.events.select("ts", "event_type")
    for part in range(_PARTS):
        third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(_PARTS - 1))
        events.filter(third == part).repartition(8).write.mode("append").parquet(path)
    stream = stream_files(t.spark, f"{path}/part-*", events.schema, max_files=8)
    return counts.windowed_counts(stream, "ts", "event_type", width="20 hours", slide="10 hours", watermark="2 days")


@query(
    "stream_batch_heads",
    """SELECT CAST(0 AS BIGINT) AS batch_id, word, count(*) AS count FROM
         (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS word FROM conversations)
       GROUP BY word ORDER BY count DESC, word LIMIT 10""",
)
def stream_batch_heads(t):
    return counts.batch_heads(counts.word_count(_stream(t, "conversations"), "text"))


@query(
    "stream_sliding_counts",
    """SELECT window_start, event_type, count(*) AS count FROM
         (SELECT event_type, make_timestamp(((epoch_us(ts) // 36000000000) - k) * 36000000000) AS window_start
          FROM events, (VALUES (0), (1)) AS s(k)) GROUP BY window_start, event_type""",
)
def stream_sliding_counts(t):
    """Windows of 20 hours, one every 10 hours."""
    stream = _stream(t, "events").select("ts", "event_type")
    return counts.windowed_counts(stream, "ts", "event_type", width="20 hours", slide="10 hours")


PREFIX = "th"
_TAGS = f"""SELECT window_start, tag, count(*) AS count FROM
     (SELECT tag, make_timestamp(((doc_id // 10) - k) * 10000000) AS window_start FROM
        (SELECT doc_id, lower(unnest(string_split(replace(text, chr(10), ' '), ' '))) AS tag FROM documents),
        (VALUES (0), (1)) AS s(k) WHERE starts_with(tag, '{PREFIX}')) GROUP BY window_start, tag"""


def _tag_counts(t):
    """One document a second from 1970 on; words with the prefix stand in for hashtags."""
    second = F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18, 6)"))
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + second
    timed = _stream(t, "documents").select(at.alias("at"), "text")
    tagged = counts.tags(timed, "text", "at", PREFIX)
    return counts.windowed_counts(tagged, "at", "tag", width="20 seconds", slide="10 seconds")


@query("stream_tag_counts", _TAGS)
def stream_tag_counts(t):
    return _tag_counts(t)


@query(
    "stream_top_tags",
    f"""SELECT window_start, tag, count FROM
          (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, tag) AS r FROM ({_TAGS}))
        WHERE r <= 10""",
)
def stream_top_tags(t):
    """The ten most frequent tags of each window, read by name from the live table."""
    counts.top_tags(_tag_counts(t), 10, view="millrace_tags")
    return t.spark.sql("SELECT window_start, tag, count FROM millrace_tags")


@query("stream_keyword_filter", "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'orea')")
def stream_keyword_filter(t):
    stream = _stream(t, "documents")
    return run_append(stream.filter(has_keyword(F.col("text"), "Orea")).select("doc_id", "lang", "source"))
