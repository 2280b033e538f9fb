"""Scalar functions, JSON fields and user-defined functions."""

from pyspark.sql import functions as F

from millrace.functions import scalars
from millrace.functions.text import tokenize
from millrace.functions.udfs import WEIGHT_FACTOR, register_udfs, scaled, token_count
from millrace.registry import query
from millrace.sources.sinks import register_view


@query(
    "string_replace_concat",
    """SELECT p_partkey, replace(replace(p_brand, 'Brand', 'B'), '#', '-') || '/' || p_type AS code,
              CAST(p_size AS VARCHAR) || ' cm' AS size FROM part""",
)
def string_replace_concat(t):
    brand = F.replace(F.replace(F.col("p_brand"), F.lit("Brand"), F.lit("B")), F.lit("#"), F.lit("-"))
    return t.part.select(
        "p_partkey",
        F.concat(brand, F.lit("/"), "p_type").alias("code"),
        F.concat(F.col("p_size").cast("string"), F.lit(" cm")).alias("size"),
    )


@query(
    "string_lower_length_split",
    """SELECT p_partkey, lower(p_type) AS low, CAST(length(p_name) AS INTEGER) AS len,
              string_split(p_name, ' ')[1] AS first_word, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_words,
              starts_with(p_name, 'red') AS is_red FROM part""",
)
def string_lower_length_split(t):
    parts = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.lower("p_type").alias("low"),
        F.length("p_name").alias("len"),
        parts[0].alias("first_word"),
        F.size(parts).alias("n_words"),
        F.startswith("p_name", F.lit("red")).alias("is_red"),
    )


@query("format_number", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price FROM orders")
def format_number(t):
    return t.orders.select("o_orderkey", scalars.number_text(F.col("o_totalprice")).alias("price"))


@query(
    "math_round_abs",
    """SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18, 2)), 1) AS DOUBLE) + 0.0 AS rounded,
              abs(c_acctbal) AS magnitude, c_acctbal - 100 AS less, c_acctbal + 1 AS more,
              c_acctbal * 2 AS twice, c_acctbal / 4 AS quarter FROM customer""",
)
def math_round_abs(t):
    c = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        (F.round(c, 1) + 0.0).alias("rounded"),
        F.abs(c).alias("magnitude"),
        (c - 100).alias("less"),
        (c + 1).alias("more"),
        (c * 2).alias("twice"),
        (c / 4).alias("quarter"),
    )


@query(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
              CAST(day(ts) AS INTEGER) AS day, CAST(dayofyear(ts) AS INTEGER) AS day_of_year,
              CAST(weekofyear(ts) AS INTEGER) AS week, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
)
def date_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in scalars.date_parts(F.col("ts")).items()])


@query("date_format", "SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M') AS shown FROM events")
def date_format(t):
    return t.events.select("event_id", F.date_format("ts", "yyyy/MM/dd HH:mm").alias("shown"))


@query(
    "cast_text",
    """SELECT o_orderkey, CAST(o_totalprice AS FLOAT)::DOUBLE AS as_float,
              CAST(trunc(o_totalprice) AS INTEGER) AS as_int,
              CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS as_long FROM orders""",
)
def cast_text(t):
    """Text that is no number becomes null."""
    text = F.col("o_totalprice").cast("string")
    key = F.when(F.col("o_orderkey") % 9 == 0, F.lit("none")).otherwise(F.col("o_custkey").cast("string"))
    return t.orders.select(
        "o_orderkey",
        text.try_cast("float").cast("double").alias("as_float"),
        text.try_cast("double").try_cast("int").alias("as_int"),
        key.try_cast("bigint").alias("as_long"),
    )


@query(
    "json_field",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
       WHERE event_id % 11 <> 0 AND json_extract(props, '$.k') IS NOT NULL""",
)
def json_field(t):
    """Every eleventh message is cut short; malformed messages are skipped."""
    message = F.when(F.col("event_id") % 11 == 0, F.expr("substring(props, 1, 3)")).otherwise(F.col("props"))
    return t.events.select("event_id", scalars.json_field(message, "k", "BIGINT").alias("k")).na.drop(subset=["k"])


# --- user-defined functions ----------------------------------------------------

@query("udf_pandas_convert", "SELECT p_partkey, CAST(CAST(p_retailprice * CAST(0.45 AS DOUBLE) AS FLOAT) AS DOUBLE) AS metric FROM part")
def udf_pandas_convert(t):
    convert = scaled(WEIGHT_FACTOR)
    return t.part.select("p_partkey", convert("p_retailprice").cast("double").alias("metric"))


@query(
    "udf_sql_registered",
    """SELECT p_partkey, p_size AS mpg, CAST(CAST(p_size * CAST(0.425 AS DOUBLE) AS FLOAT) AS DOUBLE) AS kmpl,
              CAST(CAST(p_retailprice * CAST(0.45 AS DOUBLE) AS FLOAT) AS DOUBLE) AS weight_metric FROM part""",
)
def udf_sql_registered(t):
    register_udfs(t.spark)
    register_view(t.part, "millrace_cars")
    return t.spark.sql(
        """SELECT p_partkey, p_size AS mpg, CAST(convert_mileage(CAST(p_size AS DOUBLE)) AS DOUBLE) AS kmpl,
                  CAST(convert_weight(p_retailprice) AS DOUBLE) AS weight_metric FROM millrace_cars"""
    )


@query("udf_sql_scalar", "SELECT o_orderkey, o_custkey * 2 AS converted FROM orders")
def udf_sql_scalar(t):
    register_udfs(t.spark)
    register_view(t.orders, "millrace_totals")
    return t.spark.sql("SELECT o_orderkey, double_whole(o_custkey) AS converted FROM millrace_totals")


_TOKENS = (
    "CASE WHEN length(lower(text)) > 0 AND length(trim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) = 0 "
    "THEN [] ELSE regexp_split_to_array(rtrim(lower(text), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'[ \\t\\n\\v\\f\\r]') END"
)


@query("udf_token_count", f"SELECT doc_id, CAST(len({_TOKENS}) AS INTEGER) AS tokens FROM documents")
def udf_token_count(t):
    return t.documents.select("doc_id", token_count(tokenize(F.col("text"))).alias("tokens"))


