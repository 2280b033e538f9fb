"""Daily stock prices: profile, ratios, peaks and calendar aggregates.

Tables have ``Date, Open, High, Low, Close, Volume``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import filtered_count, percent_rows, profile_formatted
from millrace.operators.relational import argmax_row, derive, ratio


def described(prices: DataFrame) -> DataFrame:
    return profile_formatted(prices, ["Open", "High", "Low", "Close", "Volume"], whole=["Volume"])


def high_volume_ratio(prices: DataFrame) -> DataFrame:
    return derive(prices, {"HV Ratio": ratio(F.col("High"), F.col("Volume"))}).select("HV Ratio")


def peak_day(prices: DataFrame) -> DataFrame:
    """The day of the highest High, the earliest of equals."""
    keyed = prices.select("Date", "High", F.unix_date(F.to_date("Date")).alias("_day"))
    return argmax_row(keyed, "High", "_day").select("Date")


def mean_close(prices: DataFrame) -> DataFrame:
    return prices.agg(F.avg("Close").alias("avg_close"))


def volume_range(prices: DataFrame) -> DataFrame:
    return prices.agg(F.max("Volume").alias("max_volume"), F.min("Volume").alias("min_volume"))


def days_below(prices: DataFrame, close: float) -> DataFrame:
    return filtered_count(prices, F.col("Close") < close)


def percent_above(prices: DataFrame, high: float) -> DataFrame:
    return percent_rows(prices, F.col("High") > high)


def high_volume_corr(prices: DataFrame) -> DataFrame:
    return prices.agg(F.corr("High", "Volume").alias("corr"))


def by_year(prices: DataFrame, date: str, answer: Column) -> DataFrame:
    return prices.groupBy(F.year(date).alias("year")).agg(answer)


def by_month(prices: DataFrame, date: str, answer: Column) -> DataFrame:
    return prices.groupBy(F.month(date).alias("month")).agg(answer).orderBy("month")
