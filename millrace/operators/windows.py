"""Year-over-year comparison of daily means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_mean(df: DataFrame, keys: Sequence[str], day: Column, value: Column) -> DataFrame:
    """Mean of ``value`` by key and calendar day: keys, year, month, day, date, mean."""
    return (
        df.groupBy(*keys, F.to_date(day).alias("date"))
        .agg(F.avg(value).alias("mean"))
        .select(
            *keys,
            F.year("date").alias("year"),
            F.month("date").alias("month"),
            F.dayofmonth("date").alias("day"),
            "date",
            "mean",
        )
    )


def yoy_lag(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the same calendar day one year earlier and the absolute change.

    Windows hold one value a year for a key and calendar day. Days whose previous
    year is absent are left out.
    """
    window = Window.partitionBy(*keys, "month", "day").orderBy("year")
    return (
        daily.withColumn("lag", F.lag("mean").over(window))
        .withColumn("_year", F.lag("year").over(window))
        .filter(F.col("_year") == F.col("year") - 1)
        .drop("_year")
        .withColumn("delta", F.abs(F.col("lag") - F.col("mean")))
    )


def yoy_lag_faithful(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The previous row in the text order of month||day, across years and keys.

    This is the literal reading of an unpartitioned ``LAG(mean, 1, 0)``: the order
    key is unpadded text ('111' is both 1-11 and 11-1), the first row compares
    with 0. Year, keys and date break ties. The order runs over the whole table,
    so it is cut at (order key, year): inside a cut the window is partitioned,
    and across cuts only the last value of each is needed. There are at most
    366 cuts a year, whatever the size of the data.
    """
    cut = ["order_key", "year"]
    tie = [*keys, "month", "day"]
    keyed = daily.withColumn("order_key", F.concat(F.col("month").cast("string"), F.col("day").cast("string")))
    ends = keyed.groupBy(*cut).agg(F.max_by("mean", F.struct(*tie)).alias("_end"))
    carried = ends.select(*cut, F.lag("_end", 1, 0.0).over(Window.orderBy(*cut)).alias("_carried"))
    inside = F.lag("mean").over(Window.partitionBy(*cut).orderBy(*tie))
    first = F.row_number().over(Window.partitionBy(*cut).orderBy(*tie)) == 1
    return (
        keyed.withColumn("_inside", inside)
        .withColumn("_first", first)
        .join(carried, cut, "left")  # every cut is there; an outer join keeps both scans alike, so one is reused
        .withColumn("lag", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_inside")))
        .withColumn("delta", F.abs(F.col("lag") - F.col("mean")))
        .drop("order_key", "_inside", "_first", "_carried")
    )


def yoy_days(yoy: DataFrame, year: int, within: float | None = None, output: str = "days") -> DataFrame:
    """Distinct dates of ``year`` whose change is below ``within``, or exactly 0 without it."""
    close = F.col("delta") == 0 if within is None else F.col("delta") < within
    return yoy.filter((F.col("year") == year) & close).agg(F.count_distinct("date").alias(output))
