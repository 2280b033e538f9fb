"""Sinks, staging views and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sink_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task."""
    df.write.mode("overwrite").csv(path, header=True)


def sink_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated lines without header or quotes; tabs and line ends become blanks."""
    cells = [F.coalesce(F.translate(F.col(c).cast("string"), "\t\r\n", "   "), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *cells).alias("value")).write.mode("overwrite").text(path)


def sink_json(df: DataFrame, path: str) -> None:
    """JSON lines; null fields are left out."""
    df.write.mode("overwrite").json(path)


def sink_libsvm(df: DataFrame, path: str) -> None:
    """(label, features vector) as libsvm text."""
    df.select("label", "features").write.mode("overwrite").format("libsvm").save(path)


def sink_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """CSV folders, one per value of ``by``.

    ``rebalance`` gathers each folder's rows in few files and, being adaptive,
    splits a folder that holds a large share of all rows over many tasks.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).csv(path, header=True)


def sink_by_year(df: DataFrame, path: str, years: Sequence[int], column: str = "Year") -> None:
    """Export the given years, one folder each; other rows are not written."""
    sink_partitioned(df.filter(F.col(column).isin(list(years))), path, [column])


def register_view(df: DataFrame, name: str, *, replace: bool = True) -> None:
    """Make ``df`` readable by name in SQL."""
    if replace:
        df.createOrReplaceTempView(name)
    else:
        df.createTempView(name)


def drop_view(spark: SparkSession, name: str) -> None:
    """Forget a view; nothing happens if it does not exist."""
    spark.sql(f"DROP VIEW IF EXISTS `{name}`")


def stage(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Name the result of ``sql`` so that the next stage can read it."""
    df = spark.sql(sql)
    df.createOrReplaceTempView(name)
    return df


def stage_table(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Like ``stage`` but stored, for results that several later stages read."""
    spark.sql(sql).write.mode("overwrite").saveAsTable(name)
    return spark.table(name)
