"""Missing data and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_nulls(
    df: DataFrame, how: str = "any", *, at_least: int | None = None, subset: Sequence[str] | None = None
) -> DataFrame:
    """Rows without nulls (``any``), with a value (``all``), or with ``at_least`` values."""
    return df.na.drop(how=how, thresh=at_least, subset=list(subset) if subset else None)


def fill(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls: text goes into text columns only, a number into numeric ones only.

    ``value`` may be a dict of column to value.
    """
    return df.na.fill(value, list(subset) if subset and not isinstance(value, dict) else None)


def fill_mean(df: DataFrame, *columns: str) -> DataFrame:
    """Fill nulls with each column's mean, as double.

    The means are scalar subqueries: one partial aggregate (Spark merges those of
    several columns into one), then constants in the plan of the second scan; they
    do not pass through the driver program.
    """
    filled = {}
    for column in columns:
        value = F.col(column).cast("double")
        filled[column] = F.coalesce(value, df.select(F.avg(value)).scalar())
    return df.withColumns(filled)


def duplicate_count(df: DataFrame, output: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each set of equal rows; nulls are equal."""
    return (
        df.groupBy(*[F.col(f"`{c}`") for c in df.columns])
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias(output))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of each column: rows (column, nulls)."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{i}`").cast("bigint").alias("nulls"))
        for i, c in enumerate(df.columns)
    ]
    return row.select(F.inline(F.array(*cells)))


def quality_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, duplicate rows and nulls by column of several tables, in long form."""

    def one(name: str, df: DataFrame) -> DataFrame:
        # Equal rows are grouped once; rows, kinds and nulls are all sums over the groups.
        kinds = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
        nulls = [F.sum(F.when(F.col(f"`{c}`").isNull(), F.col("_n"))).alias(f"_{i}") for i, c in enumerate(df.columns)]
        row = kinds.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("_kinds"), *nulls)

        def cell(check: str, column: str, value: Column) -> Column:
            return F.struct(F.lit(name).alias("table"), F.lit(check).alias("check"), F.lit(column).alias("column"),
                            F.coalesce(value, F.lit(0)).cast("bigint").alias("value"))

        return row.select(F.inline(F.array(
            cell("rows", "", F.col("rows")), cell("duplicates", "", F.col("rows") - F.col("_kinds")),
            *[cell("nulls", c, F.col(f"_{i}")) for i, c in enumerate(df.columns)],
        )))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])
