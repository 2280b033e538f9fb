"""Grouped and global aggregates, profiles and correlations: one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordering import quantile_values

_FUNCTIONS = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "stddev": F.stddev_samp,
    "distinct": F.count_distinct,
}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def named_aggregates(spec: Mapping[str, str | Sequence[str]]) -> list[Column]:
    """``{'sales': ['sum', 'max']}`` -> columns ``sum_sales``, ``max_sales``."""
    result = []
    for column, names in spec.items():
        for name in [names] if isinstance(names, str) else names:
            if column == "*":
                result.append(F.count(F.lit(1)).alias("count"))
            else:
                result.append(_FUNCTIONS[name](F.col(column)).alias(f"{name}_{column}"))
    return result


def aggregate(df: DataFrame, spec: Mapping[str, str | Sequence[str]], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates by dict, global or grouped."""
    return df.groupBy(*keys).agg(*named_aggregates(spec))


def group_all(df: DataFrame, keys: Sequence[str], function: str) -> DataFrame:
    """One aggregate over every numeric column that is not a key."""
    columns = [c for c in numeric_columns(df) if c not in keys]
    return aggregate(df, {c: function for c in columns}, keys)


def group_count(df: DataFrame, *keys) -> DataFrame:
    """Rows of each group; the null group counts its rows."""
    return df.groupBy(*keys).count()


def group_count_nonnull(df: DataFrame, key: str, output: str = "count") -> DataFrame:
    """``COUNT(key)`` by ``key``: the null group counts 0."""
    return df.groupBy(key).agg(F.count(key).alias(output))


def percent_rows(df: DataFrame, predicate: Column, output: str = "percent") -> DataFrame:
    """Share of rows meeting a predicate, in percent (a null outcome is a miss)."""
    return df.agg(F.avg(F.when(predicate, 100.0).otherwise(0.0)).alias(output))


def filtered_count(df: DataFrame, predicate: Column | str, output: str = "count") -> DataFrame:
    return df.filter(predicate).agg(F.count(F.lit(1)).alias(output))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, from one aggregate."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{i}`").alias("corr")))
    return row.select(F.inline(F.array(*cells)))


_PROFILE = {
    "count": lambda c: F.count(c).cast("double"),
    "mean": lambda c: F.avg(c),
    "stddev": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum of numeric columns, typed.

    One row per column.
    """
    row = df.agg(*[f(F.col(c)).alias(f"{c}|{s}") for c in columns for s, f in _PROFILE.items()])
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").alias(s) for s in _PROFILE]) for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def profile_formatted(df: DataFrame, columns: Sequence[str], whole: Sequence[str] = ()) -> DataFrame:
    """Profile with one row per statistic and numbers as text with two decimals.

    Columns in ``whole`` are shown as whole numbers (cut, not rounded).
    """
    row = df.agg(*[f(F.col(c)).alias(f"{c}|{s}") for c in columns for s, f in _PROFILE.items()])

    def shown(c: str, s: str) -> Column:
        value = F.col(f"`{c}|{s}`")
        if c in whole:
            return value.try_cast("bigint").cast("string").alias(c)
        return F.format_number(value.cast("float"), 2).alias(c)

    cells = [F.struct(F.lit(s).alias("summary"), *[shown(c, s) for c in columns]) for s in _PROFILE]
    return row.select(F.inline(F.array(*cells)))


def profile_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Profile with exact quartiles, one row per column: two scans, unless a column has many millions of rows."""
    quartiles = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    found, row = quantile_values(df, columns, list(quartiles.values()), [f(F.col(c)).alias(f"{c}|{s}") for c in columns for s, f in _PROFILE.items()])
    fields = profile(df, columns).schema.fields[1:]

    def typed(value, kind: T.DataType):
        return float(value) if value is not None and isinstance(kind, T.DoubleType) else value

    rows = [(c, *[typed(row[f"{c}|{f.name}"], f.dataType) for f in fields], *[found[c, p] for p in quartiles.values()]) for c in columns]
    schema = T.StructType([T.StructField("column", T.StringType()), *fields, *[T.StructField(q, T.DoubleType()) for q in quartiles]])
    return df.sparkSession.createDataFrame(rows, schema)
