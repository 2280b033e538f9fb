"""Projections, predicates, joins, sorts and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# --- projections -----------------------------------------------------------

def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    return df.withColumns(dict(columns))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the table does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def null_above(column: Column, bound) -> Column:
    """The value, or null beyond ``bound``."""
    return F.when(column <= bound, column)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two columns; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_text(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Share in percent as text, e.g. ``1,234.57%``."""
    return F.concat(F.format_number(ratio(numerator, denominator) * 100, digits), F.lit("%"))


def map_codes(
    df: DataFrame, column: str, table: Mapping | DataFrame, output: str, *, missing: str | None = None
) -> DataFrame:
    """Label of each code. A null code gets ``missing``; an unlisted code gets null.

    ``table`` is a literal of the program, or a frame of two columns (code, label) with one row a code.
    """
    key_type = df.schema[column].dataType
    if isinstance(table, DataFrame):
        code, label = table.columns
        lookup = table.select(F.col(code).cast(key_type).alias("_code"), F.col(label).alias(output))
    else:
        rows = df.sparkSession.createDataFrame(list(table.items()), ["_code", output])
        lookup = rows.withColumn("_code", F.col("_code").cast(key_type))
    labelled = df.join(lookup, F.col(column) == F.col("_code"), "left").drop("_code")
    if missing is None:
        return labelled
    return labelled.withColumn(output, F.when(F.col(column).isNull(), F.lit(missing)).otherwise(F.col(output)))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is null."""
    return df.na.drop(subset=list(columns))


def in_year(column: str, first: int, last: int | None = None) -> Column:
    """Rows of one calendar year (or of ``first`` to ``last``), as a range the scan can push down."""
    bounds = (first, (first if last is None else last) + 1)
    start, end = (F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz") for y in bounds)
    return (F.col(column) >= start) & (F.col(column) < end)


def grid_key(latitude: Column, longitude: Column, digits: int = 1) -> Column:
    """Text key of the grid cell two coordinates fall in; '-' reads X and '.' reads Z."""
    text = F.concat(F.round(latitude, digits).cast("string"), F.round(longitude, digits).cast("string"))
    return F.translate(text, "-.", "XZ")


# --- joins -----------------------------------------------------------------

def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Equi-join on shared columns, each key once in the result."""
    return left.join(right, keys, how)


def one_per_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row for each key, for a join on the keys with a table that may be skewed.

    Rows are grouped by the keys and a hash of them, which makes the same groups
    but leaves the result not partitioned by the keys. The join then shuffles both
    sides itself, and only such a join can have its hot keys split at run time:
    with an aggregate between shuffle and join, adaptive execution leaves the
    skew alone.
    """
    grouping = [*keys, F.xxhash64(*keys).alias("_apart")]
    if not aggregates:
        return df.select(*grouping).distinct().drop("_apart")
    return df.groupBy(*grouping).agg(*aggregates).drop("_apart")


def matched_only(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``.

    The right keys are reduced to one row each in the tasks before they are
    shuffled, so a key that fills a third of ``right`` costs no more than any other.
    """
    return left.join(one_per_key(right, keys), list(keys), "left_semi")


def enrich(fact: DataFrame, dimension: DataFrame, keys: Sequence[str], *, dedupe: bool = False) -> DataFrame:
    """Attach dimension columns. Several dimension rows on a key multiply the fact
    (the multiplicity is kept) unless ``dedupe`` leaves one row of each key."""
    if dedupe:
        values = [c for c in dimension.columns if c not in keys]
        dimension = one_per_key(dimension, keys, F.min(F.struct(*values)).alias("_row")).select(*keys, "_row.*")
    return fact.join(dimension, list(keys), "inner")


def first_value(df: DataFrame, value: str, *order: str) -> Column:
    """The value of the first row in an order, as a scalar for use in another query."""
    return df.agg(F.min(F.struct(*order, value)).alias("_first")).select(f"_first.{value}").scalar()


# --- sorts, limits, top-k --------------------------------------------------

def first_n(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in an order; runs as a top-k, not as a full sort."""
    return df.orderBy(*order).limit(n)


def argmax_row(df: DataFrame, by: str, tie: str) -> DataFrame:
    """The row with the highest ``by`` (lowest ``tie`` among equals), found without a sort.

    ``tie`` is a whole number.
    """
    rank = F.struct(F.col(by), (-F.col(tie)).alias("_tie"))
    return df.agg(F.max_by(F.struct(*df.columns), rank).alias("_row")).select("_row.*")


def top_n_per_group(df: DataFrame, keys: Sequence[str], n: int, *order, rank: str = "rank") -> DataFrame:
    """The first n rows of each group.

    Spark cuts every group to n rows in each task before it shuffles
    (WindowGroupLimit), so a hot group does not travel whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
