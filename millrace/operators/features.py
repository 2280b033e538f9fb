"""Feature columns for MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import global_row_number

def index_category(df: DataFrame, column: str, output: str) -> DataFrame:
    """Index of each category by falling frequency, ties in alphabetical order, as double.

    Nulls are no category; their rows get a null index. The ranking is computed and joined
    on the executors. Stage chains use MLlib's StringIndexer, which keeps its labels on the driver.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    ranked = global_row_number(counted, [F.col("count").desc(), F.col(column)], "_rank")
    index = ranked.select(column, (F.col("_rank") - 1).cast("double").alias(output))
    return df.join(index, column, "left")


def dense_ids(df: DataFrame, column: str, output: str) -> DataFrame:
    """Distinct values of a column numbered from 0: (column, output int)."""
    ranked = global_row_number(df.select(column).distinct(), [F.col(column)], "_rank")
    return ranked.select(column, (F.col("_rank") - 1).cast("int").alias(output))


def one_hot(df: DataFrame, column: str, output: str) -> DataFrame:
    """0/1 vector of a category index, the last category left out."""
    return OneHotEncoder(inputCols=[column], outputCols=[output], dropLast=True).fit(df).transform(df)


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", *, invalid: str = "error"
) -> DataFrame:
    """One vector column from numeric and vector columns.

    ``invalid`` says what a null does: ``error``, ``skip`` the row, or ``keep`` as NaN.
    """
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid).transform(df)


def scale(df: DataFrame, column: str = "features", output: str = "scaled") -> DataFrame:
    """Vector scaled to unit sample deviation, not centred."""
    return StandardScaler(inputCol=column, outputCol=output, withStd=True, withMean=False).fit(df).transform(df)


def index_vector(df: DataFrame, column: str, output: str, max_categories: int) -> DataFrame:
    """Features with few distinct values recoded as category indices."""
    indexer = VectorIndexer(inputCol=column, outputCol=output, maxCategories=max_categories)
    return indexer.fit(df).transform(df)


def vector_columns(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """The parts of a vector as plain double columns."""
    array = vector_to_array(F.col(column))
    return df.withColumns({name: array[i] for i, name in enumerate(names)})


def sparse_columns(df: DataFrame, column: str, indices: str = "indices", values: str = "values") -> DataFrame:
    """The stored entries of a sparse vector as two arrays; nothing is widened to the full length."""
    parts = F.unwrap_udt(F.col(column))
    return df.withColumns({indices: parts["indices"], values: parts["values"]})


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split; the seed is required so that it can be repeated."""
    return df.randomSplit(list(weights), seed)


def key_split(df: DataFrame, key: str, train: int = 7, of: int = 10) -> tuple[DataFrame, DataFrame]:
    """Split by a whole-number key: the same rows on every run and any cluster.

    All rows are used, each in exactly one part.
    """
    slot = F.pmod(F.col(key), F.lit(of))
    return df.filter(slot < train), df.filter((slot >= train) | F.col(key).isNull())


def fit_stages(df: DataFrame, stages: Sequence) -> PipelineModel:
    """Fit a chain of stages as one model."""
    return Pipeline(stages=list(stages)).fit(df)
