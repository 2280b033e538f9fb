"""Linear and logistic regression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import assemble


def fit_linear(df: DataFrame, columns: Sequence[str], label: str, **params) -> LinearRegressionModel:
    """Least squares on numeric columns. One pass over the data (normal equations)."""
    data = assemble(df.select(*columns, label), columns, invalid="skip")
    return LinearRegression(labelCol=label, **{"solver": "normal", **params}).fit(data)


def coefficients(df: DataFrame, model: LinearRegressionModel, columns: Sequence[str]) -> DataFrame:
    """Fitted terms as rows (term, value), the intercept included."""
    rows = [(c, float(v)) for c, v in zip(columns, model.coefficients)]
    return df.sparkSession.createDataFrame([*rows, ("intercept", float(model.intercept))], "term string, value double")


def score(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """All rows with the model's ``prediction``, null where a feature is missing; labels are not needed."""
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns])
    scored = model.transform(assemble(df, columns, invalid="keep")).drop("features")
    return scored.withColumn("prediction", F.when(complete, F.col("prediction")))


def residuals(scored: DataFrame, label: str, output: str = "residual") -> DataFrame:
    return scored.withColumn(output, F.col(label) - F.col("prediction"))


def fit_logistic(df: DataFrame, columns: Sequence[str], label: str, **params) -> LogisticRegressionModel:
    """Binary logistic regression; ``label`` is 0/1."""
    data = assemble(df.select(*columns, label), columns, invalid="skip")
    return LogisticRegression(labelCol=label, **params).fit(data)


def probabilities(scored: DataFrame, column: str = "probability", output: str = "p1") -> DataFrame:
    """The probability of class 1 as a plain column (null without a prediction), model vectors dropped."""
    value = F.when(F.col("prediction").isNotNull(), vector_to_array(F.col(column))[1])
    return scored.withColumn(output, value).drop(column, "rawPrediction")
