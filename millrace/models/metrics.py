"""Metrics as one-pass aggregates over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import running_total


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mse, rmse, mae, r2 (against the mean of the label)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.avg(F.pow(y - p, 2)).alias("mse"),
        F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.sum(F.pow(y - p, 2)) / (F.var_pop(y) * F.count(y))).alias("r2"),
    )


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Root mean squared error, one row."""
    return regression_metrics(df, label, prediction).select("rmse")


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of each (label, prediction) pair, for each value of ``by``."""
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).count()


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and weighted precision, recall and F1: one row, or one for each value of ``by``.

    Computed from the confusion table, whose size is the square of the number of classes. A row without a prediction is a miss.
    """
    cells = confusion_matrix(df, label, prediction, by)
    hits = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    by_label = cells.groupBy(*by, F.col("label").alias("class")).agg(
        F.sum("count").alias("n"), F.sum(hits).alias("hit")
    )
    by_prediction = cells.groupBy(*by, F.col("prediction").alias("class")).agg(F.sum("count").alias("predicted"))
    recall = F.col("hit") / F.col("n")
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("predicted")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(value: Column) -> Column:
        return F.sum(value * F.col("n")) / F.sum("n")

    return by_label.join(by_prediction, [*by, "class"], "left").groupBy(*by).agg(
        (F.sum("hit") / F.sum("n")).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
    )


def auc_hard(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Area under ROC of 0/1 predictions: mean of the true-positive and true-negative rates."""
    y, p = F.col(label), F.col(prediction)
    sensitivity = F.avg(F.when(y == 1, F.when(p == 1, 1.0).otherwise(0.0)))
    specificity = F.avg(F.when(y == 0, F.when(p == 0, 1.0).otherwise(0.0)))
    return df.agg(((sensitivity + specificity) / 2).alias("auc"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under ROC of a real-valued score (the rank statistic, ties count half).

    Rows are first counted by score; the negatives ranked below each score come
    from a running total over ranges, so no task sees the whole order.
    """
    counted = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_total(counted, [F.col("score")], F.col("neg"), "_upto")
    below = F.col("_upto") - F.col("neg")
    return ranked.agg(
        F.try_divide(
            F.sum(F.col("pos") * (below + F.col("neg") / 2)),
            (F.sum("pos") * F.sum("neg")).cast("double"),
        ).alias("auc")
    )
