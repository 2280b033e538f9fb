"""Logistic regression by Newton steps: the gradient and the curvature of all features in one aggregate a step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LogisticFit:
    columns: list[str]
    intercept: float
    coefficients: list[float]
    covariance: np.ndarray  # of the intercept and the coefficients
    steps: int
    converged: bool

    def log_odds(self) -> Column:
        return reduce(add, [F.col(f"`{c}`") * w for c, w in zip(self.columns, self.coefficients)], F.lit(self.intercept))

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.log_odds()))


def _complete(columns: Sequence[str], label: str) -> Column:
    return reduce(and_, [F.col(f"`{c}`").isNotNull() for c in [*columns, label]])


def newton_sums(df: DataFrame, terms: Sequence[Column], label: Column, weights: Sequence[float]) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Gradient and curvature of the log likelihood at ``weights``, the log likelihood, and the rows: one aggregate."""
    odds = reduce(add, [t * float(w) for t, w in zip(terms, weights)])
    p = 1 / (1 + F.exp(-odds))
    rows = df.select(*[t.alias(f"t{i}") for i, t in enumerate(terms)], label.cast("double").alias("y"), p.alias("p"), odds.alias("o"))
    k = len(terms)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    t = [F.col(f"t{i}") for i in range(k)]
    spread = F.col("p") * (1 - F.col("p"))
    # log(1 + e^o) without overflow
    fit = F.col("y") * F.col("o") - F.greatest("o", F.lit(0.0)) - F.log1p(F.exp(-F.abs("o")))
    row = rows.agg(
        *[F.sum((F.col("y") - F.col("p")) * t[i]) for i in range(k)], *[F.sum(spread * t[i] * t[j]) for i, j in pairs], F.sum(fit), F.count("y")
    ).first()
    curve = np.zeros((k, k))
    for (i, j), value in zip(pairs, row[k:-2]):
        curve[i, j] = curve[j, i] = value
    return np.array(row[:k], float), curve, float(row[-2]), int(row[-1])


def fit_newton(df: DataFrame, columns: Sequence[str], label: str, *, most: int = 30, tolerance: float = 1e-10) -> LogisticFit:
    """Maximum likelihood fit of a 0/1 label, to ``tolerance`` of the mean gradient.

    The features are centred and scaled inside the sums, so that their units do not matter. A step that lowers the
    likelihood is halved. Labels that the features part without a rest have no finite fit; then the steps end at ``most`` and
    ``converged`` is false. Rows with a missing feature or label are left out.
    """
    rows = df.filter(_complete(columns, label))
    first = rows.agg(*[f(F.col(f"`{c}`").cast("double")) for c in columns for f in (F.avg, F.stddev_pop)]).first()
    if first[0] is None:
        raise ValueError("no complete row to fit")
    means, scales = first[::2], [s or 1.0 for s in first[1::2]]
    terms = [F.lit(1.0), *[(F.col(f"`{c}`").cast("double") - m) / s for c, m, s in zip(columns, means, scales)]]
    y = F.col(f"`{label}`")
    weights = np.zeros(len(terms))
    gradient, curve, likelihood, n = newton_sums(rows, terms, y, weights)
    steps, converged = 0, False
    while steps < most:
        if np.abs(gradient).max() <= tolerance * n:
            converged = True
            break
        step = np.linalg.lstsq(curve, gradient, rcond=None)[0]
        for _ in range(10):
            found = newton_sums(rows, terms, y, weights + step)
            if found[2] >= likelihood - 1e-9 * abs(likelihood):
                break
            step = step / 2
        weights = weights + step
        gradient, curve, likelihood, _ = found
        steps += 1
    back = np.eye(len(terms))  # from centred and scaled terms to the columns
    for i, (m, s) in enumerate(zip(means, scales), 1):
        back[i, i], back[0, i] = 1 / s, -m / s
    plain, covariance = back @ weights, back @ np.linalg.pinv(curve, hermitian=True) @ back.T
    return LogisticFit(list(columns), float(plain[0]), plain[1:].tolist(), covariance, steps, converged)


def score(df: DataFrame, fit: LogisticFit) -> DataFrame:
    """All rows with ``p1`` and the 0/1 ``prediction``, null where a feature is missing."""
    scored = df.withColumn("p1", fit.probability())  # null with any of its columns
    return scored.withColumn("prediction", (F.col("p1") > 0.5).cast("double"))


def summary(df: DataFrame, fit: LogisticFit) -> DataFrame:
    """(term, coefficient, std_error, z) of the fitted terms."""
    errors = np.sqrt(np.diag(fit.covariance))
    values = [fit.intercept, *fit.coefficients]
    rows = [(t, float(v), float(e), float(v / e) if e else None) for t, v, e in zip(["intercept", *fit.columns], values, errors)]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double, std_error double, z double")


def score_equations(df: DataFrame, fit: LogisticFit, label: str) -> DataFrame:
    """(term, observed, predicted): sums of each column over the label and over the probabilities, equal at the optimum."""
    rows = df.filter(_complete(fit.columns, label)).withColumn("_p", fit.probability())
    terms = [("intercept", F.lit(1.0)), *[(c, F.col(f"`{c}`").cast("double")) for c in fit.columns]]
    row = rows.agg(*[F.sum(v * F.col(w)).alias(f"{w}|{t}") for t, v in terms for w in (label, "_p")])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col(f"`{label}|{t}`").alias("observed"), F.col(f"`_p|{t}`").alias("predicted")) for t, _ in terms
    ])))
