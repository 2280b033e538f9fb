"""Multinomial naive Bayes over term tables.

The model is a table of terms, not vectors: it grows with the vocabulary on the executors, and no
list of terms reaches the driver. Same estimates as MLlib's multinomial model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import one_per_key


@dataclass
class TermBayes:
    priors: DataFrame  # label, prior, rest: log prior, and log share of a term the class has not seen
    shares: DataFrame  # label, term, lift: log share over that of an unseen term


def fit_terms(weights: DataFrame, labels: DataFrame, key: str, *, smoothing: float = 1.0) -> TermBayes:
    """Fit on ``weights`` (key, term, weight) of the rows in ``labels`` (key, label).

    The share of a term in a class is its weight there plus ``smoothing``, over the class's
    weight plus ``smoothing`` for every term of the vocabulary.
    """
    by_label = labels.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    known = weights.join(labels.select(key, "label"), key).groupBy("label", "term").agg(F.sum("weight").alias("weight"))
    terms = known.select("term").distinct().agg(F.count(F.lit(1))).scalar()
    total = labels.agg(F.count(F.lit(1))).scalar()
    classes = labels.select("label").distinct().agg(F.count(F.lit(1))).scalar()
    mass = known.groupBy("label").agg(F.sum("weight").alias("mass"))
    priors = by_label.join(mass, "label", "left").select(
        "label",
        F.log((F.col("rows") + smoothing) / (total + classes * smoothing)).alias("prior"),
        F.log(F.lit(smoothing) / (F.coalesce("mass", F.lit(0.0)) + terms * smoothing)).alias("rest"),
    )
    shares = known.select("label", "term", F.log((F.col("weight") + smoothing) / smoothing).alias("lift"))
    return TermBayes(priors, shares)


def score_terms(model: TermBayes, weights: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(key, label, log_odds) of every row in ``keys`` and every class: the class's unnormalised log probability.

    Terms the model has never seen are left out, as they say nothing about the classes.
    """
    vocabulary = one_per_key(model.shares, ["term"])
    used = weights.join(vocabulary, "term", "left_semi")
    mass = used.groupBy(key).agg(F.sum("weight").alias("mass"))
    lifted = used.join(model.shares, "term").groupBy(key, "label").agg(F.sum(F.col("weight") * F.col("lift")).alias("lift"))
    every = (
        keys.select(key).join(mass, key, "left")
        .withColumn("_class", F.explode(model.priors.agg(F.collect_list(F.struct("label", "prior", "rest"))).scalar()))
        .select(key, "mass", "_class.*")
    )
    return every.join(lifted, [key, "label"], "left").select(
        key, "label",
        (F.col("prior") + F.coalesce("mass", F.lit(0.0)) * F.col("rest") + F.coalesce("lift", F.lit(0.0))).alias("log_odds"),
    )


def classify(scores: DataFrame, key: str) -> DataFrame:
    """(key, prediction, probability): the best class of each row (the least label where two tie)."""
    best = F.max(F.struct("log_odds", (-F.col("label")).alias("_order"))).alias("best")
    top = scores.groupBy(key).agg(best, F.collect_list("log_odds").alias("_all"))
    mass = F.aggregate("_all", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("best.log_odds")))
    return top.select(key, (-F.col("best._order")).alias("prediction"), (F.lit(1.0) / mass).alias("probability"))
