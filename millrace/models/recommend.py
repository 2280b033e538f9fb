"""Explicit-feedback matrix factorisation and ranked recommendations."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.features import dense_ids
from millrace.operators.relational import top_n_per_group


def ratings_table(df: DataFrame, user: Column, item: Column, rating: Column) -> DataFrame:
    """One mean rating for each (user, item); rows without either are left out.

    Repeated ratings are averaged in the tasks before anything is shuffled.
    """
    return (
        df.select(user.alias("user"), item.alias("item"), rating.cast("double").alias("rating"))
        .na.drop()
        .groupBy("user", "item")
        .agg(F.avg("rating").alias("rating"))
    )


_INT = (-(1 << 31), (1 << 31) - 1)

FEWEST_BLOCKS = 10  # MLlib's default
BLOCK_RATINGS = 1 << 22  # ratings of a block of users or items, about


def with_int_ids(ratings: DataFrame) -> DataFrame:
    """Ids as MLlib's factorisation wants them: 32-bit ``user_id`` and ``item_id``.

    Columns of up to 32 bits are used as they are, and so are wider whole numbers whose least and largest, found in one
    aggregate, fit; every other column is numbered on the executors, so no two ids become one.
    """
    wide = [c for c in ("user", "item") if isinstance(ratings.schema[c].dataType, T.LongType)]
    bounds = ratings.agg(*[f(c).alias(f"{name}_{c}") for c in wide for name, f in (("low", F.min), ("high", F.max))]).first() if wide else {}
    for column in ("user", "item"):
        fits = column in wide and (bounds[f"low_{column}"] or 0) >= _INT[0] and (bounds[f"high_{column}"] or 0) <= _INT[1]
        if fits or isinstance(ratings.schema[column].dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            ratings = ratings.withColumn(f"{column}_id", F.col(column).cast("int"))
        else:
            ratings = ratings.join(dense_ids(ratings, column, f"{column}_id"), column)
    return ratings


def fit_als(ratings: DataFrame, *, seed: int, max_iter: int = 5, reg: float = 0.01, **params) -> ALSModel:
    """Fit on ``user_id, item_id, rating``.

    A task holds a block of users or items: its ratings and the factors they meet. MLlib makes ten blocks whatever the
    table; here there are more from ``FEWEST_BLOCKS`` times ``BLOCK_RATINGS`` ratings on, so a task's memory does not grow.
    The number is odd then, as ids go to blocks by their remainder. The random start depends on the number of blocks, so
    a fit is MLlib's of the same seed and the same blocks.
    """
    blocks = -(-ratings.count() // BLOCK_RATINGS)
    if blocks > FEWEST_BLOCKS:
        # Blocks wait on disk, so the heap is for the tasks; files of earlier rounds are deleted after each checkpoint.
        params = {"numUserBlocks": blocks | 1, "numItemBlocks": blocks | 1, "intermediateStorageLevel": "DISK_ONLY", "checkpointInterval": 1} | params
    als = ALS(
        userCol="user_id", itemCol="item_id", ratingCol="rating",
        maxIter=max_iter, regParam=reg, seed=seed, coldStartStrategy="nan", **params,
    )
    return als.fit(ratings.select("user_id", "item_id", "rating"))


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """All pairs with their ``prediction``, null where the fit has not seen the user or the item."""
    scored = model.transform(pairs)
    return scored.withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def recommend(scored: DataFrame, n: int) -> DataFrame:
    """The n best-scored candidate items of each user: rows with ``rank``.

    Works on given candidates (one scored row each), so its cost is linear in them.
    """
    return top_n_per_group(scored, ["user"], n, F.col("prediction").desc_nulls_last(), "item")


def recommend_unseen(model: ALSModel, users: DataFrame, n: int) -> DataFrame:
    """The n best items of the whole catalogue for given users: user_id, item_id, prediction.

    MLlib scores blocks of factors and keeps n rows a user; meant for chosen users.
    """
    return (
        model.recommendForUserSubset(users, n)
        .select("user_id", F.explode("recommendations").alias("r"))
        .select("user_id", F.col("r.item_id").alias("item_id"), F.col("r.rating").alias("prediction"))
    )
