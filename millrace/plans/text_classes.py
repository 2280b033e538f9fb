"""Classification of labelled texts: feature stages and a naive Bayes model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import remove_stopwords, stop_words, tf_idf, tokenize
from millrace.operators.features import index_category


def with_length(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("length", F.length(text))


def text_stages(
    label: str = "class", text: str = "text", *, vocab_size: int | None = None, buckets: int | None = None,
    stop: Sequence[str] | None = None,
) -> list:
    """Label index, tokens, stop words, term counts, tf-idf, and the assembled features.

    MLlib keeps a vocabulary on the driver, so the caller names its bound: the ``vocab_size`` most
    frequent terms, or hashing into ``buckets``. ``text_features`` has no such bound. ``stop``
    defaults to Spark's English stop words. The input has ``length``.
    """
    if (vocab_size is None) == (buckets is None):
        raise ValueError("name either vocab_size or buckets")
    stop = stop_words("english") if stop is None else list(stop)
    if buckets:
        counts = HashingTF(inputCol="stop_tokens", outputCol="counts", numFeatures=buckets)
    else:
        counts = CountVectorizer(inputCol="stop_tokens", outputCol="counts", vocabSize=vocab_size)
    return [
        StringIndexer(inputCol=label, outputCol="label"),
        Tokenizer(inputCol=text, outputCol="token_text"),
        StopWordsRemover(inputCol="token_text", outputCol="stop_tokens", stopWords=stop),
        counts,
        IDF(inputCol="counts", outputCol="tf_idf"),
        VectorAssembler(inputCols=["tf_idf", "length"], outputCol="features"),
    ]


def term_weights(df: DataFrame, key: str, text: str = "text", *, stop: Sequence[str]) -> DataFrame:
    """(key, term, tf, idf, tf_idf) of each text's terms that are no stop words, over the whole vocabulary."""
    return tf_idf(df, key, remove_stopwords(tokenize(F.col(text)), stop))


def text_features(df: DataFrame, key: str, label: str = "class", text: str = "text", *, stop: Sequence[str]) -> DataFrame:
    """Rows with their label index and ``weights``, the tf-idf of each of their terms (a map); no vocabulary is cut or kept."""
    indexed = index_category(df, label, "label")
    entry = F.struct("term", "tf_idf")
    weights = term_weights(df, key, text, stop=stop).groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("weights"))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    return indexed.join(weights, key, "left").withColumn("weights", F.coalesce("weights", none))
