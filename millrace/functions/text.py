"""Text to tokens and term statistics, in native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.relational import one_per_key

_BLANKS = "\t\n\x0b\f\r"


def words(text: Column) -> Column:
    """Split on every blank or line end; runs of blanks give empty words."""
    return F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " ")


def tokenize(text: Column) -> Column:
    """Lowercased tokens between single white-space characters.

    Empty tokens inside the text are kept and trailing ones dropped, like
    MLlib's Tokenizer.
    """
    spaced = F.lower(text)
    for blank in _BLANKS:  # plain replacements and a one-letter split are several times faster than \\s
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    kept = F.rtrim(spaced)
    only_blanks = (kept == "") & (text != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def tokenize_regex(text: Column, pattern: str = r"\W", *, gaps: bool = True, min_length: int = 1) -> Column:
    """Lowercased tokens between (or, without ``gaps``, matching) a pattern, empty ones dropped."""
    lowered = F.lower(text)
    if gaps:
        tokens = F.split(lowered, pattern)
    else:
        tokens = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0))
    return F.filter(tokens, lambda t: F.length(t) >= min_length)


def stop_words(language: str = "english") -> list[str]:
    """Spark's default stop words of a language."""
    return list(StopWordsRemover.loadDefaultStopWords(language))


def remove_stopwords(tokens: Column, stop: Sequence[str]) -> Column:
    """Tokens that are no stop words, ignoring case; duplicates and order are kept."""
    unwanted = sorted({w.lower() for w in stop})
    return F.filter(tokens, lambda t: ~F.lower(t).isin(unwanted))


def ngrams(tokens: Column, n: int = 2) -> Column:
    """Blank-joined runs of n tokens; a row with fewer gives an empty array. Tokens are not null."""

    def joined(words: Column) -> Column:
        count = F.greatest(F.size(words) - (n - 1), F.lit(0))
        rest = lambda i: [x for k in range(1, n) for x in (F.lit(" "), F.get(words, i + k))]
        return F.transform(F.slice(words, F.lit(1), count), lambda w, i: F.concat(w, *rest(i)))

    # The one-element array gives the tokens a name, so that they are computed once a row.
    return F.get(F.transform(F.array(tokens), joined), F.lit(0))


def explode_terms(df: DataFrame, tokens: Column, *keep: str, term: str = "term") -> DataFrame:
    """One row for each token, beside the columns to keep.

    The outer form avoids the size check Spark puts before a plain explode, which
    would tokenize every text a second time.
    """
    return df.select(*keep, F.explode_outer(tokens).alias(term)).filter(F.col(term).isNotNull())


def term_counts(df: DataFrame, tokens: Column, term: str = "term", output: str = "count") -> DataFrame:
    """Occurrences of each token over all rows; counted in the tasks before the shuffle."""
    return explode_terms(df, tokens, term=term).groupBy(term).agg(F.count(F.lit(1)).alias(output))


def vocabulary(df: DataFrame, tokens: Column, *, size: int | None = None, min_docs: int = 1) -> DataFrame:
    """Terms in ``min_docs`` rows or more, the ``size`` most frequent ones if given: term, count, docs.

    One scan and one shuffle give both counts: each row lists its tokens and then
    its distinct tokens, told apart by position. Equal counts order by term.
    """
    listed = F.concat("_tokens", F.array_distinct("_tokens"))
    in_text = F.col("_at") < F.col("_n")
    counted = (
        df.select(tokens.alias("_tokens"))
        .select(F.size("_tokens").alias("_n"), F.posexplode_outer(listed).alias("_at", "term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count_if(in_text).alias("count"), F.count_if(~in_text).alias("docs"))
        .filter(F.col("docs") >= min_docs)
    )
    return counted if size is None else counted.orderBy(F.col("count").desc(), "term").limit(size)


def tf_idf(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Term frequency, ``ln((N+1)/(docs+1))`` and their product: key, term, tf, idf, tf_idf.

    The whole vocabulary is used. Term statistics are joined by term; a term in a
    third of all rows is a skewed join key, which adaptive execution splits (see
    ``one_per_key``). N is a scalar subquery.
    """
    total = df.select(F.count(F.lit(1))).scalar()
    counts = explode_terms(df, tokens, key).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    # Rows of a term are its texts. Counting those whose tf is positive (all of them) keeps
    # both uses of the counts alike, so their shuffle is written once and read twice.
    docs = one_per_key(counts, ["term"], F.count_if(F.col("tf") > 0).alias("_docs")).select(
        "term", F.log((total + 1) / (F.col("_docs") + 1)).alias("idf")
    )
    return counts.join(docs, "term").select(
        key, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf")
    )
