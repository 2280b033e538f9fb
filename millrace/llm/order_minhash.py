"""Order MinHash: signatures that follow the order of a text, in SQL functions only.

A text is read as tokens (runs of at most 16 characters without white space), and every
``GRAM`` tokens in a row make a k-mer. Equal k-mers of a text are told apart by their
occurrence number. A hash of k-mer and number deals them to ``BINS`` bins and orders each
bin; the two least of a bin, put back into the order of the text, are hashed as a tuple.
Two texts agree in a bin if both k-mers agree and stand in the same order, so
likeness falls with the edit distance, also where only the order changed.

One pass of hashing serves all bins. Intermediate arrays are bound as lambda variables
(``bound``), so each is computed once.

Defined results: a null text is empty and has an empty fingerprint; two empty texts are alike
(1.0), an empty and another one are not (0.0); fewer than ``GRAM`` tokens make one k-mer;
equal texts have equal fingerprints; rows of equal ids follow each other by text, and null
ids come last; in a table of one row the next document is the row itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.settings import tuned
from millrace.operators.ordering import global_row_number

GRAM, BINS = 5, 64
_PLACE = 26  # bits of a position
_RANK = 31  # bits that order a bin
_IDS = 10  # 2**10 neighbouring ids share a group
_ABSENT = 1 << 12  # groups of rows without an id


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def signature(text: Column) -> Column:
    """array<int>: for each bin that holds a k-mer, its number and a hash of its tuple."""
    tokens = F.regexp_extract_all(text, F.lit(r"\S{1,16}"), F.lit(0))
    return bound(F.transform(tokens, lambda w: F.xxhash64(w)), _from_tokens)


def _from_tokens(h: Column) -> Column:
    none = F.array().cast("array<bigint>")

    def gram(i: Column) -> Column:
        key = F.xxhash64(*[F.get(h, i + j) for j in range(GRAM)])
        return F.shiftleft(F.shiftright(key, _PLACE), _PLACE).bitwiseOR(i.cast("bigint"))

    places = F.sequence(F.lit(0), F.greatest(F.size(h) - GRAM, F.lit(0)))
    grams = F.when(F.size(h) > 0, F.transform(places, gram)).otherwise(none)
    return bound(F.sort_array(grams), _numbered)


def _numbered(s: Column) -> Column:
    """Number equal k-mers (neighbours now), and deal them to the bins."""

    def key(j: Column) -> Column:
        return F.shiftright(F.get(s, j), _PLACE)

    def run_start(j: Column, own: Column) -> Column:
        # Steps of halving length back through neighbours of the same k-mer.
        return F.aggregate(
            F.sequence(F.lit(_PLACE - 1), F.lit(0), F.lit(-1)), j,
            lambda at, b: bound(
                at - F.pow(F.lit(2.0), b).cast("int"),
                lambda to: F.when((to >= 0) & (key(F.greatest(to, F.lit(0))) == own), to).otherwise(at),
            ),
        )

    def deal(v: Column, j: Column) -> Column:
        own = F.shiftright(v, _PLACE)
        number = F.when((j > 0) & (key(F.greatest(j - 1, F.lit(0))) == own), j - run_start(j, own)).otherwise(F.lit(0))
        return bound(F.xxhash64(own, number), lambda e: F.shiftleft(e.bitwiseAND(F.lit(BINS - 1)), _PLACE + _RANK).bitwiseOR(
            F.shiftleft(F.shiftrightunsigned(e, 64 - _RANK), _PLACE)).bitwiseOR(v.bitwiseAND(F.lit((1 << _PLACE) - 1))))

    return bound(F.sort_array(F.transform(s, deal)), _tuples)


def _tuples(t: Column) -> Column:
    """The two least k-mers of each bin, in text order, as one hash."""

    def bin_of(v: Column) -> Column:
        return F.shiftright(v, _PLACE + _RANK)

    def rank(v: Column) -> Column:
        return F.shiftright(v, _PLACE)

    def place(v: Column) -> Column:
        return v.bitwiseAND(F.lit((1 << _PLACE) - 1))

    def entry(j: Column) -> Column:
        one = F.get(t, j)
        two = F.get(t, j + 1)
        whole = (
            F.when(two.isNull() | (bin_of(two) != bin_of(one)), F.xxhash64(rank(one)))
            .when(place(one) < place(two), F.xxhash64(rank(one), rank(two)))
            .otherwise(F.xxhash64(rank(two), rank(one)))
        )
        return F.shiftleft(bin_of(one), 25).bitwiseOR(whole.bitwiseAND(F.lit((1 << 25) - 1))).cast("int")

    heads = F.filter(
        F.sequence(F.lit(0), F.size(t) - 1),
        lambda j: (j == 0) | (bin_of(F.get(t, j)) != bin_of(F.get(t, F.greatest(j - 1, F.lit(0))))),
    )
    return F.when(F.size(t) > 0, F.transform(heads, entry)).otherwise(F.array().cast("array<int>"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins that agree among those either text fills."""

    def bins(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 25))

    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(filled, F.lit(1)))


def written(a: Column) -> Column:
    """A signature as text: eight hexadecimal digits a bin."""
    return F.array_join(F.transform(a, lambda v: F.lpad(F.lower(F.hex(v.cast("bigint"))), 8, "0")), "")


def with_next(texts: DataFrame) -> DataFrame:
    """(doc_id, own, next): text and signature of each row and of the row with the next lower id.

    The lowest is followed by the highest. A group holds at most 2**10 distinct ids,
    whatever their values. Rows without an id come last, in ``_ABSENT`` groups by a hash of their text.
    Within a group the next row is the one behind; only the last row of
    a group needs the first one of the next group, and only these travel a second time.
    """
    absent = F.lit(-(1 << 54)) - F.pmod(F.xxhash64("text"), F.lit(_ABSENT))  # below the group of any id
    group = F.when(F.col("doc_id").isNull(), absent).otherwise(F.shiftright("doc_id", _IDS)).alias("_group")
    both = F.struct(F.col("text"), signature(F.col("text")).alias("signature"))
    last = F.col("doc_id").desc_nulls_last()
    order = Window.partitionBy("_group").orderBy(last, "own.text")
    rows = texts.select(group, "doc_id", both.alias("own"))
    heads = (
        texts.select(group, "doc_id", "text")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("_group").orderBy(last, "text")))
        .filter(F.col("_rank") == 1).select("_group", both.alias("_following"))
    )
    numbered = global_row_number(texts.select(group).distinct(), [F.col("_group").desc()], "_at")
    total = numbered.count()
    after = numbered.select((F.col("_at") % F.lit(max(total, 1)) + 1).alias("_at"), F.col("_group").alias("_own"))
    following = after.join(numbered, "_at").join(heads, "_group").select(F.col("_own").alias("_group"), "_following")
    return (
        rows.withColumn("_behind", F.lead("own").over(order))
        .join(following, "_group", "left")
        .select("doc_id", "own", F.coalesce("_behind", "_following").alias("next"))
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how alike they are.

    The edited form has its last third replaced by the beginning of the next document.
    """
    tuned(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text, own, after = F.col("own.text"), F.col("own.signature"), F.col("next.signature")
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - third), F.substring(F.col("next.text"), F.lit(1), third))
    result = bound(edited, lambda e: bound(signature(e), lambda b: F.struct(
        F.sha2(e.cast("binary"), 256).alias("edited_sha256"),
        written(b).alias("edited_fingerprint"),
        likeness(own, b).alias("near_edited"),
    )))
    return with_next(texts).select(
        "doc_id", n.cast("bigint").alias("n_chars"), written(own).alias("fingerprint"), likeness(own, after).alias("near_next"),
        F.inline(F.array(result)),
    )
