"""Documents mixed so that each source gives its target of words: subset sums over length counts.

Sizes are words, maximal runs of characters other than 0x20 and 0x09-0x0D. Sources in code point order, null
last, weigh ``weights`` in turn and share ``share`` of all words by weight. No target exceeds ``most`` times
its source's words; what is above goes to the others by weight, until none is above. That loop runs on
one small aggregate of the sources a round, in whole numbers.

A source takes all its documents floor(target / words) times. What is then left of its target is fitted by a
second helping of some of them, at most one of each: its documents are counted by exact length, an even share of
them along the lengths is taken for all but the last ``RESERVE`` words of the budget (or the longest document, if that has more),
and a bounded knapsack over what is left of the counts finds the sum nearest to the rest. So a source's fit works
on its counts of lengths, however many documents it has, and its table of sums covers a few times the reserve.

Which documents of a length are taken is decided by a seeded hash of id, size and source: every document has a
position in the order of source, size and hash, counted over range partitions, and the first of each length are
taken. Rows equal in id, size and source are alike to the mix; which of them comes first does not show in the result.

Results: a null text has no words and takes none, like an empty one; a null source is a source of its own, not the
empty name; an empty table gives no rows; repeated rows each count. Extra columns are ignored by ``plan`` and kept by
``mixed``. Reruns agree, whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import blocks, whole_row, word_bounds
from millrace.operators.ordering import global_row_number
from millrace.operators.relational import one_per_key
from millrace.workspace import materialize

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # of all words: 150 %
MOST = 2
SEED = 20240607
RESERVE = 1 << 14  # words of a budget that the knapsack fits

SOURCE = ["_absent", "_name"]  # a null source is told from an empty name


# --- the fit of one source --------------------------------------------------------------------------

def nearest_sum(lengths: Sequence[int], counts: Sequence[int], goal: float) -> list[int]:
    """How many of each length to take, at most ``counts`` of it, for the sum nearest to ``goal`` (the smaller of two).

    Bounded knapsack: a length that may be taken k times becomes pieces of 1, 2, 4 ... times the length, and
    ``first`` keeps the piece by which a sum is reached first, so that one table leads back from any sum.
    """
    taken = [0] * len(lengths)
    whole = int(goal)
    wanted = whole if goal - whole <= 0.5 else whole + 1
    if wanted <= 0:
        return taken
    limit = min(2 * wanted, sum(n * c for n, c in zip(lengths, counts)))
    first = np.full(limit + 1, -1, np.int32)
    reached = np.zeros(limit + 1, bool)
    reached[0] = True
    pieces: list[tuple[int, int]] = []
    top = 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        left = min(counts[i], limit // lengths[i])
        times = 1
        while left > 0 and not (wanted <= limit and reached[wanted]):
            times = min(times, left)
            value = lengths[i] * times
            if value <= limit:
                top = min(top + value, limit)
                new = np.flatnonzero(reached[: top + 1 - value] & ~reached[value : top + 1]) + value
                reached[new] = True
                first[new] = len(pieces)
                pieces.append((i, times))
            left -= times
            times *= 2
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at:
        i, times = pieces[first[at]]
        taken[i] += times
        at -= lengths[i] * times
    return taken


def fit_counts(lengths: Sequence[int], counts: Sequence[int], budget: float) -> list[int]:
    """How many documents of each length (distinct, rising, above 0) to take for a sum near ``budget``."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    spent = max(0, int(budget) - max([RESERVE, *lengths]))
    taken, before, seen = [], 0, 0
    for c in counts:  # of the first documents in order of length, the same share at every length
        seen += c
        taken.append(seen * spent // total - before)
        before += taken[-1]
    rest = budget - sum(n * k for n, k in zip(lengths, taken))
    fitted = nearest_sum(lengths, [c - k for c, k in zip(counts, taken)], rest)
    return [k + m for k, m in zip(taken, fitted)]


def _fit(table: pa.Table) -> pa.Table:
    """Second helpings of one source: its rows (size, count, budget, ...) with ``more``."""
    table = table.sort_by("size")
    sizes, counts = table["size"].to_pylist(), table["count"].to_pylist()
    open_ = [i for i, n in enumerate(sizes) if n > 0]
    more = [0] * len(sizes)
    for i, k in zip(open_, fit_counts([sizes[i] for i in open_], [counts[i] for i in open_], table["budget"][0].as_py())):
        more[i] = k
    return table.append_column("more", pa.array(more, pa.int64()))


# --- sizes, targets, positions ----------------------------------------------------------------------

def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches, "_text"):
        size = pa.array(np.diff(word_bounds(data, offsets)[2]), pa.int64())
        yield rows.drop_columns(["_text"]).append_column("size", size)


def sized(docs: DataFrame, carried: Sequence[Column] = ()) -> DataFrame:
    """(doc_id, _absent, _name, carried, size) of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    source = F.col("source").cast("string")
    rows = docs.select(
        text, F.col("doc_id").cast("bigint").alias("doc_id"), source.isNull().alias("_absent"),
        F.coalesce(source, F.lit("")).alias("_name"), *carried,
    )
    return rows.mapInArrow(_sizes, T.StructType([*rows.schema.fields[1:], T.StructField("size", T.LongType())]))


def targets(units: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """(_absent, _name, source_size, target, times, budget) of every source; ``times`` all its documents, ``budget`` words beyond."""
    by_source = units.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    placed = global_row_number(by_source, [F.col(c) for c in SOURCE], "_place")
    turn = F.array(*map(F.lit, weights))
    sources = materialize(
        placed.select(*SOURCE, "source_size", F.element_at(turn, (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight")),
        "mix-sources",
    )
    upper, lower = share
    wide = "decimal(38,0)"

    def above(part: int, rest: int) -> Column:
        """Whether the weight's part of ``part`` / (lower * rest) words exceeds what the source may give."""
        return F.col("weight").cast(wide) * F.lit(part).cast(wide) > F.col("source_size").cast(wide) * F.lit(most * lower * rest).cast(wide)

    whole, rest = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    whole, rest = int(whole or 0), int(rest or 0)
    part, capped = upper * whole, 0
    while rest:  # each round takes the excess from the sources above and deals it anew
        full = F.when(above(part, rest), True)
        n, words, weight = sources.agg(
            F.count(full), F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(full, F.col("weight")))
        ).first()
        if n == capped:
            break
        capped = n
        total = sources.agg(F.sum("weight")).first()[0]
        part, rest = upper * whole - lower * most * int(words), int(total) - int(weight)
    is_full = above(part, rest) if rest else F.lit(True)
    even = F.col("weight").cast("double") * F.lit(float(part)) / F.lit(float(lower * rest or 1))
    target = F.when(is_full, F.col("source_size").cast("double") * most).otherwise(even)
    times = F.when(is_full, F.lit(most)).when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0)
    return (
        sources.withColumn("target", target).withColumn("times", times.cast("bigint"))
        .withColumn("budget", F.greatest(F.col("target") - F.col("times") * F.col("source_size"), F.lit(0.0)))
        .drop("weight")
    )


def _served(docs: DataFrame, carried: Sequence[Column], weights, share, most, seed: int) -> DataFrame:
    """``sized`` rows with source_size, target and ``times``, how often the mix takes each document."""
    units = materialize(  # fixes the tags that tell equal rows apart
        sized(docs, carried).withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "size", *SOURCE))
        .withColumn("_tag", F.monotonically_increasing_id()),
        "mix-sizes",
    )
    sources = targets(units, weights, share, most)
    key = [*SOURCE, "size"]
    placed = global_row_number(units, [F.col(c) for c in (*key, "_hash", "_tag")], "_position")
    lengths = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("count"), F.min("_position").alias("_first"))
    known = lengths.join(sources, SOURCE)
    schema = T.StructType([*known.schema.fields, T.StructField("more", T.LongType())])
    fitted = materialize(known.groupBy(*SOURCE).applyInArrow(_fit, schema), "mix-lengths")
    first = [F.first(c).alias(c) for c in ("_first", "source_size", "target", "times", "more")]
    return placed.join(one_per_key(fitted, key, *first), key).withColumn(
        "times", F.col("times") + (F.col("_position") - F.col("_first") < F.col("more")).cast("bigint")
    )


def plan(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of every document: ``taken`` words of it are in the mix, repeats counted."""
    served = _served(docs, (), weights, share, most, seed)
    return served.select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"),
        F.when(~F.col("_absent"), F.col("_name")).alias("source"),
    )


def mixed(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of the mix: those of ``docs``, each as often as it is taken. Documents without words are in no mix."""
    served = _served(docs, [whole_row(docs).alias("_row")], weights, share, most, seed)
    taken = served.filter((F.col("times") > 0) & (F.col("size") > 0))
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("_row.*")
