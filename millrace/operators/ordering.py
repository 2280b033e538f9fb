"""Operators over one total order of a whole table, without a one-task window.

A window with no PARTITION BY puts every row in one task. Here the rows are
range-partitioned instead, each range is numbered or summed on its own, and only
one small row per range (never per input row) meets in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import place_among
from millrace.workspace import materialize

_PART = "_part"


# Rows of a range, about; Spark cuts the ranges by a sample, so one may hold up to twice as many.
RANGE_ROWS = 2_000_000


def _ranged(df: DataFrame, order: Sequence, label: str) -> DataFrame:
    """Rows tagged with the ordinal of their range; stored, so the tags stay put.

    The rows are stored as they come and counted there: the number of ranges follows them, whatever the session's settings, and
    neither the count nor the sample that cuts the ranges runs the plan of ``df`` again.
    """
    stored = materialize(df, f"{label}-rows")
    ranges = max(1, math.ceil(stored.count() / RANGE_ROWS))
    return materialize(stored.repartitionByRange(ranges, *order).withColumn(_PART, F.spark_partition_id()), label)


def running_total(df: DataFrame, order: Sequence[Column], value: Column, output: str) -> DataFrame:
    """Running sum of ``value`` over the whole table in ``order`` (current row included).

    ``order`` must tell all rows apart, else rows that tie have no order and one
    value could fill a whole range.
    """
    ranged = _ranged(df.withColumn("_value", value), order, "running-total")
    by_part = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per range
        ranged.groupBy(_PART)
        .agg(F.sum("_value").alias("_sum"))
        .select(_PART, F.coalesce(F.sum("_sum").over(by_part), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("_inside", F.sum("_value").over(inside))
        .join(F.broadcast(offsets), _PART)
        .withColumn(output, F.col("_before") + F.col("_inside"))
        .drop(_PART, "_value", "_inside", "_before")
    )


def global_row_number(df: DataFrame, order: Sequence[Column], output: str) -> DataFrame:
    """Position of each row in the order of the whole table, from 1."""
    return running_total(df, order, F.lit(1).cast("bigint"), output)


_BINS = 1024
_FEW = 10_000
_SKETCH = 4096  # size of the sketch of a column
_MARGIN = 0.0015  # twice the error of its ranks


def quantile_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], more: Sequence[Column] = ()
) -> tuple[dict[tuple[str, float], float | None], Row]:
    """Exact linearly interpolated quantiles by (column, p), None for a column without values; and the row of ``more`` aggregates.

    The built-in exact percentile keeps every distinct value of a column in one task. Here
    the first scan makes a mergeable sketch of each column (and the aggregates of ``more``), which gives a bracket of
    values around each wanted rank. The second counts the values below the brackets and lists those within, if they
    are ``_FEW``, else counts them in ``_BINS`` parts; then further scans go on with the part that holds the rank. A rank that its sketch missed is
    searched where it is, so the result is exact in any case. Tasks and driver see counts of parts only, whatever the
    data; nothing is written. Nulls and NaN are ignored.
    """
    numbers = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns]
    ends = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-_MARGIN, _MARGIN)})
    sketch = [F.call_function("kll_sketch_agg_double", v, F.lit(_SKETCH)) for v in numbers]
    found = df.agg(*more, *[
        f.alias(f"_{name}{c}") for c, v in enumerate(numbers)
        for name, f in (("n", F.count(v)), ("low", F.min(v)), ("high", F.max(v)), ("at", sketch[c]))
    ]).withColumns({f"_at{c}": F.when(F.col(f"_n{c}") > 0, F.call_function("kll_sketch_get_quantile_double", f"_at{c}", F.array(*map(F.lit, ends)))) for c in range(len(columns))}).first()
    first = {c: {name: found[f"_{name}{i}"] for name in ("n", "low", "high", "at")} for i, c in enumerate(columns)}
    whole = {c: own for c, own in first.items() if own["n"]}
    cells = []
    for c, v in zip(columns, numbers):
        if c not in whole:
            continue
        cuts = sorted(set(whole[c]["at"]))
        held = set()  # cells within the bracket of a rank
        for p in probabilities:
            low, high = (whole[c]["at"][ends.index(min(1.0, max(0.0, p + d)))] for d in (-_MARGIN, _MARGIN))
            held |= {j for j in range(1, len(cuts)) if cuts[j - 1] >= low and cuts[j] <= high}
        cell = place_among(v, cuts)
        edges = F.array(*[F.lit(x) for x in [whole[c]["low"], *cuts]])
        part = v
        if 2 * _MARGIN * whole[c]["n"] > _FEW:
            low, high = F.get(edges, cell), F.get(edges, cell + 1)
            part = F.floor(F.least(F.try_divide(v / 2 - low / 2, high / 2 - low / 2), F.lit(1.0)) * (_BINS - 1)).cast("double")
        cut = v.isin(cuts)  # a value that many rows share is its own bracket
        part = F.when(cut, v).when(cell.isin(sorted(held)), part)
        cells.append(F.struct(F.lit(c).alias("column"), v.alias("value"), cell.alias("cell"), cut.alias("cut"), part.alias("part")))
    brackets: dict[tuple[str, int], tuple[float, float, int, int]] = {}  # bounds, values below, values inside
    ranks = {(c, rank) for c in whole for p in probabilities for at in [p * (whole[c]["n"] - 1)] for rank in (math.floor(at), math.ceil(at))}
    if cells:
        counted = (
            df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull()).groupBy("column", "cell", "cut", "part")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most")).collect()
        )
        for c in whole:
            below = 0
            for least, most, n in sorted((r["least"], r["most"], r["n"]) for r in counted if r["column"] == c):
                brackets |= {(c, rank): (least, most, below, n) for x, rank in ranks if x == c and below <= rank < below + n}
                below += n
    values = df.select(*[v.alias(c) for c, v in zip(columns, numbers)]).unpivot([], list(columns), "column", "value").filter(F.col("value").isNotNull())
    places: dict[tuple[str, int], float] = {}
    while brackets:
        for key, (low, high, _, _) in list(brackets.items()):
            if low == high:
                places[key] = low
                del brackets[key]
        spans = sorted({(c, low, high, below, n) for (c, _), (low, high, below, n) in brackets.items()})
        if not spans:
            break
        table = df.sparkSession.createDataFrame(spans, "column string, low double, high double, below bigint, n bigint")
        inside = values.join(F.broadcast(table), "column").filter(F.col("value").between(F.col("low"), F.col("high")))
        few = F.col("n") <= _FEW
        # Halves are scaled first, so that the width of a bracket cannot overflow.
        share = (F.col("value") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        part = F.when(few, F.col("value")).otherwise(F.floor(F.least(share, F.lit(1.0)) * (_BINS - 1)).cast("double"))
        counted = inside.groupBy("column", "low", "high", "below", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most")).collect()
        parts: dict[tuple, list] = {}
        for r in counted:
            parts.setdefault((r["column"], r["low"], r["high"], r["below"]), []).append((r["least"], r["most"], r["n"]))
        for key, (low, high, below, _) in list(brackets.items()):
            for least, most, n in sorted(parts[key[0], low, high, below]):
                if key[1] < below + n:
                    brackets[key] = (least, most, below, n)
                    break
                below += n
    out: dict[tuple[str, float], float | None] = {}
    for column in columns:
        for p in probabilities:
            out[column, p] = None
            if column in whole:
                at = p * (whole[column]["n"] - 1)
                low, high = places[column, math.floor(at)], places[column, math.ceil(at)]
                out[column, p] = low + (high - low) * (at - math.floor(at))
    return out, found


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Rows (column, p, value) of ``quantile_values``."""
    found, _ = quantile_values(df, columns, probabilities)
    return df.sparkSession.createDataFrame([(c, float(p), v) for (c, p), v in found.items()], "column string, p double, value double")
