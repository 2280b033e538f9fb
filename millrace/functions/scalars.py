"""Named column expressions over strings, numbers and dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_parts(ts: Column) -> dict[str, Column]:
    """Calendar parts of a timestamp; the week number is ISO."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_year": F.dayofyear(ts),
        "week": F.weekofyear(ts),
        "hour": F.hour(ts),
    }


def number_text(value: Column, digits: int = 2) -> Column:
    """Thousands separators and fixed decimals."""
    return F.format_number(value, digits)


def json_field(column: Column, field: str, data_type: str) -> Column:
    """A field of a JSON message; null where the message is malformed or lacks it."""
    return F.from_json(column, f"`{field}` {data_type}").getField(field)


def has_keyword(text: Column, *keywords: str) -> Column:
    """Whether the text names one of the keywords, ignoring case."""
    lowered = F.lower(text)
    found = [F.contains(lowered, F.lit(k.lower())) for k in keywords]
    result = found[0]
    for condition in found[1:]:
        result = result | condition
    return result


def place_among(value: Column, points: Sequence[float]) -> Column:
    """Number of sorted ``points`` below a value, by a balanced search in plain comparisons."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(float(points[middle])), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(points))
