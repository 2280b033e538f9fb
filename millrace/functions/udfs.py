"""User-defined functions, for what no built-in expresses.

Each of these has a native form, which jobs should prefer: a UDF ends code
generation and hides its column from pushdown.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType

# Factors of the two unit conversions.
WEIGHT_FACTOR = 0.45
MILEAGE_FACTOR = 0.425


def scaled(factor: float):
    """Vectorised UDF multiplying by ``factor``; the result is single precision."""

    @F.pandas_udf(FloatType())
    def scale(values: pd.Series) -> pd.Series:
        return values * factor

    return scale


def scaled_native(column: Column, factor: float) -> Column:
    """What ``scaled`` computes, without Python."""
    return (column * F.lit(factor)).cast("float")


@F.arrow_udf(LongType())
def doubled(values: pa.Array) -> pa.Array:
    """Twice a whole number; 64 bits wide, so totals past 2^30 do not overflow."""
    return pc.multiply(values.cast(pa.int64()), 2)


@F.arrow_udf(IntegerType())
def token_count(tokens: pa.Array) -> pa.Array:
    """Length of a token list, a batch at a time; ``size`` is the native form, which ships no tokens."""
    return pc.list_value_length(tokens)


def register_udfs(spark: SparkSession) -> None:
    """Make the UDFs callable from SQL."""
    spark.udf.register("convert_weight", scaled(WEIGHT_FACTOR))
    spark.udf.register("convert_mileage", scaled(MILEAGE_FACTOR))
    spark.udf.register("double_whole", doubled)
    spark.udf.register("count_tokens", token_count)
