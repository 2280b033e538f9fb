"""Session settings of the text operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.session import apply_settings

# Rows of whole texts differ in size by orders of magnitude, so an Arrow batch is kept to
# few rows; where Spark knows a bound in bytes, that holds as well.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def tuned(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
