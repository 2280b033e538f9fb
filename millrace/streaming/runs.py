"""Stream sources, finite runs and result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.workspace import fresh_path

Step = Callable[[DataFrame], DataFrame]


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Stream of a file, or of the files in a folder; ``max_files`` bounds a micro-batch.

    The path is given to Spark as a pattern (its last letter as a class of one),
    because a plain path must be a folder.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    return reader.load(path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]")


def stream_lines(spark: SparkSession, *, fmt: str = "text", **options: str) -> DataFrame:
    """Stream of text lines in ``value``: ``fmt`` is text, socket, kafka and so on."""
    return spark.readStream.format(fmt).options(**options).load().selectExpr("CAST(value AS STRING) AS value")


def run_to_table(
    stream: DataFrame,
    schema: T.StructType | str,
    *,
    mode: str,
    per_batch: Step | None = None,
    label: str = "stream",
    trigger: dict | None = None,
) -> str:
    """Run a stream over what is there and store each batch's rows; returns the table's path.

    Every micro-batch overwrites its own folder ``batch_id=N``, so a batch that is
    retried after a failure replaces its first try. ``per_batch`` transforms the
    batch as an ordinary DataFrame. Files and checkpoint lie in the shared folder.
    """
    spark = stream.sparkSession
    path = fresh_path(spark, label)
    spark.createDataFrame([], schema).write.parquet(f"{path}/batch_id=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        result = per_batch(batch) if per_batch else batch
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    running = (
        stream.writeStream.foreachBatch(store)
        .outputMode(mode)
        .option("checkpointLocation", fresh_path(spark, f"{label}-state"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    running.awaitTermination()
    return path


def stored_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All stored rows with their ``batch_id``."""
    return spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path).filter(F.col("batch_id") >= 0)


def run_append(stream: DataFrame, *, label: str = "stream") -> DataFrame:
    """Run a stateless stream into Parquet files (exactly once) and read them back."""
    spark = stream.sparkSession
    path = fresh_path(spark, label)
    running = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", fresh_path(spark, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
