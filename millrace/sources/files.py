"""File scans. Every scan is lazy, splittable and runs on the executors."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.records import scan_records

Schema = T.StructType | str


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: Schema | None = None, *, trim: bool = False
) -> DataFrame:
    """CSV with a header. Without ``schema`` the types are inferred (a second pass).

    ``trim`` drops blanks around unquoted values. Short and long rows are kept
    (PERMISSIVE): missing fields become null, surplus ones are ignored.
    """
    reader = spark.read.options(
        header=True, mode="PERMISSIVE", ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim
    )
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def scan_tsv(spark: SparkSession, path: str, names: Sequence[str], *, quote: str = "") -> DataFrame:
    """Tab-separated text without header; columns are strings named ``names``.

    Quoting is off by default: in free text a quote is just a character.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(schema).csv(path, sep="\t", quote=quote)


def scan_csv_skip(spark: SparkSession, path: str, skip: int, schema: Schema | None = None) -> DataFrame:
    """CSV whose files start with ``skip`` preamble lines and then a header line.

    Every file keeps its splits, also where quoted values hold line ends (see ``records``). The header of each file is
    compared with that of the first; another one is an error, never shifted values. Empty lines are no
    rows. Without ``schema`` all columns are strings, named by the header.
    """
    head = [r["value"] for r in spark.read.text(path, lineSep="\n").take(skip + 1)]  # of the first file
    if len(head) <= skip:
        raise ValueError(f"no header after {skip} lines in {path}")
    header = head[skip].rstrip("\r")
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"}
    if schema is None:
        names = spark.createDataFrame([(header,)], "value string").select(
            F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(header.count(",") + 1)), options).alias("r")
        )
        fields = [v for v in names.first()["r"] if v is not None]
        schema = T.StructType([T.StructField(name.strip(), T.StringType()) for name in fields])
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    return scan_records(spark, path, skip, header).select(F.from_csv("value", ddl, options).alias("row")).select("row.*")


def scan_json(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """JSON lines. Inferred columns come back in alphabetical order; absent keys are null."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def scan_libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """libsvm text to (label, features vector). The width is given, not inferred."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def scan_glob(spark: SparkSession, paths: str | list[str], schema: Schema) -> DataFrame:
    """All CSV files of a glob in one scan; a header unlike the schema is an error."""
    return spark.read.schema(schema).options(header=True, enforceSchema=False).csv(paths)


def scan_layouts(spark: SparkSession, layouts: Mapping[str, Schema]) -> DataFrame:
    """One scan per file layout (glob -> schema), appended with columns aligned by name."""
    return union_all([scan_glob(spark, glob, schema) for glob, schema in layouts.items()])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Append frames by column name; a column absent from one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_source_key(df: DataFrame, name: str, value) -> DataFrame:
    """Tag every row with a literal key of its source."""
    return df.withColumn(name, F.lit(value))


def with_file_key(df: DataFrame, name: str, pattern: str, group: int = 1) -> DataFrame:
    """Tag every row with a key taken from its file's path, for scans of many sources."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def from_rows(spark: SparkSession, rows: Sequence, schema: Schema | Sequence[str]) -> DataFrame:
    """Small literal table."""
    return spark.createDataFrame(rows, schema)


def coerce(df: DataFrame, types: Mapping[str, str], fill=0) -> DataFrame:
    """Cast columns, turning what is missing or unreadable into ``fill`` where that can be of the type, else null.

    Whole-number targets are read as numbers first, so '12.7' becomes 12. Text, dates, times and
    truth values have no number to fill in and stay null.
    """

    def cast(name: str, target: str) -> Column:
        source = F.col(f"`{name}`")
        kind = target.lower()
        if kind in ("int", "bigint", "long", "integer", "smallint", "tinyint"):
            exact = source.try_cast(target)
            return F.coalesce(exact, source.try_cast("double").try_cast(target), F.lit(fill).cast(target))
        if kind in ("double", "float", "real") or kind.startswith("decimal"):
            return F.coalesce(source.try_cast(target), F.lit(fill).cast(target))
        return source.try_cast(target)

    return df.withColumns({name: cast(name, target) for name, target in types.items()})


def range_source(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Integers from ``start`` up to but not including ``end``, in column ``id``."""
    return spark.range(start, end)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt out evenly to ``partitions`` tasks, for work heavy on the processor after a scan of few splits."""
    return df.repartition(partitions)
