"""Names the runnable queries and keeps their SQL twins beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_TWINS: dict[str, str] = {}


class Tables:
    """The input tables of one folder, read on first use: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name`` with its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(apply_settings(spark), folder))

        run.__name__ = name
        run.__doc__ = build.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _TWINS[name] = sql
        return build

    return register


def all_queries() -> dict[str, Query]:
    import millrace.queries  # noqa: F401  (importing registers the queries)

    return dict(_QUERIES)


def all_twins() -> dict[str, str]:
    import millrace.queries  # noqa: F401

    return dict(_TWINS)
