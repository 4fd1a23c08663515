"""Queries by name, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its timestamps come out as text, as in the SQL."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text: 9999-12-31 does not fit every client's timestamp."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    return df.withColumns({c: F.col(c).cast("string") for c in times}) if times else df
