"""Loads of many tables driven by a control table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COPY_RESULT = "source string, target string, rows bigint, status string"


def load_from_config(
    spark: SparkSession,
    config: DataFrame,
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], None],
    *,
    source: str = "source",
    target: str = "target",
    parallel: int = 4,
) -> DataFrame:
    """Copy each configured source to its target, replacing contents and schema.

    Each copy is a Spark read and write; rows are counted while they are written.
    A failing copy is reported and does not stop the others. The result has one
    row per configured table, in their order by name.
    """
    # One small row for each table to copy, taken a partition at a time.
    listed = config.select(source, target).distinct().orderBy(source, target).toLocalIterator()

    def copy(row) -> tuple[str, str, int | None, str]:
        try:
            seen = Observation()
            df = read(row[source]).observe(seen, F.count(F.lit(1)).alias("rows"))
            write(df, row[target])
            return row[source], row[target], seen.get["rows"], "ok"
        except Exception as error:  # any reader or writer may be passed in
            return row[source], row[target], None, f"failed: {type(error).__name__}"

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(copy, listed))
    return spark.createDataFrame(results, COPY_RESULT)


def promote_landed(
    spark: SparkSession, directories: dict[str, str], write: Callable[[DataFrame, str], None]
) -> DataFrame:
    """Read each landed JSON directory and save it as the table of its name."""
    config = spark.createDataFrame(list(directories.items()), "target string, source string")
    return load_from_config(spark, config, lambda path: spark.read.json(path), write)
