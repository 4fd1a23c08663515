"""CSV and JSON files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def all_strings(columns: Sequence[str]) -> T.StructType:
    """A schema of nullable text columns."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row, every column as text.

    Naming the columns saves the read of the header before the job; files whose
    header names others are then refused.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(all_strings(columns))
    return reader.csv(path)


# Holds the text of a line that does not fit the columns.
BROKEN_LINE = "_broken_line"


def read_csv_with_broken(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header row, every column as text, and ``BROKEN_LINE``: NULL for lines that fit."""
    schema = T.StructType([*all_strings(columns).fields, T.StructField(BROKEN_LINE, T.StringType(), True)])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN_LINE).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A directory of JSON lines; without a schema one pass over the data infers it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a directory of JSON lines."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Append to a plain table addressed by its path."""
    df.write.mode("append").parquet(path)
