"""Dimensions laid out by current flag and by hash bucket of their key.

A batch rewrites the open rows of the buckets its keys fall into and of no others. Rows that
it closes are added to the closed part, whose files are not read. The number of buckets is
fixed when the table is made and recorded with the column; a bucket should hold what one task
can sort, so a dimension of 1 TB takes some thousand of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import CURRENT
from tidemark.operators.scd2 import scd2_parts
from tidemark.tables.versioned import VersionedTable

BUCKET = "key_bucket"
LAYOUT = [CURRENT, BUCKET]


def create_dimension(
    spark: SparkSession, root: str, schema: T.StructType | str, keys: Sequence[str], buckets: int, **options
) -> VersionedTable:
    """An empty dimension with the columns of ``schema`` and the bucket of ``keys``."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if CURRENT.lower() not in {f.name.lower() for f in schema.fields}:
        raise ValueError(f"a dimension needs the column {CURRENT}")
    made = T.StructField(BUCKET, T.IntegerType(), True, {"keys": list(keys), "buckets": buckets})
    table = VersionedTable(spark, root, partition_by=LAYOUT, **options)
    return table.create_empty(T.StructType([*schema.fields, made]))


def is_bucketed(dim: VersionedTable) -> bool:
    return [c.lower() for c in dim.partition_by] == [c.lower() for c in LAYOUT]


def dimension_rows(dim: VersionedTable) -> DataFrame:
    """The rows in the dimension's own columns."""
    return dim.read().drop(BUCKET)


def bucket(dim: VersionedTable) -> Column:
    """The bucket of a row, from its keys in the table's own types."""
    schema = dim.schema()
    made = schema[BUCKET].metadata
    keys = [F.col(k).cast(schema[k].dataType) for k in made["keys"]]
    return F.pmod(F.xxhash64(*keys), F.lit(made["buckets"])).cast("int")


def touched_buckets(dim: VersionedTable, batch: DataFrame) -> list[int]:
    """The buckets that the batch's keys fall into; at most as many as the table has."""
    return sorted(r[BUCKET] for r in batch.select(bucket(dim).alias(BUCKET)).distinct().collect())


def load(dim: VersionedTable, rows: DataFrame) -> int:
    """Add rows as they are, such as a first load with its history."""
    return dim.append(rows.withColumn(BUCKET, bucket(dim)))


def apply_to_buckets(dim: VersionedTable, batch: DataFrame, keys: Sequence[str], as_of, newest_by: Sequence[str]) -> int:
    """Apply a batch to the buckets it touches; the rows written."""
    if list(keys) != dim.schema()[BUCKET].metadata["keys"]:
        raise ValueError(f"the table is laid out by {dim.schema()[BUCKET].metadata['keys']}")
    parts = {CURRENT: [1], BUCKET: touched_buckets(dim, batch)}
    if not parts[BUCKET]:
        return 0
    after = scd2_parts(dim.read_parts(parts).drop(BUCKET), batch, keys, as_of, newest_by=newest_by).rows()
    # Each directory is written by few tasks, however the join has spread its rows.
    return dim.replace_parts("SCD2", parts, after.withColumn(BUCKET, bucket(dim)).hint("rebalance", *LAYOUT))
