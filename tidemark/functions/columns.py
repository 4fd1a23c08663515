"""Column builders: instants, row hashes, value maps, SCD2 columns, renames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import broadcast_if_small

# Names and open end of the history columns.
START = "start_column"
END = "end_date"
CURRENT = "Iscurrent"
HASH = "hash"
SOURCE = "Source_column"
BATCH = "batch_id"
OPEN_END = "9999-12-31 00:00:00"


def instant(value: Column | datetime | str) -> Column:
    """A timestamp column from a column, a datetime or text."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns joined with ``|``; NULLs are left out of the text."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256)


def value_map(column: str | Column, values: Mapping[str, str], default: str | None) -> Column:
    """CASE over a fixed map; values outside it and NULL give ``default``."""
    column = F.col(column) if isinstance(column, str) else column
    chain = F
    for key, value in values.items():
        chain = chain.when(column == F.lit(key), F.lit(value))
    return F.lit(default) if chain is F else chain.otherwise(F.lit(default))


def map_by_table(
    df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, out: str, default: str
) -> DataFrame:
    """The same map held as rows: ``mapping`` has one row per ``key``."""
    pairs = mapping.select(F.col(key).alias("_map_key"), F.col(value).alias("_map_value"))
    joined = df.join(broadcast_if_small(pairs), F.col(column) == F.col("_map_key"), "left")
    mapped = F.when(F.col("_map_key").isNull(), F.lit(default)).otherwise(F.col("_map_value"))
    return joined.withColumn(out, mapped).drop("_map_key", "_map_value")


def with_scd2(
    df: DataFrame,
    hash_columns: Sequence[str],
    as_of: Column | datetime | str,
    *,
    current: bool = True,
    source: str | None = None,
    batch_id: int | Column | None = None,
) -> DataFrame:
    """Add start, open end, current flag and row hash; source and batch when given.

    Staged increments carry no current flag: pass ``current=False`` for them.
    """
    added: dict[str, Column] = {
        START: instant(as_of),
        END: instant(OPEN_END),
        HASH: row_hash(hash_columns),
    }
    if current:
        added[CURRENT] = F.lit(1).cast("int")
    if batch_id is not None:
        added[BATCH] = (batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).cast("int")
    if source is not None:
        added[SOURCE] = F.lit(source).cast("string")
    return df.withColumns(added)


def rename_select(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Keep and rename: one ``(source, target)`` pair per output column."""
    return df.select([F.col(source).alias(target) for source, target in pairs])


def mapping_pairs(mapping: DataFrame, table: str, table_column: str = "target_table") -> list[tuple[str, str]]:
    """The active ``(source_column, destination_column)`` pairs of one table.

    ``mapping`` is the control table that describes columns, so its rows for one
    table number no more than the table's columns. Table names are compared
    trimmed. Keys come first, then by destination name; a destination named
    twice is an error.
    """
    rows = (
        mapping.where((F.trim(table_column) == F.lit(table.strip())) & (F.col("is_active") == 1))
        .select("source_column", "destination_column", "is_key")
        .distinct()
        .orderBy(F.col("is_key").desc(), "destination_column", "source_column")
        .collect()
    )
    targets = [r["destination_column"].lower() for r in rows]
    if len(set(targets)) != len(targets):
        raise ValueError(f"two sources map to one column of {table}")
    return [(r["source_column"], r["destination_column"]) for r in rows]


def project_by_mapping(df: DataFrame, mapping: DataFrame, table: str) -> DataFrame:
    """Project ``df`` with the pairs that the mapping table holds for ``table``."""
    pairs = mapping_pairs(mapping, table)
    if not pairs:
        raise ValueError(f"no active mapping rows for {table}")
    return rename_select(df, pairs)


__all__ = [
    "BATCH", "CURRENT", "END", "HASH", "OPEN_END", "SOURCE", "START",
    "instant", "map_by_table", "mapping_pairs", "project_by_mapping", "rename_select",
    "row_hash", "value_map", "with_scd2",
]
