"""Row set operations by column name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_master(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, matched by name; absent columns become NULL."""
    first, *others = sources
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def fix_part(df: DataFrame, where: Column, fix: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``fix`` to the rows that meet ``where`` and keep all other rows.

    Rows for which ``where`` is NULL belong to the others.
    """
    chosen = F.coalesce(where, F.lit(False))
    return fix(df.where(chosen)).unionByName(df.where(~chosen))
