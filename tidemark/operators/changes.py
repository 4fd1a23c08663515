"""Compare staged rows with a dimension by key and row hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import BATCH, CURRENT, HASH


def equal_keys(keys: Sequence[str], left: str, right: str) -> Column:
    """Equality of all key columns of two aliased sides."""
    first, *others = [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]
    for cond in others:
        first = first & cond
    return first


def current_rows(dim: DataFrame) -> DataFrame:
    """Rows flagged as the current version."""
    return dim.where(F.col(CURRENT) == 1)


def latest_batch(staged: DataFrame, batch: str = BATCH) -> DataFrame:
    """Rows of the highest batch number, found by a scalar subquery.

    A table partitioned by the batch column is pruned to that one partition.
    """
    return staged.where(F.col(batch) == staged.agg(F.max(batch)).scalar())


def change_types(
    staged: DataFrame, dim: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Staged rows with INSERT, UPDATE or NO_CHANGE against every matching ``dim`` row.

    A NULL hash on either side compares as NO_CHANGE. ``carry`` names columns of
    ``dim`` to bring along, prefixed ``dim_``. Pass ``current_rows(dim)`` to compare
    with open versions only; with all versions a key yields a row per version.
    """
    known = dim.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(HASH).alias("_dim_hash"),
        *[F.col(c).alias(f"dim_{c}") for c in carry],
    )
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & (staged[k] == known[f"_k{i}"])
    kind = (
        F.when(F.col("_k0").isNull(), "INSERT")
        .when(F.col(HASH) != F.col("_dim_hash"), "UPDATE")
        .otherwise("NO_CHANGE")
    )
    joined = staged.join(known, cond, "left").withColumn("change_type", kind)
    return joined.drop("_dim_hash", *[f"_k{i}" for i in range(len(keys))])


def changed_pairs(
    dim: DataFrame,
    staged: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Old and new values of keys whose current version differs in its hash."""
    d, s = current_rows(dim).alias("d"), staged.alias("s")
    differs = F.col(f"d.{HASH}") != F.col(f"s.{HASH}")
    shown = [c for c in compare if c.lower() != HASH] + [HASH]
    return d.join(s, equal_keys(keys, "d", "s") & differs, "inner").select(
        *[F.col(f"d.{k}").alias(k) for k in keys],
        *[F.col(f"d.{c}").alias(c) for c in keep],
        *[F.col(f"d.{c}").alias(f"old_{c}") for c in shown],
        *[F.col(f"s.{c}").alias(f"new_{c}") for c in shown],
    )


def delta_set(staged: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows whose key has no current version, or one with another hash."""
    s, d = staged.alias("s"), current_rows(dim).select(*keys, HASH).alias("d")
    fresh = F.col(f"d.{keys[0]}").isNull() | (F.col(f"s.{HASH}") != F.col(f"d.{HASH}"))
    return s.join(d, equal_keys(keys, "s", "d"), "left").where(fresh).select("s.*")


def new_keys(staged: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows whose key is nowhere in ``dim``; NULL keys count as new."""
    return staged.join(dim.select(*keys), list(keys), "left_anti").select(*staged.columns)


def not_current(staged: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Staged rows without an identical current version (same key and hash)."""
    s, d = staged.alias("s"), current_rows(dim).select(*keys, HASH).alias("d")
    same = equal_keys(keys, "s", "d") & (F.col(f"s.{HASH}") == F.col(f"d.{HASH}"))
    return s.join(d, same, "left_anti")
