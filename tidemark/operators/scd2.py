"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import CURRENT, END, HASH, OPEN_END, START, instant
from tidemark.operators.changes import current_rows, equal_keys
from tidemark.operators.dedup import first_per_key, newest_per_key
from tidemark.operators.merge import Matched, NotMatched, merge_into


def null_key_rows(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that cannot be merged because a key column is NULL."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return batch.where(cond)


@dataclass(frozen=True)
class Scd2Parts:
    """A dimension after a batch, in two parts that do not overlap."""

    closed: DataFrame
    """Rows closed before, and rows without a key: carried over as they are."""
    open: DataFrame
    """Rows that were open (still open, or expired by this batch) and the versions it opens."""

    def rows(self) -> DataFrame:
        return self.closed.unionByName(self.open)


def scd2_parts(
    dim: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    as_of: Column | datetime | str,
    *,
    newest_by: Sequence[str] = ("load_date",),
) -> Scd2Parts:
    """Apply one batch. Running the same batch again changes nothing.

    The newest row per key counts, ties broken by hash; NULL keys are left out
    (see ``null_key_rows``). Hashes compare null-safe. Keys absent from the batch
    stay open. Open rows and batch are read once: a full outer join on the keys meets each
    key's old row and its new one, and gives back one or both. Open rows are shuffled, so a
    large dimension is laid out by key buckets (``plans.dimension``), of which only those
    that the batch touches come here.
    """
    order = [c for c in newest_by if c in batch.columns]
    has_keys = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    latest = newest_per_key(batch.where(has_keys), keys, [*order, HASH])
    now = instant(as_of)

    # A key has one open row. Where it has several, its new version comes with the first.
    by_key = Window.partitionBy(*keys).orderBy(HASH)
    of_key = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = current_rows(dim).where(has_keys).withColumns(
        {"_nth": F.row_number().over(by_key), "_open": F.collect_set(F.struct(F.col(HASH).alias("h"))).over(of_key)}
    )
    joined = known.alias("d").join(latest.alias("b"), equal_keys(keys, "d", "b"), "full_outer")
    was, comes = F.col(f"d.{keys[0]}").isNotNull(), F.col(f"b.{keys[0]}").isNotNull()
    expired = comes & ~F.col(f"d.{HASH}").eqNullSafe(F.col(f"b.{HASH}"))
    replaced = {END.lower(): now, CURRENT.lower(): F.lit(0)}
    old = F.struct(
        *[
            F.when(expired, replaced[f.name.lower()].cast(f.dataType)).otherwise(F.col(f"d.{f.name}")).alias(f.name)
            if f.name.lower() in replaced
            else F.col(f"d.{f.name}").alias(f.name)
            for f in dim.schema.fields
        ]
    )
    given = {c.lower(): F.col(f"b.{c}") for c in batch.columns}
    given |= {START.lower(): now, END.lower(): instant(OPEN_END), CURRENT.lower(): F.lit(1)}
    new = F.struct(
        *[given.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    held = F.exists("d._open", lambda x: x["h"].eqNullSafe(F.col(f"b.{HASH}")))
    opens = comes & (~was | ((F.col("d._nth") == 1) & ~held))
    both = F.array_compact(F.array(F.when(was, old), F.when(opens, new)))
    after = joined.select(F.explode(both).alias("row")).select("row.*")
    closed = dim.where(~F.col(CURRENT).eqNullSafe(F.lit(1)) | ~F.expr(has_keys))
    return Scd2Parts(closed, after)


def scd2_batch(
    dim: DataFrame, batch: DataFrame, keys: Sequence[str], as_of: Column | datetime | str, **options
) -> DataFrame:
    """All rows of the dimension after one batch; options as in ``scd2_parts``."""
    return scd2_parts(dim, batch, keys, as_of, **options).rows()


def scd2_single_merge(
    dim: DataFrame, source: DataFrame, keys: Sequence[str], as_of: Column | datetime | str
) -> DataFrame:
    """One pass of the one-statement merge.

    Expires current rows whose hash differs and inserts keys without a current
    row, leaving the end of inserted rows NULL. The new version of an expired row
    follows only when the merge runs again.
    """
    now = instant(as_of)
    fixed = {START.lower(), END.lower(), CURRENT.lower()}
    values = {c: F.col(f"s.{c}") for c in source.columns if c.lower() not in fixed}
    values |= {START: now, CURRENT: F.lit(1)}
    return merge_into(
        dim,
        source,
        keys,
        target_condition=F.col(f"t.{CURRENT}") == 1,
        matched=[
            Matched(
                condition=F.col(f"t.{HASH}") != F.col(f"s.{HASH}"),
                set={END: now, CURRENT: F.lit(0)},
            )
        ],
        not_matched=[NotMatched(values=values)],
    )


def drop_expired(dim: DataFrame) -> DataFrame:
    """Remove rows flagged as no longer current; a NULL flag stays."""
    return dim.where(~F.coalesce(F.col(CURRENT) == 0, F.lit(False)))


def reopen(dim: DataFrame, where: Column) -> DataFrame:
    """Flag the rows that meet ``where`` as current again."""
    flag = F.when(F.coalesce(where, F.lit(False)), F.lit(1)).otherwise(F.col(CURRENT))
    return dim.withColumn(CURRENT, flag.cast(dim.schema[CURRENT].dataType))


def dedup_versions_of(dim: DataFrame, where: Column, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key and hash among the rows that meet ``where``.

    The other rows stay as they are, those for which ``where`` is NULL included.
    """
    chosen = F.coalesce(where, F.lit(False))
    fixed = first_per_key(dim.where(chosen), [*keys, HASH], [START])
    return fixed.unionByName(dim.where(~chosen))
