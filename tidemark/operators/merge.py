"""MERGE as DataFrame joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import equal_keys
from tidemark.session import stored


class AmbiguousMerge(ValueError):
    """Several source rows would modify one target row."""


@dataclass(frozen=True)
class Matched:
    """WHEN MATCHED [AND condition] THEN UPDATE SET ... or DELETE.

    Columns are written ``t.name`` for the target and ``s.name`` for the source.
    """

    condition: Column | None = None
    set: Mapping[str, Column] = field(default_factory=dict)
    delete: bool = False


@dataclass(frozen=True)
class NotMatched:
    """WHEN NOT MATCHED [AND condition] THEN INSERT; columns left out become NULL."""

    values: Mapping[str, Column]
    condition: Column | None = None


def _either(clauses: Sequence[Matched]) -> Column:
    met = F.lit(False)
    for c in clauses:
        met = met | (F.lit(True) if c.condition is None else F.coalesce(c.condition, F.lit(False)))
    return met


# Source rows of a key that are tried before all of them.
_FIRST = 8


def _counted(df: DataFrame, name: str) -> DataFrame:
    """Equal rows as one with their number, summed up in each task before the shuffle."""
    if any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields):
        return df.withColumn(name, F.lit(1).cast("bigint"))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def _check_unambiguous(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on: Column, touches: Column
) -> None:
    """Raise if several source rows modify one target row.

    Copies count and do not meet each other: a target row is ambiguous by the number of a
    single source row, or by two different ones. A few source rows of each key are tried
    first, which finds what is ambiguous without looking at a long list of them.
    """
    repeated = (
        source.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    )
    if repeated.isEmpty():
        return
    doubled = stored(_counted(source.join(repeated, list(keys), "left_semi"), "_copies"), "merge-source")
    candidates = target.join(repeated, list(keys), "left_semi").select(*target.columns)
    # Row ids are written with the rows: a task that runs again sees the same ids.
    numbered = _counted(candidates, "_rows").withColumn("_row", F.monotonically_increasing_id())
    numbered = stored(numbered, "merge-check")

    def ambiguous(some: DataFrame) -> bool:
        hits = numbered.alias("t").join(some.alias("s"), on & touches, "inner").groupBy("t._row").agg(
            F.sum("s._copies").alias("n")
        )
        return not hits.where(F.col("n") > 1).isEmpty()

    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_copies").desc()))
    first = doubled.withColumn("_nth", nth).where(F.col("_nth") <= _FIRST).drop("_nth")
    if ambiguous(first) or ambiguous(doubled):
        raise AmbiguousMerge(f"several source rows modify one target row; keys {list(keys)}")


def merge_into(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    matched: Sequence[Matched] = (),
    not_matched: Sequence[NotMatched] = (),
    target_condition: Column | None = None,
) -> DataFrame:
    """The rows of ``target`` after merging ``source`` into it.

    Rows match on equal ``keys`` where ``target_condition`` (written with ``t.``)
    holds; the other target rows take no part in the joins. The first clause whose
    condition holds applies. A left join carries the update, so a small source is
    broadcast and the target is not shuffled; an anti join finds the rows to insert.
    """
    on = equal_keys(keys, "t", "s")
    open_rows, other_rows = target, None
    if target_condition is not None:
        met = F.coalesce(target_condition, F.lit(False))
        open_rows = target.alias("t").where(target_condition)
        other_rows = target.alias("t").where(~met)
    out = target

    if matched:
        touches = _either(matched)
        _check_unambiguous(open_rows, source, keys, on, touches)
        marked = source.withColumn("_hit", F.lit(True)).alias("s")
        joined = open_rows.alias("t").join(marked, on & touches, "left")
        action = F.lit(None).cast("int")
        for i, clause in reversed(list(enumerate(matched))):
            holds = F.lit(True) if clause.condition is None else F.coalesce(clause.condition, F.lit(False))
            action = F.when(holds, F.lit(i)).otherwise(action)
        joined = joined.withColumn("_action", F.when(F.col("s._hit"), action))
        deletes = [i for i, c in enumerate(matched) if c.delete]
        if deletes:
            joined = joined.where(~F.coalesce(F.col("_action").isin(deletes), F.lit(False)))
        columns = []
        for f in target.schema.fields:
            value = F.col(f"t.{f.name}")
            for i, clause in enumerate(matched):
                for name, new in clause.set.items():
                    if name.lower() == f.name.lower():
                        value = F.when(F.col("_action") == i, new.cast(f.dataType)).otherwise(value)
            columns.append(value.alias(f.name))
        out = joined.select(*columns)
        if other_rows is not None:
            out = out.unionByName(other_rows)

    if not_matched:
        # Only keys that the source holds go into the anti join.
        hits = open_rows.select(*keys).join(source.select(*keys), list(keys), "left_semi")
        rest = source.join(hits, list(keys), "left_anti").select(*source.columns)
        for clause in not_matched:
            chosen = rest
            if clause.condition is not None:
                holds = F.coalesce(clause.condition, F.lit(False))
                chosen = rest.alias("s").where(holds)
                rest = rest.alias("s").where(~holds)
            given = {name.lower(): value for name, value in clause.values.items()}
            inserted = chosen.alias("s").select(
                *[
                    given.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in target.schema.fields
                ]
            )
            out = out.unionByName(inserted)
    return out
