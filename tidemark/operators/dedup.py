"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool) -> DataFrame:
    lowered = {k.lower() for k in keys}
    lead = [c for c in order_by if c.lower() not in lowered]
    led = lowered | {c.lower() for c in lead}
    rest = [
        f.name for f in df.schema.fields if f.name.lower() not in led and not isinstance(f.dataType, _UNORDERED)
    ]
    if set(map(str.lower, df.columns)) == lowered:
        return df.distinct()
    order = [F.col(c).desc() if last else F.col(c).asc() for c in [*lead, *rest]] or [F.lit(0)]
    # Spark keeps the first row per key of each task before the shuffle (window
    # group limit), so a key that holds a third of the rows sends one row per task.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") == 1).drop("_nth")


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the row that sorts first by ``order_by``, ties settled by the other columns."""
    return _one_per_key(df, keys, order_by, last=False)


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the row that sorts last by ``order_by``, ties settled by the other columns."""
    return _one_per_key(df, keys, order_by, last=True)
