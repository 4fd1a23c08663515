"""Row numbers and surrogate keys that stay distributed, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that one range of the order should hold, and most ranges; beyond it they grow.
ROWS_PER_RANGE = 2_000_000
MAX_RANGES = 512
# Rows of the sample for each cut point.
_SAMPLED = 32
# Copies of a row that one task writes at a time.
_COPIES = 100_000
_UNORDERED = (T.MapType, T.VariantType)

# (column, whether descending, type)
Order = Sequence[tuple[str, bool, T.DataType]]


def _literal(value: object, kind: T.DataType) -> Column:
    # A datetime without a zone would be read in the zone of the driver.
    text = isinstance(kind, T.TimestampNTZType)
    return F.lit(str(value) if text else value).cast(kind)


def _later(order: Order, cut: Row) -> Column:
    """Whether a row sorts after the cut point; NULL sorts first, last where descending."""
    later = F.lit(False)
    for (name, descending, kind), value in reversed(list(zip(order, cut, strict=True))):
        at = _literal(value, kind)
        if value is None:
            after, same = F.lit(False) if descending else F.col(name).isNotNull(), F.col(name).isNull()
        else:
            after = F.col(name).isNull() | (F.col(name) < at) if descending else F.col(name) > at
            same = F.col(name) == at
        later = F.coalesce(after, F.lit(False)) | (F.coalesce(same, F.lit(False)) & later)
    return later


def _equal(order: Order, cut: Row) -> Column:
    same = F.lit(True)
    for (name, _, kind), value in zip(order, cut, strict=True):
        same = same & F.col(name).eqNullSafe(F.lit(None) if value is None else _literal(value, kind))
    return same


def _cut_points(narrow: DataFrame, sort: Sequence[Column], rows: int, ranges: int) -> tuple[list[Row], list[bool]]:
    """Quantiles of the order from a sample of bounded size, and which of them are one row's many copies."""
    share = min(1.0, _SAMPLED * ranges / rows)
    sample = narrow.sample(share, seed=1).orderBy(*sort).collect()
    picked = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if len(sample) >= ranges else sample
    cuts, heavy = [], []
    for cut in picked:
        if cuts and cut == cuts[-1]:
            heavy[-1] = True
        else:
            cuts.append(cut)
            heavy.append(False)
    return cuts, heavy


def _range(order: Order, cuts: list[Row], heavy: list[bool]) -> Column:
    """Twice the number of cut points before a row; one more where it is a heavy cut point itself."""

    def among(low: int, high: int) -> Column:
        if low == high:
            if low < len(cuts) and heavy[low]:
                return F.lit(2 * low) + _equal(order, cuts[low]).cast("int")
            return F.lit(2 * low)
        middle = (low + high) // 2
        return F.when(_later(order, cuts[middle]), among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(cuts))


def _numbered(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], descending: Sequence[str], name: str, rows_per_range: int
) -> DataFrame:
    """Number the rows of each key 1..n; without keys, those of the whole table.

    The order is cut into ranges at literal points, so that the rows of one key, or of the
    table, are numbered in several tasks; what a key's earlier ranges hold is added. Rows
    equal in ``order_by`` follow a hash of the whole row, whatever the number of ranges.
    Copies of one row that fill a range of their own are counted, not sorted, and written
    out again in pieces. Nothing is written in between, so ``df`` is read more than once
    and must give the same rows each time.
    """
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, _UNORDERED)]
    order = [*[(c, c in descending, df.schema[c].dataType) for c in order_by], ("_tie", False, T.LongType())]
    sort = [F.col(c).desc() if down else F.col(c).asc() for c, down, _ in order]
    rows = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    count = df.count()
    ranges = min(MAX_RANGES, -(-count // rows_per_range))
    if ranges <= 1:
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
        return rows.withColumn(name, nth.cast("bigint")).drop("_tie")

    cuts, heavy = _cut_points(rows.select(*[c for c, _, _ in order]), sort, count, ranges)
    if len(hashed) < len(df.columns):
        heavy = [False] * len(cuts)
    rows = rows.withColumn("_range", _range(order, cuts, heavy))
    sizes = rows.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    if not keys:
        # At most two rows for each cut point.
        offsets = F.broadcast(offsets)

    def in_order(part: DataFrame, place: Column) -> DataFrame:
        same = F.col("p._range") == F.col("o._range")
        for k in keys:
            same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"o.{k}"))
        placed = part.withColumn("_nth", place).alias("p").join(offsets.alias("o"), same)
        return placed.select("p.*", F.col("o._offset"))

    number = (F.col("_offset") + F.col("_nth")).cast("bigint").alias(name)
    within = Window.partitionBy(*keys, "_range").orderBy(*sort)
    out = in_order(rows.where(F.col("_range") % 2 == 0), F.row_number().over(within)).select(*df.columns, number)
    if any(heavy):
        copies = rows.where(F.col("_range") % 2 == 1).groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
        before = F.sum("_copies").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_copies")
        pieces = in_order(copies, before).withColumn("_piece", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {_COPIES})")))
        each = F.expr(f"sequence(_piece * {_COPIES} + 1, least(_copies, (_piece + 1) * {_COPIES}))")
        spread = pieces.repartition(F.col("_tie"), F.col("_piece")).withColumn("_copy", F.explode(each))
        out = out.unionByName(spread.withColumn("_nth", F.col("_nth") + F.col("_copy")).select(*df.columns, number))
    return out


def with_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    start_after: int | Column = 0,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number all rows 1..n in the order of ``order_by``, after ``start_after``.

    Gives what one window over the whole table gives, without its single task.
    Equal values of ``order_by`` are numbered in an order of their own, the same each time.
    """
    numbered = _numbered(df, [], order_by, [], name, rows_per_range)
    after = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return numbered.withColumn(name, (F.col(name) + after).cast("bigint"))


def next_key_start(df: DataFrame, key: str) -> DataFrame:
    """One row: the highest key given out so far, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_key"))


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    name: str = "rn",
    descending: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Number the rows of each key 1..n in the order of ``order_by``.

    The columns named in ``descending`` are sorted that way. A key's rows are numbered by
    ranges of the order, so that one key may hold most of a table; ties come out alike however
    many ranges there are.
    """
    return _numbered(df, keys, order_by, descending, name, rows_per_range)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that break a primary key: repeated, or with a NULL part."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where((F.col("rows") > 1) | has_null)
        .withColumn("violation", F.when(has_null, "null_key").otherwise("duplicate_key"))
    )
