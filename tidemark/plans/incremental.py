"""Loads by high-water mark, batch by batch, into a dimension with history."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import BATCH, CURRENT, with_scd2
from tidemark.operators.scd2 import scd2_parts
from tidemark.plans.dimension import apply_to_buckets, is_bucketed
from tidemark.plans.model import TableSpec
from tidemark.session import stored
from tidemark.tables.versioned import ConcurrentCommit, VersionedTable

# Fixed value: the mark of a table never loaded.
FIRST_MARK = "1900-01-01 00:00:00"
CONTROL_SCHEMA = "table_name string, last_watermark timestamp"


# -- watermarks -------------------------------------------------------------------


def seed_watermarks(tables: DataFrame, name: str = "table_name") -> DataFrame:
    """A control row per table name, marked as never loaded."""
    return tables.select(F.col(name).cast("string").alias("table_name")).distinct().select(
        "table_name", F.lit(FIRST_MARK).cast("timestamp").alias("last_watermark")
    )


def watermarks(control: DataFrame, tables: DataFrame, name: str = "table_name") -> DataFrame:
    """The mark of each table asked for; the first mark where there is none."""
    asked = tables.select(F.col(name).cast("string").alias("table_name")).distinct()
    known = control.groupBy("table_name").agg(F.max("last_watermark").alias("last_watermark"))
    mark = F.coalesce("last_watermark", F.lit(FIRST_MARK).cast("timestamp"))
    return asked.join(known, "table_name", "left").select("table_name", mark.alias("last_watermark"))


def read_watermarks(control: DataFrame, tables: Iterable[str]) -> dict[str, str]:
    """The marks of the named tables, read in one job; one value per name.

    Marks are text in the session's time zone, so that they read back unchanged.
    """
    names = list(tables)
    spark = control.sparkSession
    asked = spark.createDataFrame([(n,) for n in names], "table_name string")
    found = watermarks(control.where(F.col("table_name").isin(names)), asked)
    found = found.withColumn("last_watermark", F.col("last_watermark").cast("string"))
    return {r["table_name"]: r["last_watermark"] for r in found.collect()}


def next_watermark(staged: DataFrame, table: str | Column, load: str = "load_date") -> DataFrame:
    """The highest load date per table, as control rows.

    ``table`` is a name for all rows, or the column that holds the name.
    """
    name = F.lit(table) if isinstance(table, str) else table
    return staged.groupBy(name.alias("table_name")).agg(F.max(load).cast("timestamp").alias("last_watermark"))


def advance_watermarks(control: DataFrame, reached: DataFrame) -> DataFrame:
    """The control table after a load: marks never fall and never become NULL."""
    old = control.groupBy("table_name").agg(F.max("last_watermark").alias("_old"))
    new = reached.groupBy("table_name").agg(F.max("last_watermark").alias("_new"))
    # greatest() leaves NULL out, so an empty increment keeps the old mark.
    mark = F.coalesce(F.greatest("_old", "_new"), F.lit(FIRST_MARK).cast("timestamp"))
    return old.join(new, "table_name", "full").select("table_name", mark.alias("last_watermark"))


# -- batches -----------------------------------------------------------------------


def next_batches(staged: Mapping[str, DataFrame], batch: str = BATCH) -> DataFrame:
    """The next batch number per table: one above the highest, 1 for an empty table."""
    rows = None
    for name, df in staged.items():
        one = df.agg((F.coalesce(F.max(batch), F.lit(0)) + 1).cast("int").alias("next_batch"))
        one = one.select(F.lit(name).alias("table_name"), "next_batch")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def newer_than(
    feed: DataFrame, modified: str, mark: datetime | str, overlap: timedelta | None = None
) -> DataFrame:
    """Rows strictly newer than the mark; ``overlap`` reads a margin again.

    The mark is a literal of the column's own type, so the filter reaches the files.
    """
    at = F.lit(str(mark)).cast(feed.schema[modified].dataType)
    if overlap is not None:
        at = (at - F.expr(f"INTERVAL {int(overlap.total_seconds())} SECONDS")).cast(
            feed.schema[modified].dataType
        )
    return feed.where(F.col(modified) > at)


def staged_form(
    rows: DataFrame, spec: TableSpec, batch_id: int | Column, as_of: Column | datetime | str
) -> DataFrame:
    """Landed rows renamed to the model, with history columns, hash, batch number, source."""
    model = rows.select(
        *[F.col(s).alias(t) for s, t in spec.columns], F.col(spec.modified).alias(spec.load)
    )
    return with_scd2(
        model, spec.hash_columns, as_of, current=False, source=spec.source, batch_id=batch_id
    )


def stage_increment(
    feed: DataFrame,
    spec: TableSpec,
    mark: datetime | str,
    batch_id: int | Column,
    as_of: Column | datetime | str,
    overlap: timedelta | None = None,
) -> DataFrame:
    """The rows of ``feed`` newer than the mark, in staged form: filter first, then rename."""
    return staged_form(newer_than(feed, spec.modified, mark, overlap), spec, batch_id, as_of)


def not_staged(
    increment: DataFrame, staged: DataFrame, spec: TableSpec, mark: datetime | str, overlap: timedelta
) -> DataFrame:
    """Rows of an overlapping increment that the staged table does not hold yet.

    All model columns and the load date are compared, NULLs as values. Equal rows are
    counted on both sides, in each task before the shuffle, and come as often as the counts
    differ: what was delivered twice and staged once gives one row. Only staged rows within
    the margin take part.
    """
    compared = [*[t for _, t in spec.columns], spec.load]
    held = newer_than(staged, spec.load, mark, overlap).groupBy(*compared).agg(F.count(F.lit(1)).alias("_held"))
    given = increment.groupBy(*increment.columns).agg(F.count(F.lit(1)).alias("_given"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"i.{c}").eqNullSafe(F.col(f"m.{c}"))
    missing = F.col("_given") - F.coalesce("_held", F.lit(0))
    return (
        given.alias("i")
        .join(held.alias("m"), same, "left")
        .where(missing > 0)
        .select(*[F.col(f"i.{c}") for c in increment.columns], F.explode(F.sequence(F.lit(1).cast("bigint"), missing)))
        .drop("col")
    )


# -- rows that are turned away ----------------------------------------------------------

REJECT_SCHEMA = "table_name string, reason string, batch_id int, load_date timestamp, row string"
NULL_KEY = "null_key"


def reject_reason(spec: TableSpec) -> Column:
    """Why a staged row is turned away: a key column is NULL, or the first rule it breaks; else NULL."""
    reasons = [(NULL_KEY, F.col(k).isNull()) for k in spec.keys] + [(name, F.expr(rule)) for name, rule in spec.rules]
    return F.coalesce(F.lit(None).cast("string"), *[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in reasons])


def split_rejects(increment: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Rows to stage, rows turned away, and how many there are of each reason.

    The increment is computed and written once, into a directory for either kind; the
    counts come from that same pass.
    """
    names = list(dict.fromkeys([*([NULL_KEY] if spec.keys else []), *[name for name, _ in spec.rules]]))
    seen = Observation()
    reason = F.col("_reason")
    counts = [F.count_if(reason == name).alias(name) for name in names] or [F.lit(0).alias("none")]
    judged = increment.withColumn("_reason", reject_reason(spec)).withColumn("_rejected", reason.isNotNull())
    both = stored(judged.observe(seen, *counts), "judged", ("_rejected",))
    accepted = both.where(~F.col("_rejected")).select(*increment.columns)
    rejected = both.where("_rejected").select(
        F.lit(spec.name).alias("table_name"),
        reason.alias("reason"),
        F.col(BATCH).alias("batch_id"),
        F.col(spec.load).cast("timestamp").alias("load_date"),
        F.to_json(F.struct(*[F.col(t) for _, t in spec.columns])).alias("row"),
    )
    return accepted, rejected, {name: seen.get[name] for name in names}


# -- the whole cycle -----------------------------------------------------------------


@dataclass(frozen=True)
class CycleResult:
    table: str
    batch_id: int | None
    staged_rows: int
    rejected: Mapping[str, int] = field(default_factory=dict)
    error: str | None = None


@dataclass(frozen=True)
class Load:
    """One table of a cycle: where its rows come from and go to."""

    spec: TableSpec
    feed: DataFrame | Callable[[], DataFrame]
    staged: VersionedTable
    dim: VersionedTable | None = None


def apply_batch(dim: VersionedTable, batch: DataFrame, spec: TableSpec, as_of) -> None:
    """Write the dimension after a batch as its next version.

    In a table laid out by key buckets only the open rows of those that the batch touches are
    read and written, in one partitioned by the current flag all open rows; closed rows
    keep their files in both.
    """
    keys, newest = list(spec.keys), (spec.load,)
    if is_bucketed(dim):
        apply_to_buckets(dim, batch, keys, as_of, newest)
        return
    parts = scd2_parts(dim.read(), batch, keys, as_of, newest_by=newest)
    if dim.partition_by == [CURRENT]:
        carried = parts.closed.where(~F.col(CURRENT).eqNullSafe(F.lit(0)))
        dim.replace_open("SCD2", {CURRENT: 0}, parts.open.unionByName(carried))
    else:
        dim.overwrite(parts.rows())


def _cycle(
    load: Load, mark: str, as_of: datetime | str, overlap: timedelta | None, rejects: VersionedTable | None
) -> tuple[CycleResult, DataFrame | None]:
    """Stage what is new and apply it to the dimension; the mark reached, which is not stored yet."""
    spec, staged = load.spec, load.staged
    feed = load.feed() if callable(load.feed) else load.feed
    beyond = F.col(spec.load) > F.lit(mark).cast(feed.schema[spec.modified].dataType)

    def last_batch() -> int:
        return next_batches({spec.name: staged.read()}).first()["next_batch"] - 1

    # Only the newest batch can be left over, since each cycle starts by removing it.
    last = last_batch()
    left_over = (F.col(BATCH) == last) & beyond
    if last > 0 and not staged.read().where(left_over).isEmpty():
        staged.delete(left_over)
        last = last_batch()
    batch_id = last + 1
    increment = stage_increment(feed, spec, mark, batch_id, as_of, overlap)
    if overlap is not None:
        increment = not_staged(increment, staged.read(), spec, mark, overlap)
    counts: dict[str, int] = {}
    turned_away = None
    if rejects is not None:
        increment, turned_away, counts = split_rejects(increment, spec)
        with _rejects_lock:
            _record(rejects, turned_away if any(counts.values()) else None, spec.name, mark)
    by_batch = staged.partition_by == [BATCH]
    rows = staged.append(increment, evolve=True, partition={BATCH: batch_id} if by_batch else None)
    reached = None
    if any(counts.values()):
        # What was turned away is not read again either.
        reached = next_watermark(turned_away, spec.name)
    if rows:
        batch = staged.read().where(F.col(BATCH) == batch_id)
        if load.dim is not None:
            apply_batch(load.dim, batch, spec, as_of)
        of_batch = next_watermark(batch, spec.name, spec.load)
        reached = of_batch if reached is None else reached.unionByName(of_batch)
    return CycleResult(spec.name, batch_id if rows else None, rows, counts), reached


def run_cycle(
    spark: SparkSession,
    spec: TableSpec,
    feed: DataFrame,
    staged: VersionedTable,
    control: VersionedTable,
    as_of: datetime | str,
    dim: VersionedTable | None = None,
    overlap: timedelta | None = None,
    rejects: VersionedTable | None = None,
) -> CycleResult:
    """One load: read the mark, stage, apply to the dimension, advance the mark.

    The mark moves last. Staged rows beyond it are those of a cycle that stopped
    half way: they are removed and staged again, so a cycle can be repeated. With
    nothing new, dimension and mark stay as they are. With an ``overlap`` late rows
    are found; those staged before are not staged twice. With ``rejects`` (a table of
    ``REJECT_SCHEMA``) rows without a key and rows that break a rule of the spec go there,
    with their reason; without it they are staged, and those without a key stay out
    of the dimension.
    """
    mark = read_watermarks(control.read(), [spec.name])[spec.name]
    result, reached = _cycle(Load(spec, feed, staged, dim), mark, as_of, overlap, rejects)
    if reached is not None:
        _advance(control, reached)
    return result


def run_cycles(
    spark: SparkSession,
    loads: Sequence[Load],
    control: VersionedTable,
    as_of: datetime | str,
    overlap: timedelta | None = None,
    rejects: VersionedTable | None = None,
    parallel: int = 1,
) -> list[CycleResult]:
    """The cycle of every table of a control table.

    All marks are read in one job, and those reached are stored in one commit, after
    all tables. A table that fails is reported with its error: its mark stays and the others
    are loaded. ``parallel`` tables are loaded at a time; a feed given as a function is
    built inside its own load.
    """
    names = [load.spec.name for load in loads]
    if len(set(names)) != len(names):
        raise ValueError("a table is named twice")
    marks = read_watermarks(control.read(), names)

    def one(load: Load) -> tuple[CycleResult, DataFrame | None]:
        try:
            return _cycle(load, marks[load.spec.name], as_of, overlap, rejects)
        except Exception as error:  # whatever it is, it is that table's
            return CycleResult(load.spec.name, None, 0, error=f"{type(error).__name__}: {error}".split("\n")[0]), None

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        done = list(pool.map(one, loads))
    reached = [df for _, df in done if df is not None]
    if reached:
        _advance(control, reduce(DataFrame.unionByName, reached))
    return [result for result, _ in done]


def _repeated(table: VersionedTable, change: Callable[[], object], tries: int = 20) -> None:
    """Make a change to a table that other cycles write as well."""
    for left in reversed(range(tries)):
        table.refresh()
        try:
            change()
            return
        except ConcurrentCommit:
            if not left:
                raise


# A table's handle knows one version, so loads of one process write rejects one by one.
_rejects_lock = Lock()


def _record(rejects: VersionedTable, rows: DataFrame | None, name: str, mark: str) -> None:
    """Add a table's rejects; those beyond the mark are of a cycle that stopped half way and go.

    What an overlap reads again and is known already is not added again.
    """
    rejects.refresh()
    mine = F.col("table_name") == name
    left_over = mine & (F.col("load_date") > F.lit(mark).cast("timestamp"))
    if not rejects.read().where(left_over).isEmpty():
        _repeated(rejects, lambda: rejects.delete(left_over))
    if rows is not None:
        again = ["reason", "load_date", "row"]
        _repeated(rejects, lambda: rejects.append(rows.join(rejects.read().where(mine).select(*again), again, "left_anti")))


def _advance(control: VersionedTable, reached: DataFrame) -> None:
    """Move marks in a control table that other cycles write as well."""
    _repeated(control, lambda: control.overwrite(advance_watermarks(control.read(), reached)))
