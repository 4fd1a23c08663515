"""Parquet tables with versions, for a single writer at a time."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import merge_into
from tidemark.session import broadcast_if_small, create_file, partition_directories, path_exists, stored

_VERSION = "commit_version"
_DIRECTORY = rf"/data/({_VERSION}=.+)/[^/]+$"
_COMMIT = "version int, ts string, operation string, rows bigint, dirs array<string>, schema string"


@dataclass(frozen=True)
class _Commit:
    version: int
    dirs: tuple[str, ...]
    schema: T.StructType


class ConcurrentCommit(ValueError):
    """Another writer committed the version that was to be written."""


class VersionedTable:
    """Data directories that are never changed, and one commit row per version.

    A commit lists the directories and the schema that make up its version. Adding
    columns, truncating and restoring write a commit only. Update and delete
    rewrite just the directories that hold matching rows, and appended batches are
    directories of their own. ``partition_by`` splits each write into one
    directory per value.

    The reserved column name ``commit_version`` must not occur in the data.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        partition_by: Sequence[str] = (),
        clock: Callable[[], datetime] | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)
        self._clock = clock or (lambda: datetime.now(timezone.utc).replace(tzinfo=None))
        self._head: _Commit | None = None

    # -- commits ---------------------------------------------------------------

    def _commits(self) -> DataFrame:
        reader = self.spark.read.schema(_COMMIT).option("recursiveFileLookup", True)
        return reader.json(f"{self.root}/commits")

    def _load(self, version: int | None = None) -> _Commit | None:
        if not path_exists(self.spark, f"{self.root}/commits"):
            return None
        commits = self._commits()
        if version is not None:
            commits = commits.where(F.col("version") == version)
        row = commits.orderBy(F.col("version").desc()).limit(1).first()
        if row is None:
            return None
        schema = T.StructType.fromJson(json.loads(row["schema"]))
        return _Commit(row["version"], tuple(row["dirs"]), schema)

    def _current(self) -> _Commit:
        if self._head is None:
            self._head = self._load()
        if self._head is None:
            raise ValueError(f"no table at {self.root}")
        return self._head

    def refresh(self) -> None:
        """Forget the known version, to see commits written elsewhere."""
        self._head = None

    def exists(self) -> bool:
        self._head = self._head or self._load()
        return self._head is not None

    def _commit(self, operation: str, dirs: Sequence[str], schema: T.StructType, rows: int = 0) -> None:
        version = self._head.version + 1 if self._head else 0
        row = {
            "version": version,
            "ts": str(self._clock()),
            "operation": operation,
            "rows": rows,
            "dirs": list(dirs),
            "schema": schema.json(),
        }
        path = f"{self.root}/commits/v{version:09d}.json"
        # The file is created only if no other writer has taken this version.
        if not create_file(self.spark, path, json.dumps(row) + "\n"):
            raise ConcurrentCommit(f"version {version} of {self.root} was written elsewhere; refresh and repeat")
        self._head = _Commit(version, tuple(dirs), schema)

    # -- data directories --------------------------------------------------------

    def _scan(self, commit: _Commit, dirs: Sequence[str] | None = None) -> DataFrame:
        """Rows of some directories, with the hidden file columns still in reach."""
        dirs = commit.dirs if dirs is None else dirs
        return (
            self.spark.read.schema(commit.schema)
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/data/{d}" for d in dirs])
        )

    def _rows_of(self, commit: _Commit, dirs: Sequence[str] | None = None) -> DataFrame:
        if not (commit.dirs if dirs is None else dirs):
            return self.spark.createDataFrame([], commit.schema)
        return self._scan(commit, dirs).select(*commit.schema.names)

    @staticmethod
    def _directory() -> Column:
        return F.regexp_extract("_metadata.file_path", _DIRECTORY, 1)

    def _write(self, df: DataFrame, partition: Mapping[str, int] | None = None) -> tuple[list[str], int]:
        """Write ``df`` as the data of the next version; its directories and row count.

        With ``partition``, the one that all rows are of, they go straight into its directory: a
        write that looks for each row's directory sorts the rows first.
        """
        if _VERSION in {c.lower() for c in df.columns}:
            raise ValueError(f"{_VERSION} is reserved")
        if partition is not None and list(partition) != self.partition_by:
            raise ValueError("partition must name the partition columns")
        version = self._head.version + 1 if self._head else 0
        # A directory of its own for each write: a writer whose commit fails touches no other's files.
        name = f"{_VERSION}={version}-{uuid.uuid4().hex}"
        seen = Observation()
        others = F.lit(False)
        for c, value in (partition or {}).items():
            others = others | ~F.col(c).eqNullSafe(F.lit(value))
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(others).alias("others"))
        if partition is not None:
            name = "/".join([name, *[f"{c}={int(value)}" for c, value in partition.items()]])
            df = df.drop(*partition)
        writer = df.write.mode("error").option("compression", "zstd")
        if self.partition_by and partition is None:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.root}/data/{name}")
        rows = seen.get["rows"]
        if seen.get["others"]:
            raise ValueError(f"{seen.get['others']} rows are not of {dict(partition)}")
        if rows == 0:
            return [], 0
        if not self.partition_by or partition is not None:
            return [name], rows
        parts = partition_directories(self.spark, f"{self.root}/data/{name}", len(self.partition_by))
        return [f"{name}/{p}" for p in parts], rows

    def _conform(self, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Columns of ``schema`` by name; absent ones NULL, unknown ones an error."""
        have = {c.lower(): c for c in df.columns}
        unknown = set(have) - {f.name.lower() for f in schema.fields}
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
        return df.select(
            *[
                (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in schema.fields
            ]
        )

    @staticmethod
    def _widened(schema: T.StructType, other: T.StructType) -> T.StructType:
        known = {f.name.lower() for f in schema.fields}
        return T.StructType(
            schema.fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in other.fields if f.name.lower() not in known]
        )

    @staticmethod
    def _nullable(schema: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])

    # -- definition ----------------------------------------------------------------

    def create(self, df: DataFrame) -> "VersionedTable":
        """CREATE TABLE AS SELECT; an existing table is an error."""
        if self.exists():
            raise ValueError(f"table exists at {self.root}")
        dirs, rows = self._write(df)
        self._commit("CREATE TABLE AS SELECT", dirs, self._nullable(df.schema), rows)
        return self

    def create_empty(self, schema: T.StructType | str, if_not_exists: bool = False) -> "VersionedTable":
        """CREATE TABLE with a fixed schema and no rows."""
        if self.exists():
            if if_not_exists:
                return self
            raise ValueError(f"table exists at {self.root}")
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        self._commit("CREATE TABLE", [], self._nullable(schema))
        return self

    def clone_structure(self, root: str) -> "VersionedTable":
        """An empty table of the same columns and partitioning; no data is copied."""
        other = VersionedTable(self.spark, root, partition_by=self.partition_by, clock=self._clock)
        return other.create_empty(self.schema())

    def add_columns(self, schema: T.StructType | str) -> None:
        """ALTER TABLE ADD COLUMNS: existing rows read NULL, no file is written."""
        head = self._current()
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        taken = {f.name.lower() for f in head.schema.fields} & {f.name.lower() for f in schema.fields}
        if taken:
            raise ValueError(f"columns exist: {sorted(taken)}")
        self._commit("ADD COLUMNS", head.dirs, self._widened(head.schema, schema))

    def schema(self) -> T.StructType:
        return self._current().schema

    # -- reading ---------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as of an earlier version."""
        head = self._current()
        commit = head if version in (None, head.version) else self._load(version)
        if commit is None:
            raise ValueError(f"no version {version} of {self.root}")
        return self._rows_of(commit)

    def version(self) -> int:
        return self._current().version

    def history(self) -> DataFrame:
        """One row per commit; ``rows`` counts the rows it wrote."""
        return self._commits().select("version", "ts", "operation", "rows")

    # -- writing ---------------------------------------------------------------------

    def overwrite(self, df: DataFrame, schema: str = "same") -> None:
        """Replace all rows; ``df`` may be built from this very table.

        ``schema``: ``same`` keeps the columns, ``merge`` adds those of ``df`` and
        fills old columns ``df`` lacks with NULL, ``replace`` takes those of ``df``.
        """
        head = self._current()
        if schema == "replace":
            target = self._nullable(df.schema)
        elif schema == "merge":
            target = self._widened(head.schema, df.schema)
        elif schema == "same":
            target = head.schema
        else:
            raise ValueError(f"unknown schema mode {schema}")
        dirs, rows = self._write(self._conform(df, target))
        self._commit("OVERWRITE", dirs, target, rows)

    def append(self, df: DataFrame, evolve: bool = False, partition: Mapping[str, int] | None = None) -> int:
        """Add rows by column name; new columns only with ``evolve``. Returns the row count.

        ``partition`` names the one that all rows are of, if known, which saves a sort of them;
        rows of another are an error.
        """
        head = self._current()
        target = self._widened(head.schema, df.schema) if evolve else head.schema
        dirs, rows = self._write(self._conform(df, target), partition)
        self._commit("APPEND", [*head.dirs, *dirs], target, rows)
        return rows

    def insert(self, df: DataFrame, columns: Sequence[str]) -> int:
        """INSERT INTO t (columns) SELECT: by position; columns left out become NULL."""
        if len(columns) != len(df.columns):
            raise ValueError("one value per column is needed")
        return self.append(df.toDF(*columns))

    def _rewrite(self, operation: str, where: Column, change: Callable[[DataFrame], DataFrame]) -> None:
        head = self._current()
        if not head.dirs:
            return self._commit(operation, [], head.schema)
        hit = self._scan(head).where(where).select(self._directory().alias("d")).distinct()
        touched = {unquote(r["d"]) for r in hit.collect()}
        if not touched <= set(head.dirs):
            raise ValueError(f"unknown directories {sorted(touched - set(head.dirs))}")
        kept = [d for d in head.dirs if d not in touched]
        if not touched:
            return self._commit(operation, kept, head.schema)
        dirs, rows = self._write(change(self._rows_of(head, sorted(touched))))
        self._commit(operation, [*kept, *dirs], head.schema, rows)

    def update(self, values: Mapping[str, Column], where: Column) -> None:
        """UPDATE SET ... WHERE; rows for which ``where`` is NULL stay."""
        met = F.coalesce(where, F.lit(False))
        types = {f.name.lower(): f for f in self.schema().fields}

        def change(df: DataFrame) -> DataFrame:
            # All right-hand sides see the old row.
            new = {}
            for name, value in values.items():
                f = types[name.lower()]
                new[f.name] = F.when(met, value.cast(f.dataType)).otherwise(F.col(f.name))
            return df.withColumns(new)

        self._rewrite("UPDATE", met, change)

    def delete(self, where: Column) -> None:
        """DELETE WHERE; rows for which ``where`` is NULL stay."""
        met = F.coalesce(where, F.lit(False))
        self._rewrite("DELETE", met, lambda df: df.where(~met))

    def truncate(self) -> None:
        """Remove all rows; earlier versions stay readable."""
        self._commit("TRUNCATE", [], self.schema())

    def restore(self, version: int) -> None:
        """Make an older version the newest; the history keeps all commits."""
        old = self._load(version)
        if old is None:
            raise ValueError(f"no version {version} of {self.root}")
        self._current()
        self._commit("RESTORE", old.dirs, old.schema)

    def merge(self, source: DataFrame, keys: Sequence[str], **clauses) -> None:
        """MERGE INTO; clauses as in ``merge_into``.

        Only the directories that hold a row the source can match are read whole and
        written again; rows to insert are those that match in none of them.
        """
        head = self._current()
        touched: set[str] = set()
        if head.dirs:
            rows = self._scan(head).withColumn("_dir", self._directory()).alias("t")
            if (condition := clauses.get("target_condition")) is not None:
                rows = rows.where(condition)
            wanted = stored(source.select(*keys).distinct(), "merge-keys")
            hit = rows.join(broadcast_if_small(wanted), list(keys), "left_semi").select("_dir").distinct()
            touched = {unquote(r["_dir"]) for r in hit.collect()}
        kept = [d for d in head.dirs if d not in touched]
        dirs, rows = self._write(merge_into(self._rows_of(head, sorted(touched)), source, keys, **clauses))
        self._commit("MERGE", [*kept, *dirs], head.schema, rows)

    @staticmethod
    def _values(directory: str) -> dict[str, str]:
        """The partition values that a directory's name holds."""
        return dict(unquote(part).split("=", 1) for part in directory.split("/")[1:])

    def _within(self, values: Mapping[str, Sequence[object]]) -> list[str]:
        wanted = {k: {str(v) for v in vs} for k, vs in values.items()}
        return [d for d in self._current().dirs if all(self._values(d).get(k) in vs for k, vs in wanted.items())]

    def read_parts(self, values: Mapping[str, Sequence[object]]) -> DataFrame:
        """The rows of the partitions with these values; other directories are not listed."""
        return self._rows_of(self._current(), self._within(values))

    def replace_parts(self, operation: str, values: Mapping[str, Sequence[object]], df: DataFrame) -> int:
        """Replace the partitions with these values by ``df``, which may add rows to others.

        All other directories are kept without being read. Returns the rows written.
        """
        head, gone = self._current(), set(self._within(values))
        dirs, rows = self._write(self._conform(df, head.schema))
        self._commit(operation, [*[d for d in head.dirs if d not in gone], *dirs], head.schema, rows)
        return rows

    def replace_open(self, operation: str, carried: Mapping[str, object], df: DataFrame) -> None:
        """Keep the directories of one partition and replace all others by ``df``.

        ``carried`` names the partition, such as ``{"Iscurrent": 0}``: its files are
        listed again and not read. ``df`` may add rows to it.
        """
        if [c.lower() for c in carried] != [c.lower() for c in self.partition_by]:
            raise ValueError("carried must name the partition columns")
        head = self._current()
        leaf = "/".join(f"{k}={v}" for k, v in carried.items())
        kept = [d for d in head.dirs if d.split("/", 1)[1].lower() == leaf.lower()]
        dirs, rows = self._write(self._conform(df, head.schema))
        self._commit(operation, [*kept, *dirs], head.schema, rows)


def schema_diff(a: DataFrame, b: DataFrame) -> list[tuple[str, str | None, str | None, str]]:
    """Per column: name, type on either side, and how they compare."""
    left = {f.name.lower(): f for f in a.schema.fields}
    right = {f.name.lower(): f for f in b.schema.fields}
    out = []
    for name in [*left, *[n for n in right if n not in left]]:
        ta = left[name].dataType.simpleString() if name in left else None
        tb = right[name].dataType.simpleString() if name in right else None
        if ta is None or tb is None:
            status = "only_a" if tb is None else "only_b"
        else:
            status = "same" if ta == tb else "type_differs"
        out.append((name, ta, tb, status))
    return out


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """``schema_diff`` as rows, with the number of non-NULL values on either side.

    One aggregate over each table counts all its columns.
    """
    spark = a.sparkSession
    diff = spark.createDataFrame(
        schema_diff(a, b), "column string, type_a string, type_b string, status string"
    )

    def filled(df: DataFrame, out: str) -> DataFrame:
        counts = df.agg(
            F.map_from_arrays(
                F.array(*[F.lit(c.lower()) for c in df.columns]),
                F.array(*[F.count(F.col(f"`{c}`")) for c in df.columns]),
            ).alias("m")
        )
        return counts.select(F.explode("m").alias("column", out))

    return diff.join(filled(a, "filled_a"), "column", "left").join(filled(b, "filled_b"), "column", "left")
