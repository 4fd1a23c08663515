"""Settings a job reads from its session."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a side may be sent to every executor: a few hundred bytes a
# row keeps the copy near 100 MB.
BROADCAST_ROWS = 500_000


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder all executors share.

    The folder is the one named in ``spark.checkpoint.dir``, else ``_scratch`` under the
    warehouse, which executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the file system the path names."""
    jvm_path, system = _file_system(spark, path)
    return system.exists(jvm_path)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; whether this call made it.

    The file is written under a name of its own and appears under ``path`` whole or not at
    all: a writer that dies in between leaves a file that nobody reads.
    """
    folder, name = path.rsplit("/", 1)
    draft, system = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    target, _ = _file_system(spark, path)
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if system.getScheme() != "file":
            # Renaming does not replace a file.
            return not system.exists(target) and system.rename(draft, target)
        # Renaming would, on a local disk; a second name for the file does not.
        places = [spark._jvm.java.io.File(system.makeQualified(p).toUri().getPath()).toPath() for p in (target, draft)]
        spark._jvm.java.nio.file.Files.createLink(*places)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)


def partition_directories(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The ``column=value`` directories ``depth`` levels below ``path``, relative to it."""
    pattern, system = _file_system(spark, "/".join([path, *["*=*"] * depth]))
    found = [str(status.getPath().toString()) for status in system.globStatus(pattern)]
    return sorted("/".join(name.split("/")[-depth:]) for name in found)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if a count shows it has at most ``max_rows`` rows.

    The count is added up task by task; on files it reads their footers only. Beyond
    the bound ``df`` comes back unmarked, so that the join shuffles and adaptive
    execution splits hot keys.
    """
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


# Whether shuffle files go when the statement that made them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[SparkSession, tuple[int, str]] = {}
_cleaning_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in here are removed as soon as it has ended.

    Otherwise they lie beside those of the next statements until the driver happens to collect
    its garbage. The setting is the session's; of blocks open at a time the last restores it.
    """
    with _cleaning_lock:
        depth, before = _cleaning.get(spark) or (0, spark.conf.get(_CLEANUP, "false"))
        _cleaning[spark] = depth + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning_lock:
            depth, before = _cleaning.pop(spark)
            if depth > 1:
                _cleaning[spark] = depth - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For rows that several parts of a plan use: they are computed once, and the
    plan after them survives the loss of an executor without computing them again. What
    the write shuffled is gone when it has ended; the rows stay, so they are packed with zstd.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
