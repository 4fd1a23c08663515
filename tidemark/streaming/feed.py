"""The load cycle fed by a stream of landed files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import BATCH
from tidemark.plans.incremental import apply_batch, next_batches, staged_form
from tidemark.plans.model import TableSpec
from tidemark.tables.versioned import VersionedTable

# Names the stream and micro-batch that staged a row.
TAG = "staged_by"


def load_micro_batch(
    rows: DataFrame,
    number: int,
    spec: TableSpec,
    staged: VersionedTable,
    dim: VersionedTable | None,
    as_of: datetime | str,
    stream: str = "",
) -> int:
    """Stage one micro-batch under the table's next batch number and apply it.

    The staged rows carry the stream's name and the micro-batch's number: one that is
    delivered again replaces its own rows and keeps its batch number; no other rows are
    touched, whatever streams or cycles feed the table.
    """
    tag = f"{stream}#{number}"
    held = staged.read()
    mine = F.col(TAG) == tag
    again = held.where(mine).select(BATCH).first() if TAG in held.columns else None
    if again is not None:
        batch_id = again[BATCH]
        staged.delete(mine)
    else:
        batch_id = next_batches({spec.name: held}).first()["next_batch"]
    batch_rows = staged_form(rows, spec, batch_id, as_of).withColumn(TAG, F.lit(tag))
    count = staged.append(batch_rows, evolve=True)
    if count and dim is not None:
        batch = staged.read().where(F.col(BATCH) == batch_id).drop(TAG)
        apply_batch(dim, batch, spec, as_of)
    return count


def load_available(
    feed: DataFrame,
    spec: TableSpec,
    staged: VersionedTable,
    checkpoint: str,
    dim: VersionedTable | None = None,
    clock: Callable[[], datetime | str] = datetime.now,
) -> None:
    """Take up all files landed since the last call, then stop.

    ``feed`` is a streaming read of the landing directory; ``checkpoint`` remembers
    which files were taken and stands in for the watermark.
    """

    def take(rows: DataFrame, number: int) -> None:
        load_micro_batch(rows, number, spec, staged, dim, clock(), checkpoint)

    stream = feed.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
