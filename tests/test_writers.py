"""Two writers, rows delivered twice, and ids beyond 32 bits."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental, star
from tidemark.session import shared_path
from tidemark.sources.payloads import endpoint_status, paged_records
from tidemark.tables.versioned import ConcurrentCommit, VersionedTable


def values(df):
    return sorted(r[0] for r in df.select("id").collect())


@pytest.mark.parametrize("write", ["append", "overwrite"])
def test_a_stale_writer_leaves_committed_rows(spark, write):
    root = shared_path(spark, "writers")
    first = VersionedTable(spark, root).create(spark.range(3))
    stale = VersionedTable(spark, root)
    assert stale.version() == 0
    first.append(spark.range(10, 15))
    with pytest.raises(ConcurrentCommit):
        getattr(stale, write)(spark.range(100, 101))
    assert values(VersionedTable(spark, root).read()) == [0, 1, 2, 10, 11, 12, 13, 14]


def test_two_cycles_keep_both_marks(spark):
    root = shared_path(spark, "control")
    control = VersionedTable(spark, root)
    control.create_empty(incremental.CONTROL_SCHEMA)
    marks = "SELECT '{}' AS table_name, TIMESTAMP'2024-01-0{} 00:00:00' AS last_watermark"
    control.append(spark.sql(marks.format("a", 1)).unionByName(spark.sql(marks.format("b", 1))))
    other = VersionedTable(spark, root)
    other.version()
    incremental._advance(control, spark.sql(marks.format("a", 2)))
    incremental._advance(other, spark.sql(marks.format("b", 3)))
    got = {r.table_name: str(r.last_watermark)[:10] for r in VersionedTable(spark, root).read().collect()}
    assert got == {"a": "2024-01-02", "b": "2024-01-03"}


def test_ids_beyond_32_bits_stay_apart(spark):
    wide = {c: F.lit("x") for c in star.model.ORDER_DIM_COLUMNS if c != "order_id"}
    orders = spark.range(3_000_000_000, 3_000_000_005).select(F.col("id").cast("string").alias("order_id"))
    orders = orders.union(spark.sql("SELECT 'none'")).withColumns(wide)
    assert star.dim_orders(orders, "2024-01-01").select("order_id").distinct().count() == 5
    assert [r.order_id for r in star.order_rejects(orders).collect()] == ["none"]


def test_a_page_landed_twice_counts_once(spark):
    pages = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [3]), (3, [4]), (4, [])], "page int, records array<int>")
    got = [r.record for r in paged_records(pages, "page", "records", 10).orderBy("position").collect()]
    assert got == [1, 2, 3, 4]


def test_json_nulls_hold_no_record(spark):
    rows = spark.createDataFrame([("a", '{"data":null}'), ("b", "null"), ("c", '{"data":[1]}'), ("d", "{")], "e string, t string")
    got = {r.e: (r.records, r.status) for r in endpoint_status(rows, "e", "t").collect()}
    assert got == {"a": (0, "empty"), "b": (0, "empty"), "c": (1, "ok"), "d": (0, "failed")}


def test_equal_rows_are_counted_against_the_staged(spark):
    from tidemark.plans.model import TableSpec
    from tests.test_loads import SPEC

    assert isinstance(SPEC, TableSpec)
    row = {**{t: "x" for _, t in SPEC.columns}, SPEC.load: "2024-01-02 00:00:00"}
    one = spark.createDataFrame([row]).withColumn(SPEC.load, F.col(SPEC.load).cast("timestamp"))
    got = incremental.not_staged(one.union(one), one, SPEC, "2024-01-02 00:00:00", timedelta(days=1))
    assert got.count() == 1
