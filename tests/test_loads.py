import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental as inc
from tidemark.plans import model
from tidemark.session import shared_path
from tidemark.tables.versioned import VersionedTable

SPEC = model.TableSpec("t", (("src_k", "k"), ("src_v", "v")), ("k", "v"), ("k",), source="landing")


def feed(spark, rows):
    at = lambda d: datetime.datetime(2024, 1, d)
    return spark.createDataFrame([(k, v, at(d)) for k, v, d in rows], "src_k string, src_v string, modifiedon timestamp_ntz")


@pytest.fixture
def tables(spark):
    def new(label, schema, **options):
        return VersionedTable(spark, shared_path(spark, label), **options).create_empty(schema)

    staged = new("s", "k string, v string, load_date timestamp_ntz, start_column timestamp, end_date timestamp, hash string, batch_id int, Source_column string", partition_by=["batch_id"])
    dim = new("d", "k string, v string, start_column timestamp, end_date timestamp, Iscurrent int, hash string", partition_by=["Iscurrent"])
    return staged, new("c", inc.CONTROL_SCHEMA), dim


def cycle(spark, tables, rows, as_of="2024-02-01 00:00:00"):
    staged, control, dim = tables
    return inc.run_cycle(spark, SPEC, feed(spark, rows), staged, control, as_of, dim)


def mark(tables):
    return inc.read_watermarks(tables[1].read(), ["t"])["t"]


def test_cycle(spark, tables):
    staged, control, dim = tables
    assert cycle(spark, tables, [("a", "1", 1), ("b", "1", 2)]) == inc.CycleResult("t", 1, 2)
    assert mark(tables) == "2024-01-02 00:00:00"
    # Equal to the mark is not newer; the change of b is.
    assert cycle(spark, tables, [("a", "9", 2), ("b", "2", 3)]).staged_rows == 1
    assert dim.read().where("Iscurrent = 1").count() == 2
    assert dim.read().count() == 3
    versions = dim.version()
    # Nothing new: batch number, dimension and mark stay.
    assert cycle(spark, tables, [("b", "2", 3)]) == inc.CycleResult("t", None, 0)
    assert dim.version() == versions and mark(tables) == "2024-01-03 00:00:00"
    assert sorted(r["batch_id"] for r in staged.read().collect()) == [1, 1, 2]


def test_cycle_that_stopped_half_way_is_repeated(spark, tables):
    staged, control, dim = tables
    cycle(spark, tables, [("a", "1", 1)])
    rows = [("a", "2", 5), ("c", "1", 6)]
    staged.append(inc.stage_increment(feed(spark, rows), SPEC, mark(tables), 2, "2024-02-02 00:00:00"))
    assert staged.read().count() == 3
    assert cycle(spark, tables, rows) == inc.CycleResult("t", 2, 2)
    assert staged.read().count() == 3
    assert dim.read().count() == 3


def test_cycle_without_dimension(spark, tables):
    staged, control, dim = tables
    result = inc.run_cycle(spark, SPEC, feed(spark, [("a", "1", 1)]), staged, control, "2024-02-01 00:00:00")
    assert result.staged_rows == 1 and dim.read().isEmpty()


def test_closed_rows_keep_their_files(spark, tables):
    staged, control, dim = tables
    cycle(spark, tables, [("a", "1", 1)])
    cycle(spark, tables, [("a", "2", 2)])
    closed = [d for d in dim._current().dirs if d.endswith("Iscurrent=0")]
    cycle(spark, tables, [("a", "3", 3)])
    assert set(closed) < set(dim._current().dirs)
    assert dim.read().count() == 3


def test_filter_reaches_the_files(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumnRenamed("ts", "modifiedon")
    spec = model.TableSpec("e", (("event_id", "id"), ("user_id", "user")), ("id",))
    plan = inc.stage_increment(events, spec, "2024-01-15 00:00:00", 1, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-15T00:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_overlap_reads_a_margin_again(spark):
    rows = feed(spark, [("a", "1", 1), ("b", "1", 2), ("c", "1", 3)])
    got = inc.newer_than(rows, "modifiedon", "2024-01-02 00:00:00", datetime.timedelta(hours=36))
    assert sorted(r["src_k"] for r in got.collect()) == ["a", "b", "c"]


def test_watermarks(spark):
    control = spark.createDataFrame(
        [("a", "2024-01-05"), ("b", None)], "table_name string, w string"
    ).select("table_name", F.col("w").cast("timestamp").alias("last_watermark"))
    assert inc.read_watermarks(control, ["a", "b", "zz"]) == {
        "a": "2024-01-05 00:00:00",
        "b": inc.FIRST_MARK,
        "zz": inc.FIRST_MARK,
    }
    reached = spark.createDataFrame(
        [("a", "2024-01-01"), ("b", None), ("n", "2024-01-09")], "table_name string, w string"
    ).select("table_name", F.col("w").cast("timestamp").alias("last_watermark"))
    after = {r["table_name"]: str(r["last_watermark"]) for r in inc.advance_watermarks(control, reached).collect()}
    assert after == {"a": "2024-01-05 00:00:00", "b": inc.FIRST_MARK, "n": "2024-01-09 00:00:00"}


def test_landing_names():
    pairs = dict((m, s) for s, m in model.fact_spec("p_").columns)
    assert pairs["order_id"] == "p_orderid1"
    assert pairs["requested_ship_date"] == "p_requestedshipdate"
    assert pairs["qty"] == "p_quantity"
    assert pairs["source_system_normalized"] == "p_normalizedsourcesystem"
    assert len(pairs) == 44 and len(model.ORDER_COLUMNS) == 43
    assert ("p_productid1", "p_productid1") in model.product_spec("p_").columns
    assert ("p_customerid1", "customer_id") in model.customer_spec("p_").columns


def test_stream_of_landed_files(spark, tables):
    from tidemark.streaming import feed as stream

    staged, _, dim = tables
    path, checkpoint = shared_path(spark, "landing"), shared_path(spark, "stream")
    schema = feed(spark, []).schema

    def load(as_of):
        source = spark.readStream.schema(schema).parquet(path)
        stream.load_available(source, SPEC, staged, checkpoint, dim, clock=lambda: as_of)

    feed(spark, [("a", "1", 1), ("b", "1", 2)]).write.parquet(path)
    load("2024-02-01 00:00:00")
    feed(spark, [("a", "2", 3), ("c", "1", 3)]).write.mode("append").parquet(path)
    load("2024-03-01 00:00:00")
    load("2024-04-01 00:00:00")
    assert staged.read().count() == 4
    assert sorted((r["k"], r["v"], r["Iscurrent"]) for r in dim.read().collect()) == [
        ("a", "1", 0),
        ("a", "2", 1),
        ("b", "1", 1),
        ("c", "1", 1),
    ]
    # The last micro-batch delivered once more.
    again = feed(spark, [("a", "2", 3), ("c", "1", 3)])
    stream.load_micro_batch(again, 1, SPEC, staged, dim, "2024-05-01 00:00:00", checkpoint)
    assert staged.read().count() == 4 and dim.read().count() == 4
    # Another checkpoint starts at number 0 again and leaves what is staged.
    stream.load_micro_batch(feed(spark, [("z", "1", 4)]), 0, SPEC, staged, dim, "2024-05-01 00:00:00", "other")
    assert staged.read().count() == 5


def test_overlap_stages_late_facts_once(spark, tables):
    staged, control, _ = tables

    def load(rows):
        return inc.run_cycle(
            spark, SPEC, feed(spark, rows), staged, control, "2024-02-01 00:00:00", overlap=datetime.timedelta(days=3)
        )

    first = [("a", "1", 4), ("b", None, 5)]
    assert load(first).staged_rows == 2
    assert load([*first, ("late", "1", 3), ("c", "1", 6)]).staged_rows == 2
    assert load([*first, ("late", "1", 3), ("c", "1", 6)]).staged_rows == 0
    assert sorted(r["k"] for r in staged.read().collect()) == ["a", "b", "c", "late"]
    assert mark(tables) == "2024-01-06 00:00:00"


def test_overlap_is_harmless_for_a_dimension(spark, tables):
    staged, control, dim = tables

    def load(rows):
        return inc.run_cycle(
            spark, SPEC, feed(spark, rows), staged, control, "2024-02-01 00:00:00", dim, datetime.timedelta(days=3)
        )

    load([("a", "1", 4), ("a", "2", 5)])
    load([("a", "1", 4), ("a", "2", 5), ("b", "1", 3)])
    assert sorted((r["k"], r["v"], r["Iscurrent"]) for r in dim.read().collect()) == [("a", "2", 1), ("b", "1", 1)]
    assert mark(tables) == "2024-01-05 00:00:00"
