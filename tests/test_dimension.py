"""Dimensions by key buckets, merges by directories, cycles over many tables, rejects."""

import datetime
import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_loads import SPEC, feed
from tidemark.functions.columns import row_hash
from tidemark.operators import scd2
from tidemark.operators.merge import AmbiguousMerge, Matched, NotMatched, merge_into
from tidemark.plans import dimension as D
from tidemark.plans import incremental as inc
from tidemark.session import create_file, path_exists, shared_path
from tidemark.tables.versioned import VersionedTable

DIM = "k string, v string, start_column timestamp, end_date timestamp, Iscurrent int, hash string, load_date timestamp_ntz"


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v string").withColumns(
        {"hash": row_hash(["k", "v"]), "load_date": F.lit("2024-01-01").cast("timestamp_ntz")}
    )


def rows_of(df):
    return Counter((r.k, r.v, r.Iscurrent, str(r.start_column), str(r.end_date)) for r in df.collect())


def test_one_changed_key_rewrites_one_bucket(spark):
    dim = D.create_dimension(spark, shared_path(spark, "d"), DIM, ["k"], 16)
    many = spark.range(100_000).select(F.col("id").cast("string").alias("k"), F.lit("1").alias("v"))
    many = many.withColumns({"hash": row_hash(["k", "v"]), "load_date": F.lit("2024-01-01").cast("timestamp_ntz")})
    assert D.apply_to_buckets(dim, many, ["k"], "2024-01-01", ["load_date"]) == 100_000
    before = set(dim._current().dirs)
    written = D.apply_to_buckets(dim, batch(spark, [("77", "2")]), ["k"], "2024-02-01", ["load_date"])
    gone, new = before - set(dim._current().dirs), set(dim._current().dirs) - before
    assert len(gone) == 1 and written < 100_000 / 10
    # The bucket again, and the closed row in a directory of its own.
    assert sorted(d.split("/", 1)[1].split("/")[0] for d in new) == ["Iscurrent=0", "Iscurrent=1"]
    assert rows_of(D.dimension_rows(dim).where("k = '77'")).keys() == {
        ("77", "1", 0, "2024-01-01 00:00:00", "2024-02-01 00:00:00"),
        ("77", "2", 1, "2024-02-01 00:00:00", "9999-12-31 00:00:00"),
    }
    assert D.dimension_rows(dim).count() == 100_001


def test_buckets_agree_with_the_whole_dimension(spark):
    dim = D.create_dimension(spark, shared_path(spark, "d"), DIM, ["k"], 5)
    whole = spark.createDataFrame([], DIM)
    loads = [[(str(i), "1") for i in range(50)], [(str(i), "2") for i in range(40, 60)], [], [("7", "9"), (None, "x"), ("7", "8")], [("7", "9")]]
    for day, rows in enumerate(loads, 1):
        D.apply_to_buckets(dim, batch(spark, rows), ["k"], f"2024-01-{day:02}", ["load_date"])
        whole = scd2.scd2_batch(whole, batch(spark, rows), ["k"], f"2024-01-{day:02}")
    assert rows_of(D.dimension_rows(dim)) == rows_of(whole)
    assert D.dimension_rows(dim).columns == whole.columns
    # Opened anew, the table knows its layout.
    again = VersionedTable(spark, dim.root, partition_by=D.LAYOUT)
    assert D.is_bucketed(again) and again.schema()[D.BUCKET].metadata["buckets"] == 5
    with pytest.raises(ValueError):
        D.apply_to_buckets(again, batch(spark, [("1", "1")]), ["v"], "2024-02-01", ["load_date"])


def test_merge_rewrites_the_directories_it_touches(spark):
    table = VersionedTable(spark, shared_path(spark, "m"), partition_by=["p"])
    table.create(spark.range(1000).select("id", F.lit("old").alias("v"), (F.col("id") % 10).cast("int").alias("p")))
    before = set(table._current().dirs)
    source = spark.createDataFrame([(17, "new"), (5000, "added")], "id bigint, v string")
    table.merge(
        source,
        ["id"],
        matched=[Matched(set={"v": F.col("s.v")})],
        not_matched=[NotMatched({"id": F.col("s.id"), "v": F.col("s.v"), "p": F.lit(3)})],
    )
    assert [d.split("/")[1] for d in before - set(table._current().dirs)] == ["p=7"]
    assert Counter(r.v for r in table.read().collect()) == {"old": 999, "new": 1, "added": 1}
    before = set(table._current().dirs)
    table.merge(source.where("id = 5000"), ["id"], matched=[Matched(set={"v": F.col("s.v")})], target_condition=F.col("t.p") == 9)
    assert set(table._current().dirs) == before


def test_copies_on_both_sides_are_ambiguous_in_linear_time(spark):
    target = spark.range(20_000).select(F.lit(1).alias("id"), F.lit("a").alias("v"))
    source = spark.range(20_000).select(F.lit(1).alias("id"), F.lit("b").alias("v"))
    distinct = spark.range(20_000).select(F.lit(1).alias("id"), F.col("id").cast("string").alias("v"))
    differs = Matched(F.col("t.v") != F.col("s.v"), set={"v": F.col("s.v")})
    began = time.time()
    for t, s in ((target, source), (distinct, distinct)):
        with pytest.raises(AmbiguousMerge):
            merge_into(t, s, ["id"], matched=[differs])
    # 20,000 x 20,000 pairs would take minutes.
    assert time.time() - began < 60
    out = merge_into(target, target, ["id"], matched=[differs])
    assert out.count() == 20_000


def test_a_writer_that_dies_leaves_the_version_free(spark):
    table = VersionedTable(spark, shared_path(spark, "w")).create_empty("id int")
    # What a writer leaves that dies while it writes its commit.
    assert create_file(spark, f"{table.root}/commits/_v000000001.json-dead", '{"version": 1, "dirs"')
    table.append(spark.createDataFrame([(1,)], "id int"))
    assert VersionedTable(spark, table.root).read().count() == 1
    path = f"{table.root}/commits/v000000001.json"
    assert path_exists(spark, path) and not create_file(spark, path, "other")


def spec_tables(spark, spec):
    like = inc.stage_increment(feed(spark, []), spec, inc.FIRST_MARK, 0, "2024-01-01").schema
    staged = VersionedTable(spark, shared_path(spark, "s"), partition_by=["batch_id"]).create_empty(like)
    dim = D.create_dimension(spark, shared_path(spark, "d"), DIM, ["k"], 4)
    return staged, dim


def test_overlap_with_a_dimension_comes_to_rest(spark):
    staged, dim = spec_tables(spark, SPEC)
    control = VersionedTable(spark, shared_path(spark, "c")).create_empty(inc.CONTROL_SCHEMA)
    rows = feed(spark, [("a", "1", 5), ("b", "1", 5), ("b", "1", 5)])
    margin = datetime.timedelta(days=3)
    staged_rows, versions = [], []
    for day in range(1, 5):
        result = inc.run_cycle(spark, SPEC, rows, staged, control, f"2024-02-0{day}", dim, overlap=margin)
        staged_rows.append(result.staged_rows)
        versions.append(dim.version())
    assert staged_rows == [3, 0, 0, 0] and len(set(versions)) == 1
    # A row delivered late, older than the mark, is found, and one delivered once more comes once.
    late = rows.unionByName(feed(spark, [("c", "1", 3), ("b", "1", 5)]))
    assert inc.run_cycle(spark, SPEC, late, staged, control, "2024-02-09", dim, overlap=margin).staged_rows == 2
    assert dim.read().where("Iscurrent = 1").count() == 3


def test_rejects_are_counted_and_not_read_again(spark):
    spec = replace(SPEC, rules=(("no_number", "try_cast(v AS INT) IS NULL"),))
    staged, dim = spec_tables(spark, spec)
    control = VersionedTable(spark, shared_path(spark, "c")).create_empty(inc.CONTROL_SCHEMA)
    rejects = VersionedTable(spark, shared_path(spark, "r")).create_empty(inc.REJECT_SCHEMA)
    rows = feed(spark, [("a", "1", 1), (None, "1", 2), ("b", "x", 3), (None, "x", 4), ("c", None, 5)])

    def cycle(rows, as_of, **options):
        return inc.run_cycle(spark, spec, rows, staged, control, as_of, dim, rejects=rejects, **options)

    first = cycle(rows, "2024-02-01")
    assert (first.staged_rows, first.rejected) == (1, {"null_key": 2, "no_number": 2})
    assert Counter(r.reason for r in rejects.read().collect()) == {"null_key": 2, "no_number": 2}
    assert inc.read_watermarks(control.read(), ["t"])["t"] == "2024-01-05 00:00:00"
    assert cycle(rows, "2024-02-02").staged_rows == 0
    assert cycle(rows, "2024-02-03", overlap=datetime.timedelta(days=9)).staged_rows == 0
    assert rejects.read().count() == 4
    assert rejects.read().where("reason = 'no_number' AND row = '{\"k\":\"b\",\"v\":\"x\"}'").count() == 1


def test_a_failing_table_does_not_stop_the_others(spark):
    loads, control = [], VersionedTable(spark, shared_path(spark, "c")).create_empty(inc.CONTROL_SCHEMA)
    for name in ("one", "two", "three"):
        spec = replace(SPEC, name=name)
        staged, dim = spec_tables(spark, spec)
        loads.append(inc.Load(spec, feed(spark, [("a", "1", 3)]), staged, dim))

    def broken():
        raise OSError("no connection")

    loads[1] = replace(loads[1], feed=broken)
    version = control.version()
    done = inc.run_cycles(spark, loads, control, "2024-02-01", parallel=3)
    assert [(r.table, r.staged_rows, r.error) for r in done] == [("one", 1, None), ("two", 0, "OSError: no connection"), ("three", 1, None)]
    assert control.version() == version + 1
    assert inc.read_watermarks(control.read(), ["one", "two", "three"]) == {
        "one": "2024-01-03 00:00:00",
        "two": inc.FIRST_MARK,
        "three": "2024-01-03 00:00:00",
    }
    with pytest.raises(ValueError):
        inc.run_cycles(spark, [loads[0], loads[0]], control, "2024-02-01")
