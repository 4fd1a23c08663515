import re

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_path
from tidemark.tables.versioned import VersionedTable, schema_diff


@pytest.fixture
def table(spark):
    t = VersionedTable(spark, shared_path(spark, "t"), clock=lambda: datetime.datetime(2024, 1, 1))
    return t.create(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_create_twice_is_an_error(spark, table):
    with pytest.raises(ValueError):
        VersionedTable(spark, table.root).create(table.read())
    with pytest.raises(ValueError):
        table.create_empty("id int")
    assert table.create_empty("other string", if_not_exists=True).schema().names == ["id", "v"]


def test_missing_table(spark):
    t = VersionedTable(spark, shared_path(spark, "none"))
    assert not t.exists()
    with pytest.raises(ValueError):
        t.read()


def test_versions_stay_readable(spark, table):
    table.append(spark.createDataFrame([(3, "c")], "id int, v string"))
    table.overwrite(table.read().where("id > 1"))
    table.truncate()
    assert [len(rows(table.read(version=v))) for v in range(4)] == [2, 3, 2, 0]
    table.restore(1)
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "c")]
    history = [(r["version"], r["operation"], r["rows"]) for r in table.history().orderBy("version").collect()]
    assert history == [
        (0, "CREATE TABLE AS SELECT", 2),
        (1, "APPEND", 1),
        (2, "OVERWRITE", 2),
        (3, "TRUNCATE", 0),
        (4, "RESTORE", 0),
    ]
    with pytest.raises(ValueError):
        table.read(version=9)
    assert rows(VersionedTable(spark, table.root).read()) == rows(table.read())


def test_append_is_strict_unless_evolving(spark, table):
    wider = spark.createDataFrame([(3, 1.5)], "ID int, extra double")
    with pytest.raises(ValueError):
        table.append(wider)
    table.append(wider, evolve=True)
    assert rows(table.read()) == [(1, "a", None), (2, "b", None), (3, None, 1.5)]
    assert table.read(version=0).columns == ["id", "v"]


def versions(table):
    """The table's directories without the name of their own that each write gives them."""
    return [re.sub(r"-[0-9a-f]{32}", "", d) for d in table._current().dirs]


def test_update_keeps_null_predicates_and_untouched_directories(spark, table):
    table.append(spark.createDataFrame([(None, "n"), (9, "z")], "id int, v string"))
    table.update({"v": F.concat("v", F.lit("!")), "id": F.col("id") + 10}, F.col("id") < 2)
    assert rows(table.read()) == [(11, "a!"), (2, "b"), (9, "z"), (None, "n")]
    assert versions(table) == ["commit_version=1", "commit_version=2"]


def test_update_without_a_match(spark, table):
    table.update({"v": F.lit("q")}, F.col("id") == 99)
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_delete_keeps_null_predicates(spark, table):
    table.append(spark.createDataFrame([(None, "n")], "id int, v string"))
    table.delete(F.col("id") < 2)
    assert rows(table.read()) == [(2, "b"), (None, "n")]
    table.delete(F.lit(True))
    assert rows(table.read()) == []
    table.append(spark.createDataFrame([(5, "e")], "id int, v string"))
    assert rows(table.read()) == [(5, "e")]


def test_partitioned_rewrite_and_carry(spark):
    t = VersionedTable(spark, shared_path(spark, "p"), partition_by=["cur"])
    t.create(spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "id int, cur int"))
    assert versions(t) == ["commit_version=0/cur=0", "commit_version=0/cur=1"]
    t.replace_open("SCD2", {"cur": 0}, spark.createDataFrame([(1, 0), (4, 1)], "id int, cur int"))
    assert rows(t.read()) == [(1, 0), (2, 0), (4, 1)]
    assert "commit_version=0/cur=0" in versions(t)
    t.delete(F.col("id") == 2)
    assert rows(t.read()) == [(1, 0), (4, 1)]
    plan = t.read().where("cur = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cur" in plan


def test_clone_add_columns_insert(spark, table):
    clone = table.clone_structure(shared_path(spark, "clone"))
    assert clone.read().columns == ["id", "v"] and rows(clone.read()) == []
    clone.add_columns("n bigint")
    with pytest.raises(ValueError):
        clone.add_columns("V string")
    clone.insert(spark.createDataFrame([(7, 1)], "x bigint, y int"), ["n", "id"])
    assert rows(clone.read()) == [(1, None, 7)]
    with pytest.raises(ValueError):
        clone.insert(spark.createDataFrame([(7, 1)], "x bigint, y int"), ["n"])


def test_a_second_writer_of_a_version_fails(spark, table):
    other = VersionedTable(spark, table.root)
    assert other.version() == 0
    table.truncate()
    with pytest.raises(Exception):
        other.truncate()


def test_merge(spark, table):
    from tidemark.operators.merge import Matched, NotMatched

    source = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    table.merge(
        source,
        ["id"],
        matched=[Matched(set={"v": F.col("s.v")})],
        not_matched=[NotMatched({"id": F.col("s.id"), "v": F.col("s.v")})],
    )
    assert rows(table.read()) == [(1, "a"), (2, "B"), (3, "c")]


def test_schema_diff(spark):
    a = spark.createDataFrame([], "id int, v string, gone double")
    b = spark.createDataFrame([], "ID bigint, v string, new date")
    assert schema_diff(a, b) == [
        ("id", "int", "bigint", "type_differs"),
        ("v", "string", "string", "same"),
        ("gone", "double", None, "only_a"),
        ("new", None, "date", "only_b"),
    ]


def test_partition_values_with_special_characters(spark):
    t = VersionedTable(spark, shared_path(spark, "odd"), partition_by=["k", "n"])
    t.create(spark.createDataFrame([(1, "a b", 1), (2, "x/y", 1), (3, "50%", 2), (4, None, 2)], "id int, k string, n int"))
    assert len(t._current().dirs) == 4
    t.update({"id": F.col("id") + 10}, F.col("k").isin("a b", "x/y"))
    t.delete(F.col("k") == "50%")
    assert rows(t.read()) == [(11, "a b", 1), (12, "x/y", 1), (4, None, 2)]


def test_append_to_a_known_partition(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), partition_by=["batch_id"]).create_empty("id int, batch_id int")
    df = spark.createDataFrame([(1, 3), (2, 3)], "id int, batch_id int")
    assert table.append(df, partition={"batch_id": 3}) == 2
    assert table.append(df.limit(0), partition={"batch_id": 4}) == 0
    assert sorted(map(tuple, table.read().collect())) == [(1, 3), (2, 3)]
    assert "PartitionFilters: [isnotnull(batch_id" in table.read().where("batch_id = 3")._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="1 rows are not of"):
        table.append(spark.createDataFrame([(5, 5), (6, None)], "id int, batch_id int"), partition={"batch_id": 5})
    with pytest.raises(ValueError, match="partition columns"):
        table.append(df, partition={"id": 1})
    table.delete(F.col("id") == 1)
    assert sorted(map(tuple, table.read().collect())) == [(2, 3)]
