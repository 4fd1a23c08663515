import pytest
from pyspark.sql import functions as F

from tidemark.operators.merge import AmbiguousMerge, Matched, NotMatched, merge_into


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "old", 0), (None, "n", 1)], "id int, v string, cur int")


def update():
    return Matched(F.col("t.v") != F.col("s.v"), set={"v": F.col("s.v")})


def insert():
    return NotMatched({"id": F.col("s.id"), "v": F.col("s.v"), "cur": F.lit(1)})


def test_update_and_insert(spark, target):
    source = spark.createDataFrame([(2, "B"), (3, "c"), (1, "a")], "id int, v string")
    out = merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()], target_condition=F.col("t.cur") == 1)
    assert set(map(tuple, out.collect())) == {(1, "a", 1), (2, "B", 1), (2, "old", 0), (None, "n", 1), (3, "c", 1)}
    assert out.count() == 5


def test_null_keys_are_inserted_each_time(spark, target):
    source = spark.createDataFrame([(None, "x")], "id int, v string")
    out = merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()])
    assert out.where("id IS NULL").count() == 2


def test_two_modifying_rows_are_an_error(spark, target):
    source = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    with pytest.raises(AmbiguousMerge):
        merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()])


def test_repeated_source_rows_are_fine_if_one_modifies(spark, target):
    source = spark.createDataFrame([(1, "a"), (1, "y"), (1, "a")], "id int, v string")
    out = merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()])
    assert [r["v"] for r in out.where("id = 1").collect()] == ["y"]


def test_repeated_new_keys_are_all_inserted(spark, target):
    source = spark.createDataFrame([(9, "x"), (9, "y")], "id int, v string")
    out = merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()])
    assert out.where("id = 9").count() == 2


def test_first_clause_wins_and_delete(spark, target):
    source = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    out = merge_into(
        target,
        source,
        ["id"],
        matched=[Matched(F.col("t.cur") == 0, delete=True), update(), Matched(delete=True)],
    )
    assert sorted(r["v"] for r in out.collect()) == ["n", "x", "y"]


def test_null_condition_is_not_met(spark, target):
    source = spark.createDataFrame([(1, None)], "id int, v string")
    out = merge_into(target, source, ["id"], matched=[update()])
    assert [r["v"] for r in out.where("id = 1").collect()] == ["a"]


def test_hot_source_key(spark):
    """A third of the source is one key that matches nothing that changes."""
    target = spark.range(100).select(F.col("id"), F.lit("same").alias("v"), F.lit(1).alias("cur"))
    hot = spark.range(5000).select(F.lit(7).cast("bigint").alias("id"), F.lit("same").alias("v"))
    source = hot.unionByName(spark.range(100, 10100).select("id", F.lit("new").alias("v")))
    out = merge_into(target, source, ["id"], matched=[update()], not_matched=[insert()])
    assert out.count() == 10100
    assert out.where("id = 7").count() == 1
