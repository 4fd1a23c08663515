import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import dedup, keys


def test_surrogate_keys_equal_one_global_window(spark):
    df = spark.range(0, 20000, 1, 7).select(F.sha2(F.col("id").cast("string"), 256).alias("name"), "id")
    ours = {r["name"]: r["sk"] for r in keys.with_surrogate_key(df, ["name"], "sk").collect()}
    plain = df.withColumn("sk", F.row_number().over(Window.orderBy("name")))
    assert ours == {r["name"]: r["sk"] for r in plain.collect()}


def test_surrogate_keys_start_after(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "name string")
    out = keys.with_surrogate_key(df, ["name"], "sk", start_after=10)
    assert sorted((str(r["name"]), r["sk"]) for r in out.collect()) == [("None", 11), ("a", 12), ("b", 13)]
    assert keys.next_key_start(out, "sk").first()["max_key"] == 13
    assert keys.next_key_start(out.limit(0), "sk").first()["max_key"] == 0


def test_surrogate_key_of_an_empty_table(spark):
    df = spark.createDataFrame([], "name string")
    assert keys.with_surrogate_key(df, ["name"], "sk").collect() == []


@pytest.mark.parametrize("rows_per_range", [50, 700, 10**9])
def test_row_numbers_with_a_hot_key(spark, rows_per_range):
    """One key holds half of the rows, another is NULL; any number of ranges gives the window's result."""
    rnd = random.Random(7)
    data = [("hot" if rnd.random() < 0.5 else rnd.choice([None, *"abcdefgh"]), rnd.choice([i, None])) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v int").withColumn("w", F.monotonically_increasing_id() % 977)
    df = spark.createDataFrame(df.collect(), df.schema)
    for descending in (["v"], []):
        order = [F.col("v").desc() if descending else F.col("v").asc(), F.xxhash64("k", "v", "w")]
        out = keys.row_numbers(df, ["k"], ["v"], descending=descending, rows_per_range=rows_per_range)
        plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("bigint"))
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))


def test_row_numbers_of_copies_of_one_row(spark):
    """A third of the rows are copies of one row: they are counted and written out in pieces."""
    copies = spark.range(0, 20000, 1, 8).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    rest = spark.range(0, 40000, 1, 8).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    out = keys.row_numbers(copies.unionByName(rest), ["k"], ["v"], rows_per_range=5000).cache()
    hot = out.where("k = 'hot'")
    assert (hot.count(), hot.select("rn").distinct().count()) == (20000, 20000)
    assert hot.agg(F.min("rn"), F.max("rn")).first()[:] == (1, 20000)
    assert out.where("k <> 'hot' AND rn = 1").count() == 40000
    numbered = keys.with_surrogate_key(copies.unionByName(rest), ["v"], "sk", rows_per_range=5000).cache()
    assert numbered.agg(F.count("sk"), F.count_distinct("sk"), F.min("sk"), F.max("sk")).first()[:] == (60000, 60000, 1, 60000)


def test_near_equal_rows_spread_over_ranges(spark):
    """All rows have one value of the key: they are cut by the hash of the row."""
    df = spark.range(0, 40000, 1, 8).select(F.lit("same").alias("k"), "id")
    rows = df.withColumn("_tie", F.xxhash64("k", "id"))
    order = [("k", False, T.StringType()), ("_tie", False, T.LongType())]
    cuts, heavy = keys._cut_points(rows.select("k", "_tie"), [F.col("k"), F.col("_tie")], 40000, 16)
    sizes = [r["count"] for r in rows.groupBy(keys._range(order, cuts, heavy).alias("r")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 40000 / 16 and not any(heavy)


def test_numbering_a_large_table_does_not_use_one_task(spark):
    df = spark.range(0, 50000, 1, 8).select(F.col("id").cast("string").alias("k"))
    out = keys.with_surrogate_key(df, ["k"], "sk", rows_per_range=5000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The only single-partition step sees one row per range.
    single = plan[plan.index("Exchange SinglePartition"):]
    assert plan.count("Exchange SinglePartition") == 1
    assert "HashAggregate(keys=[_range" in single
    plain = df.withColumn("sk", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_first_and_newest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, 5, "n"), (None, 4, "m")], "k string, t int, v string"
    )
    first = {r["k"]: r["v"] for r in dedup.first_per_key(df, ["k"], ["t"]).collect()}
    newest = {r["k"]: r["v"] for r in dedup.newest_per_key(df, ["k"], ["t"]).collect()}
    assert first == {"a": "x", None: "m"}
    assert newest == {"a": "z", None: "n"}
    assert dedup.first_per_key(df, ["k"], ["t"]).columns == ["k", "t", "v"]


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "i int, s string")
    out = keys.key_violations(df, ["i", "s"]).collect()
    assert sorted((r["i"], r["s"], r["rows"], r["violation"]) for r in out) == [
        (1, "a", 2, "duplicate_key"),
        (2, None, 1, "null_key"),
    ]
