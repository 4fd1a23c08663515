"""Known answers and properties of SCD2, on the fixtures and on edge rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import HASH, row_hash, with_scd2
from tidemark.operators import scd2
from tidemark.operators.changes import change_types, current_rows

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
COLS = ["customer_id", "customer_name", "customer_segment", "region", "country"]
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def known(spark):
    """The fixture with counts known beforehand: dimension and batch of 729 rows."""
    read = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    cust = (
        read("customer")
        .join(read("nation"), F.expr("c_nationkey = n_nationkey"))
        .join(read("region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "c_mktsegment AS customer_segment",
            "r_name AS region",
            "n_name AS country",
        )
    )
    k = F.col("customer_id")
    dim = with_scd2(cust.where(k % 10 != 0), COLS, T0)
    segment = F.when((k % 10 != 0) & (k % 7 == 0), F.lit("CHANGED")).otherwise(F.col("customer_segment"))
    batch = cust.where((k % 10 == 0) | (k % 7 == 0) | (k % 3 == 0)).withColumn("customer_segment", segment)
    return dim.cache(), batch.withColumn(HASH, row_hash(COLS)).cache()


def test_known_counts(known):
    dim, batch = known
    out = scd2.scd2_batch(dim, batch, ["customer_id"], T1).cache()
    assert batch.count() == 729
    assert out.count() == 1693
    assert out.where("Iscurrent = 0").count() == 193
    assert out.where(F.col("start_column") == F.lit(T1).cast("timestamp")).count() == 343
    kinds = change_types(batch, current_rows(dim), ["customer_id"]).groupBy("change_type").count()
    assert dict(map(tuple, kinds.collect())) == {"INSERT": 150, "UPDATE": 193, "NO_CHANGE": 386}


def test_second_run_changes_nothing(known):
    dim, batch = known
    once = scd2.scd2_batch(dim, batch, ["customer_id"], T1)
    twice = scd2.scd2_batch(once, batch, ["customer_id"], T2)
    assert Counter(once.collect()) == Counter(twice.collect())


def test_several_open_rows_of_a_key(spark):
    """Each is compared; the key gets one new version, and none if one of them is identical."""
    schema = "k string, v string, start_column timestamp, end_date timestamp, Iscurrent int, hash string"
    rows = [("a", "1", None, None, 1, "h1"), ("a", "2", None, None, 1, "h2"), ("b", "1", None, None, 1, "h1"), ("b", "3", None, None, 1, None), (None, "n", None, None, 1, "h")]
    dim = spark.createDataFrame(rows, schema)
    batch = spark.createDataFrame([("a", "2", "h2"), ("b", "9", "h9"), (None, "x", "hx"), ("c", "0", None)], "k string, v string, hash string")
    out = scd2.scd2_batch(dim, batch, ["k"], T1)
    got = Counter((r.k, r.v, r.Iscurrent) for r in out.collect())
    assert got == Counter([("a", "1", 0), ("a", "2", 1), ("b", "1", 0), ("b", "3", 0), ("b", "9", 1), (None, "n", 1), ("c", "0", 1)])
    again = scd2.scd2_batch(out, batch, ["k"], T2)
    assert Counter((r.k, r.v, r.Iscurrent) for r in again.collect()) == got


def test_one_open_row_per_key_and_touching_intervals(known):
    dim, batch = known
    out = scd2.scd2_batch(dim, batch, ["customer_id"], T1).cache()
    assert out.where("Iscurrent = 1").groupBy("customer_id").count().where("count > 1").isEmpty()
    opened = current_rows(out).join(batch.select("customer_id", F.col("hash").alias("h")), "customer_id")
    assert opened.where("hash <> h").isEmpty()
    closed = out.where("Iscurrent = 0").select("customer_id", "end_date")
    both = closed.join(current_rows(out).select("customer_id", "start_column"), "customer_id")
    assert both.where("end_date <> start_column").isEmpty()
    assert both.count() == closed.count()


def test_single_merge_known_counts(known):
    dim, batch = known
    out = scd2.scd2_single_merge(dim, batch, ["customer_id"], T1).cache()
    assert out.count() == 1500
    assert out.where("Iscurrent = 0").count() == 193
    assert out.where("end_date IS NULL").count() == 150


def small(spark, rows):
    df = spark.createDataFrame(rows, "k string, a string, b string, load_date timestamp")
    return df.withColumn(HASH, row_hash(["k", "a", "b"]))


def states(df):
    return sorted(
        (r["k"], r["a"], r["b"], str(r["start_column"]), str(r["end_date"]), r["Iscurrent"])
        for r in df.collect()
    )


@pytest.fixture
def dim(spark):
    base = spark.createDataFrame([("x", "1", None), ("y", "1", "1")], "k string, a string, b string")
    return with_scd2(base, ["k", "a", "b"], T0)


def day(n):
    import datetime

    return datetime.datetime(2024, 2, n)


def test_null_keys_are_left_out_and_reported(spark, dim):
    batch = small(spark, [(None, "1", "1", day(1)), ("z", "1", "1", day(1))])
    out = scd2.scd2_batch(dim, batch, ["k"], T1)
    assert [r["k"] for r in scd2.null_key_rows(batch, ["k"]).collect()] == [None]
    assert sorted(r["k"] for r in out.collect()) == ["x", "y", "z"]


def test_newest_row_of_a_key_counts(spark, dim):
    batch = small(spark, [("y", "2", "1", day(1)), ("y", "3", "1", day(2)), ("y", "2", "1", day(1))])
    out = states(scd2.scd2_batch(dim, batch, ["k"], T1))
    assert [s for s in out if s[0] == "y"] == [
        ("y", "1", "1", T0, T1, 0),
        ("y", "3", "1", T1, "9999-12-31 00:00:00", 1),
    ]


def test_null_attributes_collide_in_the_hash(spark, dim):
    """NULLs are left out of the hashed text, so (1, NULL) and (NULL, 1) look the same."""
    batch = small(spark, [("x", None, "1", day(1))])
    assert len(states(scd2.scd2_batch(dim, batch, ["k"], T1))) == 2


def test_null_hash_counts_as_a_value(spark, dim):
    batch = small(spark, [("y", "1", "1", day(1))]).withColumn(HASH, F.lit(None).cast("string"))
    once = scd2.scd2_batch(dim, batch, ["k"], T1)
    assert [s[5] for s in states(once) if s[0] == "y"] == [0, 1]
    assert states(scd2.scd2_batch(once, batch, ["k"], T2)) == states(once)


def test_empty_batch_changes_nothing(spark, dim):
    batch = small(spark, [])
    assert states(scd2.scd2_batch(dim, batch, ["k"], T1)) == states(dim)


def test_return_to_an_older_value_opens_a_version(spark, dim):
    there = scd2.scd2_batch(dim, small(spark, [("y", "2", "1", day(1))]), ["k"], T1)
    back = scd2.scd2_batch(there, small(spark, [("y", "1", "1", day(2))]), ["k"], T2)
    assert [s[1:] for s in states(back) if s[0] == "y"] == [
        ("1", "1", T0, T1, 0),
        ("1", "1", T2, "9999-12-31 00:00:00", 1),
        ("2", "1", T1, T2, 0),
    ]


def test_single_merge_opens_the_new_version_on_the_next_run(spark, dim):
    batch = small(spark, [("y", "2", "1", day(1))]).drop("load_date")
    once = scd2.scd2_single_merge(dim, batch, ["k"], T1)
    assert [s[5] for s in states(once) if s[0] == "y"] == [0]
    twice = scd2.scd2_single_merge(once, batch, ["k"], T2)
    assert [s[3:] for s in states(twice) if s[0] == "y"] == [(T0, T1, 0), (T2, "None", 1)]


def test_repairs(spark, dim):
    gone = dim.withColumn("Iscurrent", F.when(F.col("k") == "x", F.lit(None)).otherwise(F.lit(0)).cast("int"))
    assert [r["k"] for r in scd2.drop_expired(gone).collect()] == ["x"]
    assert [r["Iscurrent"] for r in scd2.reopen(gone, F.col("k") == "y").orderBy("k").collect()] == [None, 1]
    doubled = dim.unionByName(dim)
    fixed = scd2.dedup_versions_of(doubled, F.col("b") == "1", ["k"])
    assert sorted(r["k"] for r in fixed.collect()) == ["x", "x", "y"]


def test_product_known_counts(spark):
    """The product fixture: 64 names, 23 changed and 21 new."""
    from tidemark.operators.dedup import first_per_key

    cols = ["product_name", "category", "color", "unit_price"]
    parts = spark.read.parquet(f"{SF}/part.parquet").selectExpr(
        "p_partkey", "p_name AS product_name", "p_type AS category", "p_brand AS color",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price",
    )
    won = first_per_key(parts, ["product_name"], ["p_partkey"])
    dim = with_scd2(won.select(*cols), cols, T0)
    turn = F.col("p_partkey") % 3
    batch = won.select(
        F.when(turn == 2, F.concat("product_name", F.lit("-v2"))).otherwise(F.col("product_name")).alias("product_name"),
        "category",
        "color",
        F.when(turn == 1, F.col("unit_price") + 1).otherwise(F.col("unit_price")).cast("decimal(18,2)").alias("unit_price"),
    ).withColumn(HASH, row_hash(cols))
    once = scd2.scd2_batch(dim, batch, ["product_name"], T1)
    assert (once.count(), once.where("Iscurrent = 0").count()) == (108, 23)
    assert once.where(F.col("start_column") == F.lit(T1).cast("timestamp")).count() == 44
    assert Counter(scd2.scd2_batch(once, batch, ["product_name"], T2).collect()) == Counter(once.collect())


def test_composite_keys(spark):
    rows = spark.createDataFrame([("a", 1, "v"), ("a", 2, "v")], "k string, n int, v string")
    dim = with_scd2(rows, ["k", "n", "v"], T0)
    batch = spark.createDataFrame([("a", 2, "w"), ("b", 2, "v"), ("a", None, "z")], "k string, n int, v string")
    out = scd2.scd2_batch(dim, batch.withColumn(HASH, row_hash(["k", "n", "v"])), ["k", "n"], T1)
    got = sorted((r["k"], r["n"], r["v"], r["Iscurrent"]) for r in out.collect())
    assert got == [("a", 1, "v", 1), ("a", 2, "v", 0), ("a", 2, "w", 1), ("b", 2, "v", 1)]
