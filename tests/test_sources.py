import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions import json_fields
from tidemark.session import broadcast_if_small, shared_path
from tidemark.sources import config, files, jdbc, payloads


def test_csv_keeps_text(spark):
    path = shared_path(spark, "csv")
    spark.createDataFrame([("007", None, 'a "q", b')], "id string, gap string, note string").write.option("header", True).csv(path)
    for columns in (None, ["id", "gap", "note"]):
        assert list(map(tuple, files.read_csv_strings(spark, path, columns).collect())) == [("007", None, 'a "q", b')]
    with pytest.raises(Exception, match="does not conform"):
        files.read_csv_strings(spark, path, ["id", "other", "note"]).collect()


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"a":1},{"a":2}]', [("1", None), ("2", None)]),
        ('{"a":1}', [("1", None)]),
        ('{"data":[{"a":1},5]}', [("1", None), (None, "5")]),
        ('{"data":{"a":1}}', [("1", None)]),
        ("7", [(None, "7")]),
        ('"x"', [(None, "x")]),
        ("[]", [(None, None)]),
        ('{"data":[]}', [(None, None)]),
        ('{"broken', [(None, None)]),
        (None, [(None, None)]),
    ],
)
def test_payload_shapes(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id int, body string")
    out = payloads.payload_items(df, "body").orderBy("pos")
    got = out.select(F.try_variant_get("item", "$.a", "string"), "data").collect()
    assert list(map(tuple, got)) == expected


def test_endpoint_status(spark):
    rows = [("ok", '{"data":[1,2]}'), ("ok", "{bad"), ("empty", "[]"), ("failed", "{bad"), ("one", '{"a":1}')]
    out = payloads.endpoint_status(spark.createDataFrame(rows, "endpoint string, body string"), "endpoint", "body")
    got = {r["endpoint"]: (r["payloads"], r["records"], r["failed_payloads"], r["status"]) for r in out.collect()}
    assert got == {
        "ok": (2, 2, 1, "ok"),
        "empty": (1, 0, 0, "empty"),
        "failed": (1, 0, 1, "failed"),
        "one": (1, 1, 0, "ok"),
    }


def pages(spark, sizes):
    """Pages 1.. of records numbered on; None leaves a page out."""
    rows, n = [], 0
    for page, size in enumerate(sizes, 1):
        if size is not None:
            rows.append((page, list(range(n, n + size))))
            n += size
    return spark.createDataFrame(rows, "page int, items array<int>")


@pytest.mark.parametrize(
    "sizes, limit, expected",
    [
        ([50, 50, 50, 50, 50], 200, 200),
        ([50, 50, 0, 50, 50], 200, 100),
        ([50, None, 50], 200, 50),
        ([0, 50], 200, 0),
        ([None, 50], 200, 0),
        ([3, 3, 3], 4, 4),
        ([1] * 30, 7, 7),
    ],
)
def test_pages(spark, sizes, limit, expected):
    got = payloads.paged_records(pages(spark, sizes), "page", "items", limit).orderBy("position").collect()
    assert [r["record"] for r in got] == list(range(expected))
    assert [r["position"] for r in got] == list(range(1, expected + 1))


def test_known_page_counts(spark):
    """Parts below key 500 in pages of 50: 200 rows, or 100 if the third page is empty."""
    parts = spark.read.parquet("/root/testdata/sf0.01/part.parquet").where("p_partkey < 500")
    landed = parts.groupBy(F.expr("p_partkey div 50").alias("page")).agg(F.sort_array(F.collect_list("p_partkey")).alias("items"))
    kept = payloads.paged_records(landed, "page", "items", 200, first_page=0)
    assert sorted(r["record"] for r in kept.collect()) == list(range(200))
    emptied = landed.withColumn("items", F.when(F.col("page") == 2, F.slice("items", 1, 0)).otherwise(F.col("items")))
    kept = payloads.paged_records(emptied, "page", "items", 200, first_page=0)
    assert sorted(r["record"] for r in kept.collect()) == list(range(100))


@pytest.mark.parametrize(
    "raw, price, text",
    [
        ('{"p":{"value":900.0},"d":["a","b"]}', "900.0", "a b"),
        ('{"p":12.50,"d":"plain"}', "12.5", "plain"),
        ('{"p":"$5","d":[]}', "$5", ""),
        ('{"p":"{not json","d":"[x"}', "{not json", "[x"),
        ('{"p":{"other":1},"d":null}', None, None),
        ("{broken", None, None),
    ],
)
def test_object_or_scalar(spark, raw, price, text):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(json_fields.object_or_scalar("raw", "$.p", "value"), json_fields.array_or_scalar("raw", "$.d")).first()
    assert tuple(got) == (price, text)


def test_jdbc_options():
    assert jdbc.jdbc_options("u", table="t")["dbtable"] == "t"
    assert jdbc.jdbc_options("u", query="SELECT 1")["query"] == "SELECT 1"
    split = jdbc.jdbc_options("u", query="SELECT 1", partition_column="id", lower=0, upper=9, partitions=3)
    assert split["dbtable"] == "(SELECT 1) q" and "query" not in split
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "9", "3")
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            jdbc.jdbc_options("u", **bad)
    assert jdbc.id_predicates("id", [5, 1]) == ["id < 1 OR id IS NULL", "id >= 1 AND id < 5", "id >= 5"]
    assert "encrypt=true" in jdbc.encrypted_url("h", 1433, "d")


def test_config_load_reports_failures(spark):
    saved = {}
    table_config = spark.createDataFrame([("good", "t1"), ("bad", "t2")], "source string, target string")

    def write(df, target):
        df.write.format("noop").mode("overwrite").save()
        saved[target] = True

    def read(name):
        if name == "bad":
            raise OSError("unreachable")
        return spark.range(5).toDF("id")

    out = {r["source"]: (r["rows"], r["status"]) for r in config.load_from_config(spark, table_config, read, write).collect()}
    assert out == {"good": (5, "ok"), "bad": (None, "failed: OSError")}
    assert saved == {"t1": True}


def test_mapping_errors(spark):
    schema = "target_table string, source_column string, destination_column string, is_key int, is_active int"
    twice = spark.createDataFrame([("t", "a", "X", 0, 1), ("t", "b", "x", 0, 1)], schema)
    with pytest.raises(ValueError):
        C.mapping_pairs(twice, "t")
    with pytest.raises(ValueError):
        C.project_by_mapping(spark.range(1), twice, "other")


def test_value_map_and_its_table_form(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert [r[0] for r in df.select(C.value_map("k", {"a": "A"}, "other")).collect()] == ["A", "other", "other"]
    pairs = spark.createDataFrame([("a", "A")], "key string, value string")
    out = C.map_by_table(df, "k", pairs, "key", "value", "v", "other")
    assert sorted(r["v"] for r in out.collect()) == ["A", "other", "other"]


def test_broadcast_only_below_the_bound(spark):
    df = spark.range(100)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df, 100))
    assert not hinted(broadcast_if_small(df, 99))


def test_three_part_table_names(spark):
    """A table of another database, addressed as catalog.database.table in any case."""
    path = shared_path(spark, "bronze")
    spark.range(3).write.parquet(path)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bronze LOCATION '{shared_path(spark, 'db')}'")
    spark.sql(f"CREATE TABLE bronze.dimcustomer (id BIGINT) USING parquet LOCATION '{path}'")
    assert spark.read.table("spark_catalog.bronze.DimCustomer").count() == 3
    spark.sql("DROP TABLE bronze.dimcustomer")


def test_numbers_keep_their_digits(spark):
    from tidemark.functions import json_fields

    rows = [
        ('{"data":{"p":12345678901234567.89}}',), ('{"data":{"p":{"value":0.30000000000000000004}}}',),
        ('{"data":{"p":12.50}}',), ('{"data":{"p":{"x":1}}}',), ('{"data":{"p":null}}',), ('{"data":{"p":"1.00"}}',), ("{",), (None,),
    ]
    df = spark.createDataFrame(rows, "raw string")
    got = [r[0] for r in df.select(json_fields.object_or_scalar("raw", "$.data.p", "value")).collect()]
    assert got == ["12345678901234567.89", "0.30000000000000000004", "12.5", None, None, "1.00", None, None]


def test_landing_writes_no_empty_endpoints(spark):
    import os

    from tidemark.session import shared_path
    from tidemark.sources import payloads

    rows = [
        ("a", '{"data":[{"id":1},{"id":2}]}'), ("a", '[{"id":3}]'), ("a", '{"data":['), ("b", "[]"), ("c", "{"), ("c", '{"id":\n'), ("z", '{"id":9}'), ("b", None),
    ]
    path = shared_path(spark, "endpoints")
    df = spark.createDataFrame(rows, "name string, body string")
    status = {r.endpoint: r[1:] for r in payloads.land_endpoints(df, "name", "body", ["a", "b", "c", "d"], path).collect()}
    assert status == {
        "a": (3, 3, 1, "ok"), "b": (2, 0, 1, "failed"), "c": (2, 0, 2, "failed"), "d": (0, 0, 0, "empty"), None: (1, 1, 0, "ok"),
    }
    assert sorted(os.listdir(f"{path}/kind=record")) == ["endpoint=a", "endpoint=z"]
    landed = payloads.landed_records(spark, path)
    assert sorted((r.endpoint, r.id) for r in landed.collect()) == [("a", 1), ("a", 2), ("a", 3), ("z", 9)]
