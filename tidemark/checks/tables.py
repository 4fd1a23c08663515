"""Sinks and table maintenance on versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks.registry import query
from tidemark.session import shared_path
from tidemark.sources import files
from tidemark.tables.versioned import compare_tables


def _orders(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
FINISHED_SQL = f"{ORDERS_SQL} WHERE o_orderstatus = 'F'"


def _finished(spark, sf):
    return _orders(spark, sf).where(F.col("o_orderstatus") == "F")


def _others(spark, sf):
    return _orders(spark, sf).where(F.col("o_orderstatus") != "F")


@query("snk_overwrite", f"{ORDERS_SQL} WHERE o_orderstatus <> 'F'")
def snk_overwrite(spark, sf):
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    t.overwrite(_others(spark, sf))
    return t.read()


@query(
    "snk_overwrite_merge_schema",
    """SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice,
    o_orderpriority FROM orders""",
)
def snk_overwrite_merge_schema(spark, sf):
    """New contents with one column more and two fewer: old columns stay, as NULL."""
    t = I.new_table(spark, "t").create(_orders(spark, sf))
    t.overwrite(I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), schema="merge")
    return t.read()


@query("snk_overwrite_schema", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def snk_overwrite_schema(spark, sf):
    t = I.new_table(spark, "t").create(_orders(spark, sf))
    new = I.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority")
    t.overwrite(new, schema="replace")
    return t.read()


@query("snk_append", ORDERS_SQL)
def snk_append(spark, sf):
    """Columns go by name, so their order does not matter."""
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    t.append(_others(spark, sf).select("o_totalprice", "o_orderstatus", "o_orderkey", "o_custkey"))
    return t.read()


@query(
    "snk_append_evolve",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def snk_append_evolve(spark, sf):
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    more = I.table(spark, sf, "orders").where(F.col("o_orderstatus") != "F").drop("o_orderdate")
    t.append(more, evolve=True)
    return t.read()


@query("snk_append_path", ORDERS_SQL)
def snk_append_path(spark, sf):
    path = shared_path(spark, "path")
    files.append_parquet(_finished(spark, sf), path)
    files.append_parquet(_others(spark, sf), path)
    return spark.read.parquet(path)


@query("snk_json_roundtrip", ORDERS_SQL)
def snk_json_roundtrip(spark, sf):
    path = shared_path(spark, "json")
    files.write_json(_finished(spark, sf), path)
    files.write_json(_orders(spark, sf), path)
    return files.read_json(spark, path, _orders(spark, sf).schema)


@query(
    "snk_json_by_endpoint",
    "SELECT event_id, user_id, value, event_type FROM events",
)
def snk_json_by_endpoint(spark, sf):
    """Payload rows landed in one directory per endpoint."""
    path = shared_path(spark, "json")
    events = I.table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    files.write_json(events, path, partition_by=["event_type"])
    return files.read_json(spark, path, events.schema)


@query(
    "snk_self_overwrite",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, 'source' AS "Source_column"
    FROM orders""",
)
def snk_self_overwrite(spark, sf):
    """The table is read, changed and written over itself."""
    t = I.new_table(spark, "t").create(_orders(spark, sf))
    same = t.read()
    t.overwrite(same.withColumn("o_custkey", F.col("o_custkey").cast("string")), schema="replace")
    t.overwrite(t.read().withColumn("Source_column", F.lit("source")), schema="merge")
    return t.read()


@query("snk_ctas", ORDERS_SQL)
def snk_ctas(spark, sf):
    return I.new_table(spark, "t").create(_orders(spark, sf)).read()


@query(
    "snk_insert_columns",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, NULL, 'N', o_totalprice FROM orders WHERE o_orderstatus <> 'F'""",
)
def snk_insert_columns(spark, sf):
    """Values go by position into the named columns; the one left out is NULL."""
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    rows = _others(spark, sf).select("o_totalprice", F.lit("N"), "o_orderkey")
    t.insert(rows, ["o_totalprice", "o_orderstatus", "o_orderkey"])
    return t.read()


@query("tbl_create_empty", ORDERS_SQL)
def tbl_create_empty(spark, sf):
    """An empty table of a fixed schema, created once, then filled."""
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    t = I.new_table(spark, "t").create_empty(schema)
    t.create_empty(schema, if_not_exists=True)
    t.append(_orders(spark, sf))
    return t.read()


@query("tbl_clone_schema", f"{ORDERS_SQL} WHERE o_orderstatus <> 'F'")
def tbl_clone_schema(spark, sf):
    """A table of the same structure holds none of the rows of the first."""
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    clone = t.clone_structure(shared_path(spark, "clone"))
    clone.append(_others(spark, sf))
    return clone.read()


@query(
    "tbl_add_columns",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS load_timestamp,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 2 END AS batch_id FROM orders""",
)
def tbl_add_columns(spark, sf):
    """Existing rows read NULL, later rows may carry values."""
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    t.add_columns("load_timestamp timestamp, batch_id int")
    t.append(_others(spark, sf).withColumn("batch_id", F.lit(2)))
    return t.read()


@query("tbl_truncate", FINISHED_SQL)
def tbl_truncate(spark, sf):
    t = I.new_table(spark, "t").create(_orders(spark, sf))
    t.truncate()
    t.append(_finished(spark, sf))
    return t.read()


@query(
    "tbl_update_where",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN -1 ELSE o_custkey END AS o_custkey,
    CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders""",
)
def tbl_update_where(spark, sf):
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    t.append(_others(spark, sf))
    t.update(
        {"o_orderstatus": F.lit("X"), "o_custkey": F.lit(-1)},
        (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F"),
    )
    return t.read()


@query(
    "tbl_delete_where",
    """SELECT o_orderkey, batch_id FROM (
      SELECT o_orderkey, TRY_CAST(o_orderpriority AS INT) AS batch_id FROM orders WHERE o_orderstatus = 'F'
      UNION ALL SELECT o_orderkey, CAST(o_custkey AS INT) FROM orders WHERE o_orderstatus <> 'F')
    WHERE batch_id IS NOT NULL AND batch_id >= 100""",
)
def tbl_delete_where(spark, sf):
    """Rows without a batch go; then those of low batches, by a predicate that is never NULL."""
    no_batch = F.expr("try_cast(o_orderpriority AS int)").alias("batch_id")
    orders = I.table(spark, sf, "orders")
    t = I.new_table(spark, "t").create(orders.where("o_orderstatus = 'F'").select("o_orderkey", no_batch))
    t.append(orders.where("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_custkey").cast("int").alias("batch_id")))
    t.delete(F.col("batch_id").isNull())
    t.delete(F.col("batch_id") < 100)
    return t.read()


def _history(spark, sf):
    t = I.new_table(spark, "t").create(_finished(spark, sf))
    t.append(_others(spark, sf))
    t.update({"o_custkey": F.lit(0)}, F.col("o_orderstatus") == "F")
    t.truncate()
    t.restore(1)
    return t


@query(
    "tbl_history",
    """WITH n AS (SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus <> 'F') AS o FROM orders)
    SELECT CAST(v AS INT) AS version, '2024-01-01 00:00:00' AS ts, op AS operation,
      CASE v WHEN 0 THEN f WHEN 1 THEN o WHEN 2 THEN f ELSE 0 END AS rows
    FROM n, (VALUES (0, 'CREATE TABLE AS SELECT'), (1, 'APPEND'), (2, 'UPDATE'), (3, 'TRUNCATE'), (4, 'RESTORE')) h(v, op)""",
)
def tbl_history(spark, sf):
    """Rows written per commit: the update touches the finished orders' directory only."""
    return _history(spark, sf).history()


@query("tbl_read_version", FINISHED_SQL)
def tbl_read_version(spark, sf):
    return _history(spark, sf).read(version=0)


@query("tbl_restore", ORDERS_SQL)
def tbl_restore(spark, sf):
    return _history(spark, sf).read()


@query(
    "tbl_schema_diff",
    """SELECT 'o_orderkey' AS "column", 'bigint' AS type_a, 'string' AS type_b, 'type_differs' AS status,
      count(o_orderkey) AS filled_a, count(o_orderkey) AS filled_b FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', 'bigint', 'same', count(o_custkey), count(o_custkey) FILTER (o_orderstatus = 'F') FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', NULL, 'only_a', count(o_orderstatus), NULL FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', NULL, 'only_a', count(o_totalprice), NULL FROM orders
    UNION ALL SELECT 'o_orderpriority', NULL, 'string', 'only_b', NULL, count(o_orderpriority) FROM orders""",
)
def tbl_schema_diff(spark, sf):
    """Columns of two forms of the orders, with the values filled on either side."""
    other = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("o_custkey"),
        "o_orderpriority",
    )
    return compare_tables(_orders(spark, sf), other)
