"""Warehouse inputs derived from the test tables, and the same as SQL.

Every input is built from whole tables. Dimensions, batches and feeds differ by
attributes of the rows (balance, order dates, size).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import row_hash, with_scd2
from tidemark.operators.dedup import first_per_key
from tidemark.plans.dimension import create_dimension
from tidemark.plans.model import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS
from tidemark.session import shared_path, stored
from tidemark.tables.versioned import VersionedTable

T0 = "2024-01-01 00:00:00"
T1 = "2024-02-01 00:00:00"
OPEN = "9999-12-31 00:00:00"
BATCH_CUT = "2001-01-01 00:00:00"
PREFIX = "src_"
BATCH_SOURCE = "landing"


# Columns of the test tables: naming them saves the look into each file before a job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def new_table(spark: SparkSession, label: str, **options) -> VersionedTable:
    """An own versioned table for one run, with a fixed clock."""
    return VersionedTable(spark, shared_path(spark, label), clock=lambda: datetime(2024, 1, 1), **options)


def new_dimension(spark: SparkSession, schema: str, keys: list[str], buckets: int = 8) -> VersionedTable:
    """An own dimension by key buckets for one run, with a fixed clock."""
    return create_dimension(spark, shared_path(spark, "dim"), schema, keys, buckets, clock=lambda: datetime(2024, 1, 1))


# -- SQL expressions that read the same in both engines ------------------------------

CUSTOMER_EXPR = {
    "customer_id": "'C' || CAST(c_custkey AS STRING)",
    "customer_name": "c_name",
    "customer_segment": "c_mktsegment",
    "region": "r_name",
    "country": "n_name",
    "state": "'ST' || CAST(c_nationkey AS STRING)",
    "city": "n_name || ' CITY'",
    "postal_code": "CAST(10000 + c_nationkey AS STRING)",
    "contact_email": "lower(c_name) || '@example.com'",
}

PRODUCT_EXPR = {
    "product_name": "p_name",
    "category": "p_type",
    "sub_category": "CASE WHEN p_size > 25 THEN 'Large' ELSE 'Small' END",
    "color": "p_brand",
    "unit_price": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)",
    "currency": "'USD'",
    "tax_rate": "CAST(p_size AS STRING)",
}

ORDER_EXPR = {
    "order_id": "CAST(l_orderkey AS STRING)",
    "order_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "requested_ship_date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "promised_ship_date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
    "days_to_ship": "CAST(l_linenumber AS STRING)",
    "lead_time_days": "CAST(l_linenumber + 7 AS STRING)",
    "sla_days": "'30'",
    "order_status": "o_orderstatus",
    "priority": "o_orderpriority",
    "order_category": "l_returnflag",
    **CUSTOMER_EXPR,
    "contact_phone": "'+' || CAST(c_custkey AS STRING)",
    "payment_terms": "'NET30'",
    "payment_status": "l_linestatus",
    "sku": "'SKU' || CAST(l_partkey AS STRING)",
    "product_name": "p_name",
    "sku_color": "p_brand",
    "category": "p_type",
    "sub_category": "CASE WHEN p_size > 25 THEN 'Large' ELSE 'Small' END",
    "uom": "'EA'",
    "qty": "CAST(CAST(l_quantity AS INT) AS STRING)",
    "unit_price": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING)",
    "currency": "'USD'",
    "line_amount": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)",
    "tax_rate": "CAST(CAST(l_tax AS DECIMAL(18,2)) AS STRING)",
    "tax_amount": "CAST(CAST(l_discount AS DECIMAL(18,2)) AS STRING)",
    "total_amount": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)",
    "fulfillment_channel": "CASE WHEN l_linestatus = 'O' THEN 'Web' ELSE 'Store' END",
    "source_system": "'S' || CAST(l_suppkey AS STRING)",
    "source_system_normalized": "'s' || CAST(l_suppkey AS STRING)",
    "ingest_ts": "CAST(l_shipdate AS STRING)",
    "is_valid": "'true'",
    "data_quality_notes": "l_returnflag",
    "created_by": "'load'",
    "last_updated_ts": "CAST(l_shipdate AS STRING)",
}


def _list(exprs: dict[str, str], names) -> str:
    return ", ".join(f"{exprs[n]} AS {n}" for n in names)


def _exprs(exprs: dict[str, str], names) -> list[str]:
    return [f"{exprs[n]} AS {n}" for n in names]


def hash_sql(columns, prefix: str = "") -> str:
    return "sha256(concat_ws('|', " + ", ".join(prefix + c for c in columns) + "))"


# -- customers -------------------------------------------------------------------------

CUST_COLS = ", ".join(CUSTOMER_COLUMNS)

CUST_SQL = f"""
cust AS (
  SELECT {_list(CUSTOMER_EXPR, CUSTOMER_COLUMNS)}, c_custkey, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
last_order AS (
  SELECT o_custkey, max(o_orderdate) AS last_order, min(o_orderdate) AS first_order
  FROM orders GROUP BY o_custkey)"""

CUST_BATCH_SQL = f"""
{CUST_SQL},
batch_raw AS (
  SELECT customer_id, customer_name,
    CASE WHEN c_acctbal < 2000 THEN 'CHANGED' ELSE customer_segment END AS customer_segment,
    region, country, state, city, postal_code, contact_email, last_order AS load_date
  FROM cust JOIN last_order ON c_custkey = o_custkey
  WHERE last_order >= TIMESTAMP '{BATCH_CUT}'
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS STRING), s_name, 'SUPPLIER', r_name, n_name,
    'ST' || CAST(s_nationkey AS STRING), n_name || ' CITY', CAST(10000 + s_nationkey AS STRING),
    lower(s_name) || '@example.com', TIMESTAMP '{BATCH_CUT}'
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
batch AS (SELECT *, {hash_sql(CUSTOMER_COLUMNS)} AS hash FROM batch_raw),
dim AS (
  SELECT {CUST_COLS}, '{T0}' AS start_column, '{OPEN}' AS end_date, CAST(1 AS INT) AS "Iscurrent",
    {hash_sql(CUSTOMER_COLUMNS)} AS hash
  FROM cust),
staged AS (
  SELECT {CUST_COLS}, TIMESTAMP '{T0}' AS load_date, hash, CAST(1 AS INT) AS batch_id FROM dim
  UNION ALL
  SELECT {CUST_COLS}, load_date, hash, CAST(2 AS INT) FROM batch)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer attributes, with key and balance."""
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return joined.selectExpr(*_exprs(CUSTOMER_EXPR, CUSTOMER_COLUMNS), "c_custkey", "c_acctbal")


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last_order"), F.min("o_orderdate").alias("first_order"))
    )


def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a late order, some in a new segment, and all suppliers as new keys."""
    changed = F.when(F.col("c_acctbal") < 2000, F.lit("CHANGED")).otherwise(F.col("customer_segment"))
    known = (
        customers(spark, sf_dir)
        .join(order_spans(spark, sf_dir), F.expr("c_custkey = o_custkey"))
        .where(F.col("last_order") >= F.lit(BATCH_CUT).cast("timestamp_ntz"))
        .withColumn("customer_segment", changed)
        .select(*CUSTOMER_COLUMNS, F.col("last_order").alias("load_date"))
    )
    new = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "'S' || CAST(s_suppkey AS STRING) AS customer_id",
            "s_name AS customer_name",
            "'SUPPLIER' AS customer_segment",
            "r_name AS region",
            "n_name AS country",
            "'ST' || CAST(s_nationkey AS STRING) AS state",
            "n_name || ' CITY' AS city",
            "CAST(10000 + s_nationkey AS STRING) AS postal_code",
            "lower(s_name) || '@example.com' AS contact_email",
            f"CAST('{BATCH_CUT}' AS TIMESTAMP_NTZ) AS load_date",
        )
    )
    return known.unionByName(new).withColumn("hash", row_hash(CUSTOMER_COLUMNS))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, open since T0."""
    return with_scd2(customers(spark, sf_dir).select(*CUSTOMER_COLUMNS), CUSTOMER_COLUMNS, T0)


def staged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 as loaded into the dimension, and batch 2."""
    first = (
        customers(spark, sf_dir)
        .select(*CUSTOMER_COLUMNS, F.lit(T0).cast("timestamp_ntz").alias("load_date"))
        .withColumn("hash", row_hash(CUSTOMER_COLUMNS))
        .withColumn("batch_id", F.lit(1))
    )
    second = customer_batch(spark, sf_dir).withColumn("batch_id", F.lit(2))
    return first.unionByName(second)


def stored_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension and staged rows as written tables, split by current flag and batch."""
    dim = stored(customer_dim(spark, sf_dir), "dim", ("Iscurrent",))
    return dim, stored(staged_customers(spark, sf_dir), "staged", ("batch_id",))


# -- products ----------------------------------------------------------------------------

PROD_COLS = ", ".join(PRODUCT_COLUMNS)

PROD_SQL = f"""
prod AS (
  SELECT {PROD_COLS}, p_size FROM (
    SELECT {_list(PRODUCT_EXPR, PRODUCT_COLUMNS)}, p_size,
      row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS nth
    FROM part)
  WHERE nth = 1)"""

PROD_BATCH_SQL = f"""
{PROD_SQL},
batch_raw AS (
  SELECT CASE WHEN p_size > 35 THEN product_name || '-v2' ELSE product_name END AS product_name,
    category, sub_category, color,
    CASE WHEN p_size <= 15 THEN unit_price || '9' ELSE unit_price END AS unit_price,
    currency, tax_rate, TIMESTAMP '{T1}' AS load_date
  FROM prod),
batch AS (SELECT *, {hash_sql(PRODUCT_COLUMNS)} AS hash FROM batch_raw),
dim AS (
  SELECT {PROD_COLS}, '{T0}' AS start_column, '{OPEN}' AS end_date, CAST(1 AS INT) AS "Iscurrent",
    {hash_sql(PRODUCT_COLUMNS)} AS hash
  FROM prod)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product name: that of the lowest part key."""
    parts = table(spark, sf_dir, "part").selectExpr(
        *_exprs(PRODUCT_EXPR, PRODUCT_COLUMNS), "p_size", "p_partkey"
    )
    return first_per_key(parts, ["product_name"], ["p_partkey"]).drop("p_partkey")


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_scd2(products(spark, sf_dir).select(*PRODUCT_COLUMNS), PRODUCT_COLUMNS, T0)


def staged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 as loaded into the dimension; batch 2 with new names and new prices."""
    base = products(spark, sf_dir)
    first = base.withColumn("load_date", F.lit(T0).cast("timestamp_ntz")).withColumn("batch_id", F.lit(1))
    second = base.withColumns(
        {
            "product_name": F.expr("CASE WHEN p_size > 35 THEN product_name || '-v2' ELSE product_name END"),
            "unit_price": F.expr("CASE WHEN p_size <= 15 THEN unit_price || '9' ELSE unit_price END"),
            "load_date": F.lit(T1).cast("timestamp_ntz"),
            "batch_id": F.lit(2),
        }
    )
    both = first.unionByName(second).drop("p_size")
    return both.withColumn("hash", row_hash(PRODUCT_COLUMNS))


def stored_products(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    dim = stored(product_dim(spark, sf_dir), "dim", ("Iscurrent",))
    return dim, stored(staged_products(spark, sf_dir), "staged", ("batch_id",))


# -- order lines ---------------------------------------------------------------------------

LINES_FROM = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey"""

LINES_SQL = f"""
order_lines AS (SELECT {_list(ORDER_EXPR, ORDER_COLUMNS)} {LINES_FROM})"""


def order_lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One row per order line in the columns of the order file, all text.

    Parts go onto the lines and customers onto the orders before the two meet, so that lines
    are never shuffled with what they take from their order. All four are shuffled whatever
    their size, so that what is moved grows with them; the names of nations come last.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").hint("merge"), F.expr("l_partkey = p_partkey")
    )
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").hint("merge"), F.expr("o_custkey = c_custkey")
    )
    joined = (
        lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    return joined.selectExpr(*_exprs(ORDER_EXPR, ORDER_COLUMNS), *extra)
