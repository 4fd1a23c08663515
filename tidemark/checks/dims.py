"""Joins, change detection, dimensions with history, star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks.registry import query
from tidemark.functions import columns as C
from tidemark.operators import changes, dedup, scd2
from tidemark.operators.merge import Matched, NotMatched, merge_into
from tidemark.plans import star
from tidemark.plans.model import CUSTOMER_COLUMNS, ORDER_COLUMNS, ORDER_DIM_COLUMNS, PRODUCT_COLUMNS
from tidemark.session import shared_path, shuffles_removed, stored

SCD2_SQL = """
SELECT {cols}, start_column,
  CASE WHEN d."Iscurrent" = 1 AND EXISTS (SELECT 1 FROM batch b WHERE b.{key} = d.{key} AND b.hash <> d.hash)
    THEN '{t1}' ELSE end_date END AS end_date,
  CAST(CASE WHEN d."Iscurrent" = 1 AND EXISTS (SELECT 1 FROM batch b WHERE b.{key} = d.{key} AND b.hash <> d.hash)
    THEN 0 ELSE d."Iscurrent" END AS INT) AS "Iscurrent", hash
FROM dim d
UNION ALL
SELECT {cols}, '{t1}', '{open}', CAST(1 AS INT), hash FROM batch s
WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.{key} = s.{key} AND d.hash = s.hash AND d."Iscurrent" = 1)"""


def _scd2_sql(cols: str, key: str) -> str:
    return SCD2_SQL.format(cols=cols, key=key, t1=I.T1, open=I.OPEN)


@query("scd2_batch_customer", f"WITH {I.CUST_BATCH_SQL} {_scd2_sql(I.CUST_COLS, 'customer_id')}")
def scd2_batch_customer(spark, sf):
    """The newest staged batch applied to the customer dimension."""
    dim, staged = I.stored_customers(spark, sf)
    return scd2.scd2_batch(dim, changes.latest_batch(staged), ["customer_id"], I.T1)


@query("scd2_batch_product", f"WITH {I.PROD_BATCH_SQL} {_scd2_sql(I.PROD_COLS, 'product_name')}")
def scd2_batch_product(spark, sf):
    dim, staged = I.stored_products(spark, sf)
    return scd2.scd2_batch(dim, changes.latest_batch(staged), ["product_name"], I.T1)


@query(
    "scd2_single_merge",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT {', '.join('d.' + c for c in CUSTOMER_COLUMNS)}, d.start_column,
      CASE WHEN b.hash <> d.hash THEN '{I.T1}' ELSE d.end_date END AS end_date,
      CAST(CASE WHEN b.hash <> d.hash THEN 0 ELSE 1 END AS INT) AS "Iscurrent", d.hash
    FROM dim d LEFT JOIN batch b ON b.customer_id = d.customer_id
    UNION ALL
    SELECT {I.CUST_COLS}, '{I.T1}', NULL, CAST(1 AS INT), hash FROM batch
    WHERE customer_id NOT IN (SELECT customer_id FROM dim)""",
)
def scd2_single_merge(spark, sf):
    dim, staged = I.stored_customers(spark, sf)
    source = changes.latest_batch(staged).drop(C.BATCH, "load_date")
    return scd2.scd2_single_merge(dim, source, ["customer_id"], I.T1)


@query("scd2_three_statements", f"WITH {I.CUST_BATCH_SQL} {_scd2_sql(I.CUST_COLS, 'customer_id')}")
def scd2_three_statements(spark, sf):
    """The same load as three statements on a table: expire, insert changed, insert new."""
    staged = stored(I.staged_customers(spark, sf), "staged", ("batch_id",))
    batch = changes.latest_batch(staged)
    dim = I.new_table(spark, "dim").create(I.customer_dim(spark, sf))
    differs = F.col(f"t.{C.HASH}") != F.col(f"s.{C.HASH}")
    expire = Matched(differs, set={C.END: C.instant(I.T1), C.CURRENT: F.lit(0)})
    dim.merge(batch, ["customer_id"], matched=[expire], target_condition=F.col(f"t.{C.CURRENT}") == 1)
    opened = [*CUSTOMER_COLUMNS, C.START, C.END, C.CURRENT, C.HASH]
    values = [
        *CUSTOMER_COLUMNS,
        C.instant(I.T1).alias(C.START),
        C.instant(I.OPEN).alias(C.END),
        F.lit(1).alias(C.CURRENT),
        C.HASH,
    ]
    dim.insert(changes.not_current(batch, dim.read(), ["customer_id"]).select(*values), opened)
    dim.insert(changes.new_keys(batch, dim.read(), ["customer_id"]).select(*values), opened)
    return dim.read()


@query(
    "join_expired_pairs",
    f"""WITH {I.CUST_BATCH_SQL}, after AS ({_scd2_sql(I.CUST_COLS, 'customer_id')})
    SELECT s.customer_id, s.customer_segment, s.hash, d.customer_segment AS expired_segment
    FROM batch s JOIN after d ON s.customer_id = d.customer_id WHERE d."Iscurrent" = 0 AND s.hash <> d.hash""",
)
def join_expired_pairs(spark, sf):
    """Staged rows joined with the expired versions they replaced."""
    dim, staged = I.stored_customers(spark, sf)
    batch = changes.latest_batch(staged)
    expired = scd2.scd2_batch(dim, batch, ["customer_id"], I.T1).where(F.col(C.CURRENT) == 0)
    cond = changes.equal_keys(["customer_id"], "s", "d") & (F.col("s.hash") != F.col("d.hash"))
    pairs = batch.alias("s").join(expired.alias("d"), cond, "inner")
    return pairs.select(
        "s.customer_id", "s.customer_segment", "s.hash", F.col("d.customer_segment").alias("expired_segment")
    )


@query(
    "merge_upsert",
    """WITH late AS (
      SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey),
    src AS (SELECT k, n FROM late UNION ALL SELECT -1 - s_suppkey, s_nationkey FROM supplier)
    SELECT c_custkey AS id,
      CASE WHEN n >= 3 THEN 'BUSY' WHEN n IS NOT NULL THEN 'LATE' ELSE c_mktsegment END AS segment,
      CASE WHEN n IS NOT NULL THEN n ELSE 0 END AS orders
    FROM customer LEFT JOIN src ON k = c_custkey WHERE coalesce(n <> 2, TRUE)
    UNION ALL SELECT k, 'NEW', n FROM src WHERE k NOT IN (SELECT c_custkey FROM customer) AND n > 5""",
)
def merge_upsert(spark, sf):
    """Update in two ways, delete, and insert under a condition."""
    target = I.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(0).cast("bigint").alias("orders"),
    )
    late = (
        I.table(spark, sf, "orders")
        .where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    partners = I.table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.col("s_nationkey").cast("bigint").alias("n")
    )
    n = F.col("s.n")
    return merge_into(
        target,
        late.unionByName(partners),
        ["id"],
        matched=[
            Matched(n == 2, delete=True),
            Matched(n >= 3, set={"segment": F.lit("BUSY"), "orders": n}),
            Matched(set={"segment": F.lit("LATE"), "orders": n}),
        ],
        not_matched=[
            NotMatched({"id": F.col("s.id"), "segment": F.lit("NEW"), "orders": n}, condition=n > 5)
        ],
    )


@query(
    "scd2_repair",
    f"""WITH {I.CUST_BATCH_SQL},
    after AS ({_scd2_sql(I.CUST_COLS, 'customer_id')}),
    doubled AS (SELECT * FROM after UNION ALL SELECT * FROM after WHERE customer_segment = 'SUPPLIER'),
    reopened AS (SELECT * REPLACE (CAST(CASE WHEN region = 'ASIA' THEN 1 ELSE "Iscurrent" END AS INT) AS "Iscurrent") FROM doubled),
    kept AS (SELECT * FROM reopened WHERE "Iscurrent" <> 0),
    once AS (
      SELECT DISTINCT * FROM kept WHERE customer_segment = 'SUPPLIER'
      UNION ALL SELECT * FROM kept WHERE customer_segment <> 'SUPPLIER')
    SELECT * EXCLUDE (nth) FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY start_column DESC) AS nth FROM once) WHERE nth = 1""",
)
def scd2_repair(spark, sf):
    """Reopen, drop expired, undo doubled versions, then one row per key."""
    after = stored(scd2_batch_customer(spark, sf), "after")
    doubled = after.unionByName(after.where(F.col("customer_segment") == "SUPPLIER"))
    reopened = scd2.reopen(doubled, F.col("region") == "ASIA")
    kept = scd2.drop_expired(reopened)
    once = scd2.dedup_versions_of(kept, F.col("customer_segment") == "SUPPLIER", ["customer_id"])
    return dedup.newest_per_key(once, ["customer_id"], [C.START])


@query(
    "cdc_change_type_all",
    f"""WITH {I.CUST_BATCH_SQL}, after AS ({_scd2_sql(I.CUST_COLS, 'customer_id')})
    SELECT s.customer_id, s.customer_segment, s.hash, s.batch_id, d."Iscurrent" AS "dim_Iscurrent",
      CASE WHEN d.customer_id IS NULL THEN 'INSERT' WHEN s.hash <> d.hash THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type
    FROM staged s LEFT JOIN after d ON s.customer_id = d.customer_id""",
)
def cdc_change_type_all(spark, sf):
    """All staged rows against all versions."""
    dim, staged = I.stored_customers(spark, sf)
    after = scd2.scd2_batch(dim, changes.latest_batch(staged), ["customer_id"], I.T1)
    shown = staged.select("customer_id", "customer_segment", "hash", "batch_id")
    return changes.change_types(shown, after, ["customer_id"], carry=[C.CURRENT])


@query(
    "cdc_change_type_batch",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT s.customer_id, s.customer_segment, s.hash, s.batch_id,
      CASE WHEN d.customer_id IS NULL THEN 'INSERT' WHEN s.hash <> d.hash THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type
    FROM staged s LEFT JOIN dim d ON s.customer_id = d.customer_id WHERE s.batch_id = 2""",
)
def cdc_change_type_batch(spark, sf):
    """The newest batch against current versions."""
    dim, staged = I.stored_customers(spark, sf)
    shown = staged.select("customer_id", "customer_segment", "hash", "batch_id")
    return changes.change_types(changes.latest_batch(shown), changes.current_rows(dim), ["customer_id"])


@query(
    "cdc_change_type_product",
    f"""WITH {I.PROD_BATCH_SQL}
    SELECT s.product_name, s.unit_price, s.hash,
      CASE WHEN d.product_name IS NULL THEN 'INSERT' WHEN s.hash <> d.hash THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type
    FROM batch s LEFT JOIN dim d ON s.product_name = d.product_name""",
)
def cdc_change_type_product(spark, sf):
    dim, staged = I.stored_products(spark, sf)
    batch = changes.latest_batch(staged).select("product_name", "unit_price", "hash")
    return changes.change_types(batch, changes.current_rows(dim), ["product_name"])


@query(
    "join_changed_pairs",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT d.customer_id, d.city, d.start_column, d.end_date, d.customer_segment AS old_customer_segment,
      d.hash AS old_hash, s.customer_segment AS new_customer_segment, s.hash AS new_hash
    FROM dim d JOIN batch s ON d.customer_id = s.customer_id WHERE d."Iscurrent" = 1 AND d.hash <> s.hash""",
)
def join_changed_pairs(spark, sf):
    return changes.changed_pairs(
        I.customer_dim(spark, sf),
        I.customer_batch(spark, sf),
        ["customer_id"],
        ["customer_segment"],
        keep=["city", C.START, C.END],
    )


@query(
    "join_delta_set",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT {', '.join('s.' + c for c in CUSTOMER_COLUMNS)}, CAST(s.load_date AS VARCHAR) AS load_date, s.hash
    FROM batch s LEFT JOIN dim t ON s.customer_id = t.customer_id AND t."Iscurrent" = 1
    WHERE t.customer_id IS NULL OR s.hash <> t.hash""",
)
def join_delta_set(spark, sf):
    return changes.delta_set(I.customer_batch(spark, sf), I.customer_dim(spark, sf), ["customer_id"])


@query(
    "join_left_anti",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT s.customer_id, s.customer_name, s.hash FROM batch s
    LEFT JOIN dim d ON s.customer_id = d.customer_id WHERE d.customer_id IS NULL""",
)
def join_left_anti(spark, sf):
    batch = I.customer_batch(spark, sf).select("customer_id", "customer_name", "hash")
    return changes.new_keys(batch, I.customer_dim(spark, sf), ["customer_id"])


@query(
    "join_not_exists",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT s.customer_id, s.customer_segment, s.hash FROM batch s WHERE NOT EXISTS (
      SELECT 1 FROM dim d WHERE d.customer_id = s.customer_id AND d.hash = s.hash AND d."Iscurrent" = 1)""",
)
def join_not_exists(spark, sf):
    batch = I.customer_batch(spark, sf).select("customer_id", "customer_segment", "hash")
    return changes.not_current(batch, I.customer_dim(spark, sf), ["customer_id"])


_PRODUCT_KEYS_SQL = f"""
{I.LINES_SQL},
named AS (SELECT product_name, row_number() OVER (ORDER BY product_name) AS product_id
  FROM (SELECT DISTINCT p_name AS product_name FROM part))"""


@query(
    "join_fact_key",
    f"""WITH {_PRODUCT_KEYS_SQL}
    SELECT {', '.join('a.' + c for c in ORDER_COLUMNS)}, b.product_id
    FROM named b JOIN order_lines a ON b.product_name = a.product_name""",
)
def join_fact_key(spark, sf):
    """Order lines with the surrogate key of their product."""
    names = I.table(spark, sf, "part").select(F.col("p_name").alias("product_name")).distinct()
    dim = star.with_surrogate_key(names, ["product_name"], "product_id")
    return star.fact_with_key(I.order_lines(spark, sf), dim, "product_name", "product_id")


@query(
    "pl_dim_customer",
    f"""WITH {I.LINES_SQL},
    one AS (SELECT DISTINCT {I.CUST_COLS} FROM order_lines)
    SELECT {I.CUST_COLS}, row_number() OVER (ORDER BY customer_id) AS customer_key,
      '{I.T0}' AS start_column, '{I.OPEN}' AS end_date, CAST(1 AS INT) AS "Iscurrent",
      {I.hash_sql(CUSTOMER_COLUMNS)} AS hash FROM one""",
)
def pl_dim_customer(spark, sf):
    return star.dim_customer(I.order_lines(spark, sf), I.T0)


_SUB_CATEGORY_SQL = (
    "CASE WHEN product_name = 'LG TVS' THEN 'Television' WHEN product_name = 'Samsung Mobile' THEN 'Smart Phones' "
    "WHEN product_name = 'Boat Watches' THEN 'Smart Watches' WHEN product_name = 'Dell Laptops' THEN 'Dell Laptops' "
    "WHEN product_name = 'Batteries' THEN 'Battery' ELSE 'Audio' END"
)


@query(
    "pl_dim_product",
    f"""WITH {I.LINES_SQL},
    p AS (SELECT product_name, category, {_SUB_CATEGORY_SQL} AS sub_category, sku_color AS color, unit_price, currency, tax_rate
      FROM order_lines),
    one AS (SELECT {I.PROD_COLS} FROM (
      SELECT *, row_number() OVER (PARTITION BY product_name
        ORDER BY category, sub_category, color, unit_price, currency, tax_rate) AS nth FROM p) WHERE nth = 1)
    SELECT {I.PROD_COLS}, row_number() OVER (ORDER BY product_name) AS product_id,
      '{I.T0}' AS start_column, '{I.OPEN}' AS end_date, CAST(1 AS INT) AS "Iscurrent",
      {I.hash_sql(PRODUCT_COLUMNS)} AS hash FROM one""",
)
def pl_dim_product(spark, sf):
    return star.dim_product(I.order_lines(spark, sf), I.T0)


_ORDER_REST = ", ".join(c for c in ORDER_DIM_COLUMNS if c != "order_id")


@query(
    "pl_dim_orders",
    f"""WITH {I.LINES_SQL},
    o AS (SELECT CAST(order_id AS BIGINT) AS order_id, {_ORDER_REST} FROM order_lines),
    one AS (SELECT * EXCLUDE (nth) FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_ORDER_REST}) AS nth FROM o) WHERE nth = 1)
    SELECT order_id, {_ORDER_REST}, '{I.T0}' AS start_column, '{I.OPEN}' AS end_date,
      CAST(1 AS INT) AS "Iscurrent", sha256(CAST(order_id AS VARCHAR)) AS hash FROM one""",
)
def pl_dim_orders(spark, sf):
    return star.dim_orders(I.order_lines(spark, sf), I.T0)


# Lines in a part of the order file: a packed part is read by one task.
LINES_PER_FILE = 500_000


@query(
    "pl_csv_to_star",
    f"""WITH all_lines AS (SELECT {I._list(I.ORDER_EXPR, ORDER_COLUMNS)}, l_linenumber {I.LINES_FROM}),
    good AS (SELECT * FROM all_lines WHERE l_linenumber < 7),
    named AS (SELECT product_name, row_number() OVER (ORDER BY product_name) AS product_id
      FROM (SELECT DISTINCT product_name FROM good))
    SELECT 'customers' AS output, count(*) AS rows, CAST(count(*) * (count(*) + 1) // 2 AS BIGINT) AS keys
      FROM (SELECT DISTINCT customer_id FROM good)
    UNION ALL SELECT 'products', count(*), CAST(sum(product_id) AS BIGINT) FROM named
    UNION ALL SELECT 'orders', count(*), CAST(sum(CAST(order_id AS BIGINT)) AS BIGINT)
      FROM (SELECT DISTINCT order_id FROM good WHERE length(order_id) < 5)
    UNION ALL SELECT 'fact', count(*), CAST(sum(product_id) AS BIGINT) FROM good JOIN named USING (product_name)
    UNION ALL SELECT 'bad_order_id', count(*), NULL FROM good WHERE length(order_id) >= 5
    UNION ALL SELECT 'broken_line', count(*), CAST(sum(CAST(order_id AS BIGINT)) AS BIGINT) FROM all_lines WHERE l_linenumber = 7""",
)
def pl_csv_to_star(spark, sf):
    """An order file with lines that break off and order ids that are no number, to all its tables."""
    path = shared_path(spark, "order-file")
    lines = I.order_lines(spark, sf, "l_linenumber")
    order_id = F.when((F.length("order_id") >= 5) & (F.col("l_linenumber") < 7), F.concat(F.lit("n"), "order_id"))
    lines = lines.withColumn("order_id", F.coalesce(order_id, F.col("order_id")))
    line = F.concat_ws(",", *ORDER_COLUMNS)
    text = lines.select(F.when(F.col("l_linenumber") == 7, F.substring_index(line, ",", 10)).otherwise(line).alias(",".join(ORDER_COLUMNS)))
    # The whole line is one column, so that it is written as it is, under a header of all names.
    # It is many times the tables it is made of, so it is packed.
    writer = text.write.option("header", True).option("sep", "\x01").option("escapeQuotes", False)
    with shuffles_removed(spark):
        writer.option("compression", "lz4").option("maxRecordsPerFile", LINES_PER_FILE).csv(path)
    made = star.star_from_csv(spark, path, I.T0)

    def counted(name: str, df, key):
        return df.agg(F.lit(name).alias("output"), F.count(F.lit(1)).alias("rows"), F.sum(key).cast("bigint").alias("keys"))

    first = F.substring_index("line", ",", 1)
    return (
        counted("customers", made.customers, F.col("customer_key"))
        .unionByName(counted("products", made.products, F.col("product_id")))
        .unionByName(counted("orders", made.orders, F.col("order_id")))
        .unionByName(counted("fact", made.fact, F.col("product_id")))
        .unionByName(counted("bad_order_id", made.rejects.where("reason = 'bad_order_id'"), F.lit(None).cast("bigint")))
        .unionByName(counted("broken_line", made.rejects.where("reason = 'broken_line'"), first.try_cast("bigint")))
    )
