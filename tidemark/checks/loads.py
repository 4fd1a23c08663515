"""Watermarks and incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks.registry import query
from tidemark.plans import incremental as inc
from tidemark.plans import model
from tidemark.plans.dimension import dimension_rows
from tidemark.tables.versioned import VersionedTable

FEED_MARK = "2024-01-15 00:00:00"


def _feeds(spark, sf):
    return I.table(spark, sf, "events").select(F.col("event_type").alias("table_name"))


def _control(spark, sf):
    """Marks as of the middle of the month, for the feeds that had events of value then."""
    early = (F.col("ts") <= F.lit(FEED_MARK).cast("timestamp_ntz")) & (F.col("event_type") != "signup")
    return inc.next_watermark(
        I.table(spark, sf, "events").where(early), F.col("event_type"), load="ts"
    )


CONTROL_SQL = f"""control AS (
  SELECT event_type AS table_name, max(ts) AS last_watermark FROM events
  WHERE ts <= TIMESTAMP '{FEED_MARK}' AND event_type <> 'signup' GROUP BY event_type)"""


@query(
    "wmk_seed",
    "SELECT DISTINCT event_type AS table_name, '1900-01-01 00:00:00' AS last_watermark FROM events",
)
def wmk_seed(spark, sf):
    """A control table created if absent and seeded for every feed that occurs."""
    control = I.new_table(spark, "control").create_empty(inc.CONTROL_SCHEMA, if_not_exists=True)
    control.append(inc.seed_watermarks(_feeds(spark, sf)))
    return control.read()


@query(
    "wmk_read",
    f"""WITH {CONTROL_SQL}
    SELECT DISTINCT event_type AS table_name, coalesce(CAST(last_watermark AS VARCHAR), '1900-01-01 00:00:00') AS last_watermark
    FROM events LEFT JOIN control ON table_name = event_type""",
)
def wmk_read(spark, sf):
    """Marks of all feeds; the one without a control row gets the first mark."""
    return inc.watermarks(_control(spark, sf), _feeds(spark, sf))


@query(
    "wmk_next",
    "SELECT event_type AS table_name, CAST(max(ts) AS VARCHAR) AS last_watermark FROM events GROUP BY event_type",
)
def wmk_next(spark, sf):
    return inc.next_watermark(I.table(spark, sf, "events"), F.col("event_type"), load="ts")


@query(
    "wmk_advance",
    f"""WITH {CONTROL_SQL},
    reached AS (
      SELECT event_type AS table_name, CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN min(ts) ELSE max(ts) END AS mark
      FROM events GROUP BY event_type)
    SELECT coalesce(c.table_name, r.table_name) AS table_name,
      CAST(greatest(coalesce(last_watermark, mark), coalesce(mark, last_watermark)) AS VARCHAR) AS last_watermark
    FROM control c FULL JOIN reached r ON c.table_name = r.table_name""",
)
def wmk_advance(spark, sf):
    """One increment is empty, one is older than its mark, one table is new."""
    per_feed = I.table(spark, sf, "events").groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("ts").alias("hi"), F.min("ts").alias("lo")
    )
    mark = F.when(F.col("table_name") == "view", F.col("lo")).when(F.col("table_name") != "click", F.col("hi"))
    reached = per_feed.select("table_name", mark.cast("timestamp").alias("last_watermark"))
    return inc.advance_watermarks(_control(spark, sf), reached)


# -- staged increments ------------------------------------------------------------------


def _landed(df, pairs):
    """Rows in the landing table's own names."""
    back = {model_name: landing for landing, model_name in pairs}
    return df.select(
        *[F.col(c).alias(back.get(c, c)) for c in df.columns]
    )


CUSTOMER = model.customer_spec(I.PREFIX, I.BATCH_SOURCE)
PRODUCT = model.product_spec(I.PREFIX, I.BATCH_SOURCE)
FACT = model.fact_spec(I.PREFIX, I.BATCH_SOURCE)


def customer_feed(spark, sf):
    """Landed customers, modified when they last ordered."""
    rows = (
        I.customers(spark, sf)
        .join(I.order_spans(spark, sf), F.expr("c_custkey = o_custkey"))
        .select(
            *model.CUSTOMER_COLUMNS,
            F.col("c_custkey").alias(f"{I.PREFIX}customerkey"),
            F.col("last_order").alias("modifiedon"),
        )
    )
    return _landed(rows, CUSTOMER.columns)


def _staged_tail(columns):
    return f"""'{I.T1}' AS start_column, '{I.OPEN}' AS end_date, {I.hash_sql(columns)} AS hash,
      CAST(7 AS INT) AS batch_id, '{I.BATCH_SOURCE}' AS "Source_column\""""


@query(
    "inc_load_customer",
    f"""WITH {I.CUST_SQL}
    SELECT {I.CUST_COLS}, c_custkey AS src_customerkey, CAST(last_order AS VARCHAR) AS load_date, {_staged_tail(model.CUSTOMER_COLUMNS)}
    FROM cust JOIN last_order ON c_custkey = o_custkey WHERE last_order > TIMESTAMP '{I.BATCH_CUT}'""",
)
def inc_load_customer(spark, sf):
    return inc.stage_increment(customer_feed(spark, sf), CUSTOMER, I.BATCH_CUT, 7, I.T1)


@query(
    "inc_load_product",
    f"""WITH shipped AS (SELECT l_partkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_partkey),
    p AS (SELECT {I._list(I.PRODUCT_EXPR, model.PRODUCT_COLUMNS)}, p_partkey, last_ship FROM part JOIN shipped ON l_partkey = p_partkey)
    SELECT {I.PROD_COLS}, p_partkey AS src_productid1, CAST(last_ship AS VARCHAR) AS load_date, {_staged_tail(model.PRODUCT_COLUMNS)}
    FROM p WHERE last_ship > TIMESTAMP '2001-09-01 00:00:00'""",
)
def inc_load_product(spark, sf):
    shipped = I.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("modifiedon"))
    rows = (
        I.table(spark, sf, "part")
        .join(shipped, F.expr("l_partkey = p_partkey"))
        .selectExpr(
            *I._exprs(I.PRODUCT_EXPR, model.PRODUCT_COLUMNS),
            f"p_partkey AS {I.PREFIX}productid1",
            "modifiedon",
        )
    )
    return inc.stage_increment(_landed(rows, PRODUCT.columns), PRODUCT, "2001-09-01 00:00:00", 7, I.T1)


_FACT_COLS = [*model.ORDER_COLUMNS, "product_id"]


@query(
    "inc_load_fact",
    f"""WITH f AS (SELECT {I._list(I.ORDER_EXPR, model.ORDER_COLUMNS)}, CAST(l_partkey AS VARCHAR) AS product_id, l_shipdate {I.LINES_FROM})
    SELECT {', '.join(_FACT_COLS)}, CAST(l_shipdate AS VARCHAR) AS load_date, {_staged_tail(model.FACT_HASH_COLUMNS)}
    FROM f WHERE l_shipdate > TIMESTAMP '{I.BATCH_CUT}'""",
)
def inc_load_fact(spark, sf):
    rows = I.order_lines(spark, sf, "CAST(l_partkey AS STRING) AS product_id", "l_shipdate AS modifiedon")
    return inc.stage_increment(_landed(rows, FACT.columns), FACT, I.BATCH_CUT, 7, I.T1)


# -- the whole cycle -----------------------------------------------------------------------

STAGED_SCHEMA = (
    ", ".join(f"{c} string" for c in model.CUSTOMER_COLUMNS)
    + f", {I.PREFIX}customerkey bigint, load_date timestamp_ntz, start_column timestamp, end_date timestamp, "
    "hash string, batch_id int, Source_column string"
)
DIM_SCHEMA = (
    ", ".join(f"{c} string" for c in model.CUSTOMER_COLUMNS)
    + f", {I.PREFIX}customerkey bigint, start_column timestamp, end_date timestamp, Iscurrent int, "
    "hash string, Source_column string, load_date timestamp_ntz"
)


def first_feed(spark, sf):
    """The landing table before the cut: customers that had ordered, modified at that time."""
    before = (
        I.table(spark, sf, "orders")
        .where(F.col("o_orderdate") <= F.lit(I.BATCH_CUT).cast("timestamp_ntz"))
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("modifiedon"))
    )
    rows = (
        I.customers(spark, sf)
        .join(before, F.expr("c_custkey = o_custkey"))
        .select(*model.CUSTOMER_COLUMNS, F.col("c_custkey").alias(f"{I.PREFIX}customerkey"), "modifiedon")
    )
    return _landed(rows, CUSTOMER.columns)


def second_feed(spark, sf):
    """The landing table now: later orders, and new segments for low balances."""
    segment = F.when(F.col("c_acctbal") < 2000, F.lit("CHANGED")).otherwise(F.col("customer_segment"))
    rows = (
        I.customers(spark, sf)
        .join(I.order_spans(spark, sf), F.expr("c_custkey = o_custkey"))
        .withColumn("customer_segment", segment)
        .select(
            *model.CUSTOMER_COLUMNS,
            F.col("c_custkey").alias(f"{I.PREFIX}customerkey"),
            F.col("last_order").alias("modifiedon"),
        )
    )
    return _landed(rows, CUSTOMER.columns)


def cycle_tables(spark):
    control = I.new_table(spark, "control").create_empty(inc.CONTROL_SCHEMA)
    staged = I.new_table(spark, "staged", partition_by=["batch_id"]).create_empty(STAGED_SCHEMA)
    return control, staged, I.new_dimension(spark, DIM_SCHEMA, ["customer_id"])


@query(
    "inc_full_cycle",
    f"""WITH {I.CUST_SQL},
    one AS (
      SELECT {I.CUST_COLS}, c_custkey AS src_customerkey, load_date, {I.hash_sql(model.CUSTOMER_COLUMNS)} AS hash
      FROM cust JOIN (SELECT o_custkey, max(o_orderdate) AS load_date FROM orders
        WHERE o_orderdate <= TIMESTAMP '{I.BATCH_CUT}' GROUP BY o_custkey) ON c_custkey = o_custkey),
    now AS (
      SELECT customer_id, customer_name, CASE WHEN c_acctbal < 2000 THEN 'CHANGED' ELSE customer_segment END AS customer_segment,
        region, country, state, city, postal_code, contact_email, c_custkey AS src_customerkey, last_order AS load_date
      FROM cust JOIN last_order ON c_custkey = o_custkey WHERE last_order > (SELECT max(load_date) FROM one)),
    two AS (SELECT *, {I.hash_sql(model.CUSTOMER_COLUMNS)} AS hash FROM now)
    SELECT {', '.join('o.' + c for c in model.CUSTOMER_COLUMNS)}, o.src_customerkey, '{I.T0}' AS start_column,
      CASE WHEN t.hash <> o.hash THEN '{I.T1}' ELSE '{I.OPEN}' END AS end_date,
      CAST(CASE WHEN t.hash <> o.hash THEN 0 ELSE 1 END AS INT) AS "Iscurrent", o.hash,
      '{I.BATCH_SOURCE}' AS "Source_column", CAST(o.load_date AS VARCHAR) AS load_date
    FROM one o LEFT JOIN two t ON o.customer_id = t.customer_id
    UNION ALL
    SELECT {', '.join('t.' + c for c in model.CUSTOMER_COLUMNS)}, t.src_customerkey, '{I.T1}', '{I.OPEN}', CAST(1 AS INT), t.hash,
      '{I.BATCH_SOURCE}', CAST(t.load_date AS VARCHAR)
    FROM two t LEFT JOIN one o ON o.customer_id = t.customer_id WHERE o.hash IS NULL OR o.hash <> t.hash""",
)
def inc_full_cycle(spark, sf):
    """Two loads and one without news: mark, staging, dimension, mark."""
    control, staged, dim = cycle_tables(spark)
    inc.run_cycle(spark, CUSTOMER, first_feed(spark, sf), staged, control, I.T0, dim)
    second = second_feed(spark, sf)
    inc.run_cycle(spark, CUSTOMER, second, staged, control, I.T1, dim)
    inc.run_cycle(spark, CUSTOMER, second, staged, control, "2024-03-01 00:00:00", dim)
    return dimension_rows(dim)
