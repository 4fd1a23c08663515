"""Projections, filters, aggregates, limits, sets, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks.registry import query
from tidemark.functions import columns as C
from tidemark.operators import changes, dedup, keys, sets
from tidemark.plans.incremental import newer_than, next_batches
from tidemark.plans.model import CUSTOMER_COLUMNS

PRODUCT_KINDS = {
    "red widget": "Widgets",
    "blue bolt": "Fasteners",
    "small ring": "Rings",
    "hot plate": "Kitchen",
    "old gear": "Spares",
}
PRODUCT_KINDS_SQL = " ".join(f"WHEN p_name = '{k}' THEN '{v}'" for k, v in PRODUCT_KINDS.items())


@query("prj_select", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def prj_select(spark, sf):
    return I.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")


@query(
    "prj_alias",
    "SELECT p_name AS product_name, p_type AS category, p_brand AS color, p_retailprice AS unit_price FROM part",
)
def prj_alias(spark, sf):
    return I.table(spark, sf, "part").select(
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("color"),
        F.col("p_retailprice").alias("unit_price"),
    )


LINE_PAIRS = [
    ("src_l_orderkey", "order_id"),
    ("src_l_linenumber", "line_number"),
    ("src_l_partkey", "product_key"),
    ("src_l_quantity", "qty"),
    ("src_l_extendedprice", "line_amount"),
    ("src_l_tax", "tax_rate"),
    ("src_l_linestatus", "payment_status"),
    ("src_l_shipdate", "load_date"),
]


def _prefixed(df, prefix="src_"):
    return df.toDF(*[prefix + c for c in df.columns])


@query(
    "prj_model_rename",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_key,
    l_quantity AS qty, l_extendedprice AS line_amount, l_tax AS tax_rate,
    l_linestatus AS payment_status, CAST(l_shipdate AS VARCHAR) AS load_date FROM lineitem""",
)
def prj_model_rename(spark, sf):
    return C.rename_select(_prefixed(I.table(spark, sf, "lineitem")), LINE_PAIRS)


@query(
    "prj_mapping_driven",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
    o_totalprice AS total_amount FROM orders""",
)
def prj_mapping_driven(spark, sf):
    """The projection comes from mapping rows; an inactive row and a padded table name are in."""
    mapping = spark.createDataFrame(
        [
            (" factorder", "src_orders", "src_o_orderkey", "order_id", "order_key", 1, 1),
            ("factorder", "src_orders", "src_o_custkey", "customer_id", "order_key", 0, 1),
            ("factorder", "src_orders", "src_o_orderstatus", "order_status", "order_key", 0, 1),
            ("factorder", "src_orders", "src_o_totalprice", "total_amount", "order_key", 0, 1),
            ("factorder", "src_orders", "src_o_orderpriority", "priority", "order_key", 0, 0),
            ("dimcustomer", "src_customer", "src_c_name", "customer_name", "customer_key", 0, 1),
        ],
        "target_table string, source_table string, source_column string, "
        "destination_column string, destination_key string, is_key int, is_active int",
    )
    return C.project_by_mapping(_prefixed(I.table(spark, sf, "orders")), mapping, "factorder")


@query("prj_lit", """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'source' AS "Source_column" FROM supplier""")
def prj_lit(spark, sf):
    return I.table(spark, sf, "supplier").withColumns({C.SOURCE: F.lit("source").cast("string")})


@query("prj_rename", "SELECT c_custkey AS customer_key, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def prj_rename(spark, sf):
    return I.table(spark, sf, "customer").withColumnRenamed("c_custkey", "customer_key")


@query(
    "prj_cast",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(o_orderkey AS BIGINT) AS key_int,
    TRY_CAST(o_orderpriority AS INT) AS priority_int, CAST(o_orderdate AS VARCHAR) AS order_ts,
    CAST(1 AS INT) AS flag FROM orders""",
)
def prj_cast(spark, sf):
    return I.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderkey").cast("string").cast("bigint").alias("key_int"),
        F.expr("try_cast(o_orderpriority AS int)").alias("priority_int"),
        F.col("o_orderdate").cast("string").cast("timestamp").alias("order_ts"),
        F.lit(1).cast("int").alias("flag"),
    )


@query(
    "prj_case_map",
    f"SELECT p_partkey, p_name, CASE {PRODUCT_KINDS_SQL} ELSE 'Audio' END AS sub_category FROM part",
)
def prj_case_map(spark, sf):
    parts = I.table(spark, sf, "part").select("p_partkey", "p_name")
    return parts.withColumn("sub_category", C.value_map("p_name", PRODUCT_KINDS, "Audio"))


@query(
    "prj_case_map_table",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
    coalesce(n_name, 'UNKNOWN') AS supplier_nation
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def prj_case_map_table(spark, sf):
    """The same mapping held as a table: supplier to nation name."""
    pairs = I.table(spark, sf, "supplier").join(
        I.table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    lines = I.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return C.map_by_table(lines, "l_suppkey", pairs, "s_suppkey", "n_name", "supplier_nation", "UNKNOWN")


@query("prj_select_expr", "SELECT max(l_orderkey) AS max_key, min(l_shipdate)::VARCHAR AS first_ship FROM lineitem")
def prj_select_expr(spark, sf):
    return I.table(spark, sf, "lineitem").selectExpr(
        "max(l_orderkey) AS max_key", "min(l_shipdate) AS first_ship"
    )


@query(
    "prj_scd2_columns",
    f"""WITH {I.CUST_SQL}
    SELECT {I.CUST_COLS}, '{I.T0}' AS start_column, '{I.OPEN}' AS end_date,
      CAST(1 AS INT) AS "Iscurrent", {I.hash_sql(CUSTOMER_COLUMNS)} AS hash
    FROM cust""",
)
def prj_scd2_columns(spark, sf):
    return I.customer_dim(spark, sf)


@query("flt_equality", "SELECT * EXCLUDE (ts), CAST(ts AS VARCHAR) AS ts FROM events WHERE event_type = 'click' OR event_type <> 'view' AND user_id = 8")
def flt_equality(spark, sf):
    kind = F.col("event_type")
    return I.table(spark, sf, "events").where((kind == "click") | ((kind != "view") & (F.col("user_id") == 8)))


@query(
    "flt_watermark",
    """SELECT event_id, user_id, event_type, value, CAST(ts AS VARCHAR) AS load_date
    FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
)
def flt_watermark(spark, sf):
    feed = I.table(spark, sf, "events").withColumnRenamed("ts", "modifiedon")
    rows = newer_than(feed, "modifiedon", "2024-01-15 00:00:00")
    return rows.select("event_id", "user_id", "event_type", "value", F.col("modifiedon").alias("load_date"))


def _event_batches(spark, sf):
    return I.table(spark, sf, "events").withColumn("batch_id", F.dayofmonth("ts"))


@query(
    "flt_latest_batch",
    """WITH b AS (SELECT event_id, user_id, event_type, value, CAST(day(ts) AS INT) AS batch_id FROM events)
    SELECT * FROM b WHERE batch_id = (SELECT max(batch_id) FROM b)""",
)
def flt_latest_batch(spark, sf):
    staged = _event_batches(spark, sf).select("event_id", "user_id", "event_type", "value", "batch_id")
    return changes.latest_batch(staged)


@query(
    "flt_current",
    """SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS INT) AS "Iscurrent"
    FROM orders WHERE o_orderstatus <> 'F'""",
)
def flt_current(spark, sf):
    flag = F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(1))
    return changes.current_rows(
        I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", flag.alias(C.CURRENT))
    )


@query("agg_max", "SELECT CAST(max(ts) AS VARCHAR) AS max_load, max(event_id) AS max_id FROM events")
def agg_max(spark, sf):
    return I.table(spark, sf, "events").agg(F.max("ts").alias("max_load"), F.max("event_id").alias("max_id"))


@query(
    "agg_next_batch",
    """SELECT 'events' AS table_name, CAST(coalesce(max(day(ts)), 0) + 1 AS INT) AS next_batch FROM events
    UNION ALL SELECT 'lines', CAST(coalesce(max(l_linenumber), 0) + 1 AS INT) FROM lineitem
    UNION ALL SELECT 'unbatched', CAST(coalesce(max(NULL::INT), 0) + 1 AS INT) FROM orders""",
)
def agg_next_batch(spark, sf):
    """Next batch per table; one table has only NULL batches."""
    return next_batches(
        {
            "events": _event_batches(spark, sf),
            "lines": I.table(spark, sf, "lineitem").withColumn("batch_id", F.col("l_linenumber")),
            "unbatched": I.table(spark, sf, "orders").withColumn(
                "batch_id", F.expr("try_cast(o_orderpriority AS int)")
            ),
        }
    )


@query(
    "agg_next_key_range",
    """SELECT s_name AS partner, (SELECT coalesce(max(c_custkey), 0) FROM customer)
      + row_number() OVER (ORDER BY s_name) AS partner_key FROM supplier""",
)
def agg_next_key_range(spark, sf):
    """New rows get keys after the highest one given out."""
    start = keys.next_key_start(I.table(spark, sf, "customer"), "c_custkey").scalar()
    partners = I.table(spark, sf, "supplier").select(F.col("s_name").alias("partner"))
    return keys.with_surrogate_key(partners, ["partner"], "partner_key", start_after=start)


@query(
    "dedup_key",
    """SELECT user_id, event_type, CAST(ts AS VARCHAR) AS ts, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS nth
      FROM events) WHERE nth = 1""",
)
def dedup_key(spark, sf):
    events = I.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return dedup.newest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dedup_key_hash",
    """SELECT customer_id, hash, min(event_id) AS event_id FROM (
      SELECT user_id AS customer_id, sha256(concat_ws('|', CAST(user_id AS VARCHAR), event_type)) AS hash, event_id
      FROM events) GROUP BY customer_id, hash""",
)
def dedup_key_hash(spark, sf):
    rows = I.table(spark, sf, "events").select(
        F.col("user_id").alias("customer_id"),
        C.row_hash(["user_id", "event_type"]).alias("hash"),
        "event_id",
    )
    return dedup.first_per_key(rows, ["customer_id", "hash"], ["event_id"])


@query(
    "win_surrogate_key",
    "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS order_sk FROM orders",
)
def win_surrogate_key(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keys.with_surrogate_key(orders, ["o_custkey", "o_orderkey"], "order_sk")


@query(
    "win_row_number",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem""",
)
def win_row_number(spark, sf):
    lines = I.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return keys.row_numbers(lines, ["l_orderkey"], order, descending=["l_linenumber"])


@query(
    "tbl_key_violations",
    """SELECT order_key, line_number, rows,
      CASE WHEN order_key IS NULL OR line_number IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation
    FROM (
      SELECT l_orderkey AS order_key, CASE WHEN l_returnflag = 'R' AND l_quantity > 49 THEN NULL ELSE l_linenumber END AS line_number,
        count(*) AS rows FROM lineitem GROUP BY 1, 2)
    WHERE rows > 1 OR order_key IS NULL OR line_number IS NULL""",
)
def tbl_key_violations(spark, sf):
    """(order, line) is no key of the lines; some line numbers are made NULL."""
    lost = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 49)
    lines = I.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.when(lost, F.lit(None)).otherwise(F.col("l_linenumber")).alias("line_number"),
    )
    return keys.key_violations(lines, ["order_key", "line_number"])


@query(
    "lim_ordered",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000""",
)
def lim_ordered(spark, sf):
    """The first thousand rows, as a preview shows them, in a fixed order."""
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(1000)


@query(
    "set_union_master",
    f"""WITH {I.CUST_BATCH_SQL}
    SELECT {I.CUST_COLS}, CAST(load_date AS VARCHAR) AS load_date, hash, 'landing' AS "Source_column",
      CAST(NULL AS INT) AS "Iscurrent" FROM batch
    UNION ALL
    SELECT {I.CUST_COLS}, NULL, hash, 'source', "Iscurrent" FROM dim""",
)
def set_union_master(spark, sf):
    """Two sources of customers; each has a column the other lacks."""
    landed = I.customer_batch(spark, sf).withColumn(C.SOURCE, F.lit(I.BATCH_SOURCE))
    own = I.customer_dim(spark, sf).drop(C.START, C.END).withColumn(C.SOURCE, F.lit("source"))
    return sets.union_master(landed, own)


@query(
    "set_split_fix_union",
    """WITH e AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS kind, user_id, event_id FROM events)
    SELECT kind, user_id, min(event_id) AS event_id FROM e WHERE kind = 'view' GROUP BY kind, user_id
    UNION ALL SELECT kind, user_id, event_id FROM e WHERE kind IS NULL OR kind <> 'view'""",
)
def set_split_fix_union(spark, sf):
    """One kind of event is reduced to a row per user; rows without a kind stay."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = I.table(spark, sf, "events").select(kind.alias("kind"), "user_id", "event_id")
    return sets.fix_part(
        events,
        F.col("kind") == "view",
        lambda part: dedup.first_per_key(part, ["kind", "user_id"], ["event_id"]),
    )
