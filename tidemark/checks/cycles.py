"""Cycles over all tables of a control table, and rows that they turn away."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks import loads as L
from tidemark.checks.registry import query
from tidemark.plans import incremental as inc
from tidemark.plans import model

NO_SEGMENT = ("no_segment", "customer_segment = 'MACHINERY'")


def tables_for(spark, spec, feed, keys=None):
    """An empty staged table for the feed and, with keys, an empty dimension."""
    schema = inc.stage_increment(feed, spec, inc.FIRST_MARK, 0, I.T0).schema
    staged = I.new_table(spark, "staged", partition_by=["batch_id"]).create_empty(schema)
    if keys is None:
        return staged, None
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != "batch_id"]
    return staged, I.new_dimension(spark, ", ".join([*columns, "Iscurrent int"]), keys)


@query(
    "cycle_rejects",
    f"""WITH {I.CUST_SQL}
    SELECT 'customer' AS table_name, CASE WHEN c_acctbal < 0 THEN 'null_key' ELSE 'no_segment' END AS reason,
      CAST(1 AS INT) AS batch_id, CAST(last_order AS VARCHAR) AS load_date, customer_name,
      (SELECT count(*) FROM cust JOIN last_order ON c_custkey = o_custkey
        WHERE c_acctbal >= 0 AND customer_segment <> 'MACHINERY') AS open_rows
    FROM cust JOIN last_order ON c_custkey = o_custkey WHERE c_acctbal < 0 OR customer_segment = 'MACHINERY'""",
)
def cycle_rejects(spark, sf):
    """What a cycle turns away and why; the same feed again, with a margin, adds nothing."""
    spec = replace(L.CUSTOMER, rules=(NO_SEGMENT,))
    key = dict((t, s) for s, t in spec.columns)["customer_id"]
    rows = I.customers(spark, sf).join(I.order_spans(spark, sf), F.expr("c_custkey = o_custkey"))
    named = rows.select(
        *model.CUSTOMER_COLUMNS,
        F.col("c_custkey").alias(f"{I.PREFIX}customerkey"),
        F.col("last_order").alias("modifiedon"),
        "c_acctbal",
    )
    feed = L._landed(named, spec.columns).withColumn(key, F.when(F.col("c_acctbal") >= 0, F.col(key)))
    staged, dim = tables_for(spark, spec, feed, ["customer_id"])
    control = I.new_table(spark, "control").create_empty(inc.CONTROL_SCHEMA)
    rejects = I.new_table(spark, "rejects").create_empty(inc.REJECT_SCHEMA)
    inc.run_cycle(spark, spec, feed, staged, control, I.T0, dim, rejects=rejects)
    inc.run_cycle(spark, spec, feed, staged, control, I.T1, dim, overlap=inc.timedelta(days=30), rejects=rejects)
    name = F.get_json_object("row", "$.customer_name").alias("customer_name")
    open_rows = F.lit(dim.read().where("Iscurrent = 1").count()).cast("bigint").alias("open_rows")
    return rejects.read().select("table_name", "reason", "batch_id", "load_date", name, open_rows)


@query(
    "inc_full_cycle_all",
    f"""WITH {I.CUST_SQL}, c AS (SELECT customer_id, last_order FROM cust JOIN last_order ON c_custkey = o_custkey),
    p AS (SELECT p_name, max(l_shipdate) AS shipped FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_name),
    f AS (SELECT l_shipdate {I.LINES_FROM})
    SELECT 'customer' AS table_name, CAST(max(last_order) AS VARCHAR) AS last_watermark, count(*) AS staged_rows,
      count(DISTINCT customer_id) AS open_rows, CAST(0 AS BIGINT) AS again_rows, FALSE AS failed FROM c
    UNION ALL SELECT 'product', CAST(max(shipped) AS VARCHAR), count(*), count(DISTINCT p_name), 0, FALSE FROM p
    UNION ALL SELECT 'factorder', CAST(max(l_shipdate) AS VARCHAR), count(*), NULL, 0, FALSE FROM f
    UNION ALL SELECT 'returns', '1900-01-01 00:00:00', 0, NULL, 0, TRUE""",
)
def inc_full_cycle_all(spark, sf):
    """Three tables and one whose feed lacks its columns, loaded and loaded again with a margin."""
    shipped = I.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max("l_shipdate").alias("modifiedon"))
    parts = I.table(spark, sf, "part").join(shipped, F.expr("l_partkey = p_partkey")).selectExpr(
        *I._exprs(I.PRODUCT_EXPR, model.PRODUCT_COLUMNS), f"p_partkey AS {I.PREFIX}productid1", "modifiedon"
    )
    lines = I.order_lines(spark, sf, "CAST(l_partkey AS STRING) AS product_id", "l_shipdate AS modifiedon")
    feeds = {
        L.CUSTOMER: (L.customer_feed(spark, sf), ["customer_id"]),
        L.PRODUCT: (L._landed(parts, L.PRODUCT.columns), ["product_name"]),
        L.FACT: (L._landed(lines, L.FACT.columns), None),
    }
    loads = []
    for spec, (feed, keys) in feeds.items():
        staged, dim = tables_for(spark, spec, feed, keys)
        loads.append(inc.Load(spec, feed, staged, dim))
    broken = replace(L.PRODUCT, name="returns", columns=(("no_such_column", "product_name"),))
    loads.append(inc.Load(broken, loads[1].feed, tables_for(spark, L.PRODUCT, loads[1].feed)[0]))
    control = I.new_table(spark, "control").create_empty(inc.CONTROL_SCHEMA)
    first = inc.run_cycles(spark, loads, control, I.T0, parallel=2)
    again = inc.run_cycles(spark, loads, control, I.T1, overlap=inc.timedelta(days=1), parallel=2)
    dims = {load.spec.name: load.dim for load in loads if load.dim is not None}
    rows = [
        (
            one.table,
            one.staged_rows,
            dims[one.table].read().where("Iscurrent = 1").count() if one.table in dims else None,
            two.staged_rows,
            one.error is not None and two.error is not None,
        )
        for one, two in zip(first, again, strict=True)
    ]
    named = spark.createDataFrame(
        rows, "table_name string, staged_rows bigint, open_rows bigint, again_rows bigint, failed boolean"
    )
    return inc.watermarks(control.read(), named).join(named, "table_name")
