"""Sources: files, SQL text, payloads, pages, endpoints, configured loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.checks import inputs as I
from tidemark.checks.registry import query
from tidemark.functions import json_fields
from tidemark.session import shared_path
from tidemark.sources import config, files, payloads
from tidemark.tables.versioned import VersionedTable

ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "total", "o_orderdate", "o_orderpriority"]
ORDERS_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
    o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
    CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


@query("src_csv_strings", ORDERS_TEXT_SQL)
def src_csv_strings(spark, sf):
    """Orders written as CSV with a header and read back, every column as text."""
    path = shared_path(spark, "csv")
    orders = I.table(spark, sf, "orders").withColumn("total", F.col("o_totalprice").cast("decimal(18,2)"))
    orders.select([F.col(c).cast("string") for c in ORDER_FIELDS]).write.option("header", True).csv(path)
    return files.read_csv_strings(spark, path, ORDER_FIELDS)


@query("src_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_table(spark, sf):
    I.table(spark, sf, "supplier").createOrReplaceTempView("sr_supplier")
    return spark.read.table("sr_supplier")


@query(
    "src_sql_text",
    """SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest
    FROM orders WHERE o_totalprice > 1000.0 GROUP BY o_orderpriority""",
)
def src_sql_text(spark, sf):
    return spark.sql(
        "SELECT o_orderpriority, count(*) AS orders, max(o_totalprice) AS highest "
        "FROM {orders} WHERE o_totalprice > :least GROUP BY o_orderpriority",
        args={"least": 1000.0},
        orders=I.table(spark, sf, "orders"),
    )


@query(
    "src_json_infer",
    "SELECT event_id, event_type, props, CAST(ts AS VARCHAR) AS ts, user_id, value FROM events",
)
def src_json_infer(spark, sf):
    path = shared_path(spark, "json")
    I.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string")).write.json(path)
    return files.read_json(spark, path)


@query("src_table_path", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def src_table_path(spark, sf):
    root = shared_path(spark, "parts")
    VersionedTable(spark, root).create(I.table(spark, sf, "part"))
    return VersionedTable(spark, root).read()


# -- payloads --------------------------------------------------------------------------

PAGE_ROWS = 50
PAYLOAD_SCHEMA = (
    "endpoint string, page bigint, data struct<products: array<struct<"
    "asin: bigint, product_title: string, product_price: double, product_star_rating: int>>>"
)


def _page():
    return F.expr(f"p_partkey div {PAGE_ROWS} + 1")


def _landed_pages(spark, sf, without=None):
    """Parts as payload pages of one endpoint per type; a page holds up to 50 parts."""
    product = F.struct(
        F.col("p_partkey").alias("asin"),
        F.col("p_name").alias("product_title"),
        F.col("p_retailprice").alias("product_price"),
        F.col("p_size").alias("product_star_rating"),
    )
    parts = I.table(spark, sf, "part").withColumn("page", _page())
    pages = parts.groupBy(F.col("p_type").alias("endpoint"), "page").agg(
        F.sort_array(F.collect_list(product)).alias("products")
    )
    if without is not None:
        empty = F.slice("products", 1, 0)
        pages = pages.withColumn("products", F.when(without, empty).otherwise(F.col("products")))
    path = shared_path(spark, "pages")
    pages.select("endpoint", "page", F.struct("products").alias("data")).write.json(path)
    return files.read_json(spark, path, PAYLOAD_SCHEMA)


PRODUCT_FIELDS = [
    ("asin", "asin"),
    ("product_title", "product_title"),
    ("product_price", "price"),
    ("product_star_rating", "rating"),
]


@query(
    "src_payload_explode",
    "SELECT p_partkey AS asin, p_name AS product_title, p_retailprice AS price, p_size AS rating FROM part",
)
def src_payload_explode(spark, sf):
    return payloads.explode_records(_landed_pages(spark, sf), "data.products", PRODUCT_FIELDS)


@query(
    "src_paged_limit",
    """WITH pages AS (
      SELECT p_type AS endpoint, p_partkey // 50 + 1 AS page, p_partkey AS asin, p_name AS product_title
      FROM part WHERE NOT (p_type = 'PROMO' AND p_partkey // 50 + 1 = 3)),
    numbered AS (SELECT *, dense_rank() OVER (PARTITION BY endpoint ORDER BY page) AS nth,
      row_number() OVER (PARTITION BY endpoint ORDER BY page, asin) AS position FROM pages)
    SELECT endpoint, page, position, asin, product_title FROM numbered WHERE nth = page AND position <= 200""",
)
def src_paged_limit(spark, sf):
    """Per endpoint at most 200 records, up to its first empty page; one page is landed empty."""
    pages = _landed_pages(spark, sf, (F.col("endpoint") == "PROMO") & (F.col("page") == 3))
    kept = payloads.paged_records(
        pages.select("endpoint", "page", F.col("data.products").alias("products")),
        "page",
        "products",
        200,
        ["endpoint"],
    )
    return kept.select("endpoint", "page", "position", "record.asin", "record.product_title")


DETAIL_SCHEMA = (
    "asin string, product_title string, price string, rating string, rating_count string, brand string, "
    "availability_status string, product_description string, product_url string, country string"
)


@query(
    "src_json_schema",
    """SELECT CAST(p_partkey AS VARCHAR) AS asin, p_name AS product_title,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(p_size AS VARCHAR) AS rating,
    CAST(NULL AS VARCHAR) AS rating_count, p_brand AS brand, CAST(NULL AS VARCHAR) AS availability_status,
    p_type AS product_description, CAST(NULL AS VARCHAR) AS product_url, 'US' AS country FROM part""",
)
def src_json_schema(spark, sf):
    """Records with numbers in them read under a schema of text; absent fields become NULL."""
    path = shared_path(spark, "details")
    I.table(spark, sf, "part").select(
        F.col("p_partkey").alias("asin"),
        F.col("p_name").alias("product_title"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        F.col("p_size").alias("rating"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_description"),
        F.lit("US").alias("country"),
    ).write.json(path)
    return files.read_json(spark, path, DETAIL_SCHEMA)


def _shaped_payloads(spark, sf):
    """Parts as payloads of six shapes, by the part's type."""
    item = "'{\"asin\":' || p_partkey || ',\"title\":\"' || p_name || '\"}'"
    return I.table(spark, sf, "part").selectExpr(
        "p_partkey AS payload_id",
        "p_type AS endpoint",
        f"""CASE p_type
          WHEN 'STANDARD' THEN '[' || {item} || ',' || p_size || ']'
          WHEN 'ECONOMY' THEN {item}
          WHEN 'PROMO' THEN '{{"data":[' || {item} || ',' || {item} || ']}}'
          WHEN 'LARGE' THEN '{{"data":' || {item} || '}}'
          WHEN 'SMALL' THEN CAST(p_size AS STRING)
          ELSE '{{"data":[' || {item} END AS body""",
    )


@query(
    "src_payload_shape",
    """SELECT p_partkey AS payload_id, p_type AS endpoint, CAST(pos AS INT) AS pos,
      CASE WHEN p_type = 'SMALL' OR p_type = 'STANDARD' AND pos = 1 OR p_type = 'MEDIUM' THEN NULL ELSE p_partkey END AS asin,
      CASE WHEN p_type = 'SMALL' OR p_type = 'STANDARD' AND pos = 1 OR p_type = 'MEDIUM' THEN NULL ELSE p_name END AS title,
      CASE WHEN p_type = 'SMALL' OR p_type = 'STANDARD' AND pos = 1 THEN CAST(p_size AS VARCHAR) END AS data
    FROM part JOIN (VALUES ('STANDARD', 0), ('STANDARD', 1), ('ECONOMY', 0), ('PROMO', 0), ('PROMO', 1),
      ('LARGE', 0), ('SMALL', 0), ('MEDIUM', NULL)) v(kind, pos) ON kind = p_type""",
)
def src_payload_shape(spark, sf):
    items = payloads.payload_items(_shaped_payloads(spark, sf), "body")
    return items.select(
        "payload_id",
        "endpoint",
        "pos",
        F.try_variant_get("item", "$.asin", "bigint").alias("asin"),
        F.try_variant_get("item", "$.title", "string").alias("title"),
        "data",
    )


@query(
    "src_endpoint_status",
    """SELECT event_type AS endpoint, count(*) AS payloads,
      CAST(sum(CASE WHEN event_type IN ('error', 'signup') THEN 0 WHEN event_type = 'view' AND value > 90 THEN 0 ELSE 1 END) AS BIGINT) AS records,
      CAST(sum(CASE WHEN event_type = 'error' OR event_type = 'view' AND value > 90 THEN 1 ELSE 0 END) AS BIGINT) AS failed_payloads,
      CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'empty' ELSE 'ok' END AS status
    FROM events GROUP BY event_type""",
)
def src_endpoint_status(spark, sf):
    """Events as payloads: one endpoint fails, one is empty, one has some broken payloads."""
    body = """CASE WHEN event_type = 'signup' THEN '{"data":[]}'
      WHEN event_type = 'error' OR event_type = 'view' AND value > 90 THEN '{"data":[{"id":'
      ELSE '{"data":[{"id":' || event_id || '}]}' END AS body"""
    landed = I.table(spark, sf, "events").selectExpr("event_type AS endpoint", body)
    return payloads.endpoint_status(landed, "endpoint", "body")


@query(
    "src_land_endpoints",
    """WITH counted AS (
      SELECT event_type AS endpoint, count(*) AS payloads,
        CAST(sum(CASE WHEN event_type IN ('error', 'signup') OR event_type = 'view' AND value > 90 THEN 0 ELSE 2 END) AS BIGINT) AS records,
        CAST(sum(CASE WHEN event_type = 'error' OR event_type = 'view' AND value > 90 THEN 1 ELSE 0 END) AS BIGINT) AS failed_payloads
      FROM events GROUP BY event_type)
    SELECT c.*, CASE WHEN records > 0 THEN 'ok' WHEN failed_payloads > 0 THEN 'failed' ELSE 'empty' END AS status, id, part
    FROM counted c LEFT JOIN (SELECT event_type AS endpoint, event_id AS id, part FROM events, (VALUES ('a'), ('b')) v(part)
      WHERE event_type NOT IN ('error', 'signup') AND NOT (event_type = 'view' AND value > 90)) r ON r.endpoint = c.endpoint""",
)
def src_land_endpoints(spark, sf):
    """Each endpoint's records as landed, beside its state; one fails, one is empty."""
    body = """CASE WHEN event_type = 'signup' THEN '{"data":[]}'
      WHEN event_type = 'error' OR event_type = 'view' AND value > 90 THEN '{"data":[{"id":'
      ELSE '{"data":[{"id":' || event_id || ',"part":"a"},{"id":' || event_id || ',"part":"b"}]}' END AS body"""
    events = I.table(spark, sf, "events")
    # The endpoints are configured; here they are those that occur.
    names = [r[0] for r in events.select("event_type").distinct().collect()]
    path = shared_path(spark, "endpoints")
    status = payloads.land_endpoints(events.selectExpr("event_type AS endpoint", body), "endpoint", "body", names, path)
    return status.join(payloads.landed_records(spark, path, "id bigint, part string"), "endpoint", "left")


_RAW_PART = """CASE WHEN p_size > 25
    THEN '{"data":{"product_price":{"value":' || price || '},"product_description":["' || p_name || '","' || p_type || '"],"name":"' || p_brand || '"}}'
    WHEN p_size = 25 THEN '{"data":{"product_price":{"currency":"USD"},"product_description":null}}'
    ELSE '{"data":{"product_price":' || price || ',"product_description":"' || p_name || '","name":"' || p_brand || '"}}' END AS raw"""


def _raw_records(spark, sf):
    priced = I.table(spark, sf, "part").withColumn(
        "price", F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    )
    return priced.selectExpr("p_partkey", _RAW_PART)


@query(
    "json_object_or_scalar",
    """SELECT p_partkey, CASE WHEN p_size = 25 THEN NULL ELSE regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '[.]?0+$', '') END AS price
    FROM part""",
)
def json_object_or_scalar(spark, sf):
    price = json_fields.object_or_scalar("raw", "$.data.product_price", "value")
    return _raw_records(spark, sf).select("p_partkey", price.alias("price"))


@query(
    "json_array_or_scalar",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name || ' ' || p_type WHEN p_size = 25 THEN NULL ELSE p_name END AS description
    FROM part""",
)
def json_array_or_scalar(spark, sf):
    text = json_fields.array_or_scalar("raw", "$.data.product_description")
    return _raw_records(spark, sf).select("p_partkey", text.alias("description"))


@query(
    "json_product_detail",
    """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS asin, p_name AS product_title,
      CASE WHEN p_size = 25 THEN NULL WHEN p_size = 24 THEN '12345678901234567.89'
        ELSE regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '[.]?0+$', '') END AS price,
      CAST(p_size AS VARCHAR) AS rating, CAST(p_partkey * 1000000007 AS VARCHAR) AS rating_count, p_brand AS brand,
      CAST(NULL AS VARCHAR) AS availability_status,
      CASE WHEN p_size > 25 THEN p_name || ' ' || p_type ELSE p_type END AS product_description,
      CAST(NULL AS VARCHAR) AS product_url, 'US' AS country FROM part""",
)
def json_product_detail(spark, sf):
    """Detail records of either shape, parsed once; prices keep all their digits."""
    priced = I.table(spark, sf, "part").withColumn(
        "price",
        F.when(F.col("p_size") == 24, F.lit("12345678901234567.89")).otherwise(
            F.col("p_retailprice").cast("decimal(18,2)").cast("string")
        ),
    )
    raw = """'{"data":{"asin":"' || p_partkey || '","product_title":"' || p_name || '","product_price":' ||
      CASE WHEN p_size > 25 THEN '{"value":' || price || ',"currency":"USD"}' WHEN p_size = 25 THEN '{"currency":"USD"}' ELSE price END ||
      ',"product_star_rating":"' || p_size || '","product_num_ratings":' || p_partkey * 1000000007 || ',"brand":"' || p_brand ||
      '","product_description":' || CASE WHEN p_size > 25 THEN '["' || p_name || '","' || p_type || '"]' ELSE '"' || p_type || '"' END ||
      ',"country":"US"}}' AS raw"""
    return json_fields.detail_records(priced.selectExpr("p_partkey", raw), "raw").drop("raw")


SELLER_FIELDS = [
    ("seller_id", "seller_id"),
    ("name", "seller_name"),
    ("rating", "seller_rating"),
    ("ratings_total", "rating_count"),
    ("ratings_total_percentage", "positive_feedback_pct"),
    ("store_link", "storefront_url"),
    ("business_name", "business_name"),
    ("business_address", "business_address"),
    ("domain", "seller_domain"),
    ("phone", "seller_phone"),
    ("country", "country"),
]


@query(
    "json_flatten_record",
    """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, s_name AS seller_name, CAST(s_nationkey AS VARCHAR) AS seller_rating,
    CAST(NULL AS VARCHAR) AS rating_count, CAST(s_nationkey * 4 AS VARCHAR) AS positive_feedback_pct,
    CAST(NULL AS VARCHAR) AS storefront_url, s_name || ' Inc' AS business_name, n_name || ' 1' AS business_address,
    lower(s_name) AS seller_domain, CAST(NULL AS VARCHAR) AS seller_phone,
    n_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def json_flatten_record(spark, sf):
    """Seller records flattened and renamed; fields the payload lacks become NULL."""
    sellers = I.table(spark, sf, "supplier").join(
        I.table(spark, sf, "nation"), F.expr("s_nationkey = n_nationkey")
    )
    raw = F.to_json(
        F.struct(
            F.struct(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_name").alias("name"),
                F.col("s_nationkey").alias("rating"),
                (F.col("s_nationkey") * 4).alias("ratings_total_percentage"),
                F.concat("s_name", F.lit(" Inc")).alias("business_name"),
                F.concat("n_name", F.lit(" 1")).alias("business_address"),
                F.lower("s_name").alias("domain"),
                F.col("n_name").alias("country"),
            ).alias("data")
        )
    )
    flat = json_fields.flatten_record(sellers.select(raw.alias("raw")), "raw", "data", SELLER_FIELDS)
    return flat.drop("raw")


# -- configured loads --------------------------------------------------------------------


def _save(spark, root):
    def write(df, target):
        table = VersionedTable(spark, f"{root}/{target}")
        if table.exists():
            table.overwrite(df, schema="replace")
        else:
            table.create(df)

    return write


@query(
    "cfg_multi_table_load",
    """SELECT 'customer' AS source, 'dv_customer' AS target, (SELECT count(*) FROM customer) AS rows, 'ok' AS status
    UNION ALL SELECT 'lineitem', 'dv_factorder', (SELECT count(*) FROM lineitem), 'ok'
    UNION ALL SELECT 'part', 'dv_product', (SELECT count(*) FROM part), 'ok'
    UNION ALL SELECT 'no_such_table', 'dv_missing', CAST(NULL AS BIGINT), 'failed: AnalysisException'""",
)
def cfg_multi_table_load(spark, sf):
    """Copy the configured tables; one of them does not exist."""
    rows = [
        ("customer", "dv_customer"),
        ("part", "dv_product"),
        ("lineitem", "dv_factorder"),
        ("no_such_table", "dv_missing"),
    ]
    table_config = spark.createDataFrame(rows, "source string, target string")
    return config.load_from_config(
        spark, table_config, lambda name: I.table(spark, sf, name), _save(spark, shared_path(spark, "load"))
    )


@query(
    "pl_promote_landed",
    """SELECT 'events' AS origin, CAST(event_id AS BIGINT) AS id, event_type AS kind FROM events
    UNION ALL SELECT 'orders', o_orderkey, o_orderstatus FROM orders""",
)
def pl_promote_landed(spark, sf):
    """Landed JSON directories become tables; the rows of both tables."""
    root = shared_path(spark, "promote")
    landed = {
        "events": I.table(spark, sf, "events").selectExpr("event_id AS id", "event_type AS kind"),
        "orders": I.table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS kind"),
    }
    for name, df in landed.items():
        files.write_json(df, f"{root}/landed/{name}")
    paths = {name: f"{root}/landed/{name}" for name in landed}
    config.promote_landed(spark, paths, _save(spark, f"{root}/tables"))
    saved = [
        VersionedTable(spark, f"{root}/tables/{name}").read().select(F.lit(name).alias("origin"), "id", "kind")
        for name in landed
    ]
    return saved[0].unionByName(saved[1])


@query(
    "src_literal_rows",
    """SELECT o_orderkey, coalesce(label, 'other') AS status_name FROM orders
    LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON code = o_orderstatus""",
)
def src_literal_rows(spark, sf):
    """Literal rows appended to a control table, which then names the status of every order."""
    control = I.new_table(spark, "control").create_empty("code string, label string")
    control.append(spark.createDataFrame([("F", "finished")], "code string, label string"))
    control.append(spark.sql("SELECT * FROM VALUES ('O', 'open') AS v(code, label)"))
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    named = orders.join(F.broadcast(control.read()), F.expr("code = o_orderstatus"), "left")
    return named.select("o_orderkey", F.coalesce("label", F.lit("other")).alias("status_name"))
