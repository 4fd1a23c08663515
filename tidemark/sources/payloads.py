"""Landed API payloads: shapes, pages, and the state of each endpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def explode_records(payloads: DataFrame, records: str, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per element of the array column ``records``, fields renamed."""
    return payloads.select(F.explode(records).alias("_r")).select(
        *[F.col("_r").getField(field).alias(name) for field, name in fields]
    )


def _unwrapped(text: str) -> Column:
    parsed = F.try_parse_json(F.col(text))
    return F.coalesce(F.try_variant_get(parsed, "$.data", "variant"), parsed)


def _items(value: Column) -> Column:
    items = F.try_variant_get(value, "$", "array<variant>")
    none = F.array().cast("array<variant>")
    # A JSON null holds no record; an object or scalar is one.
    return F.when(F.is_variant_null(value), none).when(value.isNotNull(), F.coalesce(items, F.array(value)))


def payload_items(payloads: DataFrame, text: str) -> DataFrame:
    """One row per item of JSON payloads of any shape.

    A list gives a row per item, an object one row, a scalar one row with its
    text in ``data``; an object's ``data`` member is unwrapped first. Broken text
    and empty lists give one row with a NULL item. Adds ``pos``, ``item`` (variant) and ``data``.
    """
    others = [c for c in payloads.columns if c != text]
    opened = payloads.withColumn("_value", _unwrapped(text))
    exploded = opened.select(*others, F.posexplode_outer(_items(F.col("_value"))).alias("pos", "item"))
    is_object = F.try_variant_get("item", "$", "map<string,variant>").isNotNull()
    return exploded.withColumn("data", F.when(~is_object, F.col("item").cast("string")))


LANDED_STATUS = "endpoint string, payloads bigint, records bigint, failed_payloads bigint, status string"


def land_endpoints(payloads: DataFrame, endpoint: str, text: str, endpoints: Sequence[str], path: str) -> DataFrame:
    """Land the records of every endpoint in one pass; the state and counts of each.

    ``path`` gets a line of JSON for each record, in a directory ``kind=record/endpoint=...``
    for each endpoint, and the text of each broken payload under ``kind=broken``. Empty
    payloads write nothing, and a broken one does not touch the other endpoints. The
    counts of the listed ``endpoints`` come from the job that writes; what others deliver
    is landed too and counted in a row without a name.
    """
    value = _unwrapped(text)
    kind = F.when(F.col("_value").isNull(), "broken").when(F.col("_item").isNull(), "none").otherwise("record")
    rows = (
        payloads.select(F.col(endpoint).alias("endpoint"), F.col(text).alias("_text"), value.alias("_value"))
        .select("endpoint", "_text", "_value", F.posexplode_outer(_items(F.col("_value"))).alias("_pos", "_item"))
        .select(
            "endpoint",
            kind.alias("kind"),
            # The first line of a payload stands for it.
            (F.coalesce("_pos", F.lit(0)) == 0).alias("_first"),
            F.when(F.col("_value").isNull(), F.translate("_text", "\r\n", "  ")).otherwise(F.to_json("_item")).alias("value"),
        )
    )
    listed = list(dict.fromkeys(endpoints))
    of = [(f"e{i}", F.col("endpoint") == name) for i, name in enumerate(listed)]
    of.append(("other", ~F.coalesce(F.col("endpoint").isin(listed), F.lit(False))))
    seen = Observation()
    counts = []
    for label, mine in of:
        counts += [
            F.count_if(mine & F.col("_first")).alias(f"{label}_payloads"),
            F.count_if(mine & (F.col("kind") == "record")).alias(f"{label}_records"),
            F.count_if(mine & (F.col("kind") == "broken")).alias(f"{label}_failed"),
        ]
    written = rows.observe(seen, *counts).where(F.col("kind") != "none").select("kind", "endpoint", "value")
    written.write.partitionBy("kind", "endpoint").text(path)
    found = seen.get
    status = []
    for (label, _), name in zip(of, [*listed, None], strict=True):
        payload_count, records, failed = [found[f"{label}_{what}"] for what in ("payloads", "records", "failed")]
        if name is not None or payload_count:
            state = "ok" if records else "failed" if failed else "empty"
            status.append((name, payload_count, records, failed, state))
    return payloads.sparkSession.createDataFrame(status, LANDED_STATUS)


def landed_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The records that ``land_endpoints`` wrote, with their ``endpoint``."""
    reader = spark.read.option("basePath", f"{path}/kind=record")
    if schema is not None:
        reader = reader.schema(f"{schema}, endpoint string")
    return reader.json(f"{path}/kind=record")


def endpoint_status(payloads: DataFrame, endpoint: str, text: str) -> DataFrame:
    """State and counts per endpoint: ok, empty or failed.

    ``ok`` if any record arrived, else ``failed`` if any payload was broken, else
    ``empty``. A broken payload does not touch the other endpoints.
    """
    value = _unwrapped(text)
    counted = payloads.select(
        F.col(endpoint),
        F.coalesce(F.size(_items(value)), F.lit(0)).cast("bigint").alias("_records"),
        value.isNull().cast("bigint").alias("_broken"),
    )
    state = (
        F.when(F.col("records") > 0, "ok").when(F.col("failed_payloads") > 0, "failed").otherwise("empty")
    )
    return (
        counted.groupBy(endpoint)
        .agg(
            F.count(F.lit(1)).alias("payloads"),
            F.sum(F.greatest("_records", F.lit(0))).alias("records"),
            F.sum("_broken").alias("failed_payloads"),
        )
        .withColumn("status", state)
    )


def paged_records(
    pages: DataFrame, page: str, records: str, limit: int, endpoint: Sequence[str] = (), first_page: int = 1
) -> DataFrame:
    """Records of consecutive pages up to the first empty or absent one, at most ``limit``.

    ``pages`` has a row for each landing of a page, with its records as an array. A page that
    counts lies within the first ``limit`` pages, since each one before it holds a
    record: no endpoint keeps more than ``limit`` pages, however many were landed.
    """
    number = F.col(page) - F.lit(first_page) + 1
    filled = pages.where((number >= 1) & (number <= limit) & (F.size(records) > 0))
    # A page landed again counts once: its fullest landing, then the smallest records.
    landed = Window.partitionBy(*endpoint, page).orderBy(F.size(records).desc(), F.to_json(records))
    filled = filled.withColumn("_landed", F.row_number().over(landed)).where("_landed = 1").drop("_landed")
    in_order = Window.partitionBy(*endpoint).orderBy(page)
    before = F.coalesce(
        F.sum(F.size(records)).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    reached = (
        filled.withColumn("_nth", F.row_number().over(in_order))
        .withColumn("_before", before)
        .where((F.col("_nth") == number) & (F.col("_before") < limit))
    )
    kept = F.slice(records, F.lit(1), (F.lit(limit) - F.col("_before")).cast("int"))
    return reached.select(*endpoint, page, "_before", F.posexplode(kept).alias("_pos", "record")).select(
        *endpoint, page, (F.col("_before") + F.col("_pos") + 1).cast("bigint").alias("position"), "record"
    )
