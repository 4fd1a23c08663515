"""Star schema from one wide table of order lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import value_map, with_scd2
from tidemark.operators.dedup import first_per_key
from tidemark.operators.keys import with_surrogate_key
from tidemark.plans import model
from tidemark.session import broadcast_if_small, stored
from tidemark.sources.files import BROKEN_LINE, read_csv_with_broken


def _equal_as_text(kind: T.DataType) -> bool:
    """Whether equal values of the type are the same: 0.0 equals -0.0, and 'a' may equal 'A'."""
    if isinstance(kind, T.StringType):
        return kind.collation == "UTF8_BINARY"
    return isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def build_dimension(
    rows: DataFrame,
    columns: Sequence[str],
    key: str,
    as_of: Column | datetime | str,
    *,
    surrogate: str | None = None,
    hash_columns: Sequence[str] | None = None,
    prefer: Sequence[str] = (),
    repeated: bool = False,
) -> DataFrame:
    """One row per ``key`` with history columns and, if named, a surrogate key.

    Of several rows for a key the one that sorts first by ``prefer``, then by its
    values, stays. ``prefer`` columns are not kept. With ``repeated``, for rows that come many
    times over, equal ones are dropped in each task before any are sorted. Rows to be numbered
    are written first, since numbering reads them several times.
    """
    extra = [c for c in prefer if c not in columns]
    given = rows.select(*columns, *extra)
    if repeated and all(_equal_as_text(f.dataType) for f in given.schema.fields):
        given = given.distinct()
    one = first_per_key(given, [key], prefer).drop(*extra)
    if surrogate is not None:
        one = with_surrogate_key(stored(one, "dimension"), [key], surrogate)
    return with_scd2(one, hash_columns or columns, as_of)


def with_sub_category(
    rows: DataFrame,
    values: Mapping[str, str] = model.SUB_CATEGORIES,
    default: str = model.SUB_CATEGORY_DEFAULT,
    by: str = "product_name",
) -> DataFrame:
    """Set ``sub_category`` from a fixed map."""
    return rows.withColumn("sub_category", value_map(by, values, default))


def dim_customer(orders: DataFrame, as_of) -> DataFrame:
    """Customer dimension of an order table in the model's columns."""
    return build_dimension(orders, model.CUSTOMER_COLUMNS, "customer_id", as_of, surrogate="customer_key", repeated=True)


def dim_product(orders: DataFrame, as_of) -> DataFrame:
    """Product dimension: sub-category set, colour renamed, keyed by name."""
    rows = with_sub_category(orders).withColumnRenamed("sku_color", "color")
    return build_dimension(rows, model.PRODUCT_COLUMNS, "product_name", as_of, surrogate="product_id", repeated=True)


def _order_number(order_id: str = "order_id") -> Column:
    """The id as a number, else NULL.

    A failed cast costs an exception for each row, so ids with a sign that no number has are told
    apart first.
    """
    text = F.col(order_id).cast("string")
    return F.when(~F.coalesce(text.rlike(r"[^0-9+.\-\x00-\x20\x7f]"), F.lit(True)), text.try_cast("bigint"))


def dim_orders(orders: DataFrame, as_of) -> DataFrame:
    """Order dimension. Only the id is hashed; ids that are no number are in ``order_rejects``."""
    rows = orders.withColumn("order_id", _order_number()).where("order_id IS NOT NULL")
    return build_dimension(rows, model.ORDER_DIM_COLUMNS, "order_id", as_of, hash_columns=["order_id"])


def order_rejects(orders: DataFrame) -> DataFrame:
    """The rows that ``dim_orders`` leaves out: their id is NULL or no number."""
    return orders.where(_order_number().isNull())


def fact_with_key(fact: DataFrame, dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Bring the surrogate key onto the fact; rows without a match drop out.

    The two columns of the dimension are broadcast if few; otherwise the join
    shuffles and adaptive execution splits the hot names on the fact side.
    """
    keys = dim.select(F.col(natural).alias("_natural"), surrogate)
    joined = fact.join(broadcast_if_small(keys), F.col(natural) == F.col("_natural"), "inner")
    return joined.drop("_natural")


@dataclass(frozen=True)
class Star:
    """What one order file becomes."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    fact: DataFrame
    rejects: DataFrame
    """(reason, line): lines that do not fit the columns, and lines whose order id is no number."""


def star_from_csv(spark: SparkSession, path: str, as_of: Column | datetime | str) -> Star:
    """Dimensions, fact and rejects of an order file.

    The file is parsed once: its lines are landed, those that do not fit with their text in a
    column of its own, and all outputs read from there. They are landed as they come; a directory
    for either kind would sort whole lines first. Lines with an order id that is no number are
    left out of the order dimension only.
    """
    read = read_csv_with_broken(spark, path, model.ORDER_COLUMNS)
    landed = stored(read, "order-lines")
    lines = landed.where(F.col(BROKEN_LINE).isNull()).select(*model.ORDER_COLUMNS)
    products = stored(dim_product(lines, as_of), "products")
    broken = landed.where(F.col(BROKEN_LINE).isNotNull()).select(F.lit("broken_line").alias("reason"), F.col(BROKEN_LINE).alias("line"))
    no_number = order_rejects(lines).select(F.lit("bad_order_id").alias("reason"), F.to_json(F.struct("*")).alias("line"))
    return Star(
        dim_customer(lines, as_of),
        products,
        dim_orders(lines, as_of),
        fact_with_key(lines, products, "product_name", "product_id"),
        broken.unionByName(no_number),
    )
