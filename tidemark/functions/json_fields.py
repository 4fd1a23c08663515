"""Fields of JSON payload text whose shape varies from record to record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record(raw: str | Column) -> Column:
    """The parsed record, NULL for broken text. Numbers with a point are decimals of up to 38 digits."""
    return F.try_parse_json(F.col(raw) if isinstance(raw, str) else raw)


def object_or_scalar_of(parsed: Column, path: str, field: str) -> Column:
    """Text at ``path`` of a parsed record; where an object sits there, the text of its ``field``.

    An object without ``field`` gives NULL. A decimal keeps all its digits but for zeros at
    its end; it is not read as a double.
    """
    at = F.try_variant_get(parsed, path, "variant")
    is_object = F.try_variant_get(at, "$", "map<string,variant>").isNotNull()
    return F.when(is_object, F.try_variant_get(at, f"$.{field}", "string")).otherwise(F.try_variant_get(at, "$", "string"))


def array_or_scalar_of(parsed: Column, path: str, separator: str = " ") -> Column:
    """Text at ``path`` of a parsed record; where an array sits there, its elements joined."""
    at = F.try_variant_get(parsed, path, "variant")
    elements = F.try_variant_get(at, "$", "array<variant>")
    joined = F.array_join(F.transform(elements, lambda x: F.try_variant_get(x, "$", "string")), separator)
    return F.when(elements.isNotNull(), joined).otherwise(F.try_variant_get(at, "$", "string"))


def object_or_scalar(raw: str | Column, path: str, field: str) -> Column:
    """``object_or_scalar_of`` the text of a record."""
    return object_or_scalar_of(record(raw), path, field)


def array_or_scalar(raw: str | Column, path: str, separator: str = " ") -> Column:
    """``array_or_scalar_of`` the text of a record."""
    return array_or_scalar_of(record(raw), path, separator)


def flatten_record(
    df: DataFrame, raw: str, root: str, fields: Sequence[tuple[str, str]]
) -> DataFrame:
    """One text column per ``(field, name)`` read from the object under ``root``.

    The text is parsed once; a missing field or broken text gives NULL.
    """
    members = ", ".join(f"`{field}` string" for field, _ in fields)
    parsed = F.from_json(F.col(raw), f"struct<`{root}`: struct<{members}>>")
    record = parsed.getField(root)
    return df.withColumns({name: record.getField(field) for field, name in fields})


# Member, or member and the field of an object in its place, by column name.
PRODUCT_DETAIL = {
    "asin": "asin",
    "product_title": "product_title",
    "price": ("product_price", "value"),
    "rating": "product_star_rating",
    "rating_count": "product_num_ratings",
    "brand": "brand",
    "availability_status": "product_availability",
    "product_description": ["product_description"],
    "product_url": "product_url",
    "country": "country",
}


def detail_records(df: DataFrame, raw: str, fields: dict = PRODUCT_DETAIL, root: str = "data") -> DataFrame:
    """One text column per field of the record under ``root``, which is parsed once.

    A pair names a member that is an object or a scalar, a list one that is an array or a scalar.
    """

    def text(member) -> Column:
        if isinstance(member, tuple):
            return object_or_scalar_of(F.col("_record"), f"$.{member[0]}", member[1])
        if isinstance(member, list):
            return array_or_scalar_of(F.col("_record"), f"$.{member[0]}")
        return F.try_variant_get("_record", f"$.{member}", "string")

    parsed = df.withColumn("_record", F.try_variant_get(record(raw), f"$.{root}", "variant"))
    return parsed.withColumns({name: text(member) for name, member in fields.items()}).drop("_record")
