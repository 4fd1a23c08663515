"""The order warehouse: columns, hashes, landing names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Column names of the order file, in file order.
ORDER_COLUMNS = [
    "order_id", "order_date", "requested_ship_date", "promised_ship_date", "days_to_ship",
    "lead_time_days", "sla_days", "order_status", "priority", "order_category", "customer_id",
    "customer_name", "customer_segment", "region", "country", "state", "city", "postal_code",
    "contact_email", "contact_phone", "payment_terms", "payment_status", "sku", "product_name",
    "sku_color", "category", "sub_category", "uom", "qty", "unit_price", "currency", "line_amount",
    "tax_rate", "tax_amount", "total_amount", "fulfillment_channel", "source_system",
    "source_system_normalized", "ingest_ts", "is_valid", "data_quality_notes", "created_by",
    "last_updated_ts",
]

# Attributes of the dimensions, in the order their hashes use.
CUSTOMER_COLUMNS = [
    "customer_id", "customer_name", "customer_segment", "region", "country", "state", "city",
    "postal_code", "contact_email",
]
PRODUCT_COLUMNS = [
    "product_name", "category", "sub_category", "color", "unit_price", "currency", "tax_rate",
]
ORDER_DIM_COLUMNS = [
    "order_id", "order_date", "requested_ship_date", "promised_ship_date", "days_to_ship",
    "lead_time_days", "sla_days", "order_status", "priority", "order_category", "payment_status",
    "uom", "qty", "unit_price", "line_amount", "tax_rate", "tax_amount", "fulfillment_channel",
]
FACT_HASH_COLUMNS = [
    "order_id", "order_date", "qty", "unit_price", "tax_rate", "fulfillment_channel",
]

# Sub-category by product name; every other product is Audio.
SUB_CATEGORIES = {
    "LG TVS": "Television",
    "Samsung Mobile": "Smart Phones",
    "Boat Watches": "Smart Watches",
    "Dell Laptops": "Dell Laptops",
    "Batteries": "Battery",
}
SUB_CATEGORY_DEFAULT = "Audio"

# Landing names that do not follow from the model name.
LANDING_NAMES = {
    "uom": "unitofmeasure",
    "qty": "quantity",
    "source_system_normalized": "normalizedsourcesystem",
    "ingest_ts": "ingesttimestamp",
    "last_updated_ts": "lastupdatedtimestamp",
}


def landing_pairs(
    columns: Sequence[str], prefix: str, names: Mapping[str, str] | None = None
) -> list[tuple[str, str]]:
    """``(landing, model)`` names: the prefix and the model name without underscores.

    ``names`` adds to or overrides the names that do not follow the rule.
    """
    known = {**LANDING_NAMES, **(names or {})}
    return [(prefix + known.get(c, c.replace("_", "")), c) for c in columns]


@dataclass(frozen=True)
class TableSpec:
    """How one landing table becomes a staged and, with a key, a dimension table."""

    name: str
    columns: tuple[tuple[str, str], ...]
    hash_columns: tuple[str, ...]
    keys: tuple[str, ...] = ()
    modified: str = "modifiedon"
    load: str = "load_date"
    source: str | None = None
    rules: tuple[tuple[str, str], ...] = ()
    """Reasons to turn a row away, each with SQL over the model's columns that is true then."""


def customer_spec(prefix: str, source: str | None = None) -> TableSpec:
    """Customers; the landing table's own key keeps its name."""
    pairs = landing_pairs(CUSTOMER_COLUMNS, prefix, {"customer_id": "customerid1"})
    own = f"{prefix}customerkey"
    return TableSpec(
        "customer", (*pairs, (own, own)), tuple(CUSTOMER_COLUMNS), ("customer_id",), source=source
    )


def product_spec(prefix: str, source: str | None = None) -> TableSpec:
    """Products by name; the landing table's own key keeps its name."""
    own = f"{prefix}productid1"
    pairs = landing_pairs(PRODUCT_COLUMNS, prefix)
    return TableSpec(
        "product", (*pairs, (own, own)), tuple(PRODUCT_COLUMNS), ("product_name",), source=source
    )


def fact_spec(prefix: str, source: str | None = None) -> TableSpec:
    """Order lines with their product id."""
    pairs = landing_pairs([*ORDER_COLUMNS, "product_id"], prefix, {"order_id": "orderid1"})
    return TableSpec("factorder", tuple(pairs), tuple(FACT_HASH_COLUMNS), source=source)
