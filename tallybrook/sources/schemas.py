"""Declared tables: columns, types, keys and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# The states, order statuses, payment types and customer segments
# that the cleaning jobs and the quality checks accept.
STATES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO",
    "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR",
    "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]
ORDER_STATUSES = ["approved", "canceled", "delivered", "invoiced", "processing", "shipped"]
PAYMENT_TYPES = ["boleto", "credit_card", "debit_card", "voucher"]
SEGMENTS = ["high_value", "low_value", "medium_value", "no_purchase"]

#: Primary key of every source table; also the load manifest, in load order.
KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "product_categories": ["product_category_name"],
}

#: Column that records the load time; an update of an existing key keeps it.
LOAD_TIME = "created_at"

ORDER_DATES = [
    "purchase_timestamp",
    "approved_at",
    "delivered_carrier_date",
    "delivered_customer_date",
    "estimated_delivery_date",
]
PRODUCT_MEASURES = ["weight_g", "length_cm", "height_cm", "width_cm"]


def _text(name: str, limit: int) -> T.StructField:
    # A longer value is refused on load, as a VARCHAR(limit) column would.
    return T.StructField(name, T.StringType(), True, {"max_length": limit})


def raw_schema(
    table: str,
    money: T.DecimalType = T.DecimalType(10, 2),
    size: T.DecimalType = T.DecimalType(8, 2),
) -> T.StructType:
    """Types of a loaded table. ``money`` is widened for data beyond the declared range."""
    ntz, integer = T.TimestampNTZType(), T.IntegerType()

    def col(name: str, dtype: T.DataType) -> T.StructField:
        return T.StructField(name, dtype, True)

    fields = {
        "customers": [
            _text("customer_id", 50),
            _text("customer_unique_id", 50),
            _text("zip_code_prefix", 10),
            _text("city", 100),
            _text("state", 2),
        ],
        "products": [
            _text("product_id", 50),
            _text("category_name", 100),
            col("name_length", integer),
            col("description_length", integer),
            col("photos_qty", integer),
            col("weight_g", T.DecimalType(10, 2)),
            *[col(c, size) for c in PRODUCT_MEASURES[1:]],
        ],
        "orders": [
            _text("order_id", 50),
            _text("customer_id", 50),
            _text("order_status", 30),
            *[col(c, ntz) for c in ORDER_DATES],
        ],
        "order_items": [
            _text("order_id", 50),
            col("order_item_id", integer),
            _text("product_id", 50),
            _text("seller_id", 50),
            col("shipping_limit_date", ntz),
            col("price", money),
            col("freight_value", money),
        ],
        "order_payments": [
            _text("order_id", 50),
            col("payment_sequential", integer),
            _text("payment_type", 30),
            col("payment_installments", integer),
            col("payment_value", money),
        ],
        "product_categories": [
            _text("product_category_name", 100),
            _text("product_category_name_english", 100),
        ],
    }[table]
    if table != "product_categories":
        fields = [*fields, col(LOAD_TIME, ntz)]
    return T.StructType(fields)


def landing_schema(table: str) -> T.StructType:
    """A landing CSV file: the raw columns without the load time, all as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), True)
            for f in raw_schema(table)
            if f.name != LOAD_TIME
        ]
    )
