"""Bronze models: projections and row filters over the loaded tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.plans.settings import Settings
from tallybrook.sources.schemas import LOAD_TIME, ORDER_DATES


def bronze_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "city", "state", LOAD_TIME
    ).where(F.col("customer_id").isNotNull())


def bronze_orders(orders: DataFrame, settings: Settings = Settings()) -> DataFrame:
    earliest = F.lit(settings.min_order_date).cast("timestamp_ntz")
    return orders.select("order_id", "customer_id", "order_status", *ORDER_DATES, LOAD_TIME).where(
        F.col("order_id").isNotNull() & (F.col("purchase_timestamp") >= earliest)
    )


def bronze_order_items(items: DataFrame) -> DataFrame:
    """Has no date filter: items of orders that are too old stay."""
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
        LOAD_TIME,
    ).where(F.col("order_id").isNotNull() & (F.col("price") > 0))


def bronze_order_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value", LOAD_TIME
    ).where(F.col("order_id").isNotNull() & (F.col("payment_value") > 0))


def bronze_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """The English category name falls back to the Portuguese one.

    No broadcast hint: Spark broadcasts the names when it has seen that they are
    small, and joins by shuffle when they are not.
    """
    names = categories.select(
        F.col("product_category_name").alias("category_name"),
        F.col("product_category_name_english").alias("_english"),
    )
    return (
        products.where(F.col("product_id").isNotNull())
        .join(names, "category_name", "left")
        .select(
            "product_id",
            "category_name",
            F.coalesce("_english", "category_name").alias("category_name_english"),
            "name_length",
            "description_length",
            "photos_qty",
            "weight_g",
            "length_cm",
            "height_cm",
            "width_cm",
            LOAD_TIME,
        )
    )
