"""Silver models: customers, orders and items with their context.

Loaded tables have unique keys, which is what lets items and payments be folded
to one row for each order before any join, and distinct orders be counted as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.dates import day_of_week, month_start, nearest_days
from tallybrook.functions.numbers import ratio
from tallybrook.operators.joins import join_unique
from tallybrook.plans.settings import Settings
from tallybrook.sources.schemas import LOAD_TIME, ORDER_DATES


def silver_customers(
    customers: DataFrame, orders: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Customers with the metrics of their delivered orders that have items.

    The average ticket is the mean price of an item. Items are folded by order
    first, so the join has one row for each order on both sides.
    """
    delivered = orders.where(F.col("order_status") == "delivered")
    bought = items.groupBy("order_id").agg(
        F.sum("price").alias("spent"), F.count("price").alias("priced_items")
    )
    summary = (
        delivered.join(bought, "order_id")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("spent").alias("spent"),
            ratio(F.sum("spent"), F.sum("priced_items")).alias("ticket"),
            F.min("purchase_timestamp").alias("first_order_at"),
            F.max("purchase_timestamp").alias("last_order_at"),
        )
    )
    spent = F.coalesce("spent", F.lit(0))
    return customers.join(summary, "customer_id", "left").select(
        "customer_id",
        "customer_unique_id",
        "zip_code_prefix",
        "city",
        "state",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        spent.alias("total_spent"),
        F.coalesce("ticket", F.lit(0.0)).alias("avg_ticket"),
        "first_order_at",
        "last_order_at",
        (F.coalesce("orders", F.lit(0)) > 1).alias("is_recurring"),
        F.when(spent >= settings.high_value, "high_value")
        .when(spent >= settings.medium_value, "medium_value")
        .when(spent > 0, "low_value")
        .otherwise("no_purchase")
        .alias("customer_segment"),
        LOAD_TIME,
    )


def silver_orders(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with totals, calendar fields, main payment type and delivery metrics.

    The main payment is the largest one, the earliest of equal ones.
    """
    bought = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items_count"),
        F.sum("price").alias("items_total"),
        F.sum("freight_value").alias("freight_total"),
        F.sum("item_total").alias("order_subtotal"),
    )
    size = F.struct("payment_value", -F.col("payment_sequential"))
    paid = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_total"),
        F.max("payment_installments").alias("max_installments"),
        F.max_by("payment_type", size).alias("main_payment_type"),
    )
    bought_at, delivered_at = F.col("purchase_timestamp"), F.col("delivered_customer_date")
    totals = ["items_total", "freight_total", "order_subtotal", "payment_total", "items_count"]
    return (
        orders.join(bought, "order_id", "left")
        .join(paid, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_status",
            *ORDER_DATES,
            month_start(bought_at).alias("purchase_month"),
            F.year(bought_at).alias("purchase_year"),
            F.month(bought_at).alias("purchase_month_num"),
            day_of_week(bought_at).alias("purchase_dow"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in totals],
            "main_payment_type",
            F.coalesce("max_installments", F.lit(1)).alias("max_installments"),
            nearest_days(bought_at, delivered_at).alias("delivery_days"),
            (delivered_at <= F.col("estimated_delivery_date")).alias("delivered_on_time"),
            LOAD_TIME,
        )
    )


def silver_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items with the fields of their order and product, NULL where there is none.

    A product may be hot, so its items go without a shuffle to a broadcast of the few
    products of that kind (see :func:`join_unique`); that join comes first, on the items
    as they are. The order's is a plain left join with a unique right key.
    """
    order = orders.select(
        "order_id",
        "order_status",
        "purchase_timestamp",
        "customer_id",
        month_start(F.col("purchase_timestamp")).alias("purchase_month"),
    )
    product = products.select("product_id", "category_name", "category_name_english", "weight_g")
    return join_unique(items, product, "product_id").join(order, "order_id", "left").select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        "item_total",
        "category_name",
        "category_name_english",
        "weight_g",
        "order_status",
        "purchase_timestamp",
        "customer_id",
        "purchase_month",
        LOAD_TIME,
    )


def delivered_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of delivered orders, without anything about their product."""
    delivered = orders.where(F.col("order_status") == "delivered").select("order_id")
    return items.join(delivered, "order_id", "left_semi")
