"""Lake enrichment, bronze to silver.

Amounts are doubles here; see :func:`tallybrook.functions.numbers.total` for their
sums. An amount that is not finite makes the sums it is in not finite. The
semantics differ from the warehouse models on purpose: days are cut and not
rounded, the main payment is the first and not the largest, and customers or
orders without purchases keep NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.dates import whole_days
from tallybrook.functions.numbers import ratio, total
from tallybrook.plans.settings import Settings

def orders_enriched(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with item and payment totals, delivery time and punctuality."""
    bought = items.groupBy("order_id").agg(
        total(F.col("price")).alias("items_total"),
        total(F.col("freight_value")).alias("freight_total"),
        F.count("order_item_id").alias("items_count"),
    )
    paid = payments.groupBy("order_id").agg(
        total(F.col("payment_value")).alias("payment_total"),
        F.min_by("payment_type", "payment_sequential").alias("main_payment_type"),
        F.max("payment_installments").alias("max_installments"),
    )
    bought_at, delivered_at = F.col("purchase_timestamp"), F.col("delivered_customer_date")
    return (
        orders.join(bought, "order_id", "left")
        .join(paid, "order_id", "left")
        .withColumns(
            {
                "order_total": F.col("items_total") + F.col("freight_total"),
                "delivery_days": whole_days(bought_at, delivered_at).cast("bigint"),
                "delivered_on_time": delivered_at <= F.col("estimated_delivery_date"),
                "purchase_year": F.year(bought_at),
                "purchase_month": F.month(bought_at),
            }
        )
    )


def customers_enriched(
    customers: DataFrame, orders: DataFrame, items: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Customers with the metrics of their delivered orders, NULL if they have none."""
    value = items.groupBy("order_id").agg(total(F.col("price")).alias("order_value"))
    return customers_by_value(customers, orders.join(value, "order_id", "left"), settings)


def customers_by_value(customers: DataFrame, valued: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """:func:`customers_enriched` from orders that have the prices of their items as ``order_value``."""
    spent = total(F.col("order_value"))
    metrics = (
        valued.where(F.col("order_status") == "delivered")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.coalesce(spent, F.lit(0.0)).alias("total_spent"),
            ratio(spent, F.count("order_value")).alias("avg_ticket"),
            F.max("purchase_timestamp").alias("last_order_date"),
            F.min("purchase_timestamp").alias("first_order_date"),
        )
        .withColumns(
            {
                "is_recurring": F.col("total_orders") > 1,
                "customer_segment": F.when(F.col("total_spent") >= settings.high_value, "high_value")
                .when(F.col("total_spent") >= settings.medium_value, "medium_value")
                .otherwise("low_value"),
            }
        )
    )
    return customers.join(metrics, "customer_id", "left")


def products_enriched(
    products: DataFrame,
    categories: DataFrame,
    items: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """Products with units and revenue from delivered orders; missing numbers become 0."""
    delivered = orders.where(F.col("order_status") == "delivered").select("order_id")
    sold = items.select("order_id", "product_id", "price").join(delivered, "order_id", "left_semi")
    metrics = sold.groupBy("product_id").agg(
        F.count("product_id").alias("units_sold"),
        total(F.col("price")).alias("total_revenue"),
        ratio(total(F.col("price")), F.count("price")).alias("avg_price"),
    )
    names = categories.withColumnRenamed("product_category_name", "category_name")
    return products.join(metrics, "product_id", "left").join(names, "category_name", "left").fillna(0)
