"""Gold models: reports over the silver models.

Distinct counts rely on two facts of the silver models: an order is one row of
silver orders, and an order has one customer. Counting in steps (order, customer,
group) needs no copy of the rows for each distinct count, and every step folds
rows before its shuffle, so no group gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.functions.dates import moment, whole_days
from tallybrook.functions.numbers import ones, percent, ratio
from tallybrook.operators.ranking import ranks_of_counts, top_ranked, with_share
from tallybrook.plans.settings import Settings


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Orders that count as revenue: delivered, with items."""
    return orders.where((F.col("order_status") == "delivered") & (F.col("items_total") > 0))


def _delivered_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("order_status") == "delivered")


MONTH = ["purchase_month", "purchase_year", "purchase_month_num"]


def month_customer_sums(orders: DataFrame) -> DataFrame:
    """What the report by month adds up, for each month and customer."""
    return (
        delivered_orders(orders)
        .groupBy(*MONTH, "customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("items_total").alias("revenue"),
            F.sum("freight_total").alias("freight"),
            F.sum("payment_total").alias("payment"),
            F.sum("items_count").alias("items"),
            F.sum(ones(F.col("delivered_on_time"))).alias("on_time"),
            F.count("delivered_on_time").alias("judged"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("timed"),
        )
    )


#: The sums of :func:`month_customer_sums`.
MONTH_SUMS = ["orders", "revenue", "freight", "payment", "items", "on_time", "judged", "days", "timed"]


def month_report(sums: DataFrame) -> DataFrame:
    """The report from the sums of each month and its number of ``customers``."""
    return sums.select(
        *MONTH,
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        F.col("revenue").alias("total_revenue"),
        F.col("freight").alias("total_freight"),
        F.col("payment").alias("total_payment"),
        ratio(F.col("revenue"), F.col("orders")).alias("avg_ticket"),
        ratio(F.col("items"), F.col("orders")).alias("avg_items_per_order"),
        ratio(F.col("on_time"), F.col("judged")).alias("on_time_delivery_rate"),
        ratio(F.col("days"), F.col("timed")).alias("avg_delivery_days"),
    )


def gold_revenue_by_month(orders: DataFrame) -> DataFrame:
    """Revenue, punctuality and delivery time for each month of purchase."""
    sums = month_customer_sums(orders).groupBy(*MONTH)
    added = sums.agg(F.count("customer_id").alias("customers"), *[F.sum(c).alias(c) for c in MONTH_SUMS])
    return month_report(added)


def gold_revenue_by_category(items: DataFrame) -> DataFrame:
    """Revenue and market share for each category, by its English and Portuguese name."""
    sold = _delivered_items(items).where(F.col("category_name").isNotNull())
    named = sold.select(
        F.col("category_name_english").alias("category"),
        F.col("category_name").alias("category_pt"),
        "customer_id",
        "order_id",
        "price",
    )
    category = ["category", "category_pt"]
    by_order = named.groupBy(*category, "customer_id", "order_id").agg(
        F.sum("price").alias("revenue"), F.count("price").alias("priced"), F.count(F.lit(1)).alias("units")
    )
    by_customer = by_order.groupBy(*category, "customer_id").agg(
        F.count("order_id").alias("orders"), *[F.sum(c).alias(c) for c in ("revenue", "priced", "units")]
    )
    totals = by_customer.groupBy(*category).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("revenue").alias("total_revenue"),
        ratio(F.sum("revenue"), F.sum("priced")).alias("avg_price"),
        F.sum("units").alias("units_sold"),
    )
    return with_share(totals, "total_revenue", "revenue_share_pct")


def gold_revenue_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and share for each customer state; orders of unknown customers do not count."""
    by_customer = (
        delivered_orders(orders)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("items_total").alias("revenue"),
            F.sum("freight_total").alias("freight"),
        )
    )
    totals = (
        by_customer.join(customers.select("customer_id", "state"), "customer_id")
        .groupBy("state")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("customer_id").alias("unique_customers"),
            F.sum("revenue").alias("total_revenue"),
            ratio(F.sum("revenue"), F.sum("orders")).alias("avg_ticket"),
            F.sum("freight").alias("total_freight"),
        )
    )
    return with_share(totals, "total_revenue", "revenue_share_pct")


def gold_top_products(sold: DataFrame, products: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The products with the most revenue, ranked by revenue and by units among all products.

    ``sold`` are the items of delivered orders. They are folded by product before the
    product table is joined, which sees the rows of the report only, and the units
    rank comes from the histogram of units, so no step sorts all products in one task.
    """
    sales = (
        sold.groupBy("product_id", "order_id")
        .agg(
            F.sum("price").alias("revenue"),
            F.count(F.lit(1)).alias("units"),
            F.count("price").alias("priced"),
            F.min("price").alias("low"),
            F.max("price").alias("high"),
        )
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("units").alias("units_sold"),
            ratio(F.sum("revenue"), F.sum("priced")).alias("avg_price"),
            F.min("low").alias("min_price"),
            F.max("high").alias("max_price"),
        )
    )
    category = products.select("product_id", F.col("category_name_english").alias("category"))
    return (
        top_ranked(sales, "total_revenue", "product_id", settings.top_k, "revenue_rank")
        .join(ranks_of_counts(sales, "units_sold", "units_rank"), "units_sold", "left")
        .join(category, "product_id", "left")
        .select(
            "product_id",
            "category",
            "total_orders",
            "total_revenue",
            "units_sold",
            "avg_price",
            "min_price",
            "max_price",
            F.col("revenue_rank").cast("bigint").alias("revenue_rank"),
            "units_rank",
        )
    )


def gold_top_customers(customers: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The customers with the highest spend, with recency and lifespan in days."""
    buyers = customers.where(F.col("total_orders") > 0)
    first, last = F.col("first_order_at"), F.col("last_order_at")
    return top_ranked(buyers, "total_spent", "customer_id", settings.top_k, "spending_rank").select(
        "customer_id",
        "city",
        "state",
        "customer_segment",
        "is_recurring",
        "total_orders",
        "total_spent",
        "avg_ticket",
        "first_order_at",
        "last_order_at",
        whole_days(last, moment(settings.as_of)).alias("days_since_last_order"),
        whole_days(first, last).alias("customer_lifespan_days"),
        F.col("spending_rank").cast("bigint").alias("spending_rank"),
    )


def monthly_growth(orders: DataFrame) -> DataFrame:
    """Revenue of each month against the month before it that has any revenue.

    The window runs over month totals, a few hundred rows.
    """
    monthly = delivered_orders(orders).groupBy("purchase_month").agg(F.sum("items_total").alias("monthly_revenue"))
    before = F.lag("monthly_revenue").over(Window.orderBy("purchase_month"))
    change = F.col("monthly_revenue") - F.col("prev_month_revenue")
    return monthly.withColumn("prev_month_revenue", before).withColumn(
        "mom_growth_pct", percent(change, F.col("prev_month_revenue"))
    )


def gold_kpis(
    orders: DataFrame,
    customers: DataFrame,
    sold: DataFrame,
    products: DataFrame,
    settings: Settings = Settings(),
) -> DataFrame:
    """The panel of key figures: one row.

    Delivered orders are folded by customer and month once. These rows are grouped by
    month and, beside that, by customer; the latter by state. What is left, a row for
    each month and state, gives all figures but the top category, which needs items
    (``sold``: those of delivered orders), folded by product before products are
    joined. Ties of category and state go to the first name.
    """
    folded = (
        delivered_orders(orders)
        .groupBy("customer_id", "purchase_month")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("items_total").alias("revenue"),
            F.count("items_total").alias("priced"),
            F.sum(ones(F.col("delivered_on_time"))).alias("on_time"),
            F.count("delivered_on_time").alias("judged"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("timed"),
        )
    )
    sums = ["orders", "revenue", "priced", "on_time", "judged", "days", "timed"]
    known = customers.select("customer_id", "state", F.lit(True).alias("known"))
    placed = folded.join(known, "customer_id", "left")
    customer = F.col("customer_id"), F.col("state"), F.col("known")
    by_both = placed.groupingSets([[F.col("purchase_month")], [*customer]], F.col("purchase_month"), *customer).agg(
        F.grouping("purchase_month").alias("is_customer"), *[F.sum(c).alias(c) for c in sums]
    )
    of_known = F.when(F.col("known"), F.col("orders"))
    by_state = by_both.groupBy("is_customer", "purchase_month", "state", "known").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count("orders").alias("customers"),
        F.count(of_known).alias("buyers"),
        F.sum(ones(of_known > 1)).alias("recurring"),
    )

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("is_customer") == 1, F.col(column)))

    month = F.when(F.col("is_customer") == 0, F.struct("purchase_month", "revenue"))
    state = F.when((F.col("is_customer") == 1) & F.col("known"), F.struct(-F.col("revenue"), "state"))
    last = F.slice(F.sort_array(F.collect_list(month)), -2, 2)
    figures = by_state.agg(
        total("revenue").alias("total_revenue"),
        ratio(total("revenue"), total("priced")).alias("overall_avg_ticket"),
        F.coalesce(total("orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(total("customers"), F.lit(0)).alias("total_customers"),
        percent(total("recurring"), total("buyers")).alias("recurring_customers_pct"),
        F.when(F.count(month) > 1, last).alias("last"),
        percent(total("on_time"), total("judged")).alias("on_time_delivery_pct"),
        F.round(ratio(total("days"), total("timed")), 1).alias("avg_delivery_days"),
        F.min(state)["state"].alias("top_state"),
    )
    now, before = F.col("last")[1]["revenue"], F.col("last")[0]["revenue"]
    by_product = sold.groupBy("product_id").agg(F.sum("price").alias("revenue"))
    named = products.where(F.col("category_name").isNotNull())
    category = (
        by_product.join(named.select("product_id", "category_name", "category_name_english"), "product_id")
        .groupBy("category_name_english", "category_name")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return figures.select(
        "total_revenue",
        "overall_avg_ticket",
        "total_orders",
        "total_customers",
        "recurring_customers_pct",
        percent(now - before, before).alias("last_month_growth_pct"),
        "on_time_delivery_pct",
        "avg_delivery_days",
        _leader(category, "category_name_english").scalar().alias("top_category"),
        "top_state",
        moment(settings.as_of).alias("calculated_at"),
    )


def _leader(totals: DataFrame, name: str) -> DataFrame:
    order: list[Column] = [F.col("revenue").desc_nulls_last(), F.col(name).asc()]
    return totals.orderBy(*order).limit(1).select(name)
