"""The indicators of the dashboard, read from the gold models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.ranking import with_position

#: How each report is read: its columns, first to last, "-" for descending.
REPORT_ORDER = {
    "gold_revenue_by_month": ["purchase_month"],
    "gold_revenue_by_category": ["-total_revenue", "category"],
    "gold_revenue_by_state": ["-total_revenue", "state"],
    "gold_top_products": ["revenue_rank", "product_id"],
    "gold_top_customers": ["spending_rank", "customer_id"],
}


def _order(report: str) -> list[Column]:
    columns = REPORT_ORDER[report]
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc() for c in columns]


def in_order(report: str, rows: DataFrame) -> DataFrame:
    """The rows of a gold model sorted for reading; a stored table has no order."""
    return rows.orderBy(*_order(report))


def numbered(report: str, rows: DataFrame, folder: str) -> DataFrame:
    """The rows of a gold model with their ``position`` when read in order, which a stored table keeps."""
    return with_position(rows, _order(report), "position", folder)


def _top(df: DataFrame, value: str, tie: str, k: int = 10) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc()).limit(k)


#: Single figures, by name: their columns of the panel.
KPIS = {
    "total_revenue": ["total_revenue"],
    "avg_ticket": ["overall_avg_ticket"],
    "orders_customers": ["total_orders", "total_customers"],
    "on_time_pct": ["on_time_delivery_pct"],
    "avg_delivery_days": ["avg_delivery_days"],
    "recurring_pct": ["recurring_customers_pct"],
}


def kpi(panel: DataFrame, name: str) -> DataFrame:
    """A single figure, read from the one-row panel."""
    return panel.select(*KPIS[name])


def top10_categories(by_category: DataFrame) -> DataFrame:
    return _top(by_category, "total_revenue", "category").select("category", "total_revenue", "units_sold")


def top10_states(by_state: DataFrame) -> DataFrame:
    return _top(by_state, "total_revenue", "state").select("state", "total_revenue", "total_orders")


def top10_products(products: DataFrame) -> DataFrame:
    return _top(products, "total_revenue", "product_id").select(
        "product_id", "category", "total_revenue", "units_sold", "revenue_rank"
    )


def top10_customers(customers: DataFrame) -> DataFrame:
    return _top(customers, "total_spent", "customer_id").select(
        "customer_id", "city", "state", "total_spent", "total_orders", "spending_rank"
    )


def category_market_share(by_category: DataFrame) -> DataFrame:
    return by_category.select("category", "category_pt", "total_revenue", "revenue_share_pct")
