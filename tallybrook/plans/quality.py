"""The quality checks of every table and model."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from tallybrook.operators.checks import (
    Check,
    accepted_range,
    accepted_values,
    not_null,
    run_checks,
    unique,
)
from tallybrook.sources.schemas import ORDER_STATUSES, PAYMENT_TYPES, SEGMENTS


def _key(column: str) -> list[Check]:
    return unique(column) + not_null(column)


SOURCE_CHECKS: dict[str, list[Check]] = {
    "customers": _key("customer_id") + not_null("state"),
    "orders": _key("order_id")
    + not_null("customer_id", "order_status")
    + accepted_values("order_status", ORDER_STATUSES),
    "order_items": not_null("order_id", "product_id", "price") + accepted_range("price", 0, inclusive=False),
    "order_payments": not_null("order_id") + accepted_values("payment_type", PAYMENT_TYPES),
    "products": _key("product_id"),
    "product_categories": _key("product_category_name"),
}

MODEL_CHECKS: dict[str, list[Check]] = {
    "bronze_customers": _key("customer_id"),
    "bronze_orders": _key("order_id"),
    "bronze_order_items": not_null("order_id") + accepted_range("item_total", 0, inclusive=False),
    "bronze_order_payments": not_null("order_id"),
    "bronze_products": _key("product_id"),
    "silver_customers": _key("customer_id") + accepted_values("customer_segment", SEGMENTS),
    "silver_orders": _key("order_id") + accepted_values("order_status", ORDER_STATUSES),
    "silver_order_items": not_null("order_id", "product_id"),
    "gold_revenue_by_month": _key("purchase_month") + accepted_range("total_revenue", 0),
    "gold_revenue_by_category": _key("category"),
    "gold_revenue_by_state": _key("state"),
    "gold_top_products": _key("product_id"),
    "gold_top_customers": _key("customer_id"),
}


def checks_of(*tests: str) -> dict[str, list[Check]]:
    """The checks of these kinds, by table; all of them without an argument."""
    every = {**SOURCE_CHECKS, **MODEL_CHECKS}
    chosen = {name: [r for r in rules if not tests or r.test in tests] for name, rules in every.items()}
    return {name: rules for name, rules in chosen.items() if rules}


def quality_report(
    table: Callable[[str], DataFrame], checks: Mapping[str, list[Check]] | None = None
) -> DataFrame:
    """One line for each check, all by default; ``table`` gives the DataFrame of a name."""
    chosen = checks_of() if checks is None else checks
    parts = [run_checks(table(name), name, rules) for name, rules in chosen.items()]
    return reduce(DataFrame.unionByName, parts)
