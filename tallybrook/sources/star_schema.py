"""Landing tables derived from a TPC-H-like star schema.

Gives every job whole tables to work on: orders, line items, customers and parts
play the six landing tables. Some values are mapped to invalid ones (a state, an
order status, a payment type, a zero weight) so that the cleaning has work to do,
and line items repeat keys by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.sources.schemas import STATES, raw_schema

#: State of each nation in order of its key; the last one is invalid.
NATION_STATES = [s.lower() for s in STATES[3:]] + ["xx"]
# Order status by status flag, or by priority where the flag is P.
FLAG_STATUS = {"F": "delivered", "O": "shipped"}
PRIORITY_STATUS = {"1": "approved", "2": "invoiced", "3": "processing", "4": "canceled", "5": "unknown"}
# Sequence number and payment type by return flag and line status.
PAYMENTS = {
    "AF": (1, "credit_card"),
    "AO": (2, "boleto"),
    "NF": (3, "voucher"),
    "NO": (4, "debit_card"),
    "RF": (5, "credit_card"),
    "RO": (6, "crypto"),
}
UNTRANSLATED_BRAND = "brand#25"

#: Line prices go beyond the declared range of amounts.
MONEY = T.DecimalType(12, 2)


def star_raw_schema(table: str) -> T.StructType:
    return raw_schema(table, MONEY)


# Columns of the star schema that the mapping reads.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def landing_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One of the six landing tables, over the whole star-schema tables below ``root``."""

    def read(name: str) -> DataFrame:
        return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{root}/{name}.parquet")

    if table == "customers":
        return _customers(read("customer"), read("nation"))
    if table == "products":
        return _products(read("part"))
    if table == "product_categories":
        return _product_categories(read("part"))
    if table == "orders":
        return _orders(read("orders"))
    if table == "order_items":
        return _order_items(read("lineitem"))
    return _order_payments(read("lineitem"))


def _case(value: str, choices: dict[str, object]) -> str:
    """SQL for the choice that belongs to ``value``, NULL where there is none."""
    return f"CASE {value} " + " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in choices.items()) + " END"


def _cents(amount: str) -> str:
    """SQL for an amount with two decimals as a whole number of hundredths, exact in a double.

    One division at the end then gives the double next to the true value, the
    same as exact decimal arithmetic would.
    """
    return f"rint({amount} * 100)"


def _customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    state = _case("c_nationkey", dict(enumerate(NATION_STATES)))
    return customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
        "string(c_custkey) AS customer_id",
        "c_name AS customer_unique_id",
        "string(c_custkey) AS zip_code_prefix",
        "' ' || lower(n_name) || ' ' AS city",
        f"{state} AS state",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "string(p_partkey) AS product_id",
        "lower(p_brand) AS category_name",
        "length(p_name) AS name_length",
        "length(p_name) * 10 AS description_length",
        "1 + p_size % 10 AS photos_qty",
        "p_size - 1 AS weight_g",
        "p_size AS length_cm",
        "p_size + 5 AS height_cm",
        "p_size + 8 AS width_cm",
    )


def _product_categories(part: DataFrame) -> DataFrame:
    names = part.selectExpr("lower(p_brand) AS product_category_name").distinct()
    return names.where(f"product_category_name <> '{UNTRANSLATED_BRAND}'").selectExpr(
        "product_category_name", "upper(product_category_name) AS product_category_name_english"
    )


def _orders(orders: DataFrame) -> DataFrame:
    by_flag = _case("o_orderstatus", FLAG_STATUS)
    by_priority = _case("left(o_orderpriority, 1)", PRIORITY_STATUS)
    return (
        orders.selectExpr(
            "o_orderkey AS k",
            "string(o_custkey) AS customer_id",
            f"coalesce({by_flag}, {by_priority}) AS order_status",
            "timestampadd(SECOND, int(7919 * o_orderkey % 86400), o_orderdate) AS purchase_timestamp",
        )
        .selectExpr(
            "*",
            "CASE WHEN order_status <> 'canceled'"
            " THEN timestampadd(HOUR, int(1 + 31 * k % 48), purchase_timestamp) END AS approved_at",
        )
        .selectExpr(
            "*",
            "CASE WHEN order_status IN ('delivered', 'shipped')"
            " THEN timestampadd(DAY, int(1 + 17 * k % 5), approved_at) END AS delivered_carrier_date",
        )
        .selectExpr(
            "string(k) AS order_id",
            "customer_id",
            "order_status",
            "purchase_timestamp",
            "approved_at",
            "delivered_carrier_date",
            "CASE WHEN order_status = 'delivered'"
            " THEN timestampadd(DAY, int(1 + 11 * k % 15), delivered_carrier_date) END AS delivered_customer_date",
            "timestampadd(DAY, int(5 + 13 * k % 26), purchase_timestamp) AS estimated_delivery_date",
        )
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "string(l_orderkey) AS order_id",
        "l_linenumber AS order_item_id",
        "string(l_partkey) AS product_id",
        "string(l_suppkey) AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        f"{_cents('l_extendedprice')} * {_cents('l_tax')} / 10000.0D AS freight_value",
    )


def _order_payments(lineitem: DataFrame) -> DataFrame:
    sequential = _case("kind", {k: n for k, (n, _) in PAYMENTS.items()})
    payment_type = _case("kind", {k: t for k, (_, t) in PAYMENTS.items()})
    return (
        lineitem.groupBy("l_orderkey", F.expr("l_returnflag || l_linestatus AS kind"))
        .agg(
            F.expr(f"sum(bigint({_cents('l_extendedprice')})) / 100.0D AS payment_value"),
            F.expr("int(count(*)) AS payment_installments"),
        )
        .selectExpr(
            "string(l_orderkey) AS order_id",
            f"{sequential} AS payment_sequential",
            f"{payment_type} AS payment_type",
            "payment_installments",
            "payment_value",
        )
    )
