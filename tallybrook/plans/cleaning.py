"""Cleaning jobs, landing to bronze.

Each job reads typed or text columns and works in the same order: lenient casts,
rows without a key out, one row for each key, normalisation, validity filter. The
survivor of a key is chosen before the filter, so a key whose survivor is invalid
is gone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.casts import at_utc, to_number, to_timestamp
from tallybrook.functions.text import strip, titlecase, zero_fill
from tallybrook.operators.dedupe import keep_one
from tallybrook.sources.schemas import (
    KEYS,
    ORDER_DATES,
    ORDER_STATUSES,
    PAYMENT_TYPES,
    PRODUCT_MEASURES,
    STATES,
)


def clean_customers(df: DataFrame) -> DataFrame:
    one = keep_one(df.dropna(subset=["customer_id"]), KEYS["customers"])
    return one.withColumns(
        {
            "city": titlecase(strip(F.col("city"))),
            "state": F.upper(strip(F.col("state"))),
            "zip_code_prefix": zero_fill(strip(F.col("zip_code_prefix")), 8),
        }
    ).where(F.col("state").isin(STATES))


def clean_orders(df: DataFrame) -> DataFrame:
    """Dates are parsed from text or taken as they are; an order without a purchase date is dropped.

    Moments, in text or in a column with a zone, are kept as in UTC.
    """
    read = {"string": to_timestamp, "timestamp": at_utc}
    dates = {c: read[dtype](F.col(c)) for c, dtype in df.dtypes if c in ORDER_DATES and dtype in read}
    dated = df.withColumns(dates)
    keyed = dated.dropna(subset=["order_id", "customer_id", "purchase_timestamp"])
    one = keep_one(keyed, KEYS["orders"])
    status = F.col("order_status").cast("string")
    return one.withColumn("order_status", status).where(F.col("order_status").isin(ORDER_STATUSES))


def clean_products(df: DataFrame) -> DataFrame:
    measured = df.withColumns({c: to_number(F.col(c)) for c in PRODUCT_MEASURES})
    one = keep_one(measured.dropna(subset=["product_id"]), KEYS["products"])
    return one.where(F.col("weight_g") > 0)


def clean_order_items(df: DataFrame) -> DataFrame:
    """The shipping limit stays as it came; loading gives it its type."""
    priced = df.withColumns({c: to_number(F.col(c)) for c in ("price", "freight_value")})
    one = keep_one(priced.dropna(subset=["order_id", "product_id"]), KEYS["order_items"])
    return one.where((F.col("price") > 0) & (F.col("freight_value") >= 0))


def clean_order_payments(df: DataFrame) -> DataFrame:
    typed = df.withColumns(
        {
            "payment_type": F.col("payment_type").cast("string"),
            "payment_value": to_number(F.col("payment_value")),
            "payment_installments": to_number(F.col("payment_installments"), "int"),
        }
    )
    one = keep_one(typed.dropna(subset=["order_id"]), KEYS["order_payments"])
    return one.where(F.col("payment_type").isin(PAYMENT_TYPES) & (F.col("payment_value") > 0))


def clean_product_categories(df: DataFrame) -> DataFrame:
    """Passed through as it is."""
    return df


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "products": clean_products,
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "product_categories": clean_product_categories,
}


#: Tables that the audit counts; categories are passed through.
AUDITED = tuple(t for t in CLEANERS if t != "product_categories")


def clean_audit(before: Mapping[str, DataFrame], after: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in, out and removed, for each cleaned table."""
    counts = []
    for table in after:
        for side, rows in (("rows_in", before[table]), ("rows_out", after[table])):
            n = F.count(F.lit(1))
            counted = rows.agg(n.alias("n")).select(F.lit(table).alias("table_name"), F.lit(side).alias("side"), "n")
            counts.append(counted)

    def of(side: str) -> F.Column:
        return F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))

    sums = reduce(DataFrame.unionByName, counts).groupBy("table_name")
    return sums.agg(of("rows_in").alias("rows_in"), of("rows_out").alias("rows_out")).withColumn(
        "rows_removed", F.col("rows_in") - F.col("rows_out")
    )
