"""Silver orders and the report by month, kept up to date from the orders that a batch changes.

Three tables are kept: the silver rows of orders, the sums of each month and customer,
and the sums of each month with its number of customers. A batch names the orders whose
rows, items or payments it changed. Only these are made anew; what their former rows
added to the sums is taken off and what the new ones add is put on. A customer counts in
a month while one order of theirs is left there, so that distinct customers stay exact
under retraction. Sums are decimals and whole numbers, which take back without a rest.

All three tables go by one version number. A refresh starts from the version before its
own, so that one that failed half-way is repeated as a whole; readers take the newest
version that all three have.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators.upsert import committed_versions, read_hit, read_version, upsert_table
from tallybrook.plans.bronze import bronze_order_items, bronze_order_payments, bronze_orders
from tallybrook.plans.gold import MONTH, MONTH_SUMS, month_customer_sums, month_report
from tallybrook.plans.settings import Settings
from tallybrook.plans.silver import silver_orders
from tallybrook.sources.tables import file_system, together

ORDERS, CUSTOMERS, MONTHS = "orders", "month_customers", "months"
_CUSTOMER_KEYS = [*MONTH, "customer_id"]
#: Whether an order has left the model, as its date is below the first one that counts.
_GONE = "_gone"
#: Where a month or customer is NULL: keys of kept tables have none.
_NO = "_unknown"


def changed_orders(batches: Mapping[str, DataFrame]) -> DataFrame:
    """The orders that a batch of orders, items or payments (by table) bears on."""
    ids = [rows.select("order_id") for table, rows in batches.items() if "order_id" in rows.columns]
    out = ids[0]
    for more in ids[1:]:
        out = out.unionAll(more)
    return out.distinct()


def refresh(
    raw: Mapping[str, DataFrame], changed: DataFrame, root: str, settings: Settings = Settings(), version: int | None = None
) -> int:
    """Bring the kept tables below ``root`` up to the loaded tables ``raw``, of which the ``changed`` orders differ.

    Returns the version written. Items and payments are read once and only those of
    changed orders shuffled, as far as their ids are few enough for Spark to broadcast.
    All orders are changed ones for the first version.
    """
    spark = changed.sparkSession
    version = version or min(_versions(spark, root)) + 1
    # A table: Spark sees its size, and it is asked for many times.
    ids = f"{root}/_changed/{version:010d}"
    changed.where("order_id IS NOT NULL").select("order_id").distinct().write.mode("overwrite").parquet(ids)
    changed = spark.read.parquet(ids)

    def of_changed(rows: DataFrame) -> DataFrame:
        return rows.join(changed, "order_id", "left_semi")

    new = silver_orders(
        of_changed(bronze_orders(raw["orders"], settings)),
        of_changed(bronze_order_items(raw["order_items"])),
        of_changed(bronze_order_payments(raw["order_payments"])),
    )
    fresh = f"{root}/_fresh/{version:010d}"
    new.write.mode("overwrite").parquet(fresh)
    new = spark.read.schema(new.schema).parquet(fresh)
    former = read_hit(spark, f"{root}/{ORDERS}", ["order_id"], changed, version)
    old = None if former is None else of_changed(former.where(~F.col(_GONE))).drop(_GONE)

    # What each month and customer gains, negative where it loses.
    gains = _named(month_customer_sums(new))
    if old is not None:
        losses = _named(month_customer_sums(old)).select(*_CUSTOMER_KEYS, *[(-F.col(c)).alias(c) for c in MONTH_SUMS])
        gains = _added(gains.unionByName(losses), _CUSTOMER_KEYS)
    sums = f"{root}/_gains/{version:010d}"
    gains.write.mode("overwrite").parquet(sums)
    gains = spark.read.parquet(sums)
    kept = read_hit(spark, f"{root}/{CUSTOMERS}", _CUSTOMER_KEYS, gains, version)
    gains = _with_former(gains, kept, _CUSTOMER_KEYS, MONTH_SUMS)
    customers = gains.select(*_CUSTOMER_KEYS, *[_sum(c).alias(c) for c in MONTH_SUMS])

    # Orders without a customer count, but for no customer.
    here = (_sum("orders") > 0).cast("int") - (F.col("_old_orders") > 0).cast("int")
    here = F.when(F.col("customer_id") == _NO, 0).otherwise(here)
    months = _added(gains.withColumn("customers", here), MONTH, [*MONTH_SUMS, "customers"])
    kept = read_version(spark, f"{root}/{MONTHS}", version, MONTH)
    columns = [*MONTH_SUMS, "customers"]
    months = _with_former(months, kept, MONTH, columns).select(*MONTH, *[_sum(c).alias(c) for c in columns])

    rows = changed.join(new.withColumn(_GONE, F.lit(False)), "order_id", "left")
    rows = rows.withColumn(_GONE, F.col(_GONE).isNull())
    # None of the three reads what another one writes.
    writes = [
        lambda: upsert_table(customers, f"{root}/{CUSTOMERS}", _CUSTOMER_KEYS, version),
        lambda: upsert_table(months, f"{root}/{MONTHS}", MONTH, version, buckets=1),
        lambda: upsert_table(rows, f"{root}/{ORDERS}", ["order_id"], version, kept=()),
    ]
    together(lambda write: write(), writes)
    for passing in (ids, fresh, sums):
        fs, where = file_system(spark, passing)
        fs.delete(where, True)
    return version


def _named(sums: DataFrame) -> DataFrame:
    """Sums without NULLs, in types that further sums keep, under keys without NULLs."""
    months = [F.coalesce(F.col(c).cast("string"), F.lit(_NO)).alias(c) for c in MONTH]
    customer = F.coalesce(F.concat(F.lit("="), F.col("customer_id")), F.lit(_NO)).alias("customer_id")
    return sums.select(*months, customer, *[F.coalesce(F.col(c), F.lit(0)).cast(_kind(sums, c)).alias(c) for c in MONTH_SUMS])


def _kind(rows: DataFrame, column: str) -> str:
    name = rows.schema[column].dataType.simpleString()
    return f"decimal(38,{name.split(',')[1]}" if name.startswith("decimal") else "double" if name == "double" else "bigint"


def _added(rows: DataFrame, keys: list[str], columns: list[str] = MONTH_SUMS) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(_kind(rows, c)).alias(c) for c in columns])


def _with_former(gains: DataFrame, kept: DataFrame | None, keys: list[str], columns: list[str]) -> DataFrame:
    """Gains with the sums kept so far as ``_old_...``, zero where there are none."""
    if kept is None:
        return gains.select("*", *[F.lit(0).cast(_kind(gains, c)).alias(f"_old_{c}") for c in columns])
    former = kept.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in columns])
    return gains.join(former, keys, "left").select(
        *gains.columns, *[F.coalesce(f"_old_{c}", F.lit(0)).cast(_kind(gains, c)).alias(f"_old_{c}") for c in columns]
    )


def _sum(column: str):
    return F.col(column) + F.col(f"_old_{column}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The newest version of each kept table, 0 without one."""
    return [max(committed_versions(spark, f"{root}/{name}"), default=0) for name in (ORDERS, CUSTOMERS, MONTHS)]


def read_orders(spark: SparkSession, root: str) -> DataFrame:
    """Silver orders as of the newest version that all kept tables have."""
    rows = read_version(spark, f"{root}/{ORDERS}", min(_versions(spark, root)) + 1, ["order_id"])
    return rows.where(~F.col(_GONE)).drop(_GONE)


def read_revenue_by_month(spark: SparkSession, root: str) -> DataFrame:
    """The report by month as of that version; a month that has lost all its orders is none."""
    sums = read_version(spark, f"{root}/{MONTHS}", min(_versions(spark, root)) + 1).where("orders > 0")
    unknown = lambda c, kind: F.expr(f"CASE WHEN {c} <> '{_NO}' THEN cast({c} AS {kind}) END").alias(c)
    keys = [unknown("purchase_month", "date"), unknown("purchase_year", "int"), unknown("purchase_month_num", "int")]
    return month_report(sums.select(*keys, "customers", *MONTH_SUMS))
