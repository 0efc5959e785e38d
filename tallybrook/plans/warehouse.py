"""The models as one graph, and the batch jobs that build the layers."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybrook.operators.checks import enforce
from tallybrook.operators.upsert import read_version, upsert_table
from tallybrook.plans import bronze, gold, lake, silver
from tallybrook.plans.cleaning import AUDITED, CLEANERS, clean_audit
from tallybrook.plans.quality import MODEL_CHECKS, SOURCE_CHECKS, quality_report
from tallybrook.plans.settings import Settings
from tallybrook.sources.schemas import KEYS, raw_schema
from tallybrook.sources.tables import (
    IS_BROKEN,
    conform,
    find_landing_tables,
    parse_landing,
    read_bytes,
    read_table,
    rejected_rows,
    sparing_disk,
    table_path,
    together,
    whole_rows,
    write_table,
)

#: Takes layer, name and rows of a model and returns the rows that its readers see.
Keep = Callable[[str, str, DataFrame], DataFrame]


#: Every model and how it is made from others, lower layers first.
MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "bronze_customers": lambda w: bronze.bronze_customers(w["customers"]),
    "bronze_orders": lambda w: bronze.bronze_orders(w["orders"], w.settings),
    "bronze_order_items": lambda w: bronze.bronze_order_items(w["order_items"]),
    "bronze_order_payments": lambda w: bronze.bronze_order_payments(w["order_payments"]),
    "bronze_products": lambda w: bronze.bronze_products(w["products"], w["product_categories"]),
    "silver_customers": lambda w: silver.silver_customers(
        w["bronze_customers"], w["bronze_orders"], w["bronze_order_items"], w.settings
    ),
    "silver_orders": lambda w: silver.silver_orders(
        w["bronze_orders"], w["bronze_order_items"], w["bronze_order_payments"]
    ),
    "silver_order_items": lambda w: silver.silver_order_items(
        w["bronze_order_items"], w["bronze_orders"], w["bronze_products"]
    ),
    "gold_revenue_by_month": lambda w: gold.gold_revenue_by_month(w["silver_orders"]),
    "gold_revenue_by_category": lambda w: gold.gold_revenue_by_category(w["silver_order_items"]),
    "gold_revenue_by_state": lambda w: gold.gold_revenue_by_state(w["silver_orders"], w["silver_customers"]),
    "gold_top_products": lambda w: gold.gold_top_products(w.delivered_items(), w["bronze_products"], w.settings),
    "gold_top_customers": lambda w: gold.gold_top_customers(w["silver_customers"], w.settings),
    "gold_kpis": lambda w: gold.gold_kpis(
        w["silver_orders"],
        w["bronze_customers"],
        silver.delivered_items(w["bronze_order_items"], w["bronze_orders"]),
        w["bronze_products"],
        w.settings,
    ),
}

#: Models large enough to be stored by month, which then prunes their readers.
BY_MONTH = {"silver_orders", "silver_order_items"}


class Warehouse:
    """Bronze, silver and gold models over the loaded tables, by name.

    A model is made when first asked for. By default it stays a plan, so a
    question about one model is answered in one job that reads only the columns
    it needs; with ``keep`` each model can be written, and its readers start
    from the written table.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        settings: Settings = Settings(),
        keep: Keep | None = None,
    ):
        self.raw = raw
        self.settings = settings
        self._writes = keep is not None
        self._keep = keep or (lambda layer, name, rows: rows)
        self._made: dict[str, DataFrame] = {}
        self._being_made = {name: Lock() for name in MODELS}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in MODELS:
            return self.raw[name]
        with self._being_made[name]:
            if name not in self._made:
                layer = name.split("_")[0]
                self._made[name] = self._keep(layer, name, MODELS[name](self))
            return self._made[name]

    def delivered_items(self) -> DataFrame:
        """Items of delivered orders: off silver items where these are written, which have been joined with their orders."""
        if self._writes:
            return self["silver_order_items"].where(F.col("order_status") == "delivered")
        return silver.delivered_items(self["bronze_order_items"], self["bronze_orders"])

    def build(self, names: Iterable[str] = tuple(MODELS), threads: int = 4) -> Warehouse:
        """Make the named models, all by default, up to ``threads`` of them at a time."""
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(self.__getitem__, [n for n in MODELS if n in set(names)]))
        return self


def keep_in(root: str, by_month: bool = True) -> Keep:
    """Write each model below ``root`` and let its readers start from there."""

    def keep(layer: str, name: str, rows: DataFrame) -> DataFrame:
        month = "purchase_month" if by_month and name in BY_MONTH else None
        return write_table(rows, root, layer, name, month)

    return keep


def clean_layer(
    spark: SparkSession, landing_root: str, lake_root: str, tables: Sequence[str] = tuple(KEYS)
) -> dict[str, DataFrame]:
    """Landing CSV to cleaned lake tables; a table that is absent or fails ends the run.

    All six tables are expected unless ``tables`` names others. Lines that don't fit
    their header are left out of the lake table and kept in a table of the same
    name in the layer ``rejected``. CSV is parsed once: whole and broken rows go to one
    table of the layer ``parsed``, apart from each other, and both are read from there.
    Large tables are cleaned one after another, so that their shuffles don't add up.
    """

    parsed = {}

    def parse(t: str) -> None:
        rows = write_table(parse_landing(spark, landing_root, t), lake_root, "parsed", t, IS_BROKEN, rebalance=False)
        write_table(rejected_rows(rows, t), lake_root, "rejected", t)
        parsed[t] = rows

    def clean(t: str) -> DataFrame:
        return write_table(CLEANERS[t](whole_rows(parsed[t], t)), lake_root, "bronze", t)

    found = find_landing_tables(spark, landing_root, tables)
    try:
        with sparing_disk(spark, split=None):
            together(parse, found)
    finally:
        # Where one can't be parsed, the others are cleaned before the run ends.
        whole = [t for t in found if t in parsed]
        with sparing_disk(spark):
            cleaned = dict(zip(whole, together(clean, whole, lambda t: read_bytes(parsed[t]))))
    return cleaned


def audit_layer(spark: SparkSession, lake_root: str, tables: Sequence[str] = AUDITED) -> DataFrame:
    """Rows in, out and removed of the last cleaning run, from the counts that its files carry: no row is read again."""

    def written(layer: str) -> dict[str, DataFrame]:
        return {t: read_table(spark, lake_root, layer, t) for t in tables}

    whole = {t: rows.where(~F.col(IS_BROKEN).cast("boolean")) for t, rows in written("parsed").items()}
    return clean_audit(whole, written("bronze"))


def enrich_layer(spark: SparkSession, lake_root: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Cleaned lake tables to enriched ones; items are passed on as they are.

    What a customer's orders are worth is read off the enriched orders, whose items
    are summed already, so items are shuffled by order once less.
    """

    def bronze_table(name: str) -> DataFrame:
        return read_table(spark, lake_root, "bronze", name)

    orders, items, customers = bronze_table("orders"), bronze_table("order_items"), bronze_table("customers")
    outputs = {
        "orders_enriched": lake.orders_enriched(orders, items, bronze_table("order_payments")),
        "products_enriched": lake.products_enriched(
            bronze_table("products"), bronze_table("product_categories"), items, orders
        ),
        "order_items": items,
    }

    def write(name: str, rows: DataFrame) -> DataFrame:
        return write_table(rows, lake_root, "silver", name)

    def made(name: str) -> dict[str, DataFrame]:
        written = {name: write(name, outputs[name])}
        if name == "orders_enriched":
            valued = written[name].withColumnRenamed("items_total", "order_value")
            written["customers_enriched"] = write("customers_enriched", lake.customers_by_value(customers, valued, settings))
        return written

    with sparing_disk(spark):
        return dict(ChainMap(*together(made, outputs, lambda name: read_bytes(outputs[name]))))


def load_layer(
    spark: SparkSession, lake_root: str, warehouse_root: str, money: T.DecimalType | None = None
) -> dict[str, DataFrame]:
    """Upsert the cleaned lake tables into the loaded ones, six versioned tables."""
    raw = {}
    for table, keys in KEYS.items():
        schema = raw_schema(table) if money is None else raw_schema(table, money)
        batch = conform(read_table(spark, lake_root, "bronze", table), schema)
        root = table_path(warehouse_root, "raw", table)
        upsert_table(batch, root, keys)
        raw[table] = read_version(spark, root, keys=keys)
    return raw


def build_models(
    raw: Mapping[str, DataFrame], warehouse_root: str, settings: Settings = Settings()
) -> Warehouse:
    """Check the loaded tables, write all models, check the models."""
    enforce(quality_report(raw.__getitem__, SOURCE_CHECKS))
    warehouse = Warehouse(raw, settings, keep_in(warehouse_root)).build()
    enforce(quality_report(warehouse.__getitem__, MODEL_CHECKS))
    return warehouse
