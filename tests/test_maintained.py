"""Models kept up to date by batches against the models made from all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators.upsert import read_version, upsert_table
from tallybrook.plans import maintained
from tallybrook.plans.bronze import bronze_order_items, bronze_order_payments, bronze_orders
from tallybrook.plans.gold import gold_revenue_by_month
from tallybrook.plans.maintained import changed_orders, read_orders, read_revenue_by_month, refresh
from tallybrook.plans.settings import Settings
from tallybrook.plans.silver import silver_orders
from tallybrook.sources.schemas import KEYS, raw_schema
from tallybrook.sources.tables import conform

SETTINGS = Settings(min_order_date="2020-01-01")
TABLES = ("orders", "order_items", "order_payments")


def batches(seed, turns=4):
    """Orders, items and payments that come, change, are cancelled, move month or customer, and leave the model."""
    rng = random.Random(seed)
    for turn in range(turns):
        ids = [f"o{rng.randrange(14)}" for _ in range(7)]
        orders = {
            i: (i, rng.choice(["c1", "c2", "c3", None]), rng.choice(["delivered", "delivered", "delivered", "canceled"]),
                f"{rng.choice(['2019-12', '2020-01', '2020-02', '2020-02'])}-03 10:00:00", rng.choice([None, "2020-03-01 00:00:00"]), "2020-03-02 00:00:00")
            for i in ids[:5]
        }
        items = {(i, n): (i, n, "p", "s", "2020-01-01 00:00:00", rng.choice([0.0, 1.0, 2.5, 7.25]), rng.choice([0.0, 1.25])) for i in ids[2:] for n in range(rng.randrange(3))}
        payments = {(i, 1): (i, 1, rng.choice(["credit_card", "boleto"]), rng.randrange(4), rng.choice([0.0, 3.5, 9.0])) for i in ids[::2]}
        yield list(orders.values()), list(items.values()), list(payments.values())


def frames(spark, rows):
    orders, items, payments = rows
    made = {
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string, order_status string, purchase_timestamp string, delivered_customer_date string, estimated_delivery_date string"),
        "order_items": spark.createDataFrame(items, "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, price double, freight_value double"),
        "order_payments": spark.createDataFrame(payments, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"),
    }
    return {t: conform(df, raw_schema(t)) for t, df in made.items()}


def load(spark, root, batch):
    for t, rows in batch.items():
        upsert_table(rows, f"{root}/raw/{t}", KEYS[t], buckets=4)
    return {t: read_version(spark, f"{root}/raw/{t}", keys=KEYS[t]) for t in TABLES}


def expected(raw):
    orders = silver_orders(
        bronze_orders(raw["orders"], SETTINGS), bronze_order_items(raw["order_items"]), bronze_order_payments(raw["order_payments"])
    )
    return orders, gold_revenue_by_month(orders)


def same(rows, got, want):
    assert got.columns == want.columns
    assert [f.dataType.typeName() for f in got.schema] == [f.dataType.typeName() for f in want.schema]
    assert rows(got) == rows(want)


def test_after_each_batch_as_if_made_anew(spark, rows, tmp_path):
    root = str(tmp_path)
    for turn, made in enumerate(batches(1, 3), 1):
        batch = frames(spark, made)
        raw = load(spark, root, batch)
        assert refresh(raw, changed_orders(batch), f"{root}/kept", SETTINGS) == turn
        orders, months = expected(raw)
        same(rows, read_orders(spark, f"{root}/kept"), orders)
        same(rows, read_revenue_by_month(spark, f"{root}/kept"), months)


def test_a_refresh_that_fails_half_way_is_repeated(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path)
    first, second = list(batches(5, 2))
    batch = frames(spark, first)
    raw = load(spark, root, batch)
    refresh(raw, changed_orders(batch), f"{root}/kept", SETTINGS)
    before = rows(read_revenue_by_month(spark, f"{root}/kept"))
    batch = frames(spark, second)
    raw = load(spark, root, batch)

    def failing(batch, place, *more, **options):
        if place.endswith("/orders"):
            raise RuntimeError("lost")
        return upsert_table(batch, place, *more, **options)

    monkeypatch.setattr(maintained, "upsert_table", failing)
    with pytest.raises(RuntimeError, match="lost"):
        refresh(raw, changed_orders(batch), f"{root}/kept", SETTINGS)
    # Two of three tables have the new version; readers still take the old one.
    assert rows(read_revenue_by_month(spark, f"{root}/kept")) == before
    monkeypatch.undo()
    assert refresh(raw, changed_orders(batch), f"{root}/kept", SETTINGS) == 2
    orders, months = expected(raw)
    same(rows, read_orders(spark, f"{root}/kept"), orders)
    same(rows, read_revenue_by_month(spark, f"{root}/kept"), months)


def test_items_are_not_shuffled_for_a_small_batch(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    batch = frames(spark, next(batches(3, 1)))
    raw = load(spark, root, batch)
    seen = []
    real = maintained.silver_orders
    monkeypatch.setattr(maintained, "silver_orders", lambda o, i, p: seen.append(i._jdf.queryExecution().executedPlan().toString()) or real(o, i, p))
    refresh(raw, changed_orders(batch).where(F.col("order_id") > "o5"), f"{root}/kept", SETTINGS)
    # Spark broadcasts the table of ids by itself, as it sees its size.
    assert "BroadcastHashJoin" in seen[0] and "LeftSemi" in seen[0] and "hashpartitioning(order_id" not in seen[0]
