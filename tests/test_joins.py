"""Joins under hot keys, alone and inside the models."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.operators.joins import heavy_keys, join_unique
from tallybrook.operators.upsert import read_version, upsert_table
from tallybrook.plans.cleaning import CLEANERS
from tallybrook.plans.warehouse import Warehouse
from tallybrook.queries import SETTINGS
from tallybrook.sources.schemas import KEYS, landing_schema, raw_schema
from tallybrook.sources.tables import conform

HOT = "p007"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=40), st.sets(st.integers(0, 7)), st.integers(1, 6))
def test_join_against_a_dictionary(spark, keys, right, parts):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int")
    sizes = spark.createDataFrame([(k, f"s{k}") for k in right], "k int, s string")
    got = join_unique(left, sizes, "k", parts)
    assert got.columns == ["k", "v", "s"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(k, i, f"s{k}" if k in right else None) for i, k in enumerate(keys)], key=str)
    counts = Counter(k for k in keys if k is not None)
    heavy = {r[0] for r in heavy_keys(left, "k", parts).collect()}
    assert heavy == {k for k, n in counts.items() if n * parts > sum(counts.values())} and len(heavy) < parts


def landing(spark):
    """A third of the items in one product, some without one that is known."""
    products = spark.range(300).selectExpr("concat('p', lpad(id, 3, '0')) AS product_id", "'beds' AS category_name", "'1' AS weight_g")
    items = spark.range(6_000).selectExpr(
        "concat('o', id DIV 2) AS order_id", "string(id % 2 + 1) AS order_item_id",
        f"CASE WHEN id % 3 = 0 THEN '{HOT}' WHEN id % 50 = 1 THEN 'nowhere' ELSE concat('p', lpad(id % 300, 3, '0')) END AS product_id",
        "'s' AS seller_id", "'2020-01-05 00:00:00' AS shipping_limit_date", "string(1 + id % 9) AS price", "'1' AS freight_value",
    )
    orders = spark.range(3_000).selectExpr("concat('o', id) AS order_id", "'c' AS customer_id", "'delivered' AS order_status", "'2020-01-02 00:00:00' AS purchase_timestamp")
    names = spark.sql("SELECT 'beds' AS product_category_name, 'Beds' AS product_category_name_english")
    made = {"products": products, "order_items": items, "orders": orders, "product_categories": names}
    out = {}
    for table, rows in made.items():
        lacking = [F.lit(None).cast("string").alias(c) for c in landing_schema(table).names if c not in rows.columns]
        out[table] = rows.select("*", *lacking).repartition(6)
    return out


@pytest.fixture(params=["cleaned", "loaded"])
def raw(request, spark, tmp_path):
    """Tables as ``keep_one`` leaves them in one plan, or loaded and read by buckets."""
    tables = {t: conform(CLEANERS[t](rows), raw_schema(t)) for t, rows in landing(spark).items()}
    if request.param == "loaded":
        for t, rows in tables.items():
            upsert_table(rows, str(tmp_path / t), KEYS[t], buckets=4)
        tables = {t: read_version(spark, str(tmp_path / t), keys=KEYS[t]) for t in tables}
    return tables


def test_a_hot_product_is_not_shuffled_by_product(spark, raw):
    """Through the models: rows of the hot product take the broadcast, and no partition of the shuffle is hot."""
    before = {n: spark.conf.get(n) for n in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        model = Warehouse(raw, SETTINGS)["silver_order_items"]
        counts = {r[0]: r[1] for r in model.groupBy("product_id").count().collect()}
        known = model.where("category_name_english = 'Beds'").count()
        found = model.select("order_id", "product_id", "category_name")
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert counts[HOT] > 2_000 and sum(counts.values()) == 6_000
    assert known == 6_000 - counts["nowhere"]
    assert "Union" in plan and plan.count("BroadcastHashJoin [product_id") >= 2
    # What is shuffled to the join by product is without the marked rows.
    marked = [part for part in plan.split("Exchange hashpartitioning(product_id")[1:] if "_heavy" in part.split("Exchange")[0]]
    assert marked and all("isnull(_heavy" in part.split("Exchange")[0] or "LeftAnti" in part.split("Exchange")[0] for part in marked)


def test_shares_need_no_window_over_all_rows(spark, raw):
    report = Warehouse(raw, SETTINGS)["gold_revenue_by_category"]
    plan = report._jdf.queryExecution().executedPlan().toString()
    # keep_one has windows by key; none is without one.
    assert not [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition(specifiedwindowframe" in line]
    assert "Subquery" in plan
    assert [(r.category, r.revenue_share_pct) for r in report.collect()] == [("Beds", 100.0)]
