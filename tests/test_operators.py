from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook.operators.dedupe import keep_one, require_unique
from tallybrook.operators.ranking import ranks_of_counts, top_ranked, with_position, with_share

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_keep_one_takes_the_smallest_row_nulls_first(frame, rows):
    df = frame("k, a int, b", ("x", 2, "m"), ("x", 1, "z"), ("x", 1, "y"), ("y", 5, "n"), ("y", None, "o"))
    assert rows(keep_one(df, ["k"])) == [("x", 1, "y"), ("y", None, "o")]


def test_keep_one_on_keys_alone(frame, rows):
    assert rows(keep_one(frame("k", ("x",), ("x",), ("y",)), ["k"])) == [("x",), ("y",)]


def test_keep_one_cuts_groups_before_the_shuffle(frame):
    plan = keep_one(frame("k, a", ("x", "1")), ["k"])._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


def test_require_unique(frame, rows):
    good = frame("k, j, a", ("x", "1", "p"), ("x", "2", "q"))
    assert rows(require_unique(good, ["k", "j"])) == rows(good)
    with pytest.raises(Exception, match="occurs twice"):
        require_unique(good, ["k"]).collect()
    with pytest.raises(Exception, match="has a NULL"):
        require_unique(frame("k, j, a", ("x", None, "p")), ["k", "j"]).collect()


def _skewed(spark, n=30_000):
    """A third of the rows has one key, a seventh has none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 900)
    return spark.range(n).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


def test_a_hot_product_takes_the_broadcast(spark, frame):
    """A third of the items has one product: with all other broadcasts forbidden, its rows are joined without a shuffle."""
    from tallybrook.plans.silver import silver_order_items

    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.shuffle.partitions",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.coalescePartitions.enabled"]
    for name, value in zip(names, ("-1", "16k", "16k", "16", "2", "false")):
        spark.conf.set(name, value)
    try:
        rows = _skewed(spark, 60_000).repartition(8)
        items = rows.selectExpr(
            "string(v) AS order_id", "1 AS order_item_id", "string(k) AS product_id", "'s' AS seller_id",
            "timestamp_ntz '2024-01-01 00:00:00' AS shipping_limit_date", "decimal(v) AS price",
            "decimal(1) AS freight_value", "decimal(v + 1) AS item_total", "cast(NULL AS timestamp_ntz) AS created_at",
        )
        orders = spark.range(0, 60_000, 2).selectExpr(
            "string(id) AS order_id", "'delivered' AS order_status",
            "timestamp_ntz'2024-01-01 00:00:00' AS purchase_timestamp", "'c' AS customer_id",
        )
        products = spark.range(900).selectExpr(
            "string(id) AS product_id", "'a' AS category_name", "'b' AS category_name_english", "decimal(1) AS weight_g"
        )
        joined = silver_order_items(items, orders, products)
        written = joined.select("order_id", "product_id", "weight_g")
        assert written.where("product_id = '7' AND weight_g IS NOT NULL").count() > 20_000
        rows = written.collect()
        assert len(rows) == 60_000
        plan = written._jdf.queryExecution().executedPlan().toString()
        assert "Union" in plan and "BroadcastHashJoin [product_id" in plan
    finally:
        for name in names:
            spark.conf.set(name, "4") if name.endswith("shuffle.partitions") else spark.conf.unset(name)


@FEW
@given(st.lists(st.integers(1, 6), min_size=1, max_size=30), st.integers(1, 8))
def test_top_ranked_against_brute_force(spark, values, k):
    df = spark.createDataFrame([(f"{i:02}", v) for i, v in enumerate(values)], "name string, v int")
    ranked = sorted((-v, f"{i:02}") for i, v in enumerate(values))[:k]
    expected = [(name, -v, 1 + sum(w > -v for w in values)) for v, name in ranked]
    got = sorted((tuple(r) for r in top_ranked(df, "v", "name", k, "place").collect()), key=lambda r: (-r[1], r[0]))
    assert got == expected


@FEW
@given(st.lists(st.integers(1, 6), min_size=1, max_size=30))
def test_ranks_of_counts_against_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n int")
    expected = {v: 1 + sum(w > v for w in values) for v in Counter(values)}
    assert {r.n: r.place for r in ranks_of_counts(df, "n", "place").collect()} == expected


def test_share_of_a_zero_total_is_null(frame, rows):
    assert rows(with_share(frame("g, v int", ("a", 0), ("b", 0)), "v", "pct")) == [("a", 0, None), ("b", 0, None)]
    assert rows(with_share(frame("g, v int", ("a", 1), ("b", 2)), "v", "pct")) == [("a", 1, 33.33), ("b", 2, 66.67)]


@FEW
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(0, 99)), max_size=40, unique=True), st.integers(1, 6))
def test_positions_against_sorting(spark, tmp_path_factory, values, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(a, b, "x") for a, b in values], "a int, b int, _row string")
        placed = with_position(df, [F.col("a").desc(), F.col("b").asc()], "position", str(tmp_path_factory.mktemp("placed")))
        got = sorted((r.position, r.a, r.b) for r in placed.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == [(i, a, b) for i, (a, b) in enumerate(sorted(values, key=lambda v: (-v[0], v[1])), 1)]
