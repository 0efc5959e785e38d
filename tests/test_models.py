"""The corners of the models' semantics, each on a small fixture."""

from datetime import date, datetime

import pytest

from tallybrook.plans import bronze, gold, lake, silver
from tallybrook.plans.settings import Settings
from tallybrook.sources.schemas import ORDER_DATES, raw_schema
from tallybrook.sources.tables import conform


@pytest.fixture
def loaded(frame):
    """Rows of a loaded table from some of its columns."""

    def make(table: str, columns: str, *some):
        return conform(frame(columns, *some), raw_schema(table))

    return make


@pytest.fixture
def shop(loaded):
    """Three customers and orders around every corner of the models."""
    orders = loaded(
        "orders",
        "order_id, customer_id, order_status, " + ", ".join(ORDER_DATES),
        # exactly two and a half days; on the minute of the estimate
        ("o1", "c1", "delivered", "2024-01-07 00:00:00", None, None, "2024-01-09 12:00:00", "2024-01-09 12:00:00"),
        # just below two and a half days; late
        ("o2", "c1", "delivered", "2024-03-03 00:00:00", None, None, "2024-03-05 11:59:59", "2024-03-04 00:00:00"),
        # delivered without items, never judged
        ("o3", "c2", "delivered", "2024-03-04 00:00:00", None, None, None, "2024-03-09 00:00:00"),
        ("o4", "c2", "shipped", "2024-03-05 00:00:00", None, None, None, None),
        # older than the earliest date, and at it
        ("o5", "c1", "delivered", "2021-12-31 23:59:59", None, None, None, None),
        ("o6", "c4", "delivered", "2022-01-01 00:00:00", None, None, "2022-01-02 00:00:00", None),
    )
    items = loaded(
        "order_items",
        "order_id, order_item_id, product_id, seller_id, price, freight_value",
        ("o1", 1, "p1", "s", "300.00", "1.00"),
        ("o1", 2, "p2", "s", "100.00", "0.50"),
        ("o2", 1, "p1", "s", "600.00", "2.00"),
        ("o4", 1, "p1", "s", "50.00", "0"),
        ("o5", 1, "p3", "s", "10.00", "0"),
        ("o6", 1, "p9", "s", "80.00", "0"),
    )
    payments = loaded(
        "order_payments",
        "order_id, payment_sequential, payment_type, payment_installments, payment_value",
        ("o1", 1, "voucher", 2, "100.00"),
        ("o1", 2, "boleto", 5, "150.00"),
        ("o1", 3, "credit_card", 1, "150.00"),
    )
    customers = loaded(
        "customers",
        "customer_id, customer_unique_id, zip_code_prefix, city, state",
        ("c1", "u1", "1", "A", "SP"),
        ("c2", "u2", "2", "B", "RJ"),
        ("c3", "u3", "3", "C", "MG"),
    )
    products = loaded(
        "products",
        "product_id, category_name, weight_g",
        ("p1", "brinquedos", "5"),
        ("p2", "livros", "5"),
        ("p3", "livros", "5"),
    )
    categories = loaded(
        "product_categories",
        "product_category_name, product_category_name_english",
        ("brinquedos", "toys"),
    )
    return dict(
        orders=orders,
        items=items,
        payments=payments,
        customers=customers,
        products=products,
        categories=categories,
        b_orders=bronze.bronze_orders(orders),
        b_items=bronze.bronze_order_items(items),
        b_products=bronze.bronze_products(products, categories),
    )


@pytest.fixture
def s_orders(shop):
    return silver.silver_orders(shop["b_orders"], shop["b_items"], bronze.bronze_order_payments(shop["payments"]))


@pytest.fixture
def s_customers(shop):
    return silver.silver_customers(shop["customers"], shop["b_orders"], shop["b_items"])


@pytest.fixture
def s_items(shop):
    return silver.silver_order_items(shop["b_items"], shop["b_orders"], shop["b_products"])


def test_minimum_date_is_inclusive(shop, rows):
    assert rows(shop["b_orders"], "order_id") == [("o1",), ("o2",), ("o3",), ("o4",), ("o6",)]
    later = bronze.bronze_orders(shop["orders"], Settings(min_order_date="2024-03-05"))
    assert rows(later, "order_id") == [("o4",)]


def test_category_name_falls_back(shop, rows):
    assert rows(shop["b_products"], "product_id", "category_name_english") == [
        ("p1", "toys"),
        ("p2", "livros"),
        ("p3", "livros"),
    ]


def test_silver_orders(s_orders):
    orders = {r.order_id: r for r in s_orders.collect()}
    one, two, three = orders["o1"], orders["o2"], orders["o3"]
    assert (one.delivery_days, one.delivered_on_time) == (3, True)
    assert (two.delivery_days, two.delivered_on_time) == (2, False)
    assert (three.delivery_days, three.delivered_on_time) == (None, None)
    assert orders["o6"].delivered_on_time is None
    # the earlier of two largest payments
    assert (one.main_payment_type, one.max_installments, one.payment_total) == ("boleto", 5, 400)
    assert (two.main_payment_type, two.max_installments, two.payment_total) == (None, 1, 0)
    assert (one.items_count, one.items_total, one.freight_total, float(one.order_subtotal)) == (2, 400, 1.5, 401.5)
    assert (three.items_count, three.items_total, three.order_subtotal) == (0, 0, 0)
    assert (one.purchase_month, one.purchase_year, one.purchase_month_num) == (date(2024, 1, 1), 2024, 1)
    assert one.purchase_dow == 0 and three.purchase_dow == 1


def test_delivery_before_purchase_rounds_away_from_zero(frame, rows):
    from pyspark.sql import functions as F

    from tallybrook.functions.dates import nearest_days, whole_days

    df = frame(
        "a timestamp_ntz, b timestamp_ntz",
        ("2024-01-03 12:00:00", "2024-01-01 00:00:00"),
        ("2024-01-03 11:00:00", "2024-01-01 00:00:00"),
        ("2024-01-01 00:00:00", "2024-01-02 12:00:00"),
    )
    a, b = F.col("a"), F.col("b")
    assert rows(df.select(nearest_days(a, b), whole_days(a, b))) == [(-2, -2), (-3, -2), (2, 1)]


def test_silver_customers(s_customers):
    customers = {r.customer_id: r for r in s_customers.collect()}
    one, two, three = (customers[c] for c in ("c1", "c2", "c3"))
    # the mean is over items, o5 is too old, o3 has no items
    assert (one.total_orders, one.total_spent, round(one.avg_ticket, 4)) == (2, 1000, 333.3333)
    assert (one.is_recurring, one.customer_segment) == (True, "high_value")
    assert (one.first_order_at, one.last_order_at) == (datetime(2024, 1, 7), datetime(2024, 3, 3))
    for none in (two, three):
        assert (none.total_orders, none.total_spent, none.avg_ticket) == (0, 0, 0)
        assert (none.is_recurring, none.customer_segment, none.first_order_at) == (False, "no_purchase", None)


@pytest.mark.parametrize(
    "high, medium, segment",
    [(1001, 300, "medium_value"), (1001, 1000, "medium_value"), (5000, 1001, "low_value")],
)
def test_segments(shop, high, medium, segment):
    limits = Settings(high_value=high, medium_value=medium)
    result = silver.silver_customers(shop["customers"], shop["b_orders"], shop["b_items"], limits)
    assert result.where("customer_id = 'c1'").first().customer_segment == segment


def test_silver_items_keep_items_of_old_orders_and_unknown_products(s_items):
    items = {(r.order_id, r.order_item_id): r for r in s_items.collect()}
    assert len(items) == 6
    old, unknown = items["o5", 1], items["o6", 1]
    assert (old.order_status, old.purchase_month, old.category_name) == (None, None, "livros")
    assert (unknown.category_name, unknown.weight_g, unknown.customer_id) == (None, None, "c4")


def test_revenue_by_month(s_orders):
    months = {r.purchase_month: r for r in gold.gold_revenue_by_month(s_orders).collect()}
    assert sorted(months) == [date(2022, 1, 1), date(2024, 1, 1), date(2024, 3, 1)]
    march = months[date(2024, 3, 1)]
    # o3 has no items, o4 is not delivered
    assert (march.total_orders, march.unique_customers, march.total_revenue) == (1, 1, 600)
    assert (march.on_time_delivery_rate, march.avg_delivery_days, march.avg_items_per_order) == (0, 2, 1)
    assert months[date(2022, 1, 1)].on_time_delivery_rate is None


def test_revenue_by_category_and_state(s_orders, s_items, s_customers, rows):
    by_category = gold.gold_revenue_by_category(s_items)
    assert rows(by_category, "category", "category_pt", "total_orders", "units_sold", "revenue_share_pct") == [
        ("livros", "livros", 1, 1, 10.0),
        ("toys", "brinquedos", 2, 2, 90.0),
    ]
    # c4 of o6 is no known customer
    by_state = gold.gold_revenue_by_state(s_orders, s_customers)
    assert rows(by_state, "state", "total_orders", "unique_customers", "revenue_share_pct") == [("SP", 2, 1, 100.0)]


def test_top_products(shop, rows):
    sold = silver.delivered_items(shop["b_items"], shop["b_orders"])
    top = gold.gold_top_products(sold, shop["b_products"], Settings(top_k=2))
    assert rows(top, "product_id", "category", "units_sold", "revenue_rank", "units_rank") == [
        ("p1", "toys", 2, 1, 1),
        ("p2", "livros", 1, 2, 2),
    ]
    whole = gold.gold_top_products(sold, shop["b_products"])
    assert rows(whole, "product_id", "category", "revenue_rank", "units_rank")[2] == ("p9", None, 3, 2)


def test_top_customers(s_customers):
    (one,) = gold.gold_top_customers(s_customers, Settings(as_of=datetime(2024, 3, 4, 12))).collect()
    assert (one.customer_id, one.days_since_last_order, one.customer_lifespan_days) == ("c1", 1, 56)
    assert gold.gold_top_customers(s_customers).first().days_since_last_order > 300


def test_growth(frame, rows):
    orders = frame(
        "order_status, items_total decimal(10,2), purchase_month date",
        ("delivered", 200, "2024-01-01"),
        ("delivered", 250, "2024-03-01"),
        ("delivered", 0, "2024-02-01"),
        ("shipped", 99, "2024-02-01"),
    )
    assert rows(gold.monthly_growth(orders), "purchase_month", "prev_month_revenue", "mom_growth_pct") == [
        (date(2024, 1, 1), None, None),
        (date(2024, 3, 1), 200, 25.0),
    ]


def test_growth_from_zero_is_null(frame):
    from tallybrook.functions.numbers import percent

    from pyspark.sql import functions as F

    df = frame("a int, b int", (5, 0), (None, 5))
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [None, None]


def test_kpis(shop, s_orders):
    sold = silver.delivered_items(shop["b_items"], shop["b_orders"])
    panel = gold.gold_kpis(s_orders, shop["customers"], sold, shop["b_products"], Settings(as_of=datetime(2024, 4, 1)))
    (one,) = panel.collect()
    assert (one.total_revenue, one.overall_avg_ticket) == (1080, 360)
    assert (one.total_orders, one.total_customers, one.recurring_customers_pct) == (3, 2, 100.0)
    assert (one.last_month_growth_pct, one.on_time_delivery_pct, one.avg_delivery_days) == (50.0, 50.0, 2.0)
    assert (one.top_category, one.top_state, one.calculated_at) == ("toys", "SP", datetime(2024, 4, 1))


def test_kpis_of_no_orders(shop, s_orders):
    nothing = [df.where("false") for df in (s_orders, shop["customers"], shop["b_items"], shop["b_products"])]
    (one,) = gold.gold_kpis(*nothing).collect()
    assert one.total_orders == 0 and one.total_revenue is None and one.top_state is None
    assert one.recurring_customers_pct is None and one.on_time_delivery_pct is None


def test_lake_orders(shop):
    orders = {r.order_id: r for r in lake.orders_enriched(shop["orders"], shop["items"], shop["payments"]).collect()}
    assert len(orders) == 6
    one, three = orders["o1"], orders["o3"]
    # days are cut, the first payment is the main one
    assert (one.delivery_days, one.main_payment_type, one.order_total) == (2, "voucher", 401.5)
    assert (one.purchase_year, one.purchase_month) == (2024, 1)
    assert (three.items_total, three.order_total, three.items_count, three.payment_total) == (None,) * 4


def test_lake_customers(shop):
    result = lake.customers_enriched(shop["customers"], shop["orders"], shop["items"])
    customers = {r.customer_id: r for r in result.collect()}
    one, two, three = (customers[c] for c in ("c1", "c2", "c3"))
    # no minimum date, and the mean is over orders
    assert (one.total_orders, one.total_spent, round(one.avg_ticket, 4)) == (3, 1010.0, 336.6667)
    assert (one.is_recurring, one.customer_segment) == (True, "high_value")
    assert (two.total_orders, two.total_spent, two.avg_ticket, two.customer_segment) == (1, 0.0, None, "low_value")
    assert (three.total_orders, three.is_recurring, three.customer_segment) == (None, None, None)


def test_lake_products(shop, rows):
    args = (shop["products"], shop["categories"], shop["items"], shop["orders"])
    columns = ["product_id", "units_sold", "total_revenue", "avg_price", "product_category_name_english", "length_cm"]
    expected = [
        ("p1", 2, 900.0, 450.0, "toys", 0),
        ("p2", 1, 100.0, 100.0, None, 0),
        ("p3", 1, 10.0, 10.0, None, 0),
    ]
    assert rows(lake.products_enriched(*args), *columns) == expected


@pytest.mark.parametrize(
    "prices, total",
    [
        (("Infinity", "10"), float("inf")),
        (("1.23456", "1"), 2.23456),
        (("1e15", "0.1"), 1000000000000000.1),
        (("0.1", "0.2"), 0.3),
        (("1e300", "1"), 1e300),
        (("0.123456789", "1"), 1.123456789),
        ((None, "2"), 2.0),
    ],
)
def test_lake_sums_keep_every_amount(frame, prices, total):
    items = frame("order_id, order_item_id int, price double, freight_value double", *[("o", i, p, 0) for i, p in enumerate(prices)])
    orders = frame(
        "order_id, purchase_timestamp timestamp_ntz, delivered_customer_date timestamp_ntz, estimated_delivery_date timestamp_ntz",
        ("o", None, None, None),
    )
    payments = frame("order_id, payment_sequential int, payment_type, payment_installments int, payment_value double")
    (one,) = lake.orders_enriched(orders, items, payments).collect()
    assert one.items_total == total and one.items_count == 2


def test_lake_sum_of_nan_is_nan(frame):
    from pyspark.sql import functions as F

    from tallybrook.functions.numbers import total

    df = frame("a double", ("NaN",), ("1",))
    assert str(df.agg(total(F.col("a"))).first()[0]) == "nan"
    assert df.where("false").agg(total(F.col("a"))).first()[0] is None


def test_reports_are_read_in_order(s_items, s_orders):
    from tallybrook.plans.dashboard import in_order

    by_category = in_order("gold_revenue_by_category", gold.gold_revenue_by_category(s_items)).collect()
    assert [r.category for r in by_category] == ["toys", "livros"]
    by_month = in_order("gold_revenue_by_month", gold.gold_revenue_by_month(s_orders)).collect()
    assert [r.purchase_month.month for r in by_month] == [1, 1, 3]
