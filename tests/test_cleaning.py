from datetime import datetime

from tallybrook.plans.cleaning import (
    clean_audit,
    clean_customers,
    clean_order_items,
    clean_order_payments,
    clean_orders,
    clean_product_categories,
    clean_products,
)

CUSTOMER = "customer_id, customer_unique_id, zip_code_prefix, city, state"
ORDER = (
    "order_id, customer_id, order_status, purchase_timestamp, approved_at, delivered_carrier_date, "
    "delivered_customer_date, estimated_delivery_date"
)
ITEM = "order_id, order_item_id int, product_id, seller_id, shipping_limit_date, price, freight_value"
PAYMENT = "order_id, payment_sequential int, payment_type, payment_installments, payment_value"
PRODUCT = (
    "product_id, category_name, name_length int, description_length int, photos_qty int, "
    "weight_g, length_cm, height_cm, width_cm"
)


def test_customers_without_id_or_repeated_are_dropped(frame):
    df = frame(
        CUSTOMER,
        ("k9", "q1", "4", "natal", "RN"),
        ("k9", "q2", "4", "natal", "RN"),
        (None, "q3", "5", "natal", "RN"),
        ("k2", "q4", "6", "olinda", "PE"),
    )
    assert sorted(r.customer_id for r in clean_customers(df).collect()) == ["k2", "k9"]


def test_state_is_upper_case_and_known(frame):
    df = frame(CUSTOMER, *[(f"k{i}", "q", "4", "natal", s) for i, s in enumerate(("rn", "Pe", "QQ", "R", ""))])
    assert sorted(r.state for r in clean_customers(df).collect()) == ["PE", "RN"]


def test_state_null_is_dropped(frame):
    assert clean_customers(frame(CUSTOMER, ("id1", "u1", "1", "a", None))).count() == 0


def test_text_is_normalised(frame):
    df = frame(
        CUSTOMER,
        ("id1", "u1", " 123 ", "\t são JOÃO-del rei d'OESTE  ", "\tsp\n"),
        ("id2", "u2", "123456789", "rio", "rj"),
        ("id3", "u3", "-42", "rio", "rj"),
        ("id4", "u4", None, None, "rj"),
    )
    result = {r.customer_id: r for r in clean_customers(df).collect()}
    assert result["id1"].zip_code_prefix == "00000123"
    assert result["id1"].city == "São João-del Rei D'oeste"
    assert result["id1"].state == "SP"
    assert result["id2"].zip_code_prefix == "123456789"
    assert result["id3"].zip_code_prefix == "-0000042"
    assert result["id4"].zip_code_prefix is None and result["id4"].city is None


def test_key_whose_survivor_is_invalid_is_gone(frame):
    # "AA" comes before "SP" among the other columns, so it survives and then fails.
    df = frame(CUSTOMER, ("id1", "u1", "1", "a", "AA"), ("id1", "u1", "1", "a", "SP"))
    assert clean_customers(df).count() == 0


def test_survivor_does_not_depend_on_row_order(frame, rows):
    some = [("id1", f"u{i % 7}", str(i), "a", "SP") for i in range(50)]
    there, back = frame(CUSTOMER, *some), frame(CUSTOMER, *reversed(some))
    kept = rows(clean_customers(there.repartition(7)))
    assert kept == rows(clean_customers(back.repartition(3))) and kept[0][1] == "u0"


def test_order_dates_are_parsed_leniently(frame):
    good = "2024-01-02 03:04:05"
    df = frame(
        ORDER,
        ("o1", "c1", "delivered", good, "2024-01-03T00:00:00", "nonsense", "2024", None),
        ("o2", "c1", "delivered", "not a date", good, good, good, good),
        ("o3", None, "delivered", good, good, good, good, good),
        ("o4", "c1", "lost", good, good, good, good, good),
        ("o5", "c1", None, good, good, good, good, good),
    )
    (one,) = clean_orders(df).collect()
    assert one.order_id == "o1"
    assert one.purchase_timestamp == datetime(2024, 1, 2, 3, 4, 5)
    assert one.approved_at == datetime(2024, 1, 3)
    assert one.delivered_carrier_date is None and one.delivered_customer_date is None


def test_dates_with_offsets_and_day_first(spark, frame):
    texts = {
        "2024-01-02 03:04:05+02:00": datetime(2024, 1, 2, 1, 4, 5),
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04:05-0330": datetime(2024, 1, 2, 6, 34, 5),
        "02/01/2024": datetime(2024, 1, 2),
        " 31/12/2024 23:59:58": datetime(2024, 12, 31, 23, 59, 58),
        "2024-01-02 03:04": datetime(2024, 1, 2, 3, 4),
        "13/13/2024": None,
        "2024-02-30": None,
    }
    df = frame("order_id, customer_id, order_status, purchase_timestamp, approved_at", *[(str(i), "c", "shipped", "2024-01-01", t) for i, t in enumerate(texts)])
    for zone in ("America/Sao_Paulo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = {r.order_id: r.approved_at for r in clean_orders(df).collect()}
        assert got == {str(i): t for i, t in enumerate(texts.values())}
        zoned = df.limit(1).selectExpr("'a' AS order_id", "'c' AS customer_id", "'shipped' AS order_status", "timestamp'2024-05-06 07:08:09 UTC' AS purchase_timestamp")
        assert clean_orders(zoned).first().purchase_timestamp == datetime(2024, 5, 6, 7, 8, 9)


def test_order_date_columns_are_optional(frame):
    df = frame("order_id, customer_id, order_status, purchase_timestamp", ("o1", "c1", "shipped", "2024-01-02"))
    assert clean_orders(df).first().purchase_timestamp == datetime(2024, 1, 2)


def test_products_without_weight_are_dropped(frame):
    def product(key, weight, height="4"):
        return (key, "jardim", 12, 80, 1, weight, "9", height, "7")

    df = frame(PRODUCT, product("a", "-1"), product("b", "0"), product("c", "0.25", "tall"), product("d", "n/a"), product(None, "3"))
    (one,) = clean_products(df).collect()
    assert (one.product_id, one.weight_g, one.height_cm) == ("c", 0.25, None)


def test_items_need_price_and_freight(frame, rows):
    df = frame(
        ITEM,
        ("o1", 1, "p1", "s1", "2024-01-01", "10.50", "0"),
        ("o1", 2, "p1", "s1", "2024-01-01", "0", "1"),
        ("o1", 3, "p1", "s1", "2024-01-01", "10", "-1"),
        ("o1", 4, "p1", "s1", "2024-01-01", "ten", "1"),
        ("o1", 5, None, "s1", "2024-01-01", "10", "1"),
        ("o2", 1, "p2", "s1", "2024-01-01", "7", "1"),
        ("o2", 1, "p1", "s1", "2024-01-01", "8", "1"),
    )
    assert rows(clean_order_items(df), "order_id", "order_item_id", "product_id", "price") == [
        ("o1", 1, "p1", 10.5),
        ("o2", 1, "p1", 8.0),
    ]
    assert dict(clean_order_items(df).dtypes)["shipping_limit_date"] == "string"


def test_payments_of_unknown_type_or_without_value_are_dropped(frame, rows):
    df = frame(
        PAYMENT,
        ("q7", 1, "voucher", "3", "12.75"),
        ("q7", 2, "cheque", "1", "9"),
        ("q8", 1, "debit_card", "some", "0.01"),
        ("q8", 2, "debit_card", "1", "-4"),
    )
    assert rows(clean_order_payments(df), "order_id", "payment_installments", "payment_value") == [
        ("q7", 3, 12.75),
        ("q8", None, 0.01),
    ]


def test_categories_pass_through(frame):
    df = frame("product_category_name, product_category_name_english", ("a", "b"), ("a", "c"))
    assert clean_product_categories(df).count() == 2


def test_audit_counts_rows(frame, rows):
    before = {"customers": frame(CUSTOMER, ("1", "u", "1", "a", "SP"), ("2", "u", "1", "a", "XX"))}
    after = {"customers": clean_customers(before["customers"])}
    assert rows(clean_audit(before, after)) == [("customers", 2, 1, 1)]


def test_usual_and_other_timestamps(spark):
    from pyspark.sql import functions as F

    from tallybrook.functions.casts import to_timestamp

    texts = ["2024-03-05", "2024-03-05 06:07:08", "2024-03-05T06:07:08.123456", "2024-13-05", "2024-03-05 25:00:00", "2024-03-05 06:07:08Z", "5/3/2024", " 2024-03-05 ", "2024-03-05\n", "2024", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(to_timestamp(F.col("t")).cast("string")).collect()
    day = "2024-03-05 00:00:00"
    assert [r[0] for r in found] == [day, "2024-03-05 06:07:08", "2024-03-05 06:07:08.123456", None, None, "2024-03-05 06:07:08", day, day, day, None, None]
