from datetime import datetime
from decimal import Decimal

import pytest

from tallybrook.sources.schemas import KEYS, STATES, landing_schema, raw_schema
from tallybrook.sources.tables import (
    BROKEN,
    conform,
    find_landing_tables,
    read_csv,
    read_landing,
    read_rejected,
    read_table,
    schema_name,
    shared_folder,
    table_path,
    write_csv,
    write_table,
)


def test_declared_tables():
    assert len(KEYS) == 6 and len(set(STATES)) == 27
    for table, keys in KEYS.items():
        assert set(keys) <= set(raw_schema(table).fieldNames())
    assert "created_at" in raw_schema("orders").fieldNames()
    assert "created_at" not in landing_schema("orders").fieldNames()


def test_csv_keeps_leading_zeros_and_quotes(spark, tmp_path, rows):
    (tmp_path / "customers.csv").write_text(
        "customer_id,customer_unique_id,zip_code_prefix,city,state\n"
        'c1,u1,00123,"Foo ""Bar"", Baz",SP\n'
        "c2,,9,x,RJ\n"
    )
    assert rows(read_landing(spark, str(tmp_path), "customers")) == [
        ("c1", "u1", "00123", 'Foo "Bar", Baz', "SP"),
        ("c2", None, "9", "x", "RJ"),
    ]


def test_csv_columns_go_by_name(spark, tmp_path, rows):
    folder = tmp_path / "product_categories.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("product_category_name_english,product_category_name\nen,pt\n")
    (folder / "b.csv").write_text("product_category_name,origin\nx,new\n")
    (folder / "_SUCCESS").write_text("")
    (folder / "empty.csv").write_text("")
    read = read_landing(spark, str(tmp_path), "product_categories")
    assert read.columns == ["product_category_name", "product_category_name_english", "origin"]
    assert rows(read) == [
        ("pt", "en", None),
        ("x", None, "new"),
    ]


def test_csv_without_key_columns_or_with_a_name_twice_fails(spark, tmp_path):
    (tmp_path / "product_categories.csv").write_text("english,portuguese\na,b\n")
    with pytest.raises(ValueError, match="lacks"):
        read_landing(spark, str(tmp_path), "product_categories")
    (tmp_path / "orders.csv").write_text("order_id,order_id\na,b\n")
    with pytest.raises(ValueError, match="twice"):
        read_landing(spark, str(tmp_path), "orders")


def test_broken_lines_are_kept_apart(spark, tmp_path, rows):
    (tmp_path / "product_categories.csv").write_text(
        "product_category_name,product_category_name_english\na,b\nc\nd,e,EXTRA\nf,\n"
    )
    assert rows(read_landing(spark, str(tmp_path), "product_categories")) == [("a", "b"), ("f", None)]
    assert rows(read_rejected(spark, str(tmp_path), "product_categories"), "line") == [("c",), ("d,e,EXTRA",)]
    # They stay out whatever columns are asked for.
    assert rows(read_landing(spark, str(tmp_path), "product_categories"), "product_category_name") == [("a",), ("f",)]
    assert read_landing(spark, str(tmp_path), "product_categories").count() == 2


def test_orders_without_optional_dates(spark, tmp_path):
    from tallybrook.plans.cleaning import clean_orders

    (tmp_path / "orders.csv").write_text("purchase_timestamp,order_id,order_status,customer_id\n2024-01-02,o1,shipped,c1\n")
    (one,) = conform(clean_orders(read_landing(spark, str(tmp_path), "orders")), raw_schema("orders")).collect()
    assert (one.order_id, one.purchase_timestamp, one.approved_at) == ("o1", datetime(2024, 1, 2), None)


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "product_categories.csv").write_text(
        'product_category_name,product_category_name_english\n"a\nb",c\n'
    )
    path = str(tmp_path / "product_categories.csv")
    (one,) = read_csv(spark, path, multiline=True).collect()
    assert one.product_category_name == "a\nb" and one[BROKEN] is None


def test_absent_landing_tables_fail(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="customers"):
        find_landing_tables(spark, str(tmp_path))
    (tmp_path / "orders.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError, match="customers"):
        find_landing_tables(spark, str(tmp_path))
    assert find_landing_tables(spark, str(tmp_path), ["orders"]) == ["orders"]


def test_conform_types_and_rounding(frame):
    items = frame("order_id, order_item_id, price, unknown", ("o1", "3", "10.005", "x"), ("o2", "4", "-10.005", "x"))
    one, two = conform(items, raw_schema("order_items"), datetime(2024, 1, 1)).orderBy("order_id").collect()
    assert (one.price, two.price) == (Decimal("10.01"), Decimal("-10.01"))
    assert (one.order_item_id, one.created_at, one.seller_id) == (3, datetime(2024, 1, 1), None)
    assert conform(items, raw_schema("order_items")).first().created_at is None


@pytest.mark.parametrize(
    "column, value",
    [("price", "123456789.00"), ("order_item_id", "x"), ("shipping_limit_date", "soon"), ("product_id", "p" * 51)],
)
def test_conform_refuses(frame, column, value):
    with pytest.raises(Exception):
        conform(frame(column, (value,)), raw_schema("order_items")).collect()


def test_schema_name_is_the_layer():
    assert (schema_name(" gold "), schema_name(None), schema_name(None, "x")) == ("gold", "public", "x")
    assert table_path("/w", "gold", "gold_kpis") == "/w/gold/gold_kpis"


def test_written_tables_are_replaced(spark, frame, rows, tmp_path):
    root = str(tmp_path)
    first = frame("a, m date, b int", ("x", "2024-01-01", 1), ("y", None, 2))
    back = write_table(first, root, "silver", "t", "m")
    assert back.columns == ["a", "m", "b"] and rows(back) == rows(first)
    again = write_table(first.where("b = 1"), root, "silver", "t", "m")
    assert rows(again) == rows(first.where("b = 1")) == rows(read_table(spark, root, "silver", "t"), "a", "m", "b")
    # The former version is still there for who reads it, the one before goes.
    assert rows(back) == rows(first)
    write_table(first, root, "silver", "t", "m")
    assert len(list((tmp_path / "silver" / "t").glob("version=*"))) == 2


def test_a_failed_write_leaves_the_table(spark, frame, rows, tmp_path):
    good = frame("a", ("x",))
    write_table(good, str(tmp_path), "silver", "t")
    with pytest.raises(Exception, match="boom"):
        write_table(good.selectExpr("raise_error('boom') AS a"), str(tmp_path), "silver", "t")
    assert rows(read_table(spark, str(tmp_path), "silver", "t")) == [("x",)]
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path), "silver", "other")


def test_csv_round_trip(spark, frame, rows, tmp_path):
    df = frame("product_category_name, product_category_name_english", ("a,b", 'say "x"'), ("c", None))
    write_csv(df, f"{tmp_path}/product_categories.csv")
    assert rows(read_landing(spark, str(tmp_path), "product_categories")) == rows(df)


def test_shared_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and shared_folder(spark) != shared_folder(spark)


def test_jobs_run_together():
    """Each waits for the other one, so one after another they would never end."""
    from threading import Barrier

    from tallybrook.sources.tables import together

    both = Barrier(2, timeout=20)
    assert together(lambda n: both.wait() >= 0 and n, [1, 2]) == [1, 2]
    assert together(str, []) == []
