"""What a batch run leaves on local disks while it runs."""

import time
from pathlib import Path
from threading import Barrier, Lock

import pytest
from pyspark.sql import functions as F

from tallybrook.plans import lake
from tallybrook.plans.warehouse import clean_layer, enrich_layer
from tallybrook.queries import Tables, _landing_files
from tallybrook.sources import tables
from tallybrook.sources.schemas import KEYS
from tallybrook.sources.tables import held, read_bytes, read_csv, sparing_disk, together, write_csv, write_table

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"


def _shuffle_files(spark) -> set[str]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


@pytest.fixture
def landing(spark, tmp_path):
    """The six tables as landing CSV."""
    rows = {
        "customers": "customer_id,customer_unique_id,zip_code_prefix,city,state\nk1,u1,1,natal,RN\nk2,u2,2,olinda,PE\n",
        "orders": "order_id,customer_id,order_status,purchase_timestamp,approved_at,delivered_carrier_date,"
        "delivered_customer_date,estimated_delivery_date\n"
        + "".join(f"o{n},k1,{s},2024-01-0{n},,,,\n" for n, s in enumerate(("delivered", "delivered", "delivered", "shipped"), 1)),
        "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2024-01-01,10.10,1\no1,2,p2,s1,2024-01-01,0.20,1\no1,2,p2,s1,2024-01-01,0.20,1\n"
        "o2,1,p1,s1,2024-01-01,Infinity,1\no4,1,p1,s1,2024-01-01,5,1\no9,1,p1,s1,2024-01-01,5,1\n",
        "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,boleto,1,11\n",
        "products": "product_id,category_name,name_length,description_length,photos_qty,weight_g,length_cm,height_cm,width_cm\n"
        "p1,a,1,1,1,1,1,1,1\np2,b,1,1,1,1,1,1,1\n",
        "product_categories": "product_category_name,product_category_name_english\na,A\n",
    }
    for table, text in rows.items():
        (tmp_path / f"{table}.csv").write_text(text)
    return str(tmp_path)


def test_a_run_frees_its_shuffles(spark, landing, tmp_path):
    before = _shuffle_files(spark)
    clean_layer(spark, landing, str(tmp_path / "lake"))
    enrich_layer(spark, str(tmp_path / "lake"))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP, None) is None and spark.conf.get(SPLIT, None) is None


def test_customers_off_enriched_orders(spark, rows, landing, tmp_path):
    cleaned = clean_layer(spark, landing, str(tmp_path / "lake"))
    enriched = enrich_layer(spark, str(tmp_path / "lake"))
    assert set(enriched) == {"orders_enriched", "customers_enriched", "products_enriched", "order_items"}
    alone = lake.customers_enriched(cleaned["customers"], cleaned["orders"], cleaned["order_items"])
    assert enriched["customers_enriched"].columns == alone.columns
    assert rows(enriched["customers_enriched"]) == rows(alone)
    assert rows(alone, "customer_id", "total_orders", "total_spent") == [("k1", 3, float("inf")), ("k2", None, None)]


def test_large_jobs_run_in_turn_beside_small_ones():
    large, beside, lock, seen = tables.LARGE + 1, Barrier(2, timeout=20), Lock(), []

    def do(item):
        name, size = item
        if size <= tables.LARGE or name == "first":
            beside.wait()
        if size > tables.LARGE:
            assert lock.acquire(blocking=False)
            time.sleep(0.05)
            seen.append(name)
            lock.release()
        return name

    items = [("second", large), ("small", 1), ("first", large + 1)]
    assert together(do, items, lambda item: item[1]) == ["second", "small", "first"]
    assert seen == ["first", "second"]


def test_a_large_job_that_fails_stops_no_other():
    done = []

    def do(name):
        if name == "bad":
            raise ValueError(name)
        done.append(name)

    with pytest.raises(ValueError, match="bad"):
        together(do, ["bad", "good", "small"], {"bad": tables.LARGE + 2, "good": tables.LARGE + 1, "small": 0}.get)
    assert sorted(done) == ["good", "small"]


def test_tables_beside_one_that_is_unreadable_are_cleaned(spark, landing, tmp_path):
    (tmp_path / "products.csv").write_text("name\nx\n")
    with pytest.raises(ValueError, match="products.csv lacks"):
        clean_layer(spark, landing, str(tmp_path / "lake"))
    assert {p.name for p in (tmp_path / "lake" / "bronze").iterdir()} == set(KEYS) - {"products"}
    assert spark.conf.get(CLEANUP, None) is None


def test_settings_are_held_by_blocks_that_overlap(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    first, second = held(spark, {key: "3"}), held(spark, {key: "4"})
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "3"
    second.__exit__(None, None, None)
    assert spark.conf.get(key, None) is None
    spark.conf.set(SPLIT, "1m")
    try:
        with pytest.raises(KeyError), sparing_disk(spark):
            assert int(spark.conf.get(SPLIT)) == 1 << 20
            raise KeyError
        assert spark.conf.get(SPLIT) == "1m"
    finally:
        spark.conf.unset(SPLIT)


def test_two_partitions_are_written_whole(spark, tmp_path):
    parsed = spark.range(0, 1000, 1, 1).select("id", (F.col("id") % 2 == 0).alias("even"))
    with sparing_disk(spark):
        back = write_table(parsed, str(tmp_path), "parsed", "t", "even", rebalance=False)
        assert back.exceptAll(parsed).isEmpty() and back.count() == 1000
        assert read_bytes(back) == sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))


def test_compressed_landing(spark, rows, tmp_path):
    df = spark.range(0, 250_000, 1, 1).selectExpr("string(id) AS a", "'x,\"y' AS b")
    write_csv(df, str(tmp_path / "t.csv"), compressed=True)
    files = list((tmp_path / "t.csv").glob("part-*"))
    assert len(files) == 3 and {f.suffix for f in files} == {".gz"}
    assert read_csv(spark, str(tmp_path / "t.csv")).select("a", "b").exceptAll(df).isEmpty()
    assert read_csv(spark, str(tmp_path / "t.csv")).count() == 250_000


def test_landing_of_a_run_is_compressed(spark):
    root = Path(_landing_files(Tables(spark, "/root/testdata/sf0.001")).removeprefix("file:"))
    assert {f.suffix for t in KEYS for f in (root / f"{t}.csv").glob("part-*")} == {".gz"}
