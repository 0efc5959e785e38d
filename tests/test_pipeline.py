"""From landing files to checked models, and the same by increments."""

import pytest

from tallybrook.operators.checks import ChecksFailed
from tallybrook.operators.upsert import committed_versions, read_version
from tallybrook.plans.warehouse import MODELS, Warehouse, build_models, clean_layer, enrich_layer, load_layer
from tallybrook.queries import SETTINGS, Tables, comparable
from tallybrook.sources.schemas import KEYS
from tallybrook.sources.star_schema import MONEY
from tallybrook.sources.tables import write_csv
from tallybrook.streaming.incremental import ingest_new_files

SF = "/root/testdata/sf0.001"


def test_batch_run(spark, tmp_path):
    landing, lake, warehouse = (str(tmp_path / d) for d in ("landing", "lake", "warehouse"))
    tables = Tables(spark, SF)
    for name in KEYS:
        write_csv(tables.landing[name], f"{landing}/{name}.csv")
    cleaned = clean_layer(spark, landing, lake)
    assert set(cleaned) == set(KEYS)
    for name in ("customers", "orders"):
        assert cleaned[name].exceptAll(tables.clean[name]).isEmpty()
    enriched = enrich_layer(spark, lake, SETTINGS)
    assert set(enriched) == {"orders_enriched", "customers_enriched", "products_enriched", "order_items"}
    raw = load_layer(spark, lake, warehouse, MONEY)
    # Loading the same batch again changes nothing.
    counts = {n: df.count() for n, df in raw.items()}
    raw = load_layer(spark, lake, warehouse, MONEY)
    assert {n: df.count() for n, df in raw.items()} == counts
    built = build_models(raw, warehouse, SETTINGS)
    lazy = Warehouse(tables.raw, SETTINGS)
    for name in MODELS:
        written, planned = comparable(built[name]), comparable(lazy[name])
        assert written.columns == planned.columns
        assert written.exceptAll(planned).isEmpty() and planned.exceptAll(written).isEmpty(), name


def test_run_stops_at_failed_checks(spark, tmp_path):
    raw = dict(Tables(spark, SF).raw)
    raw["product_categories"] = raw["product_categories"].union(raw["product_categories"])
    with pytest.raises(ChecksFailed, match="product_categories.product_category_name unique: 24"):
        build_models(raw, str(tmp_path), SETTINGS)


def _orders(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    header = (
        "order_id,customer_id,order_status,purchase_timestamp,approved_at,"
        "delivered_carrier_date,delivered_customer_date,estimated_delivery_date"
    )
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def test_increments(spark, rows, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "orders")

    def ingest():
        ingest_new_files(spark, "orders", str(landing), target, str(tmp_path / "progress")).awaitTermination()
        return rows(read_version(spark, target), "order_id", "order_status")

    _orders(landing, "1.csv", "o1,c1,shipped,2024-01-01,,,,", "o2,c1,lost,2024-01-01,,,,", "o3,c1,approved,bad,,,,")
    assert ingest() == [("o1", "shipped")]
    # Nothing new: no new version.
    ingest()
    assert committed_versions(spark, target) == [1]
    _orders(landing, "2.csv", "o1,c1,delivered,2024-01-01,,,,", "o4,c2,invoiced,2024-01-02,,,,", "o5,c2,invoiced")
    assert ingest() == [("o1", "delivered"), ("o4", "invoiced")]
    assert [r.line for r in spark.read.parquet(f"{target}-rejected").collect()] == ["o5,c2,invoiced"]


def test_increments_by_column_name(spark, rows, tmp_path):
    landing, target, seen = tmp_path / "landing", str(tmp_path / "orders"), []
    landing.mkdir()
    (landing / "1.csv").write_text("order_status,order_id,purchase_timestamp,origin,customer_id\nshipped,o1,2024-01-01,new,c1\n")
    (landing / "2.csv").write_text("")
    _orders(landing, "3 b.csv", "o2,c2,delivered,2024-01-02,,,,")
    ingest = lambda: ingest_new_files(spark, "orders", str(landing), target, str(tmp_path / "progress"), then=lambda b: seen.append(b.count()))
    ingest().awaitTermination()
    assert rows(read_version(spark, target), "order_id", "order_status", "customer_id") == [("o1", "shipped", "c1"), ("o2", "delivered", "c2")]
    assert seen == [2]
    (landing / "4.csv").write_text("customer_id,order_status\nc1,shipped\n")
    with pytest.raises(Exception, match="lacks the columns"):
        ingest().awaitTermination()
    assert committed_versions(spark, target) == [1]


def test_a_run_needs_all_landing_tables(spark, tmp_path):
    (tmp_path / "product_categories.csv").write_text("product_category_name,product_category_name_english\na,b\n")
    with pytest.raises(FileNotFoundError, match="customers"):
        clean_layer(spark, str(tmp_path), str(tmp_path / "lake"))
    assert set(clean_layer(spark, str(tmp_path), str(tmp_path / "lake"), ["product_categories"])) == {"product_categories"}
