"""One session for all tests, and rows written in short form."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("catalog")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """``frame("a, b int", (1, 2), ...)``: text columns unless typed, dates as text cast to the type."""

    def make(columns: str, *rows: tuple) -> DataFrame:
        parts = [c.strip().split(" ", 1) for c in columns.split(", ")]
        names = [p[0] for p in parts]
        text = spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in r) for r in rows],
            ", ".join(f"{n} string" for n in names),
        )
        types = [p[1] if len(p) > 1 else "string" for p in parts]
        return text.selectExpr(*[f"cast({n} AS {t}) AS {n}" for n, t in zip(names, types)])

    return make


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df: DataFrame, *columns: str) -> list[tuple]:
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
