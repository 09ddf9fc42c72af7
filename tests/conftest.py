"""One local session for all tests, and a comparison of a query with its SQL."""

from __future__ import annotations

import math
import os
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    found = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    return str(value)


def same(frame, sql: str, folder) -> None:
    """frame (Spark) has the rows and columns that DuckDB gets from sql over folder's tables."""
    with duckdb.connect() as db:
        db.execute("set timezone = 'UTC'")
        for name in TABLES:
            db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
        found = db.execute(sql)
        names = [x[0] for x in found.description]
        wanted = [dict(zip(names, row, strict=True)) for row in found.fetchall()]
    assert sorted(frame.columns) == sorted(names)
    rows = lambda some: sorted(repr([_plain(r[c]) for c in sorted(names)]) for r in some)
    assert rows(r.asDict() for r in frame.collect()) == rows(wanted)
