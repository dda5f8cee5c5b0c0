"""Shared Spark session and the employee unit rows used across tests."""

from __future__ import annotations

import datetime as dt
import sys
import tempfile
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tessera.plans import fixtures as X  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tessera-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.csv.parser.columnPruning.enabled", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(spark):
    from tessera.session import scratch_path

    return scratch_path(spark, "test")


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


SILVER = X.SILVER_SCHEMA
GOOD = ("E001", "Alice", d("1990-01-15"), Decimal("75000.00"), d("2020-03-01"), "D01", d("2024-01-01"), d("2024-06-01"))
BAD = ("E002", "Bob", None, Decimal("0.00"), d("2021-05-01"), "X99", d("2024-02-01"), d("2024-07-01"))
DELETED = ("E003", "Carol", d("1988-02-02"), Decimal("90000.00"), d("2019-04-04"), "D02", d("2023-03-03"), d("2024-05-05"))
RAW_GOOD = ("E001", "Alice", "1/15/1990", Decimal("75000.00"), "3/1/2020", "D01", "1/1/2024", "6/1/2024", None)

CHANGE_SCHEMA = T.StructType([T.StructField("_change_type", T.StringType()), *SILVER.fields])


@pytest.fixture()
def silver_rows(spark):
    return spark.createDataFrame([GOOD, BAD], SILVER)


@pytest.fixture()
def raw_rows(spark):
    return spark.createDataFrame([RAW_GOOD], X.RAW_SCHEMA)
