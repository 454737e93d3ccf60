"""A local session, and the tables as plain Python rows."""

import math
import os
import sys
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parents[1]))
from sparkloom.session import CONF

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return DATA


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    b = SparkSession.builder.master("local[8]").appName("tests")
    conf = CONF | {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.warehouse.dir": f"{base}/warehouse",
        "spark.checkpoint.dir": f"{base}/shared", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
    }
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


class Rows:
    """Tables of a folder as lists of dicts."""

    def __init__(self, folder: str) -> None:
        self.folder, self.read = folder, {}

    def __getattr__(self, name: str) -> list[dict]:
        if name not in self.read:
            self.read[name] = pq.read_table(f"{self.folder}/{name}.parquet").to_pylist()
        return self.read[name]


@pytest.fixture(scope="session")
def data(sf_dir):
    return Rows(sf_dir)


def plain(v):
    """Values that compare alike whichever engine made them."""
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    return v


def in_order(rows):
    """Rows as tuples of plain values, in an order of their own."""
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)
