"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import TABLES
from sparkloom.session import table as load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes, read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return load(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None) -> Callable:
    """Registers f(tables) -> DataFrame."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def sql(name: str, text: str, oracle: str | None = None) -> None:
    """Registers a query given as Spark SQL over the tables; without an oracle the same text checks it."""
    used = [t for t in TABLES if t in text]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in used:
            load(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(text)

    QUERIES[name] = run
    ORACLES[name] = oracle or text
