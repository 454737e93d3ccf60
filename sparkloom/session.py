"""Sessions and table registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: What every session pins: one time zone, adaptive plans with split skewed joins, Arrow between JVM and Python.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, app: str = "sparkloom", **conf: str) -> SparkSession:
    """A session with the pinned settings; ``conf`` takes further ones, with underscores for dots."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (CONF | {k.replace("_", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views over the tables of a folder; only footers are read."""
    for n in names or TABLES:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
