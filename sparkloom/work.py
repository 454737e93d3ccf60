"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import hashlib
import re
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

#: Removes a statement's shuffle files when it ends; what is written doesn't need them any more.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Names of written tables that are still there.
_NAMES: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine, as in tests, gets a temporary one; on a cluster it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="sparkloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def work_schema(spark: SparkSession) -> str:
    """The schema of the work tables: it lies in the shared folder, so that dropping a table removes its files."""
    place = f"{shared_folder(spark)}/sparkloom"
    name = f"spark_catalog.sparkloom_{hashlib.md5(place.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{place}'")
    return name


def written(df: DataFrame, what: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    name = f"{work_schema(spark)}.{what}_{uuid.uuid4().hex}"
    was = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.format("parquet").option("compression", compression).saveAsTable(name)
    finally:
        spark.conf.set(CLEANUP, was)
    out = spark.table(name)
    _NAMES[out] = name
    return out


def discard(*tables: DataFrame) -> None:
    """Drops written tables that nothing reads any more, with their files."""
    for t in tables:
        if name := _NAMES.pop(t, None):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def discard_all(spark: SparkSession) -> None:
    """Drops every written table of this shared folder, those that results still read included: for when all is done."""
    spark.sql(f"DROP SCHEMA IF EXISTS {work_schema(spark)} CASCADE")
    _NAMES.clear()
