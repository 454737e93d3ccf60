"""Sources and sinks: files, Arrow tables, ranges and series."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.work import written


def parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*paths)
    return df.select(columns) if columns else df


def csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True, sep: str = ",") -> DataFrame:
    """Without a schema one is inferred, which reads the files twice."""
    r = spark.read.option("header", header).option("sep", sep)
    return r.schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path)


def json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def arrow(spark: SparkSession, data: pa.Table | pa.RecordBatch | list[pa.RecordBatch], view: str | None = None) -> DataFrame:
    """In-memory Arrow data as a DataFrame, and as a view if it is given a name."""
    if isinstance(data, pa.RecordBatch):
        data = [data]
    df = spark.createDataFrame(pa.Table.from_batches(data) if isinstance(data, list) else data)
    if view:
        df.createOrReplaceTempView(view)
    return df


def all_types(spark: SparkSession) -> DataFrame:
    """A row with the least, one with the greatest and one with null values of each type; k tells them apart."""
    kinds = {
        "bool": ("boolean", "false", "true"), "tiny": ("tinyint", "-128", "127"), "small": ("smallint", "-32768", "32767"), "int": ("int", "-2147483648", "2147483647"),
        "big": ("bigint", "-9223372036854775807L - 1L", "9223372036854775807L"), "float": ("float", "-3.4e38", "3.4e38"), "double": ("double", "-1e300", "1e300"),
        "dec": ("decimal(19,2)", "-99999999999999999.99BD", "99999999999999999.99BD"), "text": ("string", "''", "'\U0001f986 é'"), "blob": ("binary", "X''", "X'00FF'"), "day": ("date", "DATE '0001-01-01'", "DATE '9999-12-31'"),
        "moment": ("timestamp_ntz", "TIMESTAMP_NTZ '1900-01-01 00:00:00'", "TIMESTAMP_NTZ '2999-12-31 23:59:59.999999'"), "zoned": ("timestamp", "TIMESTAMP '1900-01-01 00:00:00Z'", "TIMESTAMP '2999-12-31 23:59:59Z'"),
        "list": ("array<int>", "array()", "array(1, NULL, 2147483647)"), "record": ("struct<a:int>", "named_struct('a', NULL)", "named_struct('a', 1)"), "mapping": ("map<string,int>", "map()", "map('k', 1)"),
    }
    row = lambda k, of: f"SELECT {k} AS k, " + ", ".join(f"CAST({of(v)} AS {v[0]}) AS {c}" for c, v in kinds.items())
    return spark.sql(" UNION ALL ".join((row(1, lambda v: v[1]), row(2, lambda v: v[2]), row(3, lambda v: "NULL"))))


def series(spark: SparkSession, start: int, stop: int, step: int = 1, name: str = "generate_series") -> DataFrame:
    """Whole numbers from start to stop, both included."""
    end = stop + (1 if step > 0 else -1)
    return spark.range(start, end, step).select(F.col("id").alias(name))


def with_ordinal(df: DataFrame, *order: str, name: str = "rowid") -> DataFrame:
    """A row number from 0 in a given order, nulls first; rows that are equal in ``order`` may take each other's numbers.

    The sorted partitions are written once with each row's place, so that counts and rows come from the same run of the
    sort; offsets are sums over one row for each partition. No task ever has all rows.
    """
    s = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.struct(F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("i"))
    s = written(s.withColumn("_place", place), "sorted")
    counts = s.groupBy(F.col("_place.part").alias("_p")).agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    return s.join(F.broadcast(offsets), F.col("_place.part") == F.col("_p")).withColumn(name, F.col("_place.i") + F.col("_ahead")).drop("_place", "_p", "_ahead")


def write(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists", by: tuple[str, ...] = ()) -> None:
    w = df.write.mode(mode).format(kind)
    if kind == "csv":
        w = w.option("header", True)
    (w.partitionBy(*by) if by else w).save(path)
