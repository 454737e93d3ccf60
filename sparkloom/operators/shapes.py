"""Pivot, unpivot, top-k, distinct-on, gap filling and null order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(*names: str) -> list[Column]:
    """Sort columns with nulls last; a leading minus sorts down."""
    return [F.col(n[1:]).desc_nulls_last() if n[0] == "-" else F.col(n).asc_nulls_last() for n in names]


def pivot(df: DataFrame, on: str, using: Column, by: list[str], values: list | None = None) -> DataFrame:
    """Grouped aggregate with a column for each value of ``on``; without ``values`` they are found in a job of their own."""
    return df.groupBy(*by).pivot(on, values).agg(using)


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group. Spark turns the filter into a limit for each group before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def distinct_on(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, by, order, 1)


def qualify(df: DataFrame, value: Column, keep) -> DataFrame:  # noqa: ANN001
    """Rows for which ``keep`` holds of a window function's value."""
    return df.withColumn("_value", value).where(keep(F.col("_value"))).drop("_value")


def days_filled(df: DataFrame, day: str, value: str, by: list[str] = ()) -> DataFrame:
    """For each group a row for each day from its first to its last; days without a row have 0. No join: each row is
    followed by the days up to the group's next one."""
    w = Window.partitionBy(*by).orderBy(day)
    after = F.coalesce(F.date_sub(F.lead(day).over(w), 1), F.col(day))
    d = df.withColumn("_days", F.sequence(F.col(day), after)).withColumn("_day", F.explode("_days"))
    return d.withColumn(value, F.when(F.col("_day") == F.col(day), F.col(value)).otherwise(0)).withColumn(day, F.col("_day")).drop("_days", "_day")


def sampled(df: DataFrame, percent: float, *key: str) -> DataFrame:
    """A share of the rows by a hash of their key: the same rows in every run, whatever the partitions."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *key)), 1, 8), 16, 10).cast("long")
    return df.where(h < F.lit(int(percent / 100 * (1 << 32))))


def first_percent(df: DataFrame, order: list[Column], percent: float) -> DataFrame:
    """The first ``percent`` of all rows in an order, rounded down."""
    return df.orderBy(*order).limit(int(df.count() * percent / 100))
