"""User-defined functions: scalar with overloads and state, Arrow, aggregate, and table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import DataType


def scalar(spark: SparkSession, name: str, f: Callable[..., pd.Series], returns: str | DataType, volatile: bool = False) -> Callable[..., Column]:
    """A vectorised scalar function for SQL and for DataFrames; any number of arguments. A failure fails the query only."""
    u = F.pandas_udf(f, returns)
    u = u.asNondeterministic() if volatile else u
    spark.udf.register(name, u)
    return u


def arrow_scalar(spark: SparkSession, name: str, f: Callable[..., pa.Array], returns: str | DataType) -> Callable[..., Column]:
    u = F.arrow_udf(f, returns)
    spark.udf.register(name, u)
    return u


def constant(f: Callable[[], Any]) -> Column:
    """A function of no arguments that isn't volatile: evaluated once, as a literal."""
    return F.lit(f())


def overloads(by_type: Mapping[str, Callable[..., Column]]) -> Callable[..., Column]:
    """Dispatch on the type of the first argument, given by a schema lookup: call(df, "column")."""

    def call(df, first: str, *rest: str) -> Column:  # noqa: ANN001
        kind = df.schema[first].dataType.simpleString()
        if kind not in by_type:
            raise TypeError(f"no overload for {kind}")
        return by_type[kind](first, *rest)

    return call


def aggregate(f: Callable[[pd.Series], Any], returns: str | DataType) -> Callable[..., Column]:
    """A user aggregate over whole groups, for groups that fit a task; otherwise compose built-in aggregates."""
    f.__annotations__ = {"x": pd.Series, "return": float}
    return F.pandas_udf(f, returns, F.PandasUDFType.GROUPED_AGG)


@udtf(returnType="chunk int, first bigint, size bigint")
class Chunks:
    """chunks(n, size): the places 0..n-1 in chunks of ``size``, the last one shorter; for n of each row with LATERAL.

    Arguments may be named (``n => 10, size => 4``). Null arguments give no rows; a size below 1 raises.
    """

    def eval(self, n: int, size: int) -> Iterator[tuple]:
        if n is None or size is None:
            return
        for i, first in enumerate(range(0, n, size)):
            yield i, first, min(size, n - first)


def register(spark: SparkSession) -> None:
    """The package's own functions, as an extension's entry point would."""
    spark.udtf.register("chunks", Chunks)
    scalar(spark, "digit_sum", digit_sum, "bigint")


def digit_sum(x: pd.Series) -> pd.Series:
    """Sum of the decimal digits of whole numbers."""
    left, out = x.abs(), x * 0
    while (left > 0).any():
        out, left = out + left % 10, left // 10
    return out
