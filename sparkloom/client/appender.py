"""Bulk appends with constraints that are checked when rows are flushed."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ConstraintError(ValueError):
    """Rows that break a constraint of their table."""


@dataclass
class Constraints:
    """What Spark's tables don't enforce. Checks are joins and aggregates, not row loops; writers aren't isolated."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    checks: Sequence[str] = ()
    foreign: Sequence[tuple[Sequence[str], str, Sequence[str]]] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    generated: dict[str, str] = field(default_factory=dict)

    def check(self, spark: SparkSession, table: str, rows: DataFrame, among: DataFrame | None = None) -> None:
        """Checks new rows of a table; with ``among``, rows that are to be part of these, which replace the table's."""
        for c in self.not_null:
            if not rows.where(F.col(c).isNull()).isEmpty():
                raise ConstraintError(f"{table}.{c} is null")
        for c in self.checks:
            if not rows.where(~F.expr(c)).isEmpty():
                raise ConstraintError(f"{table}: {c}")
        for key in self.unique:
            known = [F.col(c).isNotNull() for c in key]
            new = (rows if among is None else among).select(*key)
            for k in known:
                new = new.where(k)
            twice = not new.groupBy(*key).count().where("count > 1").isEmpty()
            if twice or among is None and not new.join(spark.table(table).select(*key), list(key), "left_semi").isEmpty():
                raise ConstraintError(f"{table}: {', '.join(key)} repeats")
        for key, parent, of in self.foreign:
            new = rows.select(*[F.col(c).alias(o) for c, o in zip(key, of, strict=True)]).na.drop()
            if not new.join(spark.table(parent), list(of), "left_anti").isEmpty():
                raise ConstraintError(f"{table}: {', '.join(key)} isn't in {parent}")


class Appender:
    """Buffers rows for a table and appends them in one write for each flush.

    Columns that aren't given take their default, or null. Errors of constraints come with the flush, and leave
    the buffer as it was; as a context manager it flushes at the end, unless the block failed.
    """

    def __init__(self, spark: SparkSession, table: str, columns: Sequence[str] | None = None, constraints: Constraints | None = None, buffer: int = 100_000) -> None:
        self.spark, self.table, self.buffer = spark, table, buffer
        self.constraints = constraints or Constraints()
        self.all: StructType = spark.table(table).schema
        self.columns, self.chosen = self._known(columns), bool(columns)
        self.rows: list[tuple] = []

    def append_row(self, *values: Any) -> None:  # noqa: ANN401
        if len(values) != len(self.columns):
            raise ValueError(f"{len(values)} values for {len(self.columns)} columns")
        self.rows.append(values)
        if len(self.rows) >= self.buffer:
            self.flush()

    def append_rows(self, rows: Iterable[Sequence[Any]]) -> None:
        for r in rows:
            self.append_row(*r)

    def append_record_batch(self, batch: pa.RecordBatch) -> None:
        self.flush()
        self._append(self.spark.createDataFrame(pa.Table.from_batches([batch])))

    def set_columns(self, columns: Sequence[str] | None) -> None:
        """Other columns from now on, all but generated ones for None; rows so far are flushed first."""
        self.flush()
        self.columns = self._known(columns)

    def add_column(self, column: str) -> None:
        """One more column from now on; the first one after ``clear_columns`` is the only one."""
        self.set_columns([*(self.columns if self.chosen else []), column])
        self.chosen = True

    def clear_columns(self) -> None:
        self.set_columns(None)
        self.chosen = False

    def _known(self, columns: Sequence[str] | None) -> list[str]:
        if unknown := set(columns or ()) - set(self.all.names):
            raise ValueError(f"{self.table} has no column {sorted(unknown)}")
        return list(columns) if columns else [f.name for f in self.all if f.name not in self.constraints.generated]

    def flush(self) -> None:
        if self.rows:
            schema = StructType([self.all[c] for c in self.columns])
            self._append(self.spark.createDataFrame(self.rows, schema, verifySchema=True))
            self.rows.clear()

    def completed(self, df: DataFrame) -> DataFrame:
        """Rows of some columns with the defaults of the others, or null, and the generated columns, in the table's order."""
        c = self.constraints
        given = set(df.columns)
        full = df.select("*", *[F.expr(c.defaults[f.name] if f.name in c.defaults else "null").alias(f.name) for f in self.all if f.name not in given and f.name not in c.generated])
        full = full.withColumns({k: F.expr(v) for k, v in c.generated.items()})
        return full.select(*[F.col(f.name).cast(f.dataType) for f in self.all])

    def _append(self, df: DataFrame) -> None:
        full = self.completed(df)
        self.constraints.check(self.spark, self.table, full)
        full.write.insertInto(self.table)  # in the order of the table's columns

    def __enter__(self) -> Appender:
        return self

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            self.flush()
