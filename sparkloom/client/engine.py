"""Statements on a session, with the parameter and result rules of the client interface."""

from __future__ import annotations

import datetime as dt
import json
import re
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import Any, TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.work import discard, written

from .appender import Appender, Constraints

X = TypeVar("X")
#: Quoted text, in which a backslash escapes, comments, or one of the marks that matter between them.
PIECE = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|\$(\w+)|\?(\d+)|\?", re.S)
COMMENT = re.compile(r"(?:\s|--[^\n]*|/\*.*?\*/)*", re.S)
#: Statements that change a table, as far as they are told apart here: a name, and the rest for Spark's own parser.
INSERT = re.compile(r"INSERT\s+INTO\s+(?:TABLE\s+)?([\w.`]+)\s*(?:\(([^()]*)\)(?=\s*(?:SELECT|VALUES|FROM|WITH|TABLE)\b))?\s*(.*?)(?:\s+RETURNING\s+([^()']+))?$", re.S | re.I)
UPDATE = re.compile(r"UPDATE\s+([\w.`]+)\s+SET\s+(.*)$", re.S | re.I)
DELETE = re.compile(r"DELETE\s+FROM\s+([\w.`]+)(?:\s+WHERE\s+(.*))?$", re.S | re.I)


class NotOneChange(LookupError):
    """A statement that must change one row changed none or several."""


class NoRows(LookupError):
    """A query that must give a row gave none."""


class MoreThanOneRow(LookupError):
    """A query that must give one row gave more."""


class ParameterError(ValueError):
    """Parameters don't fit those of the statement."""


def split_statements(text: str) -> list[str]:
    """Statements of a script; semicolons in quotes and comments don't count."""
    out, at = [], 0
    for m in PIECE.finditer(text):
        if m[0] == ";":
            out.append(text[at : m.start()])
            at = m.end()
    return [s.strip() for s in [*out, text[at:]] if not COMMENT.fullmatch(s)]


def kind(statement: str) -> str:
    """The leading keyword of a statement, in capitals; comments before it don't count."""
    m = re.compile(r"\w+").match(statement, COMMENT.match(statement).end())
    return m[0].upper() if m else ""


def identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def split_commas(text: str) -> list[str]:
    """Parts between commas that stand in no bracket and no quotes."""
    out, depth, at = [], 0, 0
    for m in re.finditer(PIECE.pattern + r"|[(\[]|[)\]]|,", text, re.S):
        depth += (m[0] in "([") - (m[0] in ")]") if len(m[0]) == 1 else 0
        if m[0] == "," and depth == 0:
            out.append(text[at : m.start()])
            at = m.end()
    return [x.strip() for x in [*out, text[at:]]]


def split_where(text: str) -> tuple[str, str]:
    """What stands before and after the first WHERE in no bracket and no quotes; ``true`` where there is none."""
    depth = 0
    for m in re.finditer(PIECE.pattern + r"|[(]|[)]|\bWHERE\b|\b\w+\b", text, re.S | re.I):
        depth += (m[0] == "(") - (m[0] == ")")
        if depth == 0 and m[0].upper() == "WHERE":
            return text[: m.start()].strip(), text[m.end() :].strip()
    return text.strip(), "true"


def bind(text: str, params: Sequence[Any] | Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    """SQL with ``:name`` markers, and their values, from ``?``, ``?N``, ``$N`` and ``$name``. Counts and names must fit."""
    names: list[str] = []

    def mark(m: re.Match) -> str:
        if m[1] is None and not m[0].startswith("?"):
            return m[0]
        name = m[1] or m[2] or str(len(names) + 1)
        names.append(name)
        return f":p_{name}"

    sql = PIECE.sub(mark, text)
    if isinstance(params, Mapping):
        given = {k.lstrip("$:"): v for k, v in params.items()}
        if len(given) < len(params):
            raise ParameterError("a parameter is given twice")
        if any(n.isdigit() for n in names) and given:
            raise ParameterError("the statement has positional parameters; names were given")
    else:
        if any(not n.isdigit() for n in names) and len(params):
            raise ParameterError("the statement has named parameters; positions were given")
        given = {str(i + 1): v for i, v in enumerate(params)}
    if missing := set(names) - set(given):
        raise ParameterError(f"no value for {sorted(missing)}")
    if extra := set(given) - set(names):
        raise ParameterError(f"no such parameter: {sorted(extra)}")
    if bad := [k for k, v in given.items() if isinstance(v, (list, dict, set))]:
        raise ParameterError(f"lists and maps can't be bound: {bad}")
    return sql, {f"p_{k}": v for k, v in given.items()}


class Row:
    """A row by position or name; names match whatever their case, and the first of equal names wins."""

    def __init__(self, values: Sequence[Any], names: Sequence[str]) -> None:
        self.values, self.names = tuple(values), tuple(names)
        self.places = {n.lower(): i for i, n in reversed(list(enumerate(names)))}

    def __getitem__(self, k: int | str) -> Any:  # noqa: ANN401
        return self.values[k if isinstance(k, int) else self.places[k.lower()]]

    def __iter__(self) -> Iterator[Any]:
        return iter(self.values)

    def __len__(self) -> int:
        return len(self.values)

    def integer(self, k: int | str, bits: int = 64, signed: bool = True) -> int:
        """An integer with a range check; booleans count as 0 and 1, decimals round half away from zero."""
        v = self[k]
        if not isinstance(v, (int, bool)):
            v = int(v.quantize(0, "ROUND_HALF_UP")) if hasattr(v, "quantize") else int(v)
        low, high = (-(1 << bits - 1), (1 << bits - 1) - 1) if signed else (0, (1 << bits) - 1)
        if not low <= v <= high:
            raise OverflowError(f"{v} is out of range")
        return int(v)

    def get(self, k: int | str, kind: type[X]) -> X | None:
        """A value as a Python type; null is None. Text becomes numbers, dates, times, UUIDs and JSON values, bytes a UUID."""
        v = self[k]
        if v is None or kind is object:
            return v
        if kind is int:
            return self.integer(k)
        if kind is uuid.UUID:
            return v if isinstance(v, uuid.UUID) else uuid.UUID(bytes=bytes(v)) if isinstance(v, (bytes, bytearray)) else uuid.UUID(v)
        if kind in (dict, list) and isinstance(v, str):
            v = json.loads(v)
        if kind in (dt.datetime, dt.date, dt.time) and isinstance(v, str):
            v = kind.fromisoformat(v)
        if kind is dict and hasattr(v, "asDict"):
            v = v.asDict(recursive=True)
        if kind in (float, Decimal, str, bytes, bool) and not isinstance(v, kind):
            if kind is bool and not isinstance(v, int) or kind is str and isinstance(v, (bytes, bytearray)):
                raise TypeError(f"column {k} is no {kind.__name__}: {v!r}")
            v = kind(v)
        if not isinstance(v, kind) or kind is dt.date and isinstance(v, dt.datetime):
            raise TypeError(f"column {k} is no {kind.__name__}: {v!r}")
        return v

    def tuple(self, *kinds: type) -> tuple:
        """All values as Python types, one for each column."""
        if len(kinds) != len(self):
            raise ValueError(f"{len(self)} columns, {len(kinds)} types")
        return tuple(self.get(i, k) for i, k in enumerate(kinds))


@dataclass(frozen=True)
class Column:
    """What is known of a result's column before any row."""

    index: int
    name: str
    type: str
    nullable: bool


def columns(df: DataFrame) -> list[Column]:
    return [Column(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]


def column_index(df: DataFrame, name: str) -> int:
    """The first column of a name, whatever its case."""
    for c in columns(df):
        if c.name.lower() == name.lower():
            return c.index
    raise KeyError(name)


class Engine:
    """Statements, queries and changes on one session; ``clone`` shares the catalog but not temporary views."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.constraints: dict[str, Constraints] = {}
        self.order, self.null_order = "asc", "last"

    def clone(self) -> Engine:
        other = Engine(self.spark.newSession())
        other.constraints = self.constraints
        return other

    def sql(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> DataFrame:
        """The last of the statements as a DataFrame; those before it run at once."""
        *first, last = split_statements(text)
        for s in first:
            self.execute(s)
        sql, args = bind(last, params)
        return self.spark.sql(sql, args=args or None)

    def execute_batch(self, text: str) -> None:
        for s in split_statements(text):
            self.execute(s)

    def query(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> Iterator[Row]:
        """Rows as they come, a partition at a time; errors while fetching are raised, not taken for the end."""
        df = self.sql(text, params)
        names = df.columns
        return (Row(tuple(r), names) for r in df.toLocalIterator(prefetchPartitions=True))

    def query_map(self, text: str, params: Sequence[Any] | Mapping[str, Any], f: Callable[[Row], X]) -> Iterator[X]:
        return map(f, self.query(text, params))

    def query_row(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> Row:
        """The first row; further ones aren't computed."""
        df = self.sql(text, params)
        rows = df.take(1)
        if not rows:
            raise NoRows(text)
        return Row(tuple(rows[0]), df.columns)

    def query_one(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> Row:
        df = self.sql(text, params)
        rows = df.take(2)
        if len(rows) != 1:
            raise (MoreThanOneRow if rows else NoRows)(text)
        return Row(tuple(rows[0]), df.columns)

    def optional(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> Row | None:
        try:
            return self.query_row(text, params)
        except NoRows:
            return None

    def exists(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> bool:
        return not self.sql(text, params).isEmpty()

    def arrow(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> pa.Table:
        return self.sql(text, params).toArrow()

    def appender(self, table: str, columns: Sequence[str] | None = None, schema: str | None = None, catalog: str | None = None) -> Appender:
        name = ".".join(x for x in (catalog, schema, table) if x)
        return Appender(self.spark, name, columns, self.constraints.get(name))

    def execute(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> int:
        """Runs statements; the number of rows that the last one changed, 0 if it is no INSERT, UPDATE or DELETE."""
        *first, last = split_statements(text)
        for s in first:
            self.execute(s)
        last = last[COMMENT.match(last).end() :]
        sql, args = bind(last, params)
        if m := INSERT.match(sql):
            n = self._insert_sql(m, args)
            return n if isinstance(n, int) else 0
        if m := UPDATE.match(sql):
            sets, where = split_where(m[2])
            values = dict((x.strip() for x in a.split("=", 1)) for a in split_commas(sets))
            return self.update(m[1], values, where, args)
        if m := DELETE.match(sql):
            return self.delete(m[1], m[2] or "true", args)
        self.spark.sql(sql, args=args or None)
        return 0

    def execute_one(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> None:
        """Runs a statement that must change exactly one row; an error comes after the change."""
        if (n := self.execute(text, params)) != 1:
            raise NotOneChange(f"{n} rows changed")

    def returning(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> DataFrame:
        """Rows of an INSERT ... RETURNING."""
        sql, args = bind(text.strip(), params)
        m = INSERT.match(sql)
        if not m or not m[4]:
            raise ValueError("not an INSERT ... RETURNING")
        return self._insert_sql(m, args)

    def _insert_sql(self, m: re.Match, args: dict[str, Any]) -> int | DataFrame:
        table, body = m[1], m[3].strip()
        all_names = self.spark.table(table).columns
        given = [c.strip().strip("`") for c in m[2].split(",")] if m[2] else None
        if re.fullmatch(r"DEFAULT\s+VALUES", body, re.I):
            rows, given = self.spark.range(1).select(), []
        else:
            rows = self.spark.sql(body, args=args or None)
            given = given or all_names[: len(rows.columns)]
            rows = rows.toDF(*given)
        full = Appender(self.spark, table, given or None, self.constraints.get(table)).completed(rows)
        names = None if not m[4] else all_names if m[4].strip() == "*" else [c.strip() for c in m[4].split(",")]
        return self.insert(table, full, names)

    def insert(self, table: str, rows: DataFrame, returning: Sequence[str] | None = None) -> int | DataFrame:
        """Appends rows after checking constraints: their number, or with ``returning`` the rows themselves.

        The rows are written once beside the table: check, count, insert and what is returned all read those.
        """
        staged = written(rows.select(self.spark.table(table).columns), "insert")
        if table in self.constraints:
            self.constraints[table].check(self.spark, table, staged)
        staged.write.insertInto(table)
        if returning:
            return staged.select(*returning)
        n = staged.count()
        discard(staged)
        return n

    def query_appender(self, table: str, statement: str, rows: DataFrame, name: str = "appended") -> int:
        """Stages rows as a view that a statement then reads, such as INSERT INTO t SELECT ... FROM appended."""
        staged = written(rows, "append")
        staged.createOrReplaceTempView(name)
        try:
            return self.execute(statement)
        finally:
            self.spark.catalog.dropTempView(name)
            discard(staged)

    def update(self, table: str, values: Mapping[str, str], where: str = "true", args: dict[str, Any] | None = None) -> int:
        """Sets columns to SQL expressions where a condition holds; the number of such rows. Rewrites the table."""
        t = self.spark.table(table)
        if unknown := set(values) - set(t.columns):
            raise ValueError(f"{table} has no column {sorted(unknown)}")
        sets = [f"CAST(CASE WHEN _hit THEN {values[c]} ELSE {identifier(c)} END AS {t.schema[c].dataType.simpleString()}) AS {identifier(c)}" if c in values else identifier(c) for c in t.columns]
        return self._rewrite(table, f"SELECT {', '.join(sets)}, _hit FROM (SELECT *, coalesce(({where}), false) AS _hit FROM {table})", args)

    def delete(self, table: str, where: str = "true", args: dict[str, Any] | None = None) -> int:
        return self._rewrite(table, f"SELECT *, coalesce(({where}), false) AS _hit FROM {table}", args, drop=True)

    def merge(self, table: str, source: DataFrame, on: Sequence[str], matched: Mapping[str, str] | None = None, insert: Mapping[str, str] | None = None, delete: str = "false") -> int:
        """Merges rows into a table by equal columns ``on``: the number of rows changed, deleted or inserted.

        ``matched`` sets columns of rows that have a partner, ``delete`` drops those of them for which it holds, ``insert``
        makes rows of those without. Expressions see the table as ``t`` and the source as ``s``. A row of the table with
        several partners is refused. Rewrites the table.
        """
        t = self.spark.table(table)
        source = written(source, "merge")
        if not source.groupBy(*on).count().where("count > 1").join(t, list(on), "left_semi").isEmpty():
            discard(source)
            raise ValueError(f"several rows of the source match one of {table}")
        both = t.withColumn("_t", F.lit(True)).alias("t").join(source.withColumn("_s", F.lit(True)).alias("s"), F.expr(" AND ".join(f"t.{identifier(c)} = s.{identifier(c)}" for c in on)), "full" if insert else "left")
        old, new = F.col("_t").isNotNull(), F.col("_t").isNull()
        hit = old & F.col("_s").isNotNull()

        def value(c: str):  # noqa: ANN202
            was = F.col(f"t.{c}")
            out = F.when(hit, F.expr(matched[c])).otherwise(was) if matched and c in matched else was
            return F.when(new, F.expr(insert.get(c, "null"))).otherwise(out) if insert else out

        gone = hit & F.coalesce(F.expr(delete), F.lit(False))
        out = both.select(*[value(c).cast(t.schema[c].dataType).alias(c) for c in t.columns], (new | gone | (hit & F.lit(bool(matched)))).alias("_hit"), gone.alias("_gone"))
        n = self._replace(table, out, "_gone")
        discard(source)
        return n

    def _rewrite(self, table: str, sql: str, args: dict[str, Any] | None, drop: bool = False) -> int:
        return self._replace(table, self.spark.sql(sql, args=args or None), "_hit" if drop else None)

    def _replace(self, table: str, rows: DataFrame, without: str | None) -> int:
        """Writes the new rows once, with ``_hit``, counts and checks them there, then overwrites the table with them.

        Readers may see the table between its old and its new files; if the overwrite fails, the new rows are still in
        their work table. Another writer's rows in between are lost: tables have no transactions.
        """
        staged = written(rows, "rewrite")
        names = self.spark.table(table).columns
        n = staged.where("_hit").count()
        kept = staged.where(~F.col(without)) if without else staged
        if table in self.constraints:
            self.constraints[table].check(self.spark, table, kept.where("_hit").select(names), among=kept.select(names))
        if n:
            kept.select(names).write.insertInto(table, overwrite=True)
        discard(staged)
        return n

    def tables(self, schema: str | None = None) -> DataFrame:
        """(schema, name, temporary) of tables and views."""
        t = self.spark.sql(f"SHOW TABLES{' IN ' + schema if schema else ''}")
        return t.select(F.col("namespace").alias("schema"), F.col("tableName").alias("name"), F.col("isTemporary").alias("temporary"))

    def table_columns(self, table: str) -> list[Column]:
        return columns(self.spark.table(table))

    def version(self) -> str:
        return self.spark.version

    def setting(self, name: str) -> str | None:
        return self.spark.conf.get(name, None)

    def set_setting(self, name: str, value: object, check: bool = False) -> str | None:
        """Sets a runtime setting, and gives its value then; with ``check`` another value than the one asked for is an error."""
        self.spark.conf.set(name, str(value).lower() if isinstance(value, bool) else str(value))
        now = self.setting(name)
        if check and now != (str(value).lower() if isinstance(value, bool) else str(value)):
            raise ValueError(f"{name} is {now}")
        return now

    def explain(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()) -> str:
        """The formatted physical plan of a query."""
        sql, args = bind(text, params)
        return self.spark.sql(f"EXPLAIN FORMATTED {sql}", args=args or None).first()[0]

    def progress(self, group: str) -> tuple[int, int]:
        """Tasks done and known of a job group's jobs (see ``SparkContext.setJobGroup``)."""
        tracker, done, known = self.spark.sparkContext.statusTracker(), 0, 0
        for job in tracker.getJobIdsForGroup(group):
            for stage in (info.stageIds if (info := tracker.getJobInfo(job)) else ()):
                if s := tracker.getStageInfo(stage):
                    done, known = done + s.numCompletedTasks, known + s.numTasks
        return done, known

    def polars(self, text: str, params: Sequence[Any] | Mapping[str, Any] = ()):  # noqa: ANN201
        """The result as a Polars frame, where that package is installed."""
        import polars

        return polars.from_arrow(self.arrow(text, params))

    def sort(self, df: DataFrame, *names: str) -> DataFrame:
        """Sorted by the session's default order and place of nulls."""
        name = f"{self.order}_nulls_{self.null_order}"
        return df.orderBy(*[getattr(F.col(n), name)() for n in names])

    def interruptible(self, tag: str) -> Callable[[], None]:
        """Tags this thread's jobs; the result, called from any thread, cancels them."""
        self.spark.addTag(tag)
        return lambda: self.spark.interruptTag(tag)


class Pool:
    """An engine for each thread, all on one catalog, each with views and settings of its own."""

    def __init__(self, spark: SparkSession, prepare: Callable[[Engine], None] = lambda e: None) -> None:
        self.first, self.prepare, self.local = Engine(spark), prepare, threading.local()

    def get(self) -> Engine:
        if not hasattr(self.local, "engine"):
            self.local.engine = self.first.clone()
            self.prepare(self.local.engine)
        return self.local.engine
