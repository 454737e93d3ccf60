"""Conversions and functions whose results differ from Spark's own by default."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: strftime specifiers and Spark's date patterns
STRFTIME = {
    "%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%p": "a", "%I": "hh", "%%": "%",
}

#: fixed values: ranges of unsigned and 128-bit integers that Spark's types can't state
RANGES = {"utinyint": (0, 2**8 - 1), "usmallint": (0, 2**16 - 1), "uinteger": (0, 2**32 - 1), "ubigint": (0, 2**64 - 1)}


def to_integer(x: Column, kind: str = "bigint") -> Column:
    """Decimal or double to integer, ties away from zero; Spark's cast would cut off."""
    return F.round(x, 0).cast(kind)


def unsigned(x: Column, kind: str) -> Column:
    """A decimal that is checked against the range of an unsigned type; out of range raises."""
    low, high = RANGES[kind]
    d = x.cast("decimal(38,0)")
    return F.when(d.isNull() | d.between(F.lit(low).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)")), d).otherwise(F.raise_error(F.concat(F.lit(f"out of range for {kind}: "), d.cast("string"))))


def split(x: Column, separator: str) -> Column:
    """Split at a plain separator; Spark's own takes a regular expression."""
    return F.split(x, r"\Q" + separator.replace(r"\E", r"\E\\E\Q") + r"\E") if separator else F.split(x, "")


def item(x: Column, i: int) -> Column:
    """List item by an index from 1; null if out of range."""
    return F.try_element_at(x, F.lit(i))


def strftime(x: Column, pattern: str) -> Column:
    out = ""
    for piece in re.findall(r"%.|[^%]+", pattern, re.S):
        out += STRFTIME[piece] if piece[0] == "%" else "'" + piece.replace("'", "''") + "'"
    return F.date_format(x, out)


def interval(months: Column, days: Column, micros: Column) -> Column:
    """A mixed interval as a struct, which unlike Spark's own type can be stored and returned."""
    return F.struct(months.alias("months"), days.alias("days"), micros.alias("micros"))


def plus_interval(ts: Column, iv: Column) -> Column:
    return ts + F.make_interval(F.lit(0), iv["months"], F.lit(0), iv["days"], F.lit(0), F.lit(0), iv["micros"] / 1e6)


#: fixed values: SQL names of types whose Spark names differ
TYPE_NAMES = {"string": "VARCHAR", "int": "INTEGER", "float": "FLOAT", "binary": "BLOB", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def type_name(x: Column) -> Column:
    """The SQL name of a value's type; lists are written as their element's name and brackets."""
    t, n = F.typeof(x), F.regexp_count(F.typeof(x), F.lit("array<"))
    inner = F.regexp_replace(t, "array<|>+$", "")
    plain = F.upper(inner)
    for spark, name in TYPE_NAMES.items():
        plain = F.when(inner == spark, name).otherwise(plain)
    return F.concat(plain, F.repeat(F.lit("[]"), n))


def to_uuid(x: Column) -> Column:
    """A UUID as canonical text, from 32 hex digits with or without hyphens; other texts raise. Text order is UUID order."""
    digits = F.lower(F.replace(x, F.lit("-"), F.lit("")))
    ok = digits.rlike("^[0-9a-f]{32}$")
    text = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(x.isNull() | ok, text).otherwise(F.raise_error(F.concat(F.lit("no UUID: "), x)))


def enum_code(x: Column, labels: list[str]) -> Column:
    """A label's place from 0, which orders labels as they were declared; an unknown label raises."""
    at = F.array_position(F.array(*map(F.lit, labels)), x).cast("int") - 1
    return F.when(x.isNull() | (at >= 0), at).otherwise(F.raise_error(F.concat(F.lit("no such label: "), x)))
