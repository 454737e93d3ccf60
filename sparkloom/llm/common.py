"""What the operators of this subpackage share: table reading, the shared work folder, word hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.session import table
from sparkloom.work import discard, discard_all, work_schema, written

__all__ = ["batches", "discard", "discard_all", "map_arrow", "mix", "powers", "salted_join", "small", "table", "text_bytes", "word_hashes", "word_offsets", "work_schema", "written"]

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes up to which a side may be broadcast, as a hash relation in every executor.
BROADCAST_BYTES = 64 << 20
#: Keys that may be called hot at most, and rows that a key has at least to be called so.
HOT_KEYS, HOT_ROWS = 1000, 256


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` for columns of any names: Spark's own takes a dot in a name for a field of a struct."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(lambda it: run(b.rename_columns(names) for b in it), schema)


def small(df: DataFrame, rows: int, width: int = 32) -> DataFrame:
    """Broadcasts a side of checked size, ``width`` bytes a row; a larger one is left to a shuffle join."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def salted_join(left: DataFrame, right: DataFrame, key: str, other: str, counts: DataFrame, spread: str, how: str = "inner") -> DataFrame:
    """Joins ``left.key = right.other``, with the rows of hot keys of ``left`` spread over several tasks.

    ``counts`` (key, m) tells how many rows of ``left`` a key has. Keys with more than one in HOT_KEYS of all rows get
    as many salts as they hold such portions: rows of ``left`` are dealt by a hash of column ``spread``, those of ``right``,
    few for each key, are copied to each salt. The list of hot keys has HOT_KEYS rows at most, and is broadcast.
    """
    total, most = counts.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    least = max(HOT_ROWS, total // HOT_KEYS)
    if most <= least:
        return left.join(right, left[key] == right[other], how)
    hot = F.broadcast(counts.where(F.col("m") > least).select(F.col(key).alias("_hot"), F.ceil(F.col("m") / least).cast("int").alias("_salts")))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    a = left.join(hot, left[key] == hot["_hot"], "left").select(left["*"], F.pmod(F.xxhash64(F.lit(1), left[spread]), salts).cast("int").alias("_salt_a"))
    b = right.join(hot, right[other] == hot["_hot"], "left").select(right["*"], F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt_b"))
    return a.join(b, (a[key] == b[other]) & (a["_salt_a"] == b["_salt_b"]), how).drop("_salt_a", "_salt_b")


#: Lower case for A-Z only, and the six white-space bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=np.uint64)
#: A random 64-bit number for each byte, from a fixed seed.
BYTE_CODE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0..n-1, modulo 2^64."""
    global _POWERS
    if len(_POWERS) < n:
        out = np.full(max(n, 2 * len(_POWERS)), BASE)
        out[0] = 1
        _POWERS = np.multiply.accumulate(out)
    return _POWERS[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings of an Arrow column in one array, and n + 1 offsets; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64, len(col) + 1, col.offset * 8)
    raw = np.frombuffer(data, np.uint8, offs[-1]) if data is not None and offs[-1] else np.zeros(0, np.uint8)
    return raw[offs[0] :], offs - offs[0]


#: Separators for plain words: every ASCII byte but letters and digits.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_starts(raw: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are in words, and where words start. Each text starts anew, whatever the text before ends in."""
    inside = ~space[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offs[:-1][offs[:-1] < len(raw)]
    first[cuts] = inside[cuts]
    return inside, np.flatnonzero(first)


def word_offsets(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The n + 1 word offsets of n texts."""
    return np.searchsorted(word_starts(raw, offs)[1], offs)


def word_hashes(raw: np.ndarray, offs: np.ndarray, lower: bool = True, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many texts, and the n + 1 word offsets of the texts.

    Each word's hash sums byte codes times powers of an odd base, then scrambles the sum.
    """
    inside, starts = word_starts(raw, offs, space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    pos = np.flatnonzero(inside)
    at = np.searchsorted(pos, starts)
    lens = np.diff(np.append(at, len(pos)))
    within = np.arange(len(pos)) - np.repeat(at, lens)
    b = raw[pos]
    codes = BYTE_CODE[LOWER[b] if lower else b] * powers(int(lens.max()))[within]
    return mix(np.add.reduceat(codes, at)), np.searchsorted(starts, offs)


def batches(it: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of record batches with about ``limit`` bytes of text each, one row at least."""
    for batch in it:
        if not batch.num_rows:
            continue
        _, offs = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end
