"""Document fingerprints by Order MinHash.

The k-mers of a text (runs of K code points) are numbered by occurrence. Each of M hash orders selects the L
smallest numbered k-mers; these, in the order in which they stand in the text, are hashed to one entry of the
signature. Two texts agree in an entry if they share the selected k-mers and their order, which edits and moved
passages disturb. Fingerprints are signatures as hex text; their likeness is the share of equal entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_arrow, mix, powers, written

K, L, M = 8, 2, 64
#: Hex digits of an entry.
DIGITS = 4
#: Odd multipliers, one for each hash order, from a fixed seed.
ORDERS = np.random.Generator(np.random.PCG64(1729)).integers(1, 2**63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Numbers that one array of hash values holds at most, unless a single text has more k-mers.
ROOM = 1 << 19
#: What one document and the one after it give; and for the documents at both ends of a partition, their texts.
PAIR = "k long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def kmer_hashes(text: str, k: int = K) -> np.ndarray:
    """Hashes of all runs of k code points; of the whole text if it is shorter; none if it is empty."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if not len(x):
        return x
    base = powers(k + 1)
    n, out, have = len(x), None, 0
    power, run = x, 1  # run: code points that an entry of power covers
    k = min(k, n)
    while k:  # by the binary digits of k: hashes of runs are joined from hashes of shorter runs
        if k & 1:
            out = power if out is None else out[: n - have - run + 1] * base[run] + power[have : have + n - have - run + 1]
            have += run
        k >>= 1
        if k:
            power = power[: len(power) - run] * base[run] + power[run:]
            run *= 2
    return mix(out + np.uint64(have))


def numbered(h: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, occurrence): equal k-mers count from 0 in text order."""
    bits = np.uint64(max(1, (len(h) - 1).bit_length()))
    s = np.sort(h >> bits << bits | np.arange(len(h), dtype=np.uint64))
    again = np.flatnonzero((s[1:] >> bits) == (s[:-1] >> bits)) + 1
    if not len(again):
        return h
    places = (s & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    run = np.cumsum(np.append(True, np.diff(again) != 1))
    heads = np.searchsorted(run, run)
    number = np.arange(len(again)) - heads + 1
    out = h.copy()
    out[places[again]] = mix(h[places[again]] + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return out


def signature(text: str) -> np.ndarray:
    """M entries; zeros for an empty text."""
    h = kmer_hashes(text)
    if not len(h):
        return np.zeros(M, np.uint64)
    x = numbered(h)
    step = max(1, ROOM // len(x))
    picked = np.empty((M, min(L, len(x))), np.int64)
    for at in range(0, M, step):
        y = np.multiply.outer(ORDERS[at : at + step], x)
        rows = np.arange(len(y))
        for j in range(picked.shape[1]):
            low = y.argmin(axis=1)
            picked[at : at + step, j] = low
            y[rows, low] = np.uint64(2**64 - 1)
    picked.sort(axis=1)
    out = np.zeros(M, np.uint64)
    for j in range(picked.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[picked[:, j]])
    return out >> np.uint64(64 - 4 * DIGITS)


def as_text(sig: np.ndarray) -> str:
    return sig.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :].tobytes().hex()


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of a text column; null counts as empty, an existing column ``name`` is replaced.

    Equal texts have equal fingerprints; other columns are kept whatever their names; no shuffle.
    """
    kept = [c for c in docs.columns if c != name]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            new = [as_text(signature(x or "")) for x in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(new, pa.string())], names=[*kept, name])

    return map_arrow(docs, run, schema)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries of two fingerprints."""
    entry = lambda x, i: F.substring(x, i * DIGITS + 1, DIGITS)
    same = lambda acc, i: acc + F.when(entry(a, i) == entry(b, i), 1).otherwise(0)
    return F.aggregate(F.sequence(F.lit(0), F.lit(M - 1)), F.lit(0), same) / F.lit(float(M))


Doc = tuple[int | None, str, np.ndarray]


def pair(a: Doc, b: Doc) -> tuple:
    """The facts of PAIR of a document and the one after it."""
    (k, t, sig), (_, t2, sig2) = a, b
    half = len(t) // 2
    edited = t[: len(t) - half] + t2[:half]
    e = sig if edited == t else signature(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return k, len(t), sha, as_text(sig), as_text(e), float((sig == e).mean()), float((sig == sig2).mean())


def record_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the next document,
    in descending order of keys (null last, equal keys by the texts' MD5); the last is followed by the first. A single
    document follows itself. Null texts are empty, texts of any length are read whole. Repeated rows stand next to each
    other. An empty table gives an empty result; other columns, whatever their names, aren't read.

    Documents are sorted in as many ranges as the session has shuffle partitions, and equal keys may be in several.
    Texts move once: a task pairs the documents of its range, and writes the texts at both of its ends beside the
    results. The last document of each range then meets the first one of the next range.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.md5("t"))
    order = [F.col("k").desc_nulls_last(), F.col("h")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "t")
    kind = T.StructType.fromDDL(PAIR + ", part int, edge string, text string")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, nothing = TaskContext.get().partitionId(), None, (None,) * 7
        for b in it:
            out = []
            for k, t in zip(b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True):
                sig = held[2] if held and held[1] == t else signature(t)
                out.append((*pair(held, (k, t, sig)), part, None, None) if held else (k, *nothing[1:], part, "first", t))
                held = k, t, sig
            if out:
                yield record_batch(out, kind)
        if held:
            yield record_batch([(held[0], *nothing[1:], part, "last", held[1])], kind)

    got = written(d.mapInArrow(run, kind), "pairs")
    first, last = (got.where(F.col("edge") == e).select("k", "text", "part") for e in ("first", "last"))
    along, whole = Window.orderBy("part"), Window.partitionBy(F.lit(0))  # these windows have one row for each range
    after = first.select("part", F.coalesce(F.lead("part").over(along), F.min("part").over(whole)).alias("next"))
    ends = last.join(after, "part").join(first.select(F.col("part").alias("next"), F.col("text").alias("next_text")), "next").select("k", "text", "next_text")
    result = T.StructType.fromDDL(PAIR)

    def close(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                yield record_batch([pair((k, t, signature(t)), (None, t2, signature(t2))) for k, t, t2 in zip(*(c.to_pylist() for c in b.columns), strict=True)], result)

    return got.where("edge IS NULL").select(*result.names).union(ends.mapInArrow(close, result)).withColumnRenamed("k", key)
