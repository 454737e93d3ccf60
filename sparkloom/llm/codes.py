"""Token files with directly addressable codes.

Ids are split into chunks of a few bits. The first level holds the low chunk of every id; a bitmap tells which
ids continue; the next level holds the next chunk of those, and so on. The place of an id's next chunk is the
number of set bits before it, which a directory of counts for each 512 bits gives at once, so that any token is
read without decoding those before it. Blocks of ids in this form are the rows of an uncompressed table, written
in document order; each block lists its documents and the tokens before it in its shard.
"""

from __future__ import annotations

import itertools
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import check_cuts, Encoder, read_vocabulary
from .common import batches, small, text_bytes, written

#: Bits of each level; together 32, so that any unsigned 32-bit id can be written.
WIDTHS = (10, 6, 16)
#: Flags that one entry of the directory covers.
SPAN = 512
#: Tokens in a span, by which places find their blocks.
SPAN_TOKENS = 1 << 18
MAGIC = b"DAC1"
BLOCK = "shard int, first long, doc_ids array<long>, counts array<long>, payload binary"


def pack(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=None, bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    out = np.zeros(n, np.uint32)
    for k in range(width):
        out |= bits[:, k].astype(np.uint32) << np.uint32(k)
    return out


def encode_block(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """Header (levels, then width and count of each), then for each level its chunks, flags and directory."""
    left, head, body = ids.astype(np.uint32), [MAGIC, struct.pack("<B", len(widths))], []
    for level, width in enumerate(widths):
        last = level == len(widths) - 1
        head.append(struct.pack("<BI", width, len(left)))
        body.append(pack(left & np.uint32((1 << width) - 1), width))
        rest = left >> np.uint32(width)
        if last:
            if rest.any():
                raise ValueError("an id has more bits than all levels together")
            break
        flags = rest > 0
        ones = np.append(0, np.cumsum(flags))[: len(flags) + 1 : SPAN].astype("<u4")
        body += [np.packbits(flags, bitorder="little").tobytes(), ones.tobytes()]
        left = rest[flags]
    return b"".join(head + body)


class Block:
    """Reads a block: whole, or any single token by its place."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.data, self.levels, at = data, [], 5 + 5 * data[4]
        for k in range(data[4]):
            width, n = struct.unpack_from("<BI", data, 5 + 5 * k)
            chunks = at
            flags = chunks + (n * width + 7) // 8
            ones = flags + (n + 7) // 8
            self.levels.append((width, n, chunks, flags, ones))
            at = ones + 4 * (n // SPAN + 1)
        self.n = self.levels[0][1]

    def __getitem__(self, i: int) -> int:
        """Token ``i``: a few bytes of each level that it reaches, and at most 64 bytes of flags."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        out, shift, d = 0, 0, self.data
        for k, (width, _, chunks, flags, ones) in enumerate(self.levels):
            bit = i * width
            word = int.from_bytes(d[chunks + bit // 8 : chunks + (bit + width + 7) // 8], "little")
            out |= (word >> bit % 8 & (1 << width) - 1) << shift
            shift += width
            if k == len(self.levels) - 1 or not d[flags + i // 8] >> i % 8 & 1:
                return out
            span = i // SPAN
            before = int.from_bytes(d[flags + span * SPAN // 8 : flags + (i + 7) // 8], "little") & ((1 << i - span * SPAN) - 1)
            i = struct.unpack_from("<I", d, ones + 4 * span)[0] + before.bit_count()
        return out

    def all(self) -> np.ndarray:
        """All ids, level by level from the last."""
        out = None
        for width, n, chunks, flags, ones in reversed(self.levels):
            low = unpack(self.data[chunks:flags], n, width)
            if out is not None:
                on = np.unpackbits(np.frombuffer(self.data[flags:ones], np.uint8), count=n, bitorder="little").astype(bool)
                low[on] |= out << np.uint32(width)
            out = low
        return out


_ENCODERS: dict[str, Encoder] = {}


def library_encoder(text: str) -> Encoder:
    """Encodes chunks with the tokenizers library; ``check_cuts`` sees to it that they may be encoded apart."""
    if text not in _ENCODERS:
        check_cuts(json.loads(text))
        tokenizer = Tokenizer.from_str(text)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def chunk_ids(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            ids = [tokenizer.encode(c.decode(), add_special_tokens=False).ids for c in new]
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lens.sum())), lens

        _ENCODERS.clear()
        _ENCODERS[text] = Encoder(chunk_ids)
    return _ENCODERS[text]


def write(docs: DataFrame, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encodes all texts, each with ``end_id`` after it, and writes blocks in ascending key order; returns the table.

    A shard is a range of keys (nulls first), and lists its blocks by ``first``, the tokens before them in the shard.
    Null and empty texts are the end id alone. Rows with equal keys are all written, ordered by the MD5 of their texts,
    and may be in several shards. An empty table makes an empty one. A block holds whole documents of about 2 MB of
    text, so a very long text is a block. Other columns, whatever their names, aren't read.
    """
    shared = read_vocabulary(docs, path)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shard = 0, TaskContext.get().partitionId()
        for batch in batches(it, "t"):
            flat, bounds = library_encoder(shared.value)(*text_bytes(batch.column("t")))
            counts = np.diff(bounds) + 1
            ids = np.full(int(counts.sum()), end_id, np.uint32)
            body = np.ones(len(ids), bool)
            body[np.cumsum(counts) - 1] = False
            ids[body] = flat
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([batch.column("k").to_pylist()], pa.list_(pa.int64())),
                 pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([encode_block(ids)], pa.binary())],
                names=["shard", "first", "doc_ids", "counts", "payload"],
            )
            first += len(ids)

    ordered = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).withColumn("h", F.md5(F.coalesce("t", F.lit(""))))
    ordered = ordered.repartitionByRange("k", "h").sortWithinPartitions("k", "h").select("k", "t")
    return written(ordered.mapInArrow(run, BLOCK), "tokens", "uncompressed")


def starts(blocks: DataFrame) -> DataFrame:
    """(shard, shard_start): tokens of all shards before; one row for each partition that was written."""
    sums = blocks.select("shard", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def tokens_at(blocks: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, token) for each row of ``positions``: single tokens by their place in the whole corpus, without decoding blocks.

    A place finds its block by an equi-join on spans of SPAN_TOKENS tokens, of which a block touches a few; within it
    only the bytes that hold the token and its directory entries are looked at. Negative and null places, and those
    behind the last token, have no row. Repeated places each give one. Other columns aren't read.
    """
    n = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    at = starts(blocks)
    placed = blocks.join(small(at, at.count()), "shard").select((F.col("shard_start") + F.col("first")).alias("start"), n.alias("n"), "payload")
    spans = F.sequence(F.floor(F.col("start") / SPAN_TOKENS), F.floor((F.col("start") + F.col("n") - 1) / SPAN_TOKENS))
    want = positions.select(F.col(position).cast("long").alias("i")).withColumn("span", F.floor(F.col("i") / SPAN_TOKENS))
    # Places first go to the start of their block, so that each block's payload moves once, to all of its places.
    heads = placed.select("start", "n", F.explode(spans).alias("s"))
    want = want.join(heads, (F.col("span") == F.col("s")) & (F.col("i") >= F.col("start")) & (F.col("i") < F.col("start") + F.col("n"))).select("i", F.col("start").alias("of"))
    hits = want.join(placed.select("start", "payload"), F.col("of") == F.col("start")).select((F.col("i") - F.col("start")).alias("place"), "i", "payload")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [Block(p)[i] for i, p in zip(b.column("place").to_pylist(), b.column("payload").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(found, pa.int64())], names=["position", "token"])

    return hits.mapInArrow(run, "position long, token long").withColumnRenamed("position", position)


def read(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its block's codes."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    at = starts(blocks)
    placed = blocks.join(small(at, at.count()), "shard").select((F.col("shard_start") + F.col("first")).alias("start"), "doc_ids", "counts", "payload")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for i in range(batch.num_rows):
                ids = Block(batch.column("payload")[i].as_py()).all().astype("<u4")
                counts = np.array(batch.column("counts")[i].as_py(), np.int64)
                offs = np.append(0, np.cumsum(counts))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offs[:-1], offs[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("doc_ids")[i].as_py(), pa.int64()), pa.array(batch.column("start")[i].as_py() + offs[:-1]), pa.array(counts), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(run, schema)
