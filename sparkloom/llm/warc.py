"""Content-addressed WARC archive.

Payload bytes are stored once by their SHA-256, compressed, with their length; the exact header bytes of every
record stand in a table of their own, which names the payload by digest. Records are put together again by a
join, and a payload counts only if its digest and length verify.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, written

#: Payload bytes from which an equal payload is a revisit.
REVISIT_BYTES = 1000
#: Copies of each small payload in the join, as any number of records may share one.
SALTS = 16
CRLF = "\r\n"
#: Header field of a URL with line breaks.
EXACT = "X-Exact-Target-Base64"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOAD = "digest string, payload_digest string, payload_bytes long, packed binary"


def describe(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, digest, payload_digest, payload_bytes, packed): each row's payload with both digests."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "html"):
            body = [(x or "").encode() for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array([hashlib.sha256(x).hexdigest() for x in body], pa.string()),
                 pa.array([hashlib.sha1(x).hexdigest() for x in body], pa.string()), pa.array([len(x) for x in body], pa.int64()),
                 pa.array([zlib.compress(x, 6) for x in body], pa.binary())],
                names=["page_id", "url", "digest", "payload_digest", "payload_bytes", "packed"],
            )

    d = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return d.mapInArrow(run, f"page_id long, url string, {PAYLOAD}")


def header(date: str):  # noqa: ANN201
    """Exact WARC header bytes as a column; lengths are those of the record's block."""
    block = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit(CRLF))
    revisit = F.when(
        F.col("record_type") == "revisit", F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(F.col("refers_to"))))
    ).otherwise("")
    # A line break in a URL would end its header line: such a URL stands in a field of its own too, as Base64
    url = F.coalesce(F.col("url"), F.lit(""))
    target = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    exact = F.when(target != url, line(EXACT, F.replace(F.base64(F.encode(url, "utf-8")), F.lit(CRLF), F.lit("")))).otherwise("")
    return F.encode(
        F.concat(
            F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Date", F.lit(date)),
            line("WARC-Target-URI", target), exact, line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), revisit,
            line("WARC-Payload-Length", F.col("payload_bytes").cast("string")), line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", block.cast("string")), F.lit(CRLF),
        ),
        "utf-8",
    )


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z") -> tuple[DataFrame, DataFrame]:
    """Writes both tables of the archive to the shared folder; returns (headers, payloads) as read back.

    Of records with equal payloads of at least REVISIT_BYTES the one with the largest key is the response and the
    others are revisits; smaller payloads are responses each. Null html is an empty payload, a null url an empty
    target. A null key is smaller than all others. Rows that repeat a key with an equal payload are written as often
    as they come: the largest key's rows are responses. An empty table makes empty tables.
    """
    d = describe(pages, key, url, html)
    # One row for each distinct payload: copies meet in each task before any is moved.
    payloads = d.groupBy("digest").agg(F.first("payload_digest").alias("payload_digest"), F.first("payload_bytes").alias("payload_bytes"), F.max("page_id").alias("owner"), F.first("packed").alias("packed"))
    payloads = written(payloads, "payloads", "uncompressed")
    base = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.sha2(F.coalesce(F.col(html), F.lit("")), 256).alias("digest"))
    owners = payloads.select("digest", "payload_digest", "payload_bytes", "owner")
    h = base.join(owners, "digest")
    first = (F.col("payload_bytes") < REVISIT_BYTES) | F.col("page_id").eqNullSafe(F.col("owner"))
    h = h.withColumn("record_type", F.when(first, "response").otherwise("revisit")).withColumn("refers_to", F.when(~first, F.col("owner")))
    headers = h.select("digest", (F.col("payload_bytes") < REVISIT_BYTES).alias("small"), "record_type", "page_id", header(date).alias("header"))
    return written(headers, "headers"), payloads.drop("owner")


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_id, record): the exact bytes of every record, one for each row of ``headers``, in no order.

    A payload that fails its digest or length raises. Null
    ids, repeated records and empty payloads are records like others; an empty archive gives an empty result.
    """
    salt = F.when(F.col("small"), F.pmod(F.xxhash64("page_id"), F.lit(SALTS))).otherwise(0)
    need = headers.where("record_type = 'response'").withColumn("salt", salt.cast("int"))
    every = F.when(F.col("payload_bytes") < REVISIT_BYTES, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    p = payloads.select(F.col("digest").alias("p_digest"), "payload_bytes", "packed", F.explode(every).alias("p_salt"))
    full = need.join(p, (F.col("digest") == F.col("p_digest")) & (F.col("salt") == F.col("p_salt"))).select("page_id", "header", "digest", "payload_bytes", "packed")
    bare = headers.where("record_type = 'revisit'").select("page_id", "header", F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("payload_bytes"), F.lit(None).cast("binary").alias("packed"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for h, digest, n, packed in zip(*(b.column(c).to_pylist() for c in ("header", "digest", "payload_bytes", "packed")), strict=True):
                body = zlib.decompress(packed) if packed is not None else b""
                if packed is not None and (len(body) != n or hashlib.sha256(body).hexdigest() != digest):
                    raise ValueError(f"payload {digest} is damaged")
                out.append(h + body + b"\r\n\r\n")
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(out, pa.binary())], names=["page_id", "record"])

    return full.unionByName(bare).mapInArrow(run, "page_id long, record binary")


FIELD = re.compile(rb"([A-Za-z0-9-]+): (.*)\r\n")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.decode(): v.decode() for k, v in FIELD.findall(head + b"\r\n")}
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't fit its block")
    return fields, rest[:n]


def read(recs: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest) parsed from records.

    A response's length and digest are those of its block; a revisit's are those that its header states. URLs come back as
    they were, line breaks included; a null one as an empty string. One row for each record; a record whose length
    doesn't fit raises; an empty table gives an empty result.
    """
    fields = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"

    def number(x: str | None) -> int | None:
        x = x[len("<urn:page:") : -1] if x else "null"
        return None if x == "null" else int(x)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for r in b.column("record").to_pylist():
                f, body = parse_record(r)
                whole = f["WARC-Type"] == "response"
                rows.append((
                    number(f["WARC-Record-ID"]), base64.b64decode(f[EXACT]).decode() if EXACT in f else f["WARC-Target-URI"], f["WARC-Type"], number(f.get("WARC-Refers-To")),
                    len(body) if whole else int(f["WARC-Payload-Length"]), hashlib.sha1(body).hexdigest() if whole else f["WARC-Payload-Digest"].removeprefix("sha1:"),
                ))
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            cols = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"])

    return recs.mapInArrow(run, fields)
