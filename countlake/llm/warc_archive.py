"""Content-addressed WARC archive.

An archive is two Parquet tables. ``payloads`` holds each distinct payload
once, compressed, under its SHA-256. ``records`` holds, per record, the exact
header bytes (WARC header, and the HTTP header that opens the block) and the
address of its payload. A record is rebuilt by a join of the two: header,
HTTP header, payload, two line ends; and is then checked: Content-Length
against the bytes, SHA-1 and SHA-256 against the payload.

Of records with equal payloads of at least ``min_revisit_bytes`` bytes the one
with the largest key is a response and the others are revisits of it, without a
payload of their own.

Equal payloads are found on narrow rows (digests and lengths) with partial
aggregation. Payload bytes are moved compressed: once to be stored, with copies
dropped before the shuffle, and once for a rebuilding join, whose hot addresses
adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countlake.llm.common import pieces
from countlake.session import write_through

MIN_REVISIT_BYTES = 1000
#: The tables hold no capture time; all records carry this one.
CAPTURED = "2024-01-01T00:00:00Z"

END = "\r\n"
#: Fixed value: the profile of revisits with equal payloads.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null; line ends within a value are percent-encoded."""
    text = value.cast("string")
    safe = F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _record_id(key: Column, number: Column) -> Column:
    """A record's URI, made from its key and its number among the rows."""
    name = F.md5(F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("-")), number))
    return F.concat(F.lit("<urn:md5:"), name, F.lit(">"))


def write(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    captured: str = CAPTURED,
) -> None:
    """Writes one record per row of ``pages`` below ``path``.

    A null payload is stored as an empty one; a null url or key leaves its
    header line out. Null keys rank below all others; of rows repeated with
    one key and payload, one is the response. Other columns are left out. An
    empty table gives an empty archive.
    """
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = write_through(
        pages.select(
            F.monotonically_increasing_id().alias("number"),
            F.col(key).alias("key"),
            F.col(url).alias("url"),
            F.length(body).cast("long").alias("bytes"),
            F.unhex(F.sha2(body, 256)).alias("address"),
            F.sha1(body).alias("sha1"),
        ),
        "warc-rows",
    )
    rank = F.struct(F.col("key").isNotNull().alias("known"), "key", "number")
    groups = (
        rows.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("address")
        .agg(F.max(rank).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    own = _record_id(F.col("key"), F.col("number"))
    response = F.col("first").isNull() | (F.col("first.number") == F.col("number"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _line("Content-Length", F.col("bytes")),
        F.lit(END),
    )
    length = F.length("http") + F.when(F.col("response"), F.col("bytes")).otherwise(F.lit(0))
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        F.when(F.col("response"), F.lit(f"WARC-Type: response{END}")).otherwise(
            F.lit(f"WARC-Type: revisit{END}")
        ),
        _line("WARC-Record-ID", own),
        _line("WARC-Date", F.lit(captured)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            ~F.col("response"),
            F.concat(
                _line("WARC-Refers-To", _record_id(F.col("first.key"), F.col("first.number"))),
                _line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(F.lit("")),
        _line("Archive-Key", F.col("key")),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", length),
        F.lit(END),
    )
    (
        rows.join(groups, "address", "left")
        .withColumn("response", response)
        .withColumn("http", http)
        .select(
            header.cast("binary").alias("header"),
            F.col("http").cast("binary").alias("http"),
            "response",
            "address",
        )
        .write.option("compression", "zstd")
        .parquet(f"{path}/records")
    )

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in pieces(batches, "html"):
            payloads = [(h or "").encode() for h in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [
                    pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
                    pa.array([pack(p) for p in payloads], pa.binary()),
                ],
                names=["address", "packed"],
            )

    (
        pages.select(F.col(html).alias("html"))
        .mapInArrow(store, "address binary, packed binary")
        .dropDuplicates(["address"])
        .write.option("compression", "none")
        .parquet(f"{path}/payloads")
    )


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode().split(END)
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    return {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:] if x)}


def rebuild(spark: SparkSession, path: str) -> DataFrame:
    """Every record: record (its exact bytes), content (payload of a revisit), address.

    A response carries its payload in ``record`` and has null in ``content``.
    """
    columns = "record binary, content binary, address binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, "packed", limit=1 << 20):
            records, contents = [], []
            for row in batch.to_pylist():
                content = unpack(row["packed"])
                block = row["http"] + (content if row["response"] else b"")
                records.append(row["header"] + block + b"\r\n\r\n")
                contents.append(None if row["response"] else content)
            yield pa.record_batch(
                [
                    pa.array(records, pa.binary()),
                    pa.array(contents, pa.binary()),
                    batch.column("address"),
                ],
                names=["record", "content", "address"],
            )

    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads")
    return records.join(payloads, "address", "left").mapInArrow(build, columns)


def read(spark: SparkSession, path: str, *, key_type: str = "long") -> DataFrame:
    """Parsed and checked records: key, url, record_id, record_type, refers_to_id,
    refers_to, payload_bytes, payload_digest (hex SHA-1), all of the full payload.

    A record that does not parse, or whose lengths or digests differ from its
    bytes, fails the job.
    """
    columns = (
        "key string, url string, record_id string, record_type string, refers_to_id string, "
        "payload_bytes long, payload_digest string"
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "record", limit=1 << 20):
            out: list[tuple] = []
            for row in batch.to_pylist():
                head, _, rest = row["record"].partition(b"\r\n\r\n")
                fields = _parse(head)
                size = int(fields["content-length"])
                if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
                    raise ValueError(f"{fields['warc-record-id']}: wrong length")
                payload = row["content"]
                if fields["warc-type"] == "response":
                    payload = rest[:size].partition(b"\r\n\r\n")[2]
                sha1 = hashlib.sha1(payload).hexdigest()
                if f"sha1:{sha1}" != fields["warc-payload-digest"]:
                    raise ValueError(f"{fields['warc-record-id']}: wrong digest")
                if hashlib.sha256(payload).digest() != row["address"]:
                    raise ValueError(f"{fields['warc-record-id']}: wrong address")
                out.append(
                    (
                        fields.get("archive-key"),
                        fields.get("warc-target-uri"),
                        fields["warc-record-id"],
                        fields["warc-type"],
                        fields.get("warc-refers-to"),
                        len(payload),
                        sha1,
                    )
                )
            names = [c.split()[0] for c in columns.split(", ")]
            kinds = [pa.int64() if n == "payload_bytes" else pa.string() for n in names]
            yield pa.record_batch(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names
            )

    parsed = write_through(rebuild(spark, path).mapInArrow(parse, columns), "warc-parsed")
    revisits = parsed.where("record_type = 'revisit'")
    targets = (
        revisits.select(F.col("refers_to_id").alias("record_id"))
        .distinct()
        .join(parsed.select("record_id", F.col("key").alias("refers_to")), "record_id")
        .withColumnRenamed("record_id", "refers_to_id")
    )
    return parsed.join(targets, "refers_to_id", "left").select(
        F.col("key").cast(key_type).alias("key"),
        "url",
        "record_id",
        "record_type",
        "refers_to_id",
        F.col("refers_to").cast(key_type).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
    )
