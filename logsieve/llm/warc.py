"""A content-addressed web archive.

Payload bytes are stored once, under their SHA-256; the exact header block of every record is kept
apart, in a narrow table. Writing never moves a payload but to the place of its digest, where copies
meet as partial aggregates; roles (response or revisit) come from the narrow digests alone. Reading
verifies every stored payload against its digest, and puts records together by a join.

Defined results: a null payload is empty; of equal payloads of at least ``least`` bytes, the one with
the smallest id (null counts as the largest) is the response and the others revisit it, so exact
repeats of that very row are responses too, and their payload is still stored once; shorter ones are
all responses. Control characters in URLs are percent-encoded; a null URL has no target line. Columns
but id, URL and payload are left out."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.base import binary, quoted, slices, text_sizes, written

LAST = (1 << 63) - 1  # stands for a null id where ids are ordered
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


@dataclass(frozen=True)
class Archive:
    """headers: page_key, sha256, header (the exact bytes). payloads: sha256, length, body (zstd)."""

    headers: DataFrame
    payloads: DataFrame


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _digests(pages: DataFrame, bodies: bool) -> DataFrame:
    """The narrow record of each page, or its id and compressed body by digest."""
    schema = "page_key long, sha256 binary, length long, " + ("body binary" if bodies else "page_id long, url string, sha1 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(2))):
                data = binary(part.column(2))
                ids = part.column(0).to_pylist()
                arrays = [
                    pa.array([LAST if i is None else i for i in ids], type=pa.int64()),
                    pa.array([hashlib.sha256(d).digest() for d in data], type=pa.binary()),
                    pa.array([len(d) for d in data], type=pa.int64()),
                ]
                if bodies:
                    arrays.append(pa.array([press.compress(d) for d in data], type=pa.binary()))
                    names = ["page_key", "sha256", "length", "body"]
                else:
                    arrays += [part.column(0), part.column(1), pa.array([base32_sha1(d) for d in data], type=pa.string())]
                    names = ["page_key", "sha256", "length", "page_id", "url", "sha1"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return pages.mapInArrow(run, schema)


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _safe(url: Column) -> Column:
    for code in [*range(32), 127]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _header(date: str) -> Column:
    """The WARC and HTTP header lines of a record, ended as they stand before the payload."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(HTTP), F.col("length").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("length"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _uri(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _safe(F.col("url"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _uri(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.encode(F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), http), "UTF-8")


def write_archive(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    path: str | None = None,
) -> Archive:
    """Write the archive of ``pages`` below ``path`` (else in the shared folder)."""
    source = pages.select(
        F.col(quoted(page_id)).alias("page_id"), F.col(quoted(url)).alias("url"), F.col(quoted(html)).alias("html")
    )
    records = written(_digests(source, bodies=False), "warc-records")
    # Only payloads met twice or more have revisits; these few digests go into the join.
    firsts = written(
        records.where(F.col("length") >= least)
        .groupBy("sha256")
        .agg(F.min("page_key").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("sha256", "first"),
        "warc-firsts",
    )
    revisits = F.col("first").isNotNull() & (F.col("length") >= least) & (F.col("page_key") != F.col("first"))
    headers = (
        records.join(firsts, "sha256", "left")
        .withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisits & (F.col("first") != LAST), F.col("first")))
        .select("page_key", "sha256", "record_type", _header(date).alias("header"))
    )
    payloads = (
        _digests(source, bodies=True)
        .groupBy("sha256")
        .agg(F.min_by(F.struct("length", "body"), "page_key").alias("kept"))
        .select("sha256", "kept.length", "kept.body")
    )
    if path is None:
        return Archive(written(headers, "warc-headers"), written(payloads, "warc-payloads"))
    headers.write.parquet(f"{path}/headers")
    payloads.write.parquet(f"{path}/payloads")
    return open_archive(pages.sparkSession, path)


def open_archive(spark, path: str) -> Archive:
    return Archive(spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads"))


def line_of(header: Column, name: str) -> Column:
    """The value of a header line, null where there is none."""
    return F.nullif(F.regexp_extract(header, rf"(?md)^{name}: ([^\r\n]*)", 1), F.lit(""))


def reconstruct(archive: Archive) -> DataFrame:
    """The original records: header, payload and record bytes. A response carries its payload, read
    from the store and verified; a revisit has none. A payload that is missing or does not fit its
    SHA-256, its record's SHA-1 or its length is an error."""
    joined = archive.headers.where("record_type = 'response'").join(archive.payloads, "sha256", "left")
    schema = "page_key long, sha256 binary, record_type string, header binary, payload binary, record binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                key, digest, kind, header, length, body = (part.column(i).to_pylist() for i in range(6))
                payloads = []
                for d, h, n, b in zip(digest, header, length, body):
                    if b is None:
                        raise ValueError(f"no payload of digest {d.hex()}")
                    p = unpress.decompress(b, max_output_size=max(n, 1))
                    if len(p) != n or hashlib.sha256(p).digest() != d or f"sha1:{base32_sha1(p)}\r\n".encode() not in h:
                        raise ValueError(f"the payload of digest {d.hex()} is damaged")
                    payloads.append(p)
                records = [h + p + b"\r\n\r\n" for h, p in zip(header, payloads)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(4)), pa.array(payloads, pa.binary()), pa.array(records, pa.binary())],
                    names=["page_key", "sha256", "record_type", "header", "payload", "record"],
                )

    responses = joined.select("page_key", "sha256", "record_type", "header", "length", "body").mapInArrow(run, schema)
    revisits = archive.headers.where("record_type = 'revisit'").select(
        "page_key",
        "sha256",
        "record_type",
        "header",
        F.lit(None).cast("binary").alias("payload"),
        F.concat("header", F.lit(b"\r\n\r\n")).alias("record"),
    )
    return responses.unionByName(revisits)


def read_back(archive: Archive) -> DataFrame:
    """A row per record, from its reconstructed bytes: a revisit's payload figures are those of the
    response that its digest leads to."""
    text = F.decode("header", "UTF-8")
    rows = written(
        reconstruct(archive).select(
            "sha256",
            line_of(text, "WARC-Record-ID").alias("uri"),
            line_of(text, "WARC-Type").alias("record_type"),
            line_of(text, "WARC-Refers-To").alias("refers"),
            F.substring(line_of(text, "WARC-Payload-Digest"), 6, 99).alias("payload_digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
        ),
        "warc-read",
    )
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    revisits = rows.where("record_type = 'revisit'")
    sizes = written(
        rows.where("record_type = 'response'")
        .join(revisits.select("sha256").distinct(), "sha256", "left_semi")
        .groupBy("sha256")
        .agg(F.max("payload_bytes").alias("full_bytes")),
        "warc-sizes",
    )
    return (
        rows.where("record_type = 'response'")
        .withColumn("full_bytes", F.col("payload_bytes"))
        .unionByName(revisits.join(sizes, "sha256", "left"))
        .select(
            number("uri").alias("page_id"),
            F.col("full_bytes").alias("payload_bytes"),
            "payload_digest",
            "record_type",
            number("refers").alias("refers_to"),
        )
    )
