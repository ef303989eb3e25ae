"""WARC archives: writing them, and reading them one record at a time.

Every record is a gzip member of its own. The reader inflates a file in small steps,
takes the header block up to its empty line, frames the content by Content-Length,
checks it against the block and payload digests, and expects the member to end with the
record. Nothing but the record at hand is held.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, scratch_dir, stored, table
from .files import fresh_file, open_file

CHUNK = 1 << 16
FILE_BYTES = 256 << 20

# The profile of a revisit record, from the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member. Control characters in header values are percent-encoded."""
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    safe = ((name, re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)) for name, value in headers)
    text = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in safe) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with its digest and length only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
               ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if refers_to is None:
        return record(headers, http + payload)
    headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    return record(headers, http)


class _Member:
    """The inflated bytes of gzip members that follow one another in a stream."""

    def __init__(self, stream):
        self.stream, self.raw, self.data, self.inflate = stream, b"", bytearray(), None

    def start(self) -> bool:
        """Begin the next member; false at the end of the file."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.inflate, self.data = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate one step; false where the member has ended."""
        if self.inflate.eof:
            return False
        self.raw = self.raw or self.stream.read(CHUNK)
        if not self.raw:
            raise ValueError("the file ends within a record")
        self.data += self.inflate.decompress(self.raw, CHUNK)
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, end: bytes) -> bytes:
        searched = 0
        while (at := self.data.find(end, searched)) < 0:
            searched = max(0, len(self.data) - len(end) + 1)
            if not self.more():
                raise ValueError("a record without the end of its header")
        return self.take(at + len(end))

    def take(self, size: int) -> bytes:
        while len(self.data) < size:
            if not self.more():
                raise ValueError("a record shorter than its Content-Length")
        out = bytes(self.data[:size])
        del self.data[:size]
        return out

    def finish(self) -> None:
        if self.take(4) != b"\r\n\r\n":
            raise ValueError("a record longer than its Content-Length")
        while not self.data and self.more():
            pass
        if self.data:
            raise ValueError("a record longer than its Content-Length")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, digests checked."""
    member = _Member(stream)
    while member.start():
        version, *lines = member.until(b"\r\n\r\n").decode()[:-4].split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = member.take(int(headers["content-length"]))
        member.finish()
        if headers.get("warc-block-digest", (own := f"sha1:{digest(block)}")) != own:
            raise ValueError(f"damaged record {headers.get('warc-record-id')}")
        yield headers, block


def parsed_page(headers: dict[str, str], block: bytes) -> tuple[int, str | None, int, str, str, int | None, bytes | None]:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of a record."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"(?mi)^Content-Length: (\d+)", head)[1])
    own = headers["warc-payload-digest"].removeprefix("sha1:")
    refers = headers.get("warc-refers-to")
    if headers["warc-type"] == "response" and (digest(payload) != own or len(payload) != length):
        raise ValueError(f"damaged payload of {headers['warc-record-id']}")
    number = lambda uri: int(uri.removeprefix("<urn:page:").removesuffix(">"))
    return (number(headers["warc-record-id"]), headers.get("warc-target-uri"), length, own, headers["warc-type"],
            None if refers is None else number(refers), payload if headers["warc-type"] == "response" else None)


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per page with an id to ``folder``; ``path, records, bytes`` per file.

    Of pages with equal payloads (html in UTF-8, NULL as empty) the one with the largest
    id is a response, rows that repeat this page too; the others revisit it. Rows
    without an id are left out; an empty table gives no file.
    """
    pages = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).where("page_id IS NOT NULL")
    keyed = pages.withColumn("key", F.unhex(F.sha1("html"))).withColumn("size", F.octet_length("html"))
    last = keyed.groupBy("key", "size").agg(F.max("page_id").alias("last"))
    joined = keyed.join(last, ["key", "size"]).select(
        "page_id", "url", "html", F.when(F.col("last") != F.col("page_id"), F.col("last")).alias("refers_to"))

    def write(batches):
        stream = path = None
        records = size = 0

        def closed():
            stream.close()
            return pd.DataFrame([(path, records, size)], columns=["path", "records", "bytes"])

        for batch in batches:
            for page, url, html, refers in zip(batch["page_id"].tolist(), batch["url"], batch["html"], batch["refers_to"], strict=True):
                if stream is None:
                    path, stream = fresh_file(folder, "warc.gz")
                    records = size = 0
                data = page_record(page, url, html.encode(), None if pd.isna(refers) else int(refers))
                stream.write(data)
                records, size = records + 1, size + len(data)
                if size >= FILE_BYTES:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    # Ids beyond 2**53 must not pass through floating point.
    joined = joined.withColumn("refers_to", F.col("refers_to").cast("string"))
    return stored(joined.mapInPandas(write, "path string, records long, bytes long"), "archives")


def read_warc(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The pages in the archives: a file per task, a record at a time."""
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if with_payload else [])]
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def read(batches):
        def frame(rows):
            return pd.DataFrame(rows, columns=columns).assign(refers_to=[None if r[5] is None else str(r[5]) for r in rows])

        for batch in batches:
            for path in batch["path"]:
                rows, held = [], 0
                with open_file(path) as stream:
                    for headers, block in read_records(stream):
                        rows.append(parsed_page(headers, block)[:len(columns)])
                        held += len(block)
                        if held >= 16 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                if rows:
                    yield frame(rows)

    files = archives.select("path").repartition(max(1, archives.count()))
    found = files.mapInPandas(read, schema + (", payload binary" if with_payload else ""))
    return found.withColumn("refers_to", F.col("refers_to").cast("bigint"))


@query("op6_warc")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_warc(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return read_warc(archives, with_payload=False).drop("url")
