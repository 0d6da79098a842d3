"""WARC archives: a writer with identical-payload revisits, and a splittable reader.

Archives are gzip files with one member per record. The reader deals byte
ranges to tasks. A task scans its range for the gzip magic and takes a place
for the start of a record only when the member's header decodes and what it
inflates to begins with a WARC version line. From the first record on it
walks from member to member; it owns the records that start inside its
range and reads past its end to complete the last one.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import Scratch, cut

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 1000
CHUNK = 1 << 18
SPLIT = 8 << 20


def _files(uri: str):
    """The file system of a path and the path in it, as a task sees them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI: one without a scheme lies where Spark itself would put it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    if uri.startswith("file:"):
        return "file://" + uri.removeprefix("file:").removeprefix("//")
    return "s3://" + uri.split("://", 1)[1] if uri.startswith(("s3a://", "s3n://")) else uri


def _urn(page: object) -> str:
    """Any id, as text; a null id is told from an empty one."""
    return "urn:none" if page is None else f"urn:page:{quote(str(page), safe='')}"


def _page(urn: str) -> str | None:
    return unquote(urn[1:-1].removeprefix("urn:page:")) if urn.startswith("<urn:page:") else None


def _record(page: object, url: str, payload: bytes, digest: str, keeper: object, is_revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{_urn(page)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + " ".join(url.split()),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if is_revisit:
        head += [f"WARC-Refers-To: <{_urn(keeper)}>", f"WARC-Profile: {REVISIT}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, keeper): keeper is the largest page_id with an equal payload of ``least`` bytes or more.

    Where all equal pages have null ids there is no keeper. Digests are
    counted before they are shuffled, and pages meet their group in a join
    that Spark can split, so a payload shared by a third of all pages does
    not gather in one task.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    url = F.coalesce(F.col("url"), F.lit("")) if "url" in pages.columns else F.lit("")
    rows = pages.select(F.col(page_id).alias("page_id"), url.alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    big = rows.where(F.octet_length("payload") >= least).groupBy(F.col("digest").alias("same")).agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return rows.join(big, F.col("digest") == F.col("same"), "left").drop("same")


def write(rows: DataFrame, folder: str) -> pd.DataFrame:
    """Writes archives of ``with_revisits`` rows; returns (path, bytes, records) of each, a row for every task.

    A task that is repeated writes a file of its own name again; only files
    of tasks that ended well are returned.
    """

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                for page, url, payload, digest, keeper in zip(batch["page_id"], batch["url"], batch["payload"], batch["digest"], batch["keeper"]):
                    payload = bytes(payload)
                    member = zlib.compressobj(1, zlib.DEFLATED, 31)
                    record = _record(page, url, payload, digest, keeper, keeper is not None and page != keeper)
                    data = member.compress(record) + member.flush()
                    out.write(data)
                    size, n = size + len(data), n + 1
        yield pd.DataFrame({"path": [f"{folder}/{name}"], "bytes": [size], "records": [n]})

    typed = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "keeper")})
    return typed.mapInPandas(put, "path string, bytes long, records long").toPandas()


class _Stream:
    """Bytes of an open file from a place on, in chunks."""

    def __init__(self, file, at: int):
        self.file, self.at = file, at
        file.seek(at)

    def more(self) -> bytes:
        return self.file.read(CHUNK)


def _opens(file, at: int) -> bool:
    """Whether a gzip member that inflates to a WARC record starts at this place."""
    file.seek(at)
    data = file.read(4096)
    try:
        return zlib.decompressobj(31).decompress(data, 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _first(file, start: int, end: int) -> int:
    """Where the first record of [start, end) starts; -1 if none does."""
    at, tail = start, b""
    while at < end:
        file.seek(at)
        data = tail + file.read(min(CHUNK, end - at + len(MAGIC) - 1))
        base, found = at - len(tail), -1
        while (found := data.find(MAGIC, found + 1)) >= 0:
            if base + found >= end:
                return -1
            if _opens(file, base + found):
                return base + found
        at, tail = at + CHUNK, data[-(len(MAGIC) - 1) :]
    return -1


def records(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the records that start inside [start, end)."""
    at = _first(file, start, end)
    while 0 <= at < end:
        file.seek(at)
        member, parts, used, data = zlib.decompressobj(31), [], 0, b""
        try:
            while not member.eof:
                data = file.read(CHUNK)
                if not data:
                    raise zlib.error("the archive ends inside a record")
                parts.append(member.decompress(data))
                used += len(data)
        except zlib.error:
            at = _first(file, at + 1, end)  # a damaged member: the next record is searched for
            continue
        yield at, b"".join(parts)
        at += used - len(member.unused_data)
        file.seek(at)
        if at < end and file.read(len(MAGIC)) != MAGIC:
            at = _first(file, at, end)


def parse(record: bytes) -> dict | None:
    """The fields of a record, its payload's digest and length checked where it holds the payload; None for other bytes."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:])}
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or sizes and sizes[0] != len(payload)):
        return None
    return {"page_id": _page(fields.get("warc-record-id", "")), "url": fields.get("warc-target-uri", ""), "record_type": kind, "payload_digest": digest, "payload_bytes": sizes[0] if sizes else len(payload), "refers_to": _page(fields.get("warc-refers-to", "")), "payload": payload if kind == "response" else None}


def read(spark: SparkSession, archives: pd.DataFrame, split: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """A row per response or revisit record of the archives (path, bytes), read in byte ranges of ``split``; ids as text.

    Damaged members and records whose payload does not have their digest are
    passed over, as archives from elsewhere hold some; ``roundtrip`` counts.
    """
    ranges = [(p, a, min(n, a + split)) for p, n in zip(archives["path"], archives["bytes"]) for a in range(0, int(n), split)]
    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string" + ", payload binary" * with_payload
    if not ranges:
        return spark.createDataFrame([], schema)
    names = [x.split()[0] for x in schema.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start, end in zip(batch["path"], batch["start"], batch["end"]):
                files, name = _files(path)
                with files.open_input_file(name) as file:
                    held, size = [], 0
                    for _, record in records(file, start, end):
                        row = parse(record)
                        if row is None or row["record_type"] not in ("response", "revisit"):
                            continue
                        held.append([row[k] for k in names])
                        size += len(record) if with_payload else 100
                        if size > 8 << 20:
                            yield _frame(held, names)
                            held, size = [], 0
                    if held:
                        yield _frame(held, names)

    places = spark.createDataFrame(ranges, "path string, start long, end long")
    return places.repartition(min(len(ranges), 100_000)).mapInPandas(scan, schema)


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"payload_bytes": "Int64"})


def roundtrip(pages: DataFrame, page_id: str = "page_id", with_payload: bool = False, split: int = SPLIT, **options) -> DataFrame:
    """The pages as they are read back from archives in the shared folder.

    Ids may be of any type that has a text form; they come back as that type.
    A null html is an empty payload and a null url an empty one. Rows that
    repeat the largest id of their payload are responses all. A null id stays
    null and revisits the group's largest id. Payloads may be of any length: a
    task holds one whole, with its record, at a time, and reads it across
    splits. Other columns are left out; an empty table gives no rows. Fewer or
    more records read than written raise an error.
    """
    spark = pages.sparkSession
    archives = write(with_revisits(pages, page_id, **options), qualified(spark, f"{Scratch(spark).root}/warc"))
    found = cut(read(spark, archives, split, with_payload))
    written, got = int(archives["records"].sum()) if len(archives) else 0, found.count()
    if written != got:
        raise ValueError(f"{written} records were written and {got} read")
    kind = pages.schema[page_id].dataType
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
