"""Legacy web archives to WARC.

An ARC file begins with a version block whose third line names the fields of
all header lines: five of them in version 1, ten in version 2. ``read_arc`` takes
the names from there, parses each record's header line and reads as many bytes as it declares.
``convert`` turns a record into the WARC record it stands for: identifier (a
name-based UUID of URL, date and digest), date in ISO form, type after the
URL's scheme, and SHA-1 digests in Base32.

Of records with equal payloads of at least ``LEAST`` bytes the one with the
largest key is written whole and the others as revisits of it: their block is
the HTTP header only, whose Content-Length still tells the payload's size. Which
one is whole is settled by an aggregate per digest before anything is written, so a
payload that a third of all records share is one row there. Each task writes
gzipped archives to the shared folder under temporary names and renames them when complete, so
a task that runs again replaces its files with the same content.

Defined results: a null payload is empty; a null URL is ``urn:none``; white space and
control characters in URLs are percent-encoded; records that repeat the largest
key of their payload are all whole, as are those with null keys where no other
key is there; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.common import materialise, new_path

LEAST = 1000
#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 256_000_000
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
_UNSAFE = re.compile(r"[\x00-\x20\x7f\s]")


@dataclass(frozen=True)
class ArcRecord:
    """A record's header fields by name, and its content."""

    fields: dict[str, str]
    content: bytes
    version: int


def arc_block(version: int, name: str, date: str) -> bytes:
    """The version block that an ARC file begins with."""
    body = f"{version} 0 archive\n{' '.join(FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/plain", "Result-code": "200", "Archive-length": str(len(body))}
    return " ".join(values.get(f, "-") for f in FIELDS[version]).encode() + b"\n" + body + b"\n"


def arc_record(version: int, fields: dict[str, str], content: bytes) -> bytes:
    """A record's bytes; missing fields are '-'."""
    values = fields | {"Archive-length": str(len(content))}
    return " ".join(values.get(f, "-") for f in FIELDS[version]).encode() + b"\n" + content + b"\n"


def read_arc(stream) -> Iterator[ArcRecord]:
    """The records of an ARC stream, its version block first. Raises ValueError on a header or length that doesn't hold."""
    names, version = None, 0
    while line := stream.readline():
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if names is None:
            if not values[0].startswith("filedesc:"):
                raise ValueError("an ARC file begins with its version block")
            size = int(values[-1])
            content = stream.read(size)
            head = content.decode("utf-8", "replace").split("\n")
            version, names = int(head[0].split(" ")[0]), head[1].split(" ")
            if version not in FIELDS or names[-1] != "Archive-length":
                raise ValueError(f"unknown ARC version block: {head[:2]}")
            # the block's own line may be one of version 1 in either version
            yield ArcRecord(dict(zip(names if len(values) == len(names) else FIELDS[1], values)), content, version)
            continue
        if len(values) != len(names):
            # old writers left blanks in content types: what is too many belongs there
            at, extra = names.index("Content-type"), len(values) - len(names)
            if extra < 0:
                raise ValueError(f"an ARC header line of {len(values)} fields, {len(names)} declared")
            values = [*values[:at], " ".join(values[at : at + extra + 1]), *values[at + extra + 1 :]]
        size = int(values[-1])
        content = stream.read(size)
        if len(content) != size:
            raise ValueError(f"an ARC record of {len(content)} bytes, {size} declared")
        yield ArcRecord(dict(zip(names, values)), content, version)


def iso_date(date: str) -> str:
    """A date of 14 digits, or of the first few of them, in ISO form."""
    d = (date + "00000101000000"[len(date) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """Header, with the blank line, and payload of an HTTP response."""
    head, blank, payload = content.partition(b"\r\n\r\n")
    return head + blank, payload


def record_id(url: str, date: str, digest: str, key: str = "") -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {key}')}>"


def convert(record: ArcRecord, key: str = "", refers_to: str | None = None) -> bytes:
    """The WARC record that an ARC record stands for; with ``refers_to``, the key of an equal payload's record, a revisit."""
    url, date = record.fields["URL"], iso_date(record.fields["Archive-date"])
    scheme = url.partition(":")[0].lower()
    content = record.content
    headers = [("WARC-Type", "warcinfo" if scheme == "filedesc" else "response" if scheme in ("http", "https", "urn") else "resource")]
    if headers[0][1] == "response":
        head, payload = split_http(content)
        digest = sha1(payload)
        if refers_to is not None:
            headers[0] = ("WARC-Type", "revisit")
            headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id("", "", digest, refers_to)), ("Key-Of-Referred", refers_to)]
            content = head
        kind = "application/http; msgtype=response"
    else:
        digest, kind = sha1(content), record.fields.get("Content-type", "-")
    own = record_id("", "", digest, key) if key else record_id(url, date, digest)
    headers += [("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", sha1(content)), ("Content-Type", kind), ("Content-Length", str(len(content)))]
    ip = record.fields.get("IP-address", "-")
    headers += [("WARC-IP-Address", ip)] * (ip not in ("-", "0.0.0.0")) + [("Key", key)] * bool(key)
    return b"WARC/1.1\r\n" + "".join(f"{a}: {b}\r\n" for a, b in headers).encode() + b"\r\n" + content + b"\r\n\r\n"


def read_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the beginning of a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size or sha1(block) != headers["WARC-Block-Digest"]:
            raise ValueError(f"a damaged record: {headers['WARC-Record-ID']}")
        yield headers, block


def decide(pages: DataFrame, key_col: str, payload_col: str, least: int = LEAST) -> DataFrame:
    """``pages`` with ``_refers_to``: the largest key of an equal payload of at least ``least`` bytes, where that is another key."""
    data = F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8")
    hashed = pages.withColumn("_digest", F.when(F.octet_length(data) >= least, F.sha1(data)))
    top = hashed.filter(F.col("_digest").isNotNull()).groupBy("_digest").agg(F.max(key_col).alias("_top"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    joined = hashed.join(top.withColumnRenamed("_digest", "_d"), F.col("_digest") == F.col("_d"), "left")
    return joined.withColumn("_refers_to", F.when(~F.col(key_col).eqNullSafe(F.col("_top")), F.col("_top"))).drop("_digest", "_d", "_top")


def write_archives(pages: DataFrame, folder: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "20240101000000", least: int = LEAST) -> DataFrame:
    """Writes ``pages`` as gzipped WARC files below ``folder``, through the legacy format, and returns the materialised list (path, records, bytes)."""
    rows = decide(pages.select(key_col, url_col, payload_col), key_col, payload_col, least).select(F.col(key_col).cast("string").alias("key"), F.col(url_col).alias("url"), F.coalesce(payload_col, F.lit("")).alias("payload"), F.col("_refers_to").cast("string").alias("refers_to"))

    def arc_of(key: str, url: str | None, payload: bytes, version: int) -> ArcRecord:
        """The page as a record of a legacy archive, parsed from its bytes."""
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        url = _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "urn:none")
        if ":" not in url or url.partition(":")[0].lower() not in ("http", "https"):
            url = f"urn:{url.removeprefix('urn:')}"
        fields = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html", "Result-code": "200"}
        records = read_arc(io.BytesIO(arc_block(version, "pages.arc", date) + arc_record(version, fields, head + payload)))
        return [*records][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, number, done = None, 0, []

        def close():
            out[0].close()
            fs.move(out[1], out[2])
            done.append((out[2], out[3], out[4]))

        for b in batches:
            for key, url, payload, refers_to in zip(*[b.column(c) for c in ("key", "url", "payload", "refers_to")]):
                if out is None:
                    name = f"{root}/pages-{task.partitionId():06d}-{number:04d}.warc.gz"
                    temporary = f"{name}.{uuid.uuid4().hex}.tmp"
                    out, number = [fs.open_output_stream(temporary, compression=None), temporary, name, 0, 0], number + 1
                key, to = json.dumps(key.as_py()), refers_to.as_py()  # one line, and a null is no string
                data = convert(arc_of(key, url.as_py(), payload.as_py().encode(), 1 + out[3] % 2), key, None if to is None else json.dumps(to))
                member = gzip.compress(data, 4, mtime=0)
                out[0].write(member)
                out[3], out[4] = out[3] + 1, out[4] + len(member)
                if out[4] >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            path, records, size = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(records, pa.int64()), pa.array(size, pa.int64())], names=["path", "records", "bytes"])

    listed, _ = materialise(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")
    return listed


def read_archives(listed: DataFrame, folder: str) -> DataFrame:
    """(key, url, date, payload_bytes, payload_digest, record_type, refers_to) of each record of the listed archives.

    A response's payload is measured and hashed; a revisit's size is read from
    its HTTP header and its digest from its own header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        names = ["key", "url", "date", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

        out = []
        for b in batches:
            for path in b.column("path").to_pylist():
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for h, block in read_warc(stream):
                        head, payload = split_http(block)
                        digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        size = len(payload)
                        if h["WARC-Type"] == "revisit":
                            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        elif hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"a payload that isn't its digest's: {h['WARC-Record-ID']}")
                        key, to = (json.loads(h.get(x, "null")) for x in ("Key", "Key-Of-Referred"))
                        out.append((key, h["WARC-Target-URI"], h["WARC-Date"], size, digest, h["WARC-Type"], to))
                        if len(out) == 5_000:
                            yield batch(out)
                            out = []
        if out:
            yield batch(out)

    files = max(1, listed.count())
    return listed.select("path").repartition(min(files, 10_000), "path").mapInArrow(run, "key string, url string, date string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The columns that query op7 returns, read back from the archives it writes."""
    folder = new_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder}"
    kind = pages.schema["page_id"].dataType
    back = read_archives(write_archives(pages, folder), folder)
    return back.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
