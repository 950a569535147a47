"""Legacy web archives: ARC files written, converted to WARC, and WARC files read back.

An archive is one file of a text table: every record ends with a line feed, which is what the table's writer puts behind a
row. So archives are written and committed by Spark itself, wherever the path is, and read as binary files, one archive
at a time, record after record. A file holds what one partition holds, so ``spark.sql.files.maxPartitionBytes`` bounds it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field as attribute

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncloom.llm.rows import field, ship
from syncloom.llm.textops import CHUNK_BYTES
from syncloom.operators.skew import join_unique
from syncloom.session import scratch_path, stored

#: Fixed values of the two formats: the fields of a header line by version of ARC, and WARC's name of a repeat.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "20000101000000"
#: The header by which a page keeps its number through both formats.
NUMBER = "X-Page-Id"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def escaped(url: str | None) -> str:
    """A URL without blanks, control characters or line ends, which a header line cannot hold; none is ``unknown:``."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "unknown:"


# ARC: written


def version_block(version: int, name: str, date: str = DATE) -> bytes:
    """The first record of an archive: the version and the names of the fields of the header lines that follow."""
    body = f"{version} 0 syncloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == 2:
        values += ["200", "-", "-", "0", name]
    return f"{' '.join(values)} {len(body)}\n".encode() + body


def url_record(version: int, name: str, offset: int, url: str | None, number: int | None, payload: bytes, date: str = DATE) -> bytes:
    """A page as it came: status line, headers, payload."""
    extra = "" if number is None else f"{NUMBER}: {number}\r\n"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{extra}\r\n".encode() + payload
    values = [escaped(url), "0.0.0.0", date, "text/html"]
    if version == 2:
        values += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), name]
    return f"{' '.join(values)} {len(block)}\n".encode() + block


def write_records(records: DataFrame, path: str) -> None:
    """Rows of one binary column ``record``, each without the line feed that ends it, as archives below ``path``."""
    records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").text(path)


def write_arc(pages: DataFrame, path: str, versions: Sequence[int] = (1, 2), url: str = "url", body: str = "html", key: str = "page_id") -> None:
    """Pages as ARC archives below ``path``, one per partition; partitions take the versions in turn."""
    ship(pages.sparkSession)
    given = pages.select(pages[f"`{key}`"].cast("long").alias("k"), pages[f"`{url}`"].cast("string").alias("u"), F.coalesce(pages[f"`{body}`"].cast("string"), F.lit("")).cast("binary").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = versions[part % len(versions)], f"part-{part:05d}.arc"
        first = version_block(version, name)
        out, offset, size = [first], len(first) + 1, 0
        for batch in batches:
            for k, u, b in zip(*(field(batch, c) for c in ("k", "u", "b"))):
                out.append(url_record(version, name, offset, u.as_py(), k.as_py(), b.as_py()))
                offset += len(out[-1]) + 1
                size += len(out[-1])
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    write_records(given.mapInArrow(run, "record binary"), path)


# ARC: read


@dataclass
class Legacy:
    """A record of an ARC archive."""

    offset: int
    fields: dict[str, str]
    block: bytes
    cut: bool = False  # the archive ends before the declared length
    version: int = 1

    @property
    def is_version(self) -> bool:
        return self.fields["URL"].startswith("filedesc:")

    @property
    def http(self) -> bool:
        return self.block.startswith(b"HTTP/")

    @property
    def split(self) -> tuple[bytes, bytes]:
        """Headers with the blank line that ends them, and the payload."""
        end = re.search(rb"\r?\n\r?\n", self.block) if self.http else None
        return (self.block[: end.end()], self.block[end.end() :]) if end else (self.block, b"") if self.http else (b"", self.block)


def opened(data: bytes) -> io.BufferedIOBase:
    """A stream over an archive, compressed (as one member or record by record) or not."""
    return gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)


def read_arc(data: bytes, name: str = "") -> Iterator[Legacy]:
    """Records of an archive by their declared lengths; only the record at hand is in memory besides ``data``.

    The version block says which fields header lines have. Without one their number does: ten of version 2, else five.
    Values never hold blanks but for the URL of careless writers, so the other fields are counted from the right.
    """
    stream, offset, names, version = opened(data), 0, None, 0
    while line := stream.readline():
        here, offset = offset, offset + len(line)
        if not line.strip():
            continue
        parts = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        mine = names or ARC_FIELDS[2 if len(parts) >= 10 and parts[-1].isdigit() and parts[-2] and parts[-3].isdigit() else 1]
        url = " ".join(parts[: len(parts) - len(mine) + 1])
        if url.startswith("filedesc:"):  # its own line has the fields of the version it declares
            mine = ARC_FIELDS[2 if len(parts) >= 10 else 1]
            url = " ".join(parts[: len(parts) - len(mine) + 1])
        if len(parts) < len(mine) or not parts[-1].isdigit():
            raise ValueError(f"{name}: no ARC header line at byte {here}: {line[:80]!r}")
        record = Legacy(here, dict(zip(mine, [url, *parts[len(parts) - len(mine) + 1 :]])), b"", version=version or (2 if len(mine) == 10 else 1))
        length = int(parts[-1])
        record.block = stream.read(length)
        record.cut = len(record.block) < length
        offset += len(record.block)
        if record.is_version:
            lines = record.block.decode("utf-8", "replace").splitlines()
            version = record.version = int(lines[0].split(" ")[0]) if lines and lines[0][:1].isdigit() else 1
            named = tuple(lines[1].split()) if len(lines) > 1 else ()
            names = named if named and named[0] == "URL" else ARC_FIELDS.get(version, ARC_FIELDS[1])
        yield record


# WARC: made of ARC


def warc_date(text: str) -> str:
    """ISO form of an archive's date; digits that old archives leave out are the earliest possible."""
    digits = re.sub(r"\D", "", text)[:14]
    if len(digits) < 4:
        digits = DATE
    d = digits + "00000101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(name: str, offset: int) -> str:
    """The same identifier whenever the same archive is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


@dataclass
class Original:
    """What a revisit says about the record that has its payload."""

    id: str
    url: str
    date: str


def warc_record(record: Legacy, name: str, original: Original | None = None) -> bytes:
    """The equivalent WARC record, without its last line feed."""
    url, date = record.fields["URL"], warc_date(record.fields["Archive-date"])
    head, payload = record.split
    block = record.block
    lines = [("WARC-Record-ID", record_id(name, record.offset)), ("WARC-Date", date)]
    if record.is_version:
        block = f"software: syncloom\r\nformat: WARC File Format 1.0\r\nconvertedFrom: ARC/{record.version}\r\n".encode()
        lines = [("WARC-Type", "warcinfo"), *lines, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    else:
        kind = "revisit" if original else "response" if record.http else "resource"
        content = "application/http; msgtype=response" if record.http else record.fields.get("Content-type", "") or "application/octet-stream"
        lines = [("WARC-Type", kind), *lines, ("WARC-Target-URI", url), ("WARC-IP-Address", record.fields.get("IP-address", "0.0.0.0")), ("Content-Type", content)]
        lines += [("WARC-Warcinfo-ID", record_id(name, 0)), ("WARC-Payload-Digest", f"sha1:{sha1(payload)}")]
        if original:
            block = head
            lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", original.id), ("WARC-Refers-To-Target-URI", original.url), ("WARC-Refers-To-Date", original.date)]
        if record.cut:
            lines.append(("WARC-Truncated", "length"))
    lines += [("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8", "surrogateescape") + block + b"\r\n\r"


def archives(spark: SparkSession, path: str) -> DataFrame:
    """``name, content`` of the archives below ``path``."""
    return spark.read.format("binaryFile").load(path).where("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def payloads(spark: SparkSession, path: str, number: str = NUMBER) -> DataFrame:
    """``name, offset, id, url, date, number, size, digest`` (SHA-256) of every HTTP record: narrow rows to decide on."""
    ship(spark)
    wanted = re.compile(rb"^" + re.escape(number.encode()) + rb":[ \t]*(-?\d{1,18})[ \t]*\r?$", re.I | re.M)
    names = ["name", "offset", "id", "url", "date", "number", "size", "digest"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(field(batch, "name").to_pylist(), field(batch, "content")):
                out = []
                for r in read_arc(content.as_py(), name):
                    if r.is_version or not r.http:
                        continue
                    head, payload = r.split
                    found = wanted.search(head)
                    url = r.fields["URL"].encode("utf-8", "surrogateescape").decode("utf-8", "replace")
                    out.append((name, r.offset, record_id(name, r.offset), url, warc_date(r.fields["Archive-date"]), int(found[1]) if found else None, len(payload), hashlib.sha256(payload).digest()))
                columns = zip(*out) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return archives(spark, path).mapInArrow(run, "name string, offset long, id string, url string, date string, number long, size long, digest binary")


def repeats(found: DataFrame, least: int) -> DataFrame:
    """``name, marks``: per archive the offsets of its records that repeat another one's payload, and what that one is.

    Of equal payloads of ``least`` bytes at least, the record with the largest number is the original; without numbers, or of
    equal ones, the one with the largest identifier. Digests meet pre-aggregated; a payload that a third of all records
    have is spread when the records are told (``join_unique``). An archive's marks are as many as its records at most.
    """
    spark = found.sparkSession
    some = stored(found.where(F.col("size") >= least), scratch_path(spark, "payloads"))
    first = some.groupBy("digest").agg(F.max(F.struct("number", "id", "url", "date")).alias("o"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = stored(first.select("digest", "o"), scratch_path(spark, "originals"))
    told = join_unique(some.select("name", "offset", "id", "digest"), first, ["digest"], "left").where("o is not null and id <> o.id")
    return told.groupBy("name").agg(F.collect_list(F.struct("offset", "o.id", "o.url", "o.date")).alias("marks"))


def convert_arc(spark: SparkSession, arc: str, warc: str, least: int = 0, number: str = NUMBER) -> None:
    """The ARC archives below ``arc`` as WARC archives below ``warc``: a record for each, in their order.

    Version blocks become ``warcinfo``; HTTP responses ``response``, or ``revisit`` without payload where another response has the same one
    (``repeats``); anything else ``resource``. Identifiers follow from an archive's name and the record's place, dates and types from
    its header line, digests from its bytes. A record cut short keeps what there is, marked ``WARC-Truncated``; a line that
    should be a header and is not fails the job, naming archive and byte. An empty archive gives none.
    """
    marks = stored(repeats(payloads(spark, arc, number), least), scratch_path(spark, "revisits"))
    given = archives(spark, arc).join(marks, "name", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, told in zip(field(batch, "name").to_pylist(), field(batch, "content"), field(batch, "marks")):
                originals = {m["offset"]: Original(m["id"], m["url"], m["date"]) for m in told.as_py() or []}
                out, size = [], 0
                for record in read_arc(content.as_py(), name):
                    out.append(warc_record(record, name, originals.get(record.offset)))
                    size += len(out[-1])
                    if size >= CHUNK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                        out, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    write_records(given.mapInArrow(run, "record binary"), warc)


# WARC: read


@dataclass
class Record:
    offset: int
    headers: dict[str, str] = attribute(default_factory=dict)
    block: bytes = b""


def read_records(data: bytes, name: str = "") -> Iterator[Record]:
    """Records of a WARC archive; header names in lower case."""
    stream, offset = opened(data), 0
    while line := stream.readline():
        record, offset = Record(offset), offset + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: no WARC record at byte {record.offset}: {line[:80]!r}")
        while (line := stream.readline()).strip():
            offset += len(line)
            key, _, value = line.decode("utf-8", "replace").partition(":")
            record.headers[key.strip().lower()] = value.strip()
        length = int(record.headers["content-length"])
        record.block = stream.read(length)
        if len(record.block) < length:
            raise ValueError(f"{name}: the record at byte {record.offset} is cut short")
        offset += len(line) + length
        yield record


WARC = T.StructType(
    [
        T.StructField("archive", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("uri", T.StringType()), T.StructField("date", T.StringType()), T.StructField("refers_to", T.StringType()),
        T.StructField("number", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
        T.StructField("headers", T.StringType()), T.StructField("payload", T.BinaryType()),
    ]
)


def read_warc(spark: SparkSession, path: str, payload: bool = True, number: str = NUMBER) -> DataFrame:
    """Every record of the archives below ``path``, the columns of ``WARC``; ``payload`` null if not asked for, or of a revisit.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: counted and computed where it is in the record (a digest that
    differs from the declared one fails the job), as declared by a revisit's headers. ``number`` is the value of that HTTP header.
    """
    ship(spark)

    def of_http(head: bytes, name: str) -> int | None:
        found = re.search(rb"^" + re.escape(name.encode()) + rb":[ \t]*(-?\d{1,18})[ \t]*\r?$", head, re.I | re.M)
        return int(found[1]) if found else None

    kinds = [pa.string()] * 6 + [pa.int64()] * 2 + [pa.string()] * 2 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(field(batch, "name").to_pylist(), field(batch, "content")):
                out, size = [], 0
                for record in read_records(content.as_py(), name):
                    h, kind = record.headers, record.headers.get("warc-type")
                    is_http = h.get("content-type", "").startswith("application/http")
                    head, body = Legacy(0, {}, record.block).split if is_http else (b"", record.block)
                    declared = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if kind == "revisit":
                        mine = (of_http(head, "Content-Length"), declared, head.decode("utf-8", "replace"), None)
                    else:
                        digest = sha1(body)
                        if declared not in (None, digest):
                            raise ValueError(f"{name}: the payload of {h.get('warc-record-id')} is not what its digest says")
                        mine = (len(body), digest, head.decode("utf-8", "replace"), body if payload else None)
                    refers = h.get("warc-refers-to")
                    out.append((name, h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-date"), refers, of_http(head, number), *mine))
                    size += len(head) + (len(body) if payload else 0) + 200
                    if size >= CHUNK_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], WARC.names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], WARC.names)

    return archives(spark, path).mapInArrow(run, WARC)


def archived(pages: DataFrame, least: int = 0, url: str = "url", body: str = "html", key: str = "page_id", folder: str | None = None) -> DataFrame:
    """Pages written as ARC archives, converted to WARC and read back: the columns of ``WARC`` but the payload, and
    ``refers_to_number``, the number of the record that a revisit refers to.

    The payload is the body in UTF-8. Of equal payloads of ``least`` bytes at least, the page with the largest key is the response, all
    others revisit it; smaller ones are all responses. A null body is an empty payload, a null or empty URL ``unknown:``. A null key is smaller
    than all others; a revisit of a page without key refers to null. Of repeated rows one is the response. Very long bodies take memory
    of a few times their size. An empty table gives an empty result; other columns are not read. Archives stay below ``folder``
    (``arc`` and ``warc``), by default a scratch folder.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    write_arc(pages, f"{folder}/arc", url=url, body=body, key=key)
    convert_arc(spark, f"{folder}/arc", f"{folder}/warc", least)
    read = read_warc(spark, f"{folder}/warc", payload=False).where(F.col("record_type").isin("response", "revisit")).drop("payload")
    read = stored(read, scratch_path(spark, "records"))
    named = read.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("number").alias("refers_to_number"))
    # only records that something refers to are met, of which there are as many as groups of copies
    wanted = read.where("refers_to is not null").select("refers_to").distinct()
    named = stored(named.join(wanted, "refers_to"), scratch_path(spark, "referred"))
    return join_unique(read, named, ["refers_to"], "left")
