"""Legacy web archives to WARC.

``write_arc`` stores pages as ARC files (version 1 or 2, gzip), ``read_arc`` parses any ARC file,
``write_warc`` synthesises the equivalent WARC records and stores them, ``read_warc`` reads them back.

* ARC: the first record of a file is ``filedesc:`` with the version block; its field line says which header
  layout follows (5 fields in version 1, 10 in version 2). A header line ends with the declared length of
  its block; the reader takes exactly that many bytes, then one line feed. A header with a field count of
  neither version, a length that is no number or a block cut short raise ArchiveError.
* WARC: record ids are UUIDs of version 5 over (file, place in it, archive date, URL, payload digest), 14-digit
  dates become ISO 8601, ``filedesc:`` becomes warcinfo, ``dns:`` resource, HTTP responses response, everything else resource.
  Of responses with equal payloads of at least REVISIT_BYTES bytes those with the largest sequence id stay responses, the
  others become revisit records without payload that refer to one of them.
* The choice of responses needs digests, lengths and ids alone: ``read_arc`` gives them without blocks, ``choose_responses`` joins them,
  and ``write_warc`` meets the choices of a file with the file as it is stored. No block is shuffled unpacked, payloads are hashed once.
* Files are written by Spark's own text writer with the record end as line separator (strings keep their bytes
  through it), so a lost executor's half-written file is never seen and any file system that Spark writes to will do. A file
  written here has at most FILE_RECORDS records. A file is read as one value (Spark's limit for one is 2 GB), unpacked as a stream
  and emitted in bounded batches.

Defined cases: a null html is an empty payload; a null url becomes ``urn:unknown``, white space in URLs is
percent-encoded; repeated rows give one record each, with ids of their own; equal payloads under the largest sequence id are
responses all, and a null id is smaller than any other; empty tables give archives with only the description record or none; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronofold.llm.common import clean_shuffles, materialize, scratch_path

REVISIT_BYTES = 1000
ARC_DATE = "20240101000000"
SEQUENCE_HEADER = "X-Archive-Sequence"
BATCH_BYTES = 8 << 20
FILE_RECORDS = 4096
#: Spark's text writer packs with this level of gzip; the archives are scratch.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": FILE_RECORDS}
V1_FIELDS = "URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
WARC_VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """An archive whose bytes do not follow its format."""


def _filedesc(version: int, name: str) -> bytes:
    block = f"{version} 0 chronofold\n{V1_FIELDS if version == 1 else V2_FIELDS}\n".encode()
    middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {ARC_DATE} {middle} {len(block)}\n".encode() + block


def _arc_record(version: int, name: str, url: str | None, seq: int | None, html: str | None) -> bytes:
    payload = (html or "").encode("utf-8", "surrogatepass")
    tag = "" if seq is None else f"{SEQUENCE_HEADER}: {seq}\r\n"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{tag}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    place = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "urn:unknown")
    middle = "text/html" if version == 1 else f"text/html 200 {base64.b32encode(hashlib.sha1(payload).digest()).decode()} - 0 {name}"
    return f"{place} 0.0.0.0 {ARC_DATE} {middle} {len(block)}\n".encode() + block


def _arc_lines(version_by: str):
    def run(batches):
        from pyspark import TaskContext

        part, written = TaskContext.get().partitionId(), 0
        version = 1 + part % 2 if version_by == "partition" else int(version_by)
        held, size = [], 0
        for batch in batches:
            for url, seq, html in zip(*(batch.column(c).to_pylist() for c in ("url", "seq", "html"))):
                if written % FILE_RECORDS == 0:  # the writer begins a file here
                    name = f"pages-{part:06d}-{written // FILE_RECORDS:06d}.arc.gz"
                    held.append(_filedesc(version, name))
                    written += 1
                held.append(_arc_record(version, name, url, seq, html))
                written += 1
                size += len(held[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])
                    held, size = [], 0
        if not written:
            held.append(_filedesc(version, f"pages-{part:06d}-000000.arc.gz"))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["record"])

    return run


def write_arc(pages: DataFrame, path: str, version_by: str = "partition", key: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Writes ARC files of at most FILE_RECORDS records; version_by: "1", "2" or "partition" (alternating)."""
    rows = pages.select(F.col(url).alias("url"), F.col(key).cast("long").alias("seq"), F.col(html).alias("html"))
    lines = rows.mapInArrow(_arc_lines(version_by), "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.mode("overwrite").option("lineSep", "\n").options(**PACKED).text(path)
    return path


class _Stream:
    """Sequential reader over plain or gzip bytes (any number of members); holds only what is not yet taken."""

    def __init__(self, raw: bytes, chunk: int = 1 << 20):
        self.raw, self.chunk, self.at, self.held = memoryview(raw), chunk, 0, bytearray()
        self.zip = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.zip is not None and self.zip.unconsumed_tail:
            self.held += self.zip.decompress(self.zip.unconsumed_tail, self.chunk)
            return True
        if self.zip is not None and self.zip.eof:
            rest = self.zip.unused_data
            if not rest and self.at >= len(self.raw):
                return False
            self.zip = zlib.decompressobj(31)
            piece = rest or bytes(self.raw[self.at : self.at + self.chunk])
            self.at += 0 if rest else len(piece)
            self.held += self.zip.decompress(piece, self.chunk)
            return True
        if self.at >= len(self.raw):
            return False
        piece = bytes(self.raw[self.at : self.at + self.chunk])
        self.at += len(piece)
        self.held += self.zip.decompress(piece, self.chunk) if self.zip is not None else piece
        return True

    def line(self, end: bytes) -> bytes | None:
        """Bytes before end, which is taken too; None at the end of the stream."""
        start = 0
        while (found := self.held.find(end, start)) < 0:
            start = max(len(self.held) - len(end), 0)
            if not self._more():
                if self.held:
                    raise ArchiveError("a header is cut short")
                return None
        out = bytes(self.held[:found])
        del self.held[: found + len(end)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ArchiveError(f"a block of {n} bytes is cut short")
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, ends: bytes) -> None:
        """Takes record ends; at the end of the stream they may be missing."""
        for _ in ends:
            if not self.held and not self._more():
                return
            del self.held[:1]


def parse_arc(raw: bytes) -> Iterator[dict]:
    """Records of one ARC file: url, ip, date, mime, status, checksum and block, by the layout its version block declares."""
    stream, layout = _Stream(raw), None
    while (line := stream.line(b"\n")) is not None:
        if not line.strip():
            continue
        fields = line.decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        if not fields[-1].isdigit():
            raise ArchiveError("a header line declares no length")
        block = stream.take(int(fields[-1]))
        stream.skip(b"\n")
        if fields[0].startswith("filedesc:"):
            layout = len(block.decode("utf-8", "replace").split("\n")[1].split()) if block.count(b"\n") > 1 else len(fields)
        if len(fields) not in (5, 10) or (layout and len(fields) != layout):
            raise ArchiveError(f"a header line of {len(fields)} fields fits no version")
        two = len(fields) == 10
        yield {
            "url": fields[0], "ip": fields[1], "date": fields[2], "mime": fields[3], "status": fields[4] if two else None,
            "checksum": fields[5] if two and fields[5] != "-" else None, "block": block,
        }


def split_http(block: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (lower case) and payload of an HTTP response block, or None."""
    if not block.startswith(b"HTTP/"):
        return None
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        return None
    pairs = (x.split(":", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}, payload


def _converted(record: dict, file: str, place: int, digest: str | None = None) -> dict:
    """The WARC side of an ARC record, the place-th of a file: type, id, ISO date, digest (computed if not given) and block."""
    block, http = record["block"], split_http(record["block"])
    scheme = record["url"].split(":", 1)[0]
    kind = {"filedesc": "warcinfo", "dns": "resource"}.get(scheme, "response" if http else "resource")
    payload = http[1] if http else block
    seq = http[0].get(SEQUENCE_HEADER.lower()) if http else None
    digest = digest or hashlib.sha1(payload).hexdigest()
    digits = record["date"].ljust(14, "0")[:14]
    date = f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"
    name = f"{file} {place} {record['date']} {record['url']} {digest}"
    return {
        "place": place, "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}", "kind": kind, "url": record["url"], "ip": record["ip"],
        "date": date, "mime": "application/http;msgtype=response" if http else record["mime"], "seq": int(seq) if seq else None,
        "payload_digest": digest, "payload_bytes": len(payload), "block": block,
    }


def _batched(records: Iterator[dict], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in records:
        held.append(r)
        size += size_of(r)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


_ARROW = pa.schema([
    ("file", pa.string()), ("place", pa.int32()), ("record_id", pa.string()), ("kind", pa.string()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()),
    ("mime", pa.string()), ("seq", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("block", pa.binary()),
])
CONVERTED = "file string, place int, record_id string, kind string, url string, ip string, date string, mime string, seq long, payload_digest string, payload_bytes long, block binary"


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _arc_to_rows(blocks: bool):
    def rows(path, content):
        for place, record in enumerate(parse_arc(content)):
            row = _converted(record, _name(path), place) | {"file": path}
            yield row if blocks else row | {"block": None}

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = (batch.column(c)[i].as_py() for c in ("path", "content"))
                yield from _batched(rows(path, content), _ARROW, lambda r: 256 + len(r["block"] or b""))

    return run


def read_arc(spark, path: str, blocks: bool = True) -> DataFrame:
    """Every record of the ARC files under path with its file and place, its WARC identifiers, dates, type and digest."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_arc_to_rows(blocks), CONVERTED)


def choose_responses(converted: DataFrame) -> DataFrame:
    """(file, place, payload_digest, first_id, first_url, first_date) of every record; of the response that a repeated payload
    stands for, or null."""
    big = (F.col("kind") == "response") & (F.col("payload_bytes") >= REVISIT_BYTES)
    groups = converted.where(big).groupBy("payload_digest", "payload_bytes")
    chosen = groups.agg(F.max(F.struct("seq", "record_id", "url", "date")).alias("c"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    chosen = chosen.select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), "c")
    same = big & (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b"))
    later = F.col("d").isNotNull() & ~F.col("seq").eqNullSafe(F.col("c")["seq"])
    first = [F.when(later, F.col("c")[c]).alias(f"first_{k}") for c, k in (("record_id", "id"), ("url", "url"), ("date", "date"))]
    return converted.join(chosen, same, "left").select("file", "place", "payload_digest", *first)


def _warc_record(r: dict, first: dict | None = None) -> bytes:
    """The bytes of a record; first: id, url and date of the response that it revisits."""
    block, kind, extra = r["block"], r["kind"], ""
    if first:
        block, kind = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n", "revisit"
        extra = f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{first['first_id']}>\r\nWARC-Refers-To-Target-URI: {first['first_url']}\r\nWARC-Refers-To-Date: {first['first_date']}\r\n"
    b32 = lambda digest: base64.b32encode(digest).decode()
    where = "" if kind == "warcinfo" else f"WARC-Target-URI: {r['url']}\r\nWARC-IP-Address: {r['ip']}\r\nWARC-Payload-Digest: sha1:{b32(bytes.fromhex(r['payload_digest']))}\r\n"
    mime = "application/warc-fields" if kind == "warcinfo" else r["mime"]
    head = (
        f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{r['record_id']}>\r\nWARC-Date: {r['date']}\r\n{where}{extra}"
        f"WARC-Block-Digest: sha1:{b32(hashlib.sha1(block).digest())}\r\nContent-Type: {mime}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode("utf-8", "surrogateescape") + block


def _warc_lines(batches):
    def records(path, content, choices):
        known = {c["place"]: c for c in choices}
        for place, record in enumerate(parse_arc(content)):
            choice = known[place]
            yield {"record": _warc_record(_converted(record, _name(path), place, choice["payload_digest"]), choice if choice["first_id"] else None)}

    for batch in batches:
        for i in range(batch.num_rows):
            path, content, choices = (batch.column(c)[i].as_py() for c in ("path", "content", "choices"))
            yield from _batched(records(path, content, choices), pa.schema([("record", pa.binary())]), lambda r: len(r["record"]))


def write_warc(spark, arc: str, path: str) -> str:
    """Writes the ARC files under arc as WARC 1.1 files, gzip; the two line ends after each block are the writer's line separator."""
    choices = choose_responses(read_arc(spark, arc, blocks=False)).groupBy("file").agg(F.collect_list(F.struct("place", "payload_digest", "first_id", "first_url", "first_date")).alias("choices"))
    files = spark.read.format("binaryFile").load(arc).select("path", "content")
    whole = files.join(choices.hint("shuffle_hash"), F.col("path") == F.col("file")).select("path", "content", "choices")
    lines = whole.mapInArrow(_warc_lines, "record binary").select(F.col("record").cast("string").alias("value"))
    with clean_shuffles(spark):
        lines.write.mode("overwrite").option("lineSep", "\r\n\r\n").options(**PACKED).text(path)
    return path


def parse_warc(raw: bytes) -> Iterator[dict]:
    """Records of one WARC file: headers (lower-case names) and block."""
    stream = _Stream(raw)
    while (head := stream.line(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "surrogateescape").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ArchiveError("a record does not begin with its version")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        if not headers.get("content-length", "").isdigit():
            raise ArchiveError("a record declares no length")
        block = stream.take(int(headers["content-length"]))
        stream.skip(b"\r\n\r\n")
        yield {"headers": headers, "block": block}


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _hex_digest(value: str | None) -> str | None:
    return base64.b32decode(value.partition(":")[2]).hex() if value else None


def _read_row(r: dict) -> dict:
    h, http = r["headers"], split_http(r["block"])
    payload = http[1] if http else r["block"]
    seq, size = (http[0].get(SEQUENCE_HEADER.lower()), http[0].get("content-length")) if http else (None, None)
    kind, declared = h.get("warc-type"), _hex_digest(h.get("warc-payload-digest"))
    if kind != "revisit" and declared and hashlib.sha1(payload).hexdigest() != declared:
        raise ArchiveError(f"the payload of {h.get('warc-record-id')} does not match its digest")
    return {
        "record_id": _bare(h.get("warc-record-id")), "record_type": kind, "url": h.get("warc-target-uri"), "date": h.get("warc-date"),
        "seq": int(seq) if seq else None, "payload_digest": declared, "refers_to_id": _bare(h.get("warc-refers-to")),
        "payload_bytes": (int(size) if size and size.isdigit() else None) if kind == "revisit" else len(payload), "payload": None if kind == "revisit" else payload,
    }


_READ = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()), ("seq", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
READ = "record_id string, record_type string, url string, date string, seq long, payload_digest string, refers_to_id string, payload_bytes long, payload binary"


def _warc_to_rows(payloads: bool):
    def rows(content):
        for record in parse_warc(content):
            row = _read_row(record)
            yield row if payloads else row | {"payload": None}

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _batched(rows(batch.column("content")[i].as_py()), _READ, lambda r: 256 + len(r["payload"] or b""))

    return run


def read_warc(spark, path: str, payloads: bool = True) -> DataFrame:
    """Records of the WARC files under path; payload is null for revisits, whose payload_bytes are those that their HTTP header
    declares. Digests are checked, and hexadecimal."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_warc_to_rows(payloads), READ)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(seq, record_type, payload_bytes, payload_digest, refers_to) of all responses and revisits; refers_to is the sequence id of the
    response that a revisit refers to."""
    lean = records.where(F.col("record_type").isin("response", "revisit")).select("record_id", "record_type", "seq", "payload_bytes", "payload_digest", "refers_to_id")
    referred = lean.where(F.col("record_type") == "revisit").select(F.col("refers_to_id").alias("id")).distinct()
    named = lean.where(F.col("record_type") == "response").select(F.col("record_id").alias("id"), F.col("seq").alias("refers_to"), F.col("payload_bytes").alias("declared"))
    named = named.join(referred, "id", "left_semi")
    out = lean.join(named, F.col("refers_to_id") == F.col("id"), "left")
    return out.select("seq", "record_type", F.coalesce("payload_bytes", "declared").alias("payload_bytes"), "payload_digest", "refers_to")


def convert_pages(pages: DataFrame) -> DataFrame:
    """pages -> ARC files -> WARC files -> records read back, as resolve_revisits returns them."""
    spark = pages.sparkSession
    arc = write_arc(pages, scratch_path(spark, "arc"))
    warc = write_warc(spark, arc, scratch_path(spark, "warc"))
    return resolve_revisits(materialize(read_warc(spark, warc, payloads=False).drop("payload"), "warc-records"))
