"""Legacy archive converter: ARC files (versions 1 and 2) to WARC 1.1.

An ARC file begins with a filedesc record whose body names the version and the fields of the
header lines that follow; each record is a header line, as many bytes as its last field declares,
and a line feed. The converter parses those, and synthesises what WARC needs and ARC lacks: record
identifiers (from URL, date and position, so that a second run gives the same), ISO timestamps,
types, and digests of block and payload. An HTTP answer becomes a response; among equal payloads the
one of least key is the response, the others are revisits that name it. Other blocks (dns, ftp)
become resource records, whole, with the content type of their header line. The filedesc record
becomes a warcinfo record that begins each file with that record's text.

Pages are converted once; the converted records are written, and duplicates are found in their narrow
columns. Archives are written record by record as gzip members by the tasks that hold the records,
and read back as binary files of bounded size, those that the finished tasks have named. Payloads are
shuffled only where duplicates don't fit a broadcast of checked size.

Defined cases: a null html is an empty payload; a null url becomes about:blank, and white space in
one is percent-encoded, since ARC parts its fields by spaces (of a header line with more of them, the first
belong to the URL); an answer's head ends at the first blank line, of CRLF or bare line feeds, and an
answer without one is a resource; a null page_id is a response and
never referred to; repeated rows with the least page_id are all responses. A truncated or
malformed ARC record raises, or is kept as a reject. An empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, new_folder, table, text_or_empty
from strainflow.llm.files import check_folder, only, whole_file
from strainflow.llm.words import chunks

#: Header lines of ARC by version (fixed by the format).
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The blank line after an answer's head.
BLANK = b"\r\n\r\n"
#: Compressed bytes after which a task begins another file.
FILE_BYTES = 128 << 20
#: Payloads that occur more than once, up to which they are broadcast.
BROADCAST_GROUPS = 50_000
#: More files than this aren't broadcast.
BROADCAST_FILES = 100_000
#: Bytes of a file that are inflated at a time.
PIECE = 64 << 10


class DamagedError(ValueError):
    """A record that can't be read; at: its place in the file."""

    def __init__(self, text: str, at: int):
        super().__init__(text)
        self.at = at


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_file(name: str, version: int, records: list[tuple[str, str, str, str, bytes]]) -> bytes:
    """An uncompressed ARC file of (url, ip, 14-digit date, content type, block)."""
    about = f"{version} 0 strainflow\n{FIELDS[version]}\n\n".encode()
    out = [f"filedesc://{name} 0.0.0.0 20000101000000 text/plain {'200 - - 0 ' + name + ' ' if version == 2 else ''}{len(about)}\n".encode(), about, b"\n"]
    for url, ip, date, kind, block in records:
        extra = f"200 {digest(block)} - {sum(map(len, out))} {name} " if version == 2 else ""
        out += [f"{url} {ip} {date} {kind} {extra}{len(block)}\n".encode(), block, b"\n"]
    return b"".join(out)


def encoded(url: str) -> str:
    """A URL whose white space is percent-encoded."""
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def unpacked(data: bytes) -> bytes:
    """An ARC file's bytes, of gzip members if it begins as one."""
    return b"".join(_inflated(memoryview(data))) if data[:2] == b"\x1f\x8b" else data


def parted(block: bytes) -> tuple[bytes, bytes] | None:
    """Head (with its blank line) and payload of an HTTP answer, whose lines end in CRLF or in bare line
    feeds; None if it has no blank line or is no answer."""
    if not block.startswith(b"HTTP/"):
        return None
    ends = [at + len(gap) for gap in (b"\r\n\r\n", b"\n\n") if (at := block.find(gap)) >= 0]
    return (block[: min(ends)], block[min(ends) :]) if ends else None


def arc_about(data: bytes) -> tuple[str, int]:
    """The text of the filedesc record, and where the next record begins."""
    end = data.index(b"\n")
    first = data[:end].decode().split(" ")
    if not first[0].startswith("filedesc://"):
        raise ValueError("not an ARC file: no filedesc record")
    stop = end + 1 + int(first[-1])
    return data[end + 1 : stop].decode(), stop


def arc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record after the filedesc."""
    text, at = arc_about(data)
    about = text.split("\n")
    version, names = int(about[0].split(" ")[0]), about[1].split(" ")
    if version not in FIELDS:
        raise ValueError(f"ARC version {version} is unknown")
    while True:
        while data[at : at + 1] == b"\n":
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        if end < 0:
            raise DamagedError("an ARC header line without its end", at)
        # from the right: a URL may hold blanks
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise DamagedError(f"an ARC header line of {len(values)} fields, not {len(names)}", at)
        fields = dict(zip(names, values, strict=True))
        if not fields["Archive-length"].isdigit():
            raise DamagedError(f"an ARC record of length {fields['Archive-length']}", at)
        size = int(fields["Archive-length"])
        if end + 1 + size > len(data):
            raise DamagedError("an ARC record ends before its declared length", at)
        yield fields, data[end + 1 : end + 1 + size]
        at = end + 1 + size


RECORDS = "url string, ip string, date string, kind string, type string, record_id string, about string, http binary, payload binary, payload_digest string"


def convert(arcs: DataFrame, column: str = "arc", rejects: bool = False) -> DataFrame:
    """(url, ip, date, kind, type, record_id, about, http binary, payload binary, payload_digest) of
    each record in a column of whole ARC files, plain or of gzip members; type is response or
    resource, about the text of the file's filedesc record. White space in a URL is percent-encoded.
    With `rejects`, a damaged record doesn't raise: it and what follows it in its file, which can't
    be parted, are one row of type reject, whose about says why and where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, whole, about = [], b"", ""
                try:
                    whole = unpacked(data.as_py())
                    about = arc_about(whole)[0]
                    for at, (f, block) in enumerate(arc_records(whole)):
                        http, payload = parted(block) or (b"", block)
                        date = f["Archive-date"].ljust(14, "0")
                        date = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
                        url = encoded(f["URL"])
                        id_ = uuid.uuid5(uuid.NAMESPACE_URL, f"{url} {date} {at} {hashlib.sha1(http.removesuffix(BLANK)).hexdigest()}")
                        rows.append((url, f["IP-address"], date, f["Content-type"], "response" if http else "resource", f"<urn:uuid:{id_}>", about, http, payload, digest(payload)))
                except (ValueError, zlib.error) as e:
                    if not rejects:
                        raise
                    at = getattr(e, "at", 0)
                    rest = whole[at:] or data.as_py()
                    rows.append((None, None, None, None, "reject", None, f"{e} at byte {at}", b"", rest, digest(rest)))
                kinds = [pa.string()] * 7 + [pa.binary(), pa.binary(), pa.string()]
                names = ["url", "ip", "date", "kind", "type", "record_id", "about", "http", "payload", "payload_digest"]
                yield pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(10)], names)

    return arcs.select(column).mapInArrow(run, RECORDS)


def mark_revisits(records: DataFrame, key: str, least_bytes: int = 0) -> DataFrame:
    """records with refers_to and refers_to_id, those of the response that a revisit repeats. The
    column payload_bytes tells sizes, so that no payload is read to find the groups."""
    size = F.col("payload_bytes")
    groups = records.filter(F.col(key).isNotNull() & (F.col("type") == "response") & (size >= least_bytes)).groupBy(F.col("payload_digest").alias("_d"), size.alias("_n"))
    first = groups.agg(F.count("*").alias("_copies"), F.min(F.struct(F.col(key).alias("key"), F.col("record_id").alias("id"))).alias("_first")).filter("_copies > 1").drop("_copies")
    few = first.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    joined = records.join(F.broadcast(first) if few else first, (F.col("payload_digest") == F.col("_d")) & (size == F.col("_n")), "left")
    again = (F.col("type") == "response") & (F.col(key) > F.col("_first.key"))
    return joined.withColumns({"refers_to": F.when(again, F.col("_first.key")), "refers_to_id": F.when(again, F.col("_first.id"))}).drop("_d", "_n", "_first")


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def fields_of(r: dict, key: str) -> tuple[list[tuple[str, str]], bytes]:
    """Header fields and block of a record's WARC form."""
    again = r["refers_to"] is not None
    block = r["http"] if again else r["http"] + r["payload"]
    fields = [("WARC-Type", "revisit" if again else r["type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["url"])]
    kind = "application/http;msgtype=response" if r["type"] == "response" else r["kind"]
    fields += [("WARC-IP-Address", r["ip"]), ("Content-Type", kind), ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if again:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", r["refers_to_id"]), ("X-Refers-To-Key", str(r["refers_to"])), ("X-Payload-Bytes", str(r["payload_bytes"]))]
    return fields + ([("X-Key", str(r[key]))] if r[key] is not None else []), block


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(warc_record(fields, block)) + packer.flush()


def write_warc(records: DataFrame, folder: str, key: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes records (of mark_revisits) as .warc.gz files; (file, records, bytes) of each file, once
    its task has ended. A file begins with a warcinfo record of its first record's archive."""
    check_folder(folder)
    columns = ["url", "ip", "date", "kind", "type", "record_id", "about", "http", "payload", "payload_digest", "payload_bytes", key, "refers_to", "refers_to_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        rows = (row for batch in batches for some in chunks([batch]) for row in some.to_pylist())
        row, number = next(rows, None), 0
        while row is not None:
            name = f"part-{part:06d}-{number:06d}-{attempt}.warc.gz"
            with whole_file(folder, name) as stream:
                about = row["about"].encode()
                info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", row["date"]), ("WARC-Filename", name), ("Content-Type", "text/plain")]
                head = _member(info, about)
                stream.write(head)
                count, size = 0, len(head)
                while row is not None and size < file_bytes:
                    packed = _member(*fields_of(row, key))
                    stream.write(packed)
                    count, size, row = count + 1, size + len(packed), next(rows, None)
            yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["file", "records", "bytes"])
            number += 1

    return records.select(*columns).mapInArrow(run, "file string, records bigint, bytes bigint")


def _inflated(data: memoryview) -> Iterator[bytes]:
    """Each gzip member; pieces are fed one by one, since what follows a member is copied."""
    at = 0
    while at < len(data):
        member, out = zlib.decompressobj(31), []
        while not member.eof:
            if at >= len(data):
                raise ValueError("a gzip member without its end")
            out.append(member.decompress(data[at : at + PIECE]))
            at += PIECE
        at = min(at, len(data)) - len(member.unused_data)
        yield b"".join(out)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record in a file of gzip members."""
    for record in _inflated(memoryview(data)):
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        if rest[size:] != b"\r\n\r\n":
            raise ValueError("a WARC record that differs from its declared length")
        yield fields, rest[:size]


def payload_of(fields: dict[str, str], block: bytes) -> tuple[int, str]:
    """Bytes and digest of a record's payload: what follows an answer's head, a resource's whole block."""
    if fields["WARC-Type"] == "revisit":
        return int(fields["X-Payload-Bytes"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = (parted(block) or (b"", block))[1] if fields["WARC-Type"] == "response" else block
    return len(payload), digest(payload)


def read_warc(spark, folder: str, files: DataFrame | None = None) -> DataFrame:
    """(key, record_type, refers_to, payload_bytes, payload_digest) of each record but warcinfo in
    all files, or in those that `files` (of write_warc()) names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = ["key", "record_type", "refers_to", "payload_bytes", "payload_digest"]
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for f, block in warc_records(data.as_buffer()):
                    if f["WARC-Type"] != "warcinfo":
                        rows.append((f.get("X-Key"), f["WARC-Type"], f.get("X-Refers-To-Key"), *payload_of(f, block)))
                    if len(rows) == 10_000:
                        yield pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], names)
                        rows = []
                yield pa.record_batch([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], names)

    found = only(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder), files, BROADCAST_FILES)
    return found.select("content").mapInArrow(run, "key string, record_type string, refers_to string, payload_bytes bigint, payload_digest string")


def arcs_of_pages(pages: DataFrame) -> DataFrame:
    """Pages as legacy archives, files of version 1 and 2 in turn: column arc."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, batch in enumerate(chunks(batches)):
            records = []
            for r in batch.to_pylist():
                body = r["html"].encode()
                key = "" if r["key"] is None else f"X-Key: {r['key']}\r\n"
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{key}Content-Length: {len(body)}\r\n\r\n".encode()
                url = encoded(r["url"]) or "about:blank"
                records.append((url, "0.0.0.0", "20000101000000", "text/html", http + body))
            yield pa.record_batch([pa.array([arc_file(f"pages-{part}-{number}.arc", 1 + number % 2, records)], pa.binary())], ["arc"])

    page = pages.select(F.col("page_id").alias("key"), text_or_empty("url").alias("url"), text_or_empty("html").alias("html"))
    return page.mapInArrow(run, "arc binary")


def op7_arc_to_warc(spark, sf_dir: str) -> DataFrame:
    """All pages through ARC files, the converter, and WARC files written and read back."""
    pages = table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    key = F.nullif(F.regexp_extract(F.col("http").cast("string"), r"\r\nX-Key: ([^\r]*)", 1), F.lit("")).cast(kind)
    records = convert(arcs_of_pages(pages)).withColumns({"key": key, "payload_bytes": F.octet_length("payload").cast("bigint")})
    marked = mark_revisits(materialize(records, "arc-records"), "key")
    folder = new_folder(spark, "warc")
    files = materialize(write_warc(marked, folder, "key"), "warc-files")
    back = read_warc(spark, folder, files)
    return back.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
