"""WARC archives: a writer with revisit records and a reader that salvages what it can."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.prefix import partitions
from riskloom.session import shared_folder, stage

#: Bytes of records after which a writer begins another file.
FILE_BYTES = 128 << 20
#: Bytes read from an archive at a time.
CHUNK = 1 << 20
#: Longest header block and record block that the reader takes a plain record's word for; those
#: inside a member that unpacked end with it at the latest.
HEADER_BYTES = 64 << 10
RECORD_BYTES = 1 << 30
#: Longest unpacked member: a row's html and its escaped url have 2 GiB and 6 GiB at most.
MEMBER_BYTES = 9 << 30
VERSIONS = (b"WARC/1.1\r\n", b"WARC/1.0\r\n")
MEMBER = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the payload's SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(value: str | None) -> int | None:
    text = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def _clean(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def encode_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One response or revisit record, uncompressed; a revisit has the header of its response."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_clean(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head = VERSIONS[0] + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return head + block + b"\r\n\r\n"


def compress_member(record: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@dataclass
class Record:
    """A record that passed all checks; ``payload`` is empty for revisits."""

    offset: int
    headers: dict[str, str]
    payload: bytes
    payload_bytes: int


@dataclass
class Gap:
    """Bytes that belong to no valid record."""

    start: int
    end: int
    reason: str


class Damaged(Exception):
    """What stands at an offset is no valid record."""


@dataclass
class _Window:
    """The bytes of a file from ``base`` on, as far as they were read and are still needed."""

    read: Callable[[int], bytes]
    base: int = 0
    data: bytearray = field(default_factory=bytearray)
    ended: bool = False

    def more(self) -> bool:
        if not self.ended:
            found = self.read(CHUNK)
            self.data += found
            self.ended = not found
        return not self.ended

    def get(self, offset: int, length: int) -> bytes:
        while self.base + len(self.data) < offset + length and self.more():
            pass
        return bytes(self.data[offset - self.base : offset - self.base + length])

    def drop(self, offset: int) -> None:
        if offset - self.base > CHUNK:
            del self.data[: offset - self.base]
            self.base = offset


def _member(window: _Window, offset: int) -> tuple[bytes, int]:
    """Contents of the gzip member at an offset, checked by its trailer, and where it ends."""
    unpacker = zlib.decompressobj(31)
    out, at = [], offset
    size, step = 0, 4096
    try:
        while not unpacker.eof:
            piece = window.get(at, step)
            step = min(2 * step, CHUNK)
            if not piece:
                raise Damaged("member cut short")
            out.append(unpacker.decompress(piece, MEMBER_BYTES))
            size += len(out[-1])
            if size > MEMBER_BYTES or unpacker.unconsumed_tail:
                raise Damaged("member too long")
            at += len(piece) - len(unpacker.unused_data)
    except zlib.error as error:
        raise Damaged("member does not unpack") from error
    return b"".join(out), at


def _headers(block: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in block.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a name")
        found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def _parse(get: Callable[[int, int], bytes], offset: int, member: bytes | None = None) -> tuple[Record, int]:
    """The record at an offset, with its version, lengths and digests checked, and its end.

    In an unpacked ``member`` the header and the block may be as long as the member.
    """
    version = get(offset, len(VERSIONS[0]))
    if version not in VERSIONS:
        raise Damaged("no version line")
    if member is not None:
        end = member.find(b"\r\n\r\n", offset) - offset
        if end < 0:
            raise Damaged("header without an end")
        head = member[offset : offset + end]
    else:
        size = 1024
        while (end := (head := get(offset, size)).find(b"\r\n\r\n")) < 0:
            if len(head) < size or size > HEADER_BYTES:
                raise Damaged("header without an end")
            size *= 4
    headers = _headers(head[len(version) : end])
    length = headers.get("content-length", "")
    if not length.isdigit() or int(length) > (RECORD_BYTES if member is None else len(member)):
        raise Damaged("no usable length")
    start, stop = offset + end + 4, offset + end + 4 + int(length)
    block = get(start, int(length))
    if get(stop, 4) != b"\r\n\r\n":
        raise Damaged("record does not end where its length says")
    digest = headers.get("warc-block-digest", "").removeprefix("sha1:")
    if digest and digest != payload_digest(block):
        raise Damaged("block digest differs")
    kind = headers.get("warc-type")
    http, payload = b"", block
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    size = len(payload)
    if kind == "revisit":
        for line in http.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length" and value.strip().isdigit():
                size = int(value)
    else:
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if digest and digest != payload_digest(payload):
            raise Damaged("payload digest differs")
    return Record(offset, headers, payload, size), stop + 4


def _records_at(window: _Window, offset: int) -> tuple[list[Record], int, Gap | None]:
    """Records of the member or plain record at an offset, their end, and damage inside."""
    if window.get(offset, len(MEMBER)) != MEMBER:
        record, end = _parse(window.get, offset)
        return [record], end, None
    data, end = _member(window, offset)
    records, at, hurt = [], 0, None
    while at < len(data):
        try:
            record, at = _parse(lambda i, n: data[i : i + n], at, data)
        except Damaged as reason:
            # the member unpacked, so what follows the damage in it is searched as well
            found = [i for v in VERSIONS if (i := data.find(v, at + 1)) >= 0]
            hurt = Gap(offset, end, f"inside a member: {reason}")
            if not found:
                break
            at = min(found)
            continue
        record.offset = offset
        records.append(record)
    return records, end, hurt


def _next_start(window: _Window, offset: int) -> int | None:
    """The next offset after ``offset`` at which a member or version line may begin."""
    marks = (MEMBER, *VERSIONS)
    at = offset + 1
    while True:
        data = window.get(at, CHUNK)
        found = [i for m in marks if (i := data.find(m)) >= 0]
        if found:
            return at + min(found)
        if len(data) < CHUNK:
            return None
        at += CHUNK - max(map(len, marks)) + 1
        window.drop(at)


def salvage(read: Callable[[int], bytes]) -> Iterator[Record | Gap]:
    """All valid records of an archive in order, and the byte ranges that hold none.

    ``read(n)`` gives the next bytes, none at the end.  Compressed members and plain records may be
    mixed.  A record that fails a check (unpacking, version line, lengths, digests) is put aside:
    the search goes on one byte after its start for the next gzip member or version line that holds
    a valid record, and the bytes between are one gap.  Memory holds one record and one chunk.
    """
    window = _Window(read)
    offset, lost, reason = 0, None, ""
    while window.get(offset, 1):
        try:
            records, end, hurt = _records_at(window, offset)
            if hurt is not None and not records:
                raise Damaged(hurt.reason)
        except Damaged as damage:
            if lost is None:
                lost, reason = offset, str(damage)
            following = _next_start(window, offset)
            if following is None:
                while window.more():
                    window.drop(window.base + len(window.data))
                yield Gap(lost, window.base + len(window.data), reason)
                return
            # bytes of the gap need not be kept, as the search never goes back
            window.drop(following)
            offset = following
            continue
        if lost is not None:
            yield Gap(lost, offset, reason)
            lost = None
        if hurt is not None:
            yield hurt
        yield from records
        offset = end
        window.drop(offset)


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _with_first(rows: DataFrame) -> DataFrame:
    """Add the smallest page of each payload digest.

    The smallest pages are stored, so that the join is one of plain exchanges and a frequent
    payload's rows are split over tasks.
    """
    first = stage(rows.groupBy("sha1").agg(F.min("page").alias("first")), "warc-first")
    return rows.join(first, "sha1")


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    least_bytes: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Write one record per row to gzip archives and return the stored list of files.

    The payload is the html in UTF-8, empty for null.  Of rows with equal payloads of at least
    ``least_bytes`` bytes, those with the smallest id are responses and the others revisit it;
    null ids come last and revisit too, or are responses where no id is known.  Smaller payloads
    are all responses.  The smallest id per payload digest comes from a sum over tasks, so a
    payload that a third of all rows share needs no task of its own: the sum is stored before the
    join, in which the payload's rows can so be split.  Each task writes files of
    about ``FILE_BYTES`` under new names and only listed files are read, so tasks may run again.
    Returns ``path, records, bytes``; an empty table gives no files.
    """
    folder = folder or f"{shared_folder(pages.sparkSession).rstrip('/')}/riskloom/warc-{uuid.uuid4().hex}"
    system, path = _open(folder)
    system.create_dir(path)
    html = F.coalesce(F.col(html_column).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_column).cast("long").alias("page"),
        F.col(url_column).cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
    )
    long = F.octet_length("html") >= least_bytes
    rows = _with_first(rows).select(
        "page",
        "url",
        "html",
        "first",
        (long & F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))).alias("again"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        system, path = _open(folder)
        files, out = [], None
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, first, again = (batch.column(k)[i].as_py() for k in range(5))
                if out is None:
                    files.append([f"{task}-{len(files):04d}.warc.gz", 0, 0])
                    out = system.open_output_stream(f"{path}/{files[-1][0]}", compression=None)
                member = compress_member(encode_record(page, url, html.encode("utf-8"), first, again))
                out.write(member)
                files[-1][1] += 1
                files[-1][2] += len(member)
                if files[-1][2] >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if files:
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [f"{folder.rstrip('/')}/{f[0]}" for f in files],
                    "records": [f[1] for f in files],
                    "bytes": [f[2] for f in files],
                }
            )

    return stage(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame, complete: bool = False) -> DataFrame:
    """Every valid record and every byte gap of the archives listed in column ``path``.

    With ``complete`` the read fails at a file that gives another number of records than its column
    ``records`` says.

    Rows: ``path, offset, page_id, url, record_type, refers_to, payload_digest, payload_bytes,
    payload, gap_end, gap_reason``; a gap has only path, offset, end and reason.  Of a revisit,
    digest and size are those of the response's full payload, and ``payload`` is null.
    """
    schema = (
        "path string, offset long, page_id long, url string, record_type string, refers_to long,"
        " payload_digest string, payload_bytes long, payload binary, gap_end long, gap_reason string"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uri, wanted in ((r["path"], r.get("records")) for batch in batches for r in batch.to_pylist()):
            folder, _, name = uri.rpartition("/")
            system, path = _open(folder)
            rows, size, met = [], 0, 0
            with system.open_input_stream(f"{path}/{name}", compression=None) as file:
                for x in salvage(file.read):
                    if isinstance(x, Gap):
                        rows.append((uri, x.start, *[None] * 7, x.end, x.reason))
                        continue
                    met += 1
                    h, revisit = x.headers, x.headers.get("warc-type") == "revisit"
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append(
                        (
                            uri,
                            x.offset,
                            _page(h.get("warc-record-id")),
                            h.get("warc-target-uri"),
                            h.get("warc-type"),
                            _page(h.get("warc-refers-to")) if revisit else None,
                            digest or payload_digest(x.payload),
                            x.payload_bytes,
                            None if revisit else x.payload,
                            None,
                            None,
                        )
                    )
                    size += len(x.payload)
                    if size > 4 * CHUNK or len(rows) >= 1000:
                        yield batch_of(rows)
                        rows, size = [], 0
            if wanted is not None and met != wanted:
                raise RuntimeError(f"{uri}: {met} records read of {wanted} written")
            if rows:
                yield batch_of(rows)

    each = files.select("path", *["records"] * complete).repartition(partitions(files), "path")
    return each.mapInArrow(read, schema)
