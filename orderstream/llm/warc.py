"""Web archives: WARC files with an index of every record, read back by byte ranges.

Each record is a gzip member of its own, so an archive can be read from any record's
offset. Tasks write archives to a folder of the file system that all executors share
and name them uniquely; the index, a table that Spark commits, refers only to the
archives of tasks that ended well. What a lost task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstream.llm.common import stored
from orderstream.session import scratch

# Bytes of an archive after which a task begins another.
ARCHIVE_BYTES = 256 << 20

# Most bytes that one read fetches, unless a single record is longer.
READ_BYTES = 8 << 20

# Bytes of records that a task reads, on average.
TASK_BYTES = 32 << 20

# Bytes between two selected records that are read along rather than skipped.
GAP_BYTES = 64 << 10

# Pages have no time of their own; every record of an archive needs one.
DATE = "1970-01-01T00:00:00Z"

# Names of the format, and the header fields that name a page.
_VERSION = "WARC/1.1"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE, _REFERS_TO_PAGE = "X-Page-ID", "X-Refers-To-Page-ID"
_LINE = b"\r\n"

INDEX_SCHEMA = (
    "archive STRING, offset BIGINT, length BIGINT, page_id BIGINT, url STRING, payload_digest STRING"
)
RECORD_SCHEMA = (
    "page_id BIGINT, url STRING, record_type STRING, payload_bytes BIGINT, payload_digest STRING,"
    " refers_to BIGINT"
)


def payload(html: Column) -> Column:
    """The UTF-8 of a page, empty if null."""
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def digest_text(data: bytes) -> str:
    """SHA-1 in base 32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


# -- records ------------------------------------------------------------------------


def _header_lines(fields: list[tuple[str, Any]]) -> bytes:
    return b"".join(f"{name}: {value}".encode() + _LINE for name, value in fields if value is not None)


def _header_url(url: str | None) -> str | None:
    """The address without characters that would end a header line."""
    if url is None:
        return None
    return "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)


def record(
    page_id: int | None,
    url: str | None,
    data: bytes,
    response: bool,
    refers_to: int | None,
    record_id: str,
) -> tuple[bytes, str]:
    """One record, not compressed, and the digest of its payload.

    A response has the HTTP headers and the payload, a revisit the headers alone; the
    headers give the length of the full payload in both.
    """
    digest = digest_text(data)
    http = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(data))]
    block = b"HTTP/1.1 200 OK" + _LINE + _header_lines(http) + _LINE
    if response:
        block += data
    fields = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_url(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if response else _REVISIT),
        (_PAGE, page_id),
        (_REFERS_TO_PAGE, None if response else refers_to),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = _VERSION.encode() + _LINE + _header_lines(fields) + _LINE
    return head + block + _LINE + _LINE, digest


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name: value for name, _, value in (line.partition(": ") for line in lines)}


def parse(data: bytes) -> dict[str, Any]:
    """Headers and payload of one record, not compressed.

    The payload of a response is checked against its digest and length; a revisit has
    none of its own (None), only their values.
    """
    head, split, rest = data.partition(_LINE + _LINE)
    if not split or not head.startswith(b"WARC/"):
        raise ValueError("not the beginning of a WARC record")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(_LINE + _LINE)
    size = int(_fields(http)["Content-Length"])
    digest = fields["WARC-Payload-Digest"].partition(":")[2]
    response = fields["WARC-Type"] == "response"
    if response and (len(body) != size or digest_text(body) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    refers_to = fields.get(_REFERS_TO_PAGE)
    return {
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": None if refers_to is None else int(refers_to),
        "payload": body if response else None,
    }


# -- files --------------------------------------------------------------------------


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file, for any scheme that Arrow knows."""
    scheme, colon, path = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(uri)


class _Archives:
    """Archives that one task writes, one after another."""

    def __init__(self, folder: str, most: int) -> None:
        self.system, self.path = _opened(folder)
        self.system.create_dir(self.path, recursive=True)
        self.folder, self.most = folder, most
        self.out, self.name, self.offset = None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Archive, offset and length of a record, compressed and written."""
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        if self.out is None or self.offset and self.offset + len(member) > self.most:
            self.close()
            name = f"{uuid.uuid4().hex}.warc.gz"
            self.out = self.system.open_output_stream(f"{self.path}/{name}", compression=None)
            self.name, self.offset = f"{self.folder}/{name}", 0
        self.out.write(member)
        place = self.name, self.offset, len(member)
        self.offset += len(member)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


# -- writing ------------------------------------------------------------------------


def _decided(pages: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, url, data, response, refers_to`` for every page.

    The largest page_id of equal payloads (null is smallest, then the largest url) has
    the response. Of rows equal in all of that one has it; these are counted and
    written from one of them. Payloads are equal if their SHA-256 is.
    """
    data = payload(F.col("html"))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        data.alias("data"),
        F.unhex(F.sha2(data, 256)).alias("key"),
    )
    # Narrow rows, combined within tasks first, so the copies of one page are no burden.
    same = rows.groupBy("key", "page_id", "url").agg(F.count("*").alias("ties"))
    last = F.max_by(F.struct("page_id", "url", "ties"), F.struct("page_id", "url"))
    groups = same.groupBy("key").agg(last.alias("last"))
    # Stored, so that a payload of very many pages is a skewed key of a plain join.
    groups = stored(groups.select("key", "last.*"), "warc-groups")
    found = rows.alias("r").join(groups.alias("g"), "key")
    small = F.length("r.data") < min_bytes
    is_last = F.col("r.page_id").eqNullSafe(F.col("g.page_id")) & F.col("r.url").eqNullSafe(F.col("g.url"))
    several = is_last & (F.col("ties") > 1) & ~small
    response = small | is_last
    refers_to = F.when(~response, F.col("g.page_id"))
    shown = ["r.page_id", "r.url", "r.data"]
    plain = found.where(~several).select(*shown, response.alias("response"), refers_to.alias("refers_to"))
    if groups.where("ties > 1").isEmpty():
        return plain
    once = found.where(several).select(*shown, "key", "ties").dropDuplicates(["key"])
    each = once.withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("ties"))))
    first = F.col("i") == 1
    repeated = each.select(
        "page_id", "url", "data", first.alias("response"), F.when(~first, F.col("page_id")).alias("refers_to")
    )
    return plain.unionByName(repeated)


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``page_id, url, html``; the index of all records.

    Of pages with equal payloads of at least ``min_bytes`` the one with the largest
    page_id is a response and the others revisit it; smaller payloads are all responses.
    The index has ``archive, offset, length, page_id, url, payload_digest`` and is
    stored before it is returned. ``folder`` is made below the shared folder if not
    given.

    A null html is an empty payload; a null url has no header; control characters and
    spaces of an url are escaped in the header, not in the index. A null page_id counts
    as the smallest. An empty table gives an empty index. Other columns are not read.
    """
    folder = folder or scratch(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives: _Archives | None = None
        for batch in batches:
            places: list[tuple] = []
            archives = archives or _Archives(folder, archive_bytes)
            urls = batch.column(1).cast(pa.binary())
            columns = [batch.column(0), urls, *batch.columns[2:]]
            for page_id, url, data, response, refers_to in zip(*columns, strict=True):
                text = url.as_py()
                text = None if text is None else text.decode("utf-8", "replace")
                whole, digest = record(
                    page_id.as_py(), text, data.as_py(), response.as_py(), refers_to.as_py(), str(uuid.uuid4())
                )
                places.append((*archives.add(whole), digest))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            found = [pa.array([p[i] for p in places], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*found[:3], batch.column(0), batch.column(1), found[3]],
                names=["archive", "offset", "length", "page_id", "url", "payload_digest"],
            )
        if archives is not None:
            archives.close()

    return stored(_decided(pages, min_bytes).mapInArrow(write, INDEX_SCHEMA), "warc-index")


# -- reading ------------------------------------------------------------------------


def ranges(
    places: list[tuple[str, int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES
) -> Iterator[tuple[str, int, int, list[int]]]:
    """Archive, begin and end of every read, and the numbers of the records in it.

    ``places`` are sorted by archive and offset. Neighbours at most ``gap`` apart share a
    read of up to ``most`` bytes.
    """
    archive, begin, end, members = "", 0, 0, []
    for number, (name, offset, length) in enumerate(places):
        joined = name == archive and offset - end <= gap and offset + length - begin <= most
        if members and not joined:
            yield archive, begin, end, members
            members = []
        if not members:
            archive, begin, end = name, offset, offset
        members.append(number)
        end = max(end, offset + length)
    if members:
        yield archive, begin, end, members


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that rows of an index name, one row each.

    ``page_id, url`` come from the index, all else from the records: ``record_type,
    payload_bytes, payload_digest, refers_to`` and, if wanted, ``payload``, null for a
    revisit. Rows are sorted by archive and offset, and neighbouring records are read
    together; a task holds one read at a time. A record that does not match its digest
    is an error. An empty selection gives no rows.
    """
    schema = RECORD_SCHEMA + (", payload BINARY" if payloads else "")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()][: len(names) - 2]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = "", None
        for batch in batches:
            places = list(zip(*(column.to_pylist() for column in batch.columns[:3]), strict=True))
            for archive, begin, end, members in ranges(places):
                if archive != name:
                    if file is not None:
                        file.close()
                    system, path = _opened(archive)
                    name, file = archive, system.open_input_file(path)
                data = file.read_at(end - begin, begin)
                found = []
                for number in members:
                    _, offset, length = places[number]
                    member = data[offset - begin : offset - begin + length]
                    found.append(parse(zlib.decompress(member, 31)))
                rows = batch.slice(members[0], len(members))
                arrays = [pa.array([row[n] for row in found], kind) for n, kind in zip(names[2:], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(3), rows.column(4), *arrays], names=names)
        if file is not None:
            file.close()

    chosen = index.select("archive", "offset", "length", "page_id", "url")
    total = chosen.agg(F.sum("length")).first()[0] or 0
    # Stretches of archives are dealt out, many to a task, however few rows name them.
    stretch = F.floor(F.col("offset") / READ_BYTES)
    tasks = max(total // TASK_BYTES, chosen.sparkSession.sparkContext.defaultParallelism)
    chosen = chosen.repartition(int(tasks), "archive", stretch).sortWithinPartitions("archive", "offset")
    return chosen.mapInArrow(read, schema)
