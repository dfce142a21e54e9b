"""WARC records in ZIP packages: written as stored members with an index, read back by ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and ``indexes/index.cdx`` (one line per record:
place and length in the archive), both stored, so a record's place in the package is known without unpacking. The
reader looks at the end of a package for the directory (ZIP64 where the plain fields are full), finds the members, reads
the index and then only the ranges of records. Packages lie in the folder of ``spark.checkpoint.dir``; tasks open them
with Arrow's file systems, by whatever scheme the folder has.

Of records with equal payloads the one with the smallest page id is a response, the others are revisits that name it.
Payloads are grouped by digest with partial aggregation; the join that tells copies of their first is split by Spark
where one digest is hot.

Defined cases: a null payload is empty; payloads below ``least`` bytes are all responses; a null page id comes after
all others, and rows equal to the first in id and payload are responses too; other columns are ignored; an empty
table gives no package and no rows. A package is named anew at each attempt, and only names that the finished job
returns are read, so a lost executor or a repeated task leaves no half-written input.
"""

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import written
from clickloom.session import fresh_path

PACKAGE_BYTES = 32 << 20
RANGE_RECORDS = 500
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
# Fixed values of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
DOS_DATE = 0x21


def typed(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, ``digest``, ``record_type`` and ``refers_to`` per page."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"),
                        (F.octet_length(body) >= least).alias("shared"))
    # Written, so that the join can split the pages of one payload.
    firsts = written(rows.where("shared").groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"), "firsts")
    first = F.when(F.col("shared"), F.col("first"))
    revisit = first.isNotNull() & ~F.col("page_id").eqNullSafe(first)
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, first).alias("refers_to"))


def record(page_id, url: str | None, body: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record; of a revisit the payload is left out, its length and digest stay in the header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (body if kind == "response" else b"")
    told = base64.b32encode(bytes.fromhex(digest)).decode()
    name = lambda x: "" if x is None else str(x)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name(page_id)}>",
             "WARC-Target-URI: " + " ".join((url or "").split()), "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{told}", f"X-Payload-Length: {len(body)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{name(refers_to)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def zipped(data: bytes) -> bytes:
    """One gzip member."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class Package:
    """Writes a ZIP of stored members to a sequential stream; sizes beyond 32 bits go to ZIP64 fields.

    A stored member's size and checksum are only known at its end, so they follow it in a data descriptor. With
    ``force64`` every field that may be ZIP64 is, as in packages over 4 GiB.
    """

    def __init__(self, stream, force64: bool = False):
        self.stream, self.at, self.members, self.force64 = stream, 0, [], force64

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def open(self, name: str) -> None:
        self.name, self.begin, self.crc, self.size = name.encode(), self.at, 0, 0
        # The empty ZIP64 field tells readers that the descriptor has 64-bit sizes.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, DOS_DATE, 0, FULL32, FULL32, len(self.name), len(extra))
                 + self.name + extra)
        self.data = self.at

    def write(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self.put(data)

    def end(self) -> None:
        self.put(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.begin, self.crc, self.size))

    def close(self) -> None:
        start = self.at
        for name, begin, crc, size in self.members:
            wide = [x for x in (size, size, begin) if self.force64 or x >= FULL32]
            narrow = [FULL32 if self.force64 or x >= FULL32 else x for x in (size, size, begin)]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            self.put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, DOS_DATE, crc, narrow[0], narrow[1],
                                           len(name), len(extra), 0, 0, 0, 0, narrow[2]) + name + extra)
        size, n = self.at - start, len(self.members)
        if self.force64 or start >= FULL32 or size >= FULL32 or n >= FULL16:
            at = self.at
            self.put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self.put(LOCATOR64 + struct.pack("<IQI", 0, at, 1))
            n, size, start = FULL16, FULL32, FULL32
        self.put(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0))


class Reader:
    """Range reads on a ZIP of stored members; ``fetch(start, length)`` returns bytes."""

    def __init__(self, size: int, fetch):
        self.fetch = fetch
        tail_at = max(0, size - 22 - FULL16)
        tail = fetch(tail_at, size - tail_at)
        end = tail.rfind(END)
        if end < 0:
            raise ValueError("no end of a ZIP directory")
        n, length, start = struct.unpack_from("<HII", tail, end + 10)
        if n == FULL16 or length == FULL32 or start == FULL32:
            locator = fetch(tail_at + end - 20, 20)
            if locator[:4] != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            head = fetch(struct.unpack_from("<Q", locator, 8)[0], 56)
            n, length, start = struct.unpack_from("<QQQ", head, 32)
        self.members = dict(self._entries(fetch(start, length), n))

    @staticmethod
    def _entries(directory: bytes, n: int) -> Iterator[tuple[str, tuple[int, int, int]]]:
        at = 0
        for _ in range(n):
            if directory[at:at + 4] != CENTRAL:
                raise ValueError("broken ZIP directory")
            method, = struct.unpack_from("<H", directory, at + 10)
            packed, size, name_size, extra_size, comment = struct.unpack_from("<IIHHH", directory, at + 20)
            begin, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46:at + 46 + name_size].decode()
            extra, stop = at + 46 + name_size, at + 46 + name_size + extra_size
            while extra + 4 <= stop:
                tag, length = struct.unpack_from("<HH", directory, extra)
                if tag == 1:
                    wide = list(struct.unpack_from(f"<{length // 8}Q", directory, extra + 4))
                    size = wide.pop(0) if size == FULL32 else size
                    packed = wide.pop(0) if packed == FULL32 else packed
                    begin = wide.pop(0) if begin == FULL32 else begin
                extra += 4 + length
            yield name, (method, begin, packed)
            at = stop + comment

    def stored(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member begin, and how many they are."""
        method, begin, size = self.members[name]
        if method:
            raise ValueError(f"{name} is compressed")
        head = self.fetch(begin, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"{name} has no local header")
        return begin + 30 + sum(struct.unpack_from("<HH", head, 26)), size


def parsed(data: bytes) -> tuple[dict, bytes]:
    """Headers (lower-case names) and payload of a WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in head.decode().split("\r\n")[1:])
    headers = {name.lower(): value for name, value in headers.items()}
    block = rest[:int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, force64: bool = False) -> DataFrame:
    """Write the rows of ``typed`` to packages below ``folder`` (a URI); returns (path, n) of the finished ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        package, lines = None, []

        def finish():
            package.end()
            package.open(INDEX)
            package.write("".join(lines).encode())
            package.end()
            package.close()
            package.stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n": [len(lines)]})

        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
                    package, lines = Package(store.open_output_stream(fs.FileSystem.from_uri(path)[1]), force64), []
                    package.open(ARCHIVE)
                body = zipped(record(row["page_id"], row["url"], row["html"].encode(), row["digest"],
                                     row["record_type"], row["refers_to"]))
                lines.append(f"{package.size} {len(body)}\n")
                package.write(body)
                if package.size >= package_bytes:
                    yield finish()
                    package = None
        if package is not None:
            yield finish()

    return written(pages.mapInArrow(run, "path string, n long"), "packages")


def opened(path: str):
    """The file's handle and a reader of its directory."""
    store, base = fs.FileSystem.from_uri(path)
    handle = store.open_input_file(base)
    def fetch(start, length):
        handle.seek(start)
        return handle.read(length)
    return handle, Reader(handle.size(), fetch)


def locations(reader: Reader) -> list[tuple[int, int]]:
    """Start in the package and length of every record, from the package's index."""
    (archive, _), (index, size) = reader.stored(ARCHIVE), reader.stored(INDEX)
    entries = (map(int, line.split()) for line in reader.fetch(index, size).splitlines())
    return [(archive + begin, length) for begin, length in entries]


def read(packages: DataFrame, most: int = RANGE_RECORDS) -> DataFrame:
    """All records, read by range, ``most`` held at a time: page_id (text), url, record_type, refers_to (text),
    payload_digest, payload_bytes and ``payload`` (null for revisits)."""
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds)))

    def name(uri):
        return uri[len("<urn:page:"):-1] or None

    def record_at(path, reader, begin, length):
        headers, payload = parsed(zlib.decompress(reader.fetch(begin, length), 31))
        kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response":
            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"{path}: the payload at {begin} does not match its digest")
            return (name(headers["warc-record-id"]), headers["warc-target-uri"], kind, None, digest, len(payload), payload)
        return (name(headers["warc-record-id"]), headers["warc-target-uri"], kind, name(headers["warc-refers-to"]), digest,
                int(headers["x-payload-length"]), None)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                handle, reader = opened(path)
                with handle:
                    spans = locations(reader)
                    for at in range(0, len(spans), most):
                        rows = [record_at(path, reader, *span) for span in spans[at:at + most]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema=schema)

    # Packages have a bounded size: one is a task. The number keeps the small table of names from being one partition.
    tasks = max(1, packages.count())
    return packages.select("path").repartition(tasks).mapInArrow(
        run, "page_id string, url string, record_type string, refers_to string, payload_digest string, "
             "payload_bytes long, payload binary")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """The pages as records, written to packages in the shared folder and read back from them."""
    folder = fresh_path(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    return read(write(typed(pages, least), folder))
