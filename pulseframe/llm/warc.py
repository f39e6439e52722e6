"""WARC archives with a two-level capture index.

Writing: every task appends records, each a gzip member, to one archive file of its own in a folder all executors share.
The row of a record (key, file, offset, length) leaves the task only when its file is closed, and a repeated task writes
a new file, so rows of the written capture table always point at whole files; files nobody points at are ignored.

Index: captures are sorted by reversed-host URL key and page over the whole archive (range partitions), packed into
compressed blocks of lines, one index file per range; each file ends with its sparse directory, one entry per block.
Above these lies one entry per index file, whose number is that of the range partitions.

Look-up: requests are sorted the same way; a task binary-searches the file list, then the file's directory, reads the
byte range of one block and finally the byte range of the record. Nothing depends on how often a URL occurs, since the
page belongs to the key.

Payloads of at least ``REVISIT_BYTES`` bytes that are equal are stored once: the capture with the smallest page is the
response, the others are revisits that refer to it. Defined cases: NULL html is an empty payload, a NULL url has an
empty key, a NULL page is larger than any other when the response is chosen; rows that share page and payload with
the response are responses, too. Repeated rows are captures of their own. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pulseframe.sources.staging import fresh_path, stage

REVISIT_BYTES = 100
BLOCK_LINES = 2000
TASK_LINES = 50_000
ROLL_BYTES = 64 << 20
OPEN_FILES, OPEN_BLOCKS = 32, 16
CAPTURED = "2024-01-01T00:00:00Z"

CAPTURE = "key string, page_id long, url string, record_type string, refers_to long, file string, offset long, size long"
FOUND = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
NO_PAGE = -(1 << 63) - 1  # sorts before every page, as NULL does in Spark


def url_key(url: Column) -> Column:
    """Reversed-host key of a URL: ``https://a.example.com/x?y`` becomes ``com,example,a)/x?y``.

    Scheme and fragment are left out, the host is in lower case; a NULL url has an empty key.
    """
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://|#.*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    tail = F.regexp_replace(rest, r"(?s)^[^/?]*", "")
    return F.when(rest == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)
    )


# ---- files that all executors share


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class Ranges:
    """Byte ranges of shared files; the last few files stay open."""

    def __init__(self) -> None:
        self.files: OrderedDict[str, pa.NativeFile] = OrderedDict()

    def file(self, path: str) -> pa.NativeFile:
        if path not in self.files:
            fs, local = opened(path)
            self.files[path] = fs.open_input_file(local)
            if len(self.files) > OPEN_FILES:
                self.files.popitem(last=False)[1].close()
        self.files.move_to_end(path)
        return self.files[path]

    def read(self, path: str, offset: int, size: int) -> bytes:
        file = self.file(path)
        file.seek(offset)
        return file.read(size)

    def close(self) -> None:
        for file in self.files.values():
            file.close()


class Files:
    """Files written one after the other under names nobody else uses; a new one begins where one passes ``roll`` bytes."""

    def __init__(self, folder: str, suffix: str, roll: int = ROLL_BYTES) -> None:
        self.folder, self.suffix, self.roll = folder, suffix, roll
        self.path, self.out, self.at = "", None, 0

    def append(self, data: bytes) -> tuple[str, int]:
        """The path and offset at which ``data`` begins."""
        if self.out is None:
            self.path, self.at = posixpath.join(self.folder, f"{uuid.uuid4().hex}{self.suffix}"), 0
            fs, local = opened(self.path)
            self.out = fs.open_output_stream(local, compression=None)
        where = self.path, self.at
        self.out.write(data)
        self.at += len(data)
        return where

    @property
    def full(self) -> bool:
        return self.at >= self.roll

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def make_folder(path: str) -> str:
    fs, local = opened(path)
    fs.create_dir(local, recursive=True)
    return path


# ---- records


def packed(data: bytes) -> bytes:
    """A gzip member of its own, so that a reader can begin at any record."""
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def page_urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def one_line(value: str) -> str:
    """A header value without control characters: they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(
    page: int | None, url: str | None, payload: bytes, digest: str, revisit: bool = False, refers_to: int | None = None
) -> bytes:
    """A response record, or a revisit record, which leaves out the payload and names the response's page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", page_urn(page)),
        ("WARC-Date", CAPTURED),
        ("WARC-Target-URI", one_line(url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", page_urn(refers_to)),
        ]
    block = http if revisit else http + payload
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and HTTP payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def page_of(urn: str) -> int | None:
    digits = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


# ---- writing


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, and for revisits the response's page."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = (
        rows.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("digest", "response")
    )
    joined = rows.join(shared, "digest", "left")
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "digest", url_key(F.col("url")).alias("key"), revisit.alias("revisit"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def write_archive(pages: DataFrame, path: str) -> DataFrame:
    """Write the records of ``pages`` under ``path`` and return the written capture table (one row per record)."""
    folder = make_folder(f"{path}/records")
    schema = StructType.fromDDL(CAPTURE)
    names = [f.name for f in schema.fields]

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, waiting = Files(folder, ".warc.gz"), []

        def done() -> pa.RecordBatch:
            files.close()
            columns = list(zip(*waiting, strict=True)) if waiting else [[] for _ in names]
            waiting.clear()
            types = {"page_id": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64(), "size": pa.int64()}
            return pa.RecordBatch.from_arrays(
                [pa.array(c, types.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names=names
            )

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in
                       ("page_id", "url", "payload", "digest", "key", "revisit", "refers_to")]
            for page, url, payload, digest, key, revisit, refers_to in zip(*columns, strict=True):
                data = packed(record(page, url, payload, digest, revisit, refers_to))
                file, offset = files.append(data)
                waiting.append((key, page, url, "revisit" if revisit else "response", refers_to, file, offset, len(data)))
                if files.full:
                    yield done()
        if waiting:
            yield done()

    captures = decided(pages).mapInArrow(write, schema)
    captures.write.parquet(f"{path}/captures")
    return pages.sparkSession.read.schema(schema).parquet(f"{path}/captures")


# ---- index


def write_index(captures: DataFrame, path: str) -> DataFrame:
    """Sort the captures, write index files under ``path`` and return their list: file, first and last key and page."""
    folder = make_folder(f"{path}/index")
    listing = "file string, first_key string, first_page long, last_key string, last_page long, blocks long, lines long"

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, directory, lines, total = Files(folder, ".cdx", 1 << 62), [], [], 0

        def flush() -> None:
            block = zlib.compress("\n".join(json.dumps(line, separators=(",", ":")) for line in lines).encode(), 6)
            _, offset = files.append(block)
            directory.append([lines[0][:2], lines[-1][:2], offset, len(block)])
            lines.clear()

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("key", "page_id", "file", "offset", "size")]
            for line in zip(*columns, strict=True):
                lines.append(line)
                total += 1
                if len(lines) == BLOCK_LINES:
                    flush()
        if lines:
            flush()
        if directory:
            foot = zlib.compress(json.dumps(directory).encode(), 6)
            files.append(foot + struct.pack("<Q", len(foot)))
            file = files.path
            files.close()
            first, last = directory[0][0], directory[-1][1]
            yield pa.RecordBatch.from_pydict({
                "file": [file], "first_key": [first[0]], "first_page": pa.array([first[1]], pa.int64()),
                "last_key": [last[0]], "last_page": pa.array([last[1]], pa.int64()),
                "blocks": pa.array([len(directory)], pa.int64()), "lines": pa.array([total], pa.int64()),
            })

    ordered = (
        captures.select("key", "page_id", "file", "offset", "size")
        .repartitionByRange("key", "page_id")
        .sortWithinPartitions("key", "page_id")
    )
    return stage(ordered.mapInArrow(pack, listing), "index-files")


def place(key: str, page: int | None) -> tuple[str, int]:
    return key, NO_PAGE if page is None else page


class Reader:
    """Finds captures by (key, page) and reads their records, with a few directories and blocks at hand."""

    def __init__(self, listing: list[tuple[tuple[str, int], tuple[str, int], str]]) -> None:
        """``listing``: first place, last place and path of the index files, in order."""
        self.ranges, self.listing = Ranges(), listing
        self.firsts = [first for first, _, _ in listing]
        self.directories: OrderedDict[str, tuple[list, list]] = OrderedDict()
        self.blocks: OrderedDict[tuple[str, int], tuple[list, list]] = OrderedDict()

    def _kept(self, cache: OrderedDict, key, make):
        if key not in cache:
            cache[key] = make()
            if len(cache) > OPEN_BLOCKS:
                cache.popitem(last=False)
        cache.move_to_end(key)
        return cache[key]

    def directory(self, file: str) -> tuple[list, list]:
        def load():
            end = self.ranges.file(file).size()
            (size,) = struct.unpack("<Q", self.ranges.read(file, end - 8, 8))
            entries = json.loads(zlib.decompress(self.ranges.read(file, end - 8 - size, size)))
            return [place(*entry[0]) for entry in entries], entries

        return self._kept(self.directories, file, load)

    def block(self, file: str, offset: int, size: int) -> tuple[list, list]:
        def load():
            lines = [json.loads(x) for x in zlib.decompress(self.ranges.read(file, offset, size)).split(b"\n")]
            return [place(*line[:2]) for line in lines], lines

        return self._kept(self.blocks, (file, offset), load)

    def captures(self, key: str, page: int | None) -> Iterator[tuple[str, int, int]]:
        """File, offset and size of every record of a place; equal places may reach over blocks and files."""
        wanted = place(key, page)
        for number in range(max(0, bisect_left(self.firsts, wanted) - 1), len(self.listing)):
            first, last, file = self.listing[number]
            if first > wanted:
                break
            if last < wanted:
                continue
            firsts, entries = self.directory(file)
            for entry in entries[max(0, bisect_left(firsts, wanted) - 1):]:
                if place(*entry[0]) > wanted:
                    break
                if place(*entry[1]) < wanted:
                    continue
                places, lines = self.block(file, entry[2], entry[3])
                for line in lines[bisect_left(places, wanted):bisect_right(places, wanted)]:
                    yield line[2], line[3], line[4]

    def record(self, file: str, offset: int, size: int) -> tuple[dict[str, str], bytes]:
        return parsed(zlib.decompress(self.ranges.read(file, offset, size), 31))


def file_list(index: DataFrame) -> list[tuple[tuple[str, int], tuple[str, int], str]]:
    """The top of the index: one entry per range partition, whatever the number of captures."""
    return sorted(
        (place(r["first_key"], r["first_page"]), place(r["last_key"], r["last_page"]), r["file"]) for r in index.collect()
    )


def look_up(requests: DataFrame, index: DataFrame) -> DataFrame:
    """The records of the requested (url, page_id) pairs, read back from the archives.

    A revisit record has the length and digest that it declares; ``resolved`` replaces them by its response's.
    """
    listing = file_list(index)
    names = [f.name for f in StructType.fromDDL(FOUND).fields]

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(listing)
        try:
            for batch in batches:
                out = []
                for key, page in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                    for where in reader.captures(key, page):
                        fields, payload = reader.record(*where)
                        kind = fields["WARC-Type"]
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                        if kind == "revisit":
                            size, digest = None, fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        refers_to = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
                        out.append((page_of(fields["WARC-Record-ID"]), size, digest, kind, refers_to))
                columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        finally:
            reader.ranges.close()

    wanted = requests.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id")).distinct()
    # The reads behind a narrow request are wide, so the number of tasks follows the captures, not the requests' bytes.
    lines = sum(r["lines"] for r in index.select("lines").collect())
    tasks = max(requests.sparkSession.sparkContext.defaultParallelism, -(-lines // TASK_LINES))
    ordered = wanted.repartitionByRange(tasks, "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(find, FOUND)


def resolved(found: DataFrame) -> DataFrame:
    """``found`` with length and digest of the full payload on revisits, taken from the responses they refer to."""
    responses = (
        found.where("record_type = 'response'")
        .groupBy(F.col("payload_digest"), F.col("page_id").alias("refers_to"))
        .agg(F.max("payload_bytes").alias("response_bytes"))
    )
    joined = found.join(responses, ["payload_digest", "refers_to"], "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "response_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to",
    )


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, index the archives and read every page back through the index."""
    path = fresh_path(spark, "archive")
    captures = write_archive(pages, path)
    index = write_index(captures, path)
    return resolved(stage(look_up(pages.select("url", "page_id"), index), "read-back"))
