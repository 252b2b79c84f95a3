"""WARC archives with a two-level capture index.

Tasks write records (one gzip member each) to archives in the shared folder. The
index holds one line per capture, sorted by a key that starts with the reversed host:
lines lie in compressed blocks, and a sparse directory has the first key of each
block. A lookup binary-searches the shards, the directory and the block, and then
reads only its record's range from the archive."""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import attach, materialize, pick, shared_dir

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Lines of an index block; lines of a shard, and shards at most (each a row on the driver).
BLOCK_LINES, SHARD_LINES, SHARDS = 256, 5000, 4096
#: The pages carry no capture time.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 1
OPEN_FILES = 64


def reversed_host(url: str | None) -> str:
    """Sort key of a URL: `https://www.a.org:81/x?y` is `org,a,www:81)/x?y`; `-` without a URL."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return "-" + url
    return (",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
            + (f"?{parts.query}" if parts.query else ""))


def capture_key(url: str | None, page_id: int | None) -> str:
    """Key of a capture: equal URLs lie together, ordered by page."""
    return f"{reversed_host(url)} {'' if page_id is None else format(page_id + (1 << 63), '020d')}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit holds no payload, only its digest and length."""
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_PLAIN)}")
    head.append(f"WARC-Payload-Digest: sha1:{payload_digest(payload)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>", f"X-Payload-Length: {len(payload)}"]
    body = b"" if revisit else payload
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


#: Everything printable may stand in a header line; the rest is percent-encoded.
_PLAIN = "".join(chr(c) for c in range(33, 127))


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, body) of one record; raises if it is damaged."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    if version != "WARC/1.0" or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    return headers, rest[:size]


class Store:
    """Files of the shared folder, of any scheme that Arrow's file systems know."""

    def __init__(self):
        self.systems: dict[str, arrow_fs.FileSystem] = {}
        self.open: OrderedDict[str, object] = OrderedDict()

    def _place(self, uri: str) -> tuple[arrow_fs.FileSystem, str]:
        folder, _, name = uri.rpartition("/")
        if folder not in self.systems:
            self.systems[folder], _ = arrow_fs.FileSystem.from_uri(folder)
        return self.systems[folder], arrow_fs.FileSystem.from_uri(uri)[1]

    def create(self, uri: str):
        system, path = self._place(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path, compression=None)

    def size(self, uri: str) -> int:
        return self._handle(uri).size()

    def _handle(self, uri: str):
        if uri not in self.open:
            system, path = self._place(uri)
            self.open[uri] = system.open_input_file(path)
            if len(self.open) > OPEN_FILES:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return self.open[uri]

    def read(self, uri: str, offset: int, length: int) -> bytes:
        file = self._handle(uri)
        file.seek(offset)
        return file.read(length)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least: int = 0) -> DataFrame:
    """Write one record per row; returns the captures: key, archive, offset, length.

    Rows whose payloads are equal (by SHA-256) and have at least ``least`` bytes are one
    group: the smallest id is the response, the others revisit it. The payloads move
    once, to meet the decision of their group; a hot payload's rows are dealt out.
    A task that is run again writes to a file of another name; only the files that
    the returned rows name count."""
    rows = pick(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))
    rows = rows.withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("sha", F.unhex(F.sha2("html", 256)))
    groups = rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n_rows")).where("n_rows > 1")
    rows = attach(rows, groups, "sha", "n_rows", rows.count(), "page_id").select(
        "page_id", "url", "html",
        F.when(F.octet_length("html") >= least, F.coalesce("first", "page_id")).otherwise(F.col("page_id")).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, file, uri, size = Store(), None, "", 0
        for batch in batches:
            out = []
            for page_id, url, html, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if file is None:
                    uri = f"{folder}/archives/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    file, size = store.create(uri), 0
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = record(page_id, url, html.encode(), first, first is not None and first != page_id)
                data = pack.compress(data) + pack.flush()
                file.write(data)
                out.append((capture_key(url, page_id), uri, size, len(data)))
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    file.close()
                    file = None
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["key", "archive", "offset", "length"])
        if file is not None:
            file.close()

    return materialize(rows.mapInArrow(run, "key string, archive string, offset long, length long"), "captures")


_TRAILER = "<QQ"


def build_index(captures: DataFrame, folder: str) -> list[tuple[str, str]]:
    """Write the index; returns (last key, shard) in key order, at most SHARDS of them.

    A shard is blocks of compressed lines, then its directory (first key, offset and
    length of each block), then the place of the directory."""
    shards = max(1, min(SHARDS, -(-captures.count() // SHARD_LINES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri = f"{folder}/index/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.cdx"
        file, at, directory, lines, last = None, 0, [], [], ""

        def flush() -> int:
            data = zlib.compress(json.dumps(lines).encode())
            directory.append((lines[0][0], at, len(data)))
            file.write(data)
            lines.clear()
            return at + len(data)

        for batch in batches:
            for line in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if file is None:
                    file = Store().create(uri)
                lines.append(line)
                last = line[0]
                if len(lines) == BLOCK_LINES:
                    at = flush()
        if file is not None:
            if lines:
                at = flush()
            data = zlib.compress(json.dumps(directory).encode())
            file.write(data + struct.pack(_TRAILER, at, len(data)))
            file.close()
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([uri])], names=["last", "shard"])

    order = ["key", "archive", "offset"]
    written = captures.select(*order, "length").repartitionByRange(shards, *order).sortWithinPartitions(*order)
    return sorted(tuple(r) for r in materialize(
        written.mapInArrow(run, "last string, shard string"), "shards").collect())


class Index:
    """Lookups by binary search; keeps one directory and one block."""

    def __init__(self, shards: list[tuple[str, str]], store: Store):
        self.last, self.shards, self.store = [s[0] for s in shards], [s[1] for s in shards], store
        self.shard, self.directory, self.firsts = -1, [], []
        self.at, self.lines = (-1, -1), []

    def _load(self, shard: int, block: int | None = None) -> None:
        uri = self.shards[shard]
        if shard != self.shard:
            end = self.store.size(uri)
            size = struct.calcsize(_TRAILER)
            offset, length = struct.unpack(_TRAILER, self.store.read(uri, end - size, size))
            self.directory = json.loads(zlib.decompress(self.store.read(uri, offset, length)))
            self.firsts, self.shard = [d[0] for d in self.directory], shard
        if block is not None and self.at != (shard, block):
            _, offset, length = self.directory[block]
            self.lines = json.loads(zlib.decompress(self.store.read(uri, offset, length)))
            self.at = shard, block

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of every capture with this key."""
        shard = bisect_left(self.last, key)
        while shard < len(self.shards):
            self._load(shard)
            block = max(0, bisect_left(self.firsts, key) - 1)
            while block < len(self.directory) and self.firsts[block] <= key:
                self._load(shard, block)
                for line in self.lines[bisect_left(self.lines, key, key=lambda x: x[0]):
                                       bisect_right(self.lines, key, key=lambda x: x[0])]:
                    yield line[1], line[2], line[3]
                block += 1
            if self.last[shard] != key:
                break
            shard += 1


_FOUND = ("key string, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")


def read_captures(keys: DataFrame, shards: list[tuple[str, str]], with_payload: bool = True) -> DataFrame:
    """The records of the captures named by column ``key``, read back from the archives.

    Keys are sorted into as many ranges as there are shards, so that a task reads few
    index blocks, each once. Payloads are checked against their digests."""
    def page(urn: str) -> int | None:
        text = urn.removeprefix("<urn:page:").removesuffix(">")
        return None if text == "None" else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store()
        index, kinds = Index(shards, store), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                                              pa.int64(), pa.string(), pa.binary())
        names = [x.split()[0] for x in _FOUND.split(", ")]

        def send(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            rows, held = [], 0
            for key in batch.column(0).to_pylist():
                for archive, offset, length in index.find(key):
                    headers, body = parse(zlib.decompress(store.read(archive, offset, length), 31))
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and payload_digest(body) != digest:
                        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
                    refers = headers.get("WARC-Refers-To")
                    rows.append((key, page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
                                 page(refers) if refers else None,
                                 int(headers.get("X-Payload-Length", len(body))), digest,
                                 body if with_payload else None))
                    held += len(body) if with_payload else 0
                    if held > 32 << 20:
                        yield send(rows)
                        rows, held = [], 0
            if rows:
                yield send(rows)

    order = keys.select("key").distinct().repartitionByRange(max(1, len(shards)), "key").sortWithinPartitions("key")
    return order.mapInArrow(run, _FOUND)


def archive_folder(pages: DataFrame) -> str:
    """A new folder for archives and index in the shared one."""
    return f"{shared_dir(pages.sparkSession)}/sluice-warc/{uuid.uuid4().hex}"


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                    least: int = 0, folder: str | None = None, with_payload: bool = False) -> DataFrame:
    """Write all pages, index them, and read every capture back through the index.

    One row per page: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (base32 SHA-1) and, if asked for, payload (null for revisits: empty).

    * null html: an empty payload; null URL: a record without target, key `-`.
    * null id: never the smallest one; a group without any id is all responses.
    * rows that repeat the smallest id of their payload: all of them are responses.
    * equal URLs, repeated rows: each has a record of its own and is returned.
    * empty table: no rows; other columns are ignored, whatever their names."""
    folder = folder or archive_folder(pages)
    captures = write_archives(pages, folder, id_col, url_col, html_col, least)
    found = read_captures(captures, build_index(captures, folder), with_payload)
    return found.select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest",
                        *(["payload"] if with_payload else []))
