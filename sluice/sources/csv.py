"""Governed CSV parsing (S8, S9, E6): every file in blocks, each in a task of its own.

Whether a block starts inside a quoted field depends on the blocks before it. A first pass
reads each block from both starts and gives its effect on that state. Effects compose:
the state at a block is that after the last block which ends alike from both starts, turned once by
each block since then that turns it, so two running aggregates over the blocks' rows
give the state and the number of lines before every block. The second pass reads each block
from its true state; a record belongs to the block in which it begins, which reads on to
its end. Headers, widths and the first failure of each file are relational steps over the
records. Neither pass holds more than a record and a batch of rows.

A document held as bytes is a row of one task, which parses it to the end: it needs no block, no
stored record and no join, however many documents there are."""

from __future__ import annotations

import codecs
import io
import re
from collections.abc import Iterator
from itertools import islice
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StructType

from sluice.operators.skew import spread_join
from sluice.session import ensure_checkpoint_dir
from sluice.sources.files import open_bytes

PARSED_SCHEMA = (
    "kind string, row_number long, headers array<string>, vals array<string>, "
    "failure_category string, expected_field_count int, actual_field_count int, "
    "data_row_count long"
)
#: Bytes of a file that one task parses, and events of one batch.
BLOCK_BYTES = 32 << 20
BATCH = 8192

# The failure categories of a document's structure.
INVALID_UTF8 = "invalid_utf8"
MALFORMED = "malformed_csv"
EMPTY_HEADER = "empty_header"
DUPLICATE_HEADER = "duplicate_header"
ROW_WIDTH = "row_width"
MISSING_HEADER = "missing_header"
SOURCE_ACCESS = "source_access"

_STOP = re.compile("[,\r]")


class RecordReader:
    """Comma-separated records from physical lines, with doubled quotes and no escapes.

    ``inside`` says whether the first line continues a quoted field. Lines come without
    their line feed; a carriage return outside quotes ends a record too. A quote
    that opens no field is an ordinary character; after a closing quote only a
    comma or the end of the record may follow."""

    def __init__(self, inside: bool = False):
        self.inside = inside
        self.broken = False
        self.line = 0               # physical lines begun before the next one
        self.start = 0              # line on which the open record began
        self.fields: list[str] = []
        self.value: list[str] = []  # pieces of the open quoted field
        self.head = inside          # the open record began before the first line
        self.begin = self.ended = 0  # places in a line where the last record began and ended

    def _value_end(self, text: str, at: int) -> tuple[str | None, int]:
        """Read a quoted value from ``at``; (value, place after the quote) or (None, end)."""
        while True:
            quote = text.find('"', at)
            if quote < 0:
                self.value.append(text[at:])
                return None, len(text)
            self.value.append(text[at:quote])
            if text.startswith('"', quote + 1):
                self.value.append('"')
                at = quote + 2
                continue
            value = "".join(self.value)
            self.value = []
            return value, quote + 1

    def feed(self, text: str) -> Iterator[tuple[int, list[str], bool]]:
        """(line, fields, whether it began before the first line) of each record ended here."""
        if self.broken:
            return
        first, at = self.line, 0
        self.line += 1 + text.count("\r", 0, max(0, len(text) - 1))
        while True:
            if not self.inside and not self.fields:
                while text.startswith("\r", at):
                    at += 1
                if at >= len(text):  # a blank line
                    return
                self.start, self.begin = first + text.count("\r", 0, at), at
            if self.inside or text.startswith('"', at):
                value, at = self._value_end(text, at if self.inside else at + 1)
                self.inside = value is None
                if self.inside:
                    self.value.append("\n")
                    return
                if at < len(text) and text[at] not in ",\r":
                    self.broken = True
                    return
            else:
                stop = _STOP.search(text, at)
                end = stop.start() if stop else len(text)
                value, at = text[at:end], end
            self.fields.append(value)
            if at < len(text) and text[at] == ",":
                at += 1
                continue
            self.ended = at
            fields, early, self.fields, self.head = self.fields, self.head, [], False
            yield self.start, fields, early


def block_lines(file: BinaryIO, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """The lines that begin in a block, then those after it (marked True), without line feeds.

    A file's first line comes without its byte order mark."""
    at = max(0, start - 1)
    file.seek(at)
    if start:
        at += len(file.readline())
    first = not start
    for line in file:
        here, at = at, at + len(line)
        if first:
            line, first = line.removeprefix(codecs.BOM_UTF8), False
        yield line.removesuffix(b"\n"), here >= end


def _step(line: bytes, inside: bool | None) -> tuple[bool | None, bool]:
    """The state after a line (None: broken), and whether a record ended in it."""
    if inside is None:
        return None, True
    reader = RecordReader(inside)
    ended = sum(1 for _ in reader.feed(line.decode("latin-1")))
    return None if reader.broken else reader.inside, bool(ended or reader.broken)


def block_effect(file: BinaryIO, start: int, end: int) -> tuple[bool | None, bool | None, bool, int]:
    """States at a block's end from outside and from inside a quoted field (None: broken), whether
    a record open at its start ends in it, and the number of its physical lines."""
    outside, inside, ends, n_lines = False, True, False, 0
    for line, after in block_lines(file, start, end):
        if after:
            break
        n_lines += 1 + line.count(b"\r", 0, max(0, len(line) - 1))
        if b'"' in line:  # no other line changes either state
            outside, _ = _step(line, outside)
            inside, ended = _step(line, inside)
            ends = ends or ended
    return outside, inside, ends, n_lines


_EFFECT = ("path string, block long, outside boolean, inside boolean, ends boolean, n_lines long, "
           "failure string")


def _effects(block_bytes: int):
    kind = pa.schema([("path", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()),
                      ("ends", pa.bool_()), ("n_lines", pa.int64()), ("failure", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                try:
                    with open_bytes(path) as file:
                        found = (*block_effect(file, block, block + block_bytes), None)
                except OSError:
                    found = False, True, False, 0, SOURCE_ACCESS
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (path, block, *found), strict=True))], kind)

    return run


def start_states(effects: DataFrame) -> DataFrame:
    """path, block, failure, starts_inside, closes (a later block ends the record open at this one's
    end) and before (physical lines before the block), from every block's effect.

    A block that breaks from one start counts as ending alike from both: if it breaks from
    its true start, what follows no longer matters."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("path").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    same = F.col("outside").isNull() | F.col("inside").isNull() | (F.col("outside") == F.col("inside"))
    to = F.coalesce("outside", "inside", F.lit(False))
    effects = effects.withColumn("turns", (~same & F.col("outside")).cast("long"))
    effects = effects.withColumn("turned", F.coalesce(F.sum("turns").over(before), F.lit(0)))
    known = F.last(F.when(same, F.struct(to.alias("state"), F.col("turned").alias("turned"))), ignorenulls=True).over(before)
    turns = (F.col("turned") - F.coalesce(known["turned"], F.lit(0))) % 2 == 1
    return effects.select(
        "path", "block", "failure", (F.coalesce(known["state"], F.lit(False)) != turns).alias("starts_inside"),
        F.coalesce(F.max("ends").over(after), F.lit(False)).alias("closes"),
        F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("before"))


#: What a block's lines give: `record` or `error`, in the order of (block, line, place).
_EVENT = ("path string, block long, line long, place int, kind string, fields array<string>, failure string, "
          "row_number long")
_EVENTS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("place", pa.int32()),
                     ("kind", pa.string()), ("fields", pa.list_(pa.string())), ("failure", pa.string()),
                     ("row_number", pa.int64())])


def line_records(reader: RecordReader, line: bytes) -> Iterator[tuple[int, list[str] | None, str | None, bool]]:
    """(line, fields, failure, whether it began before the first line) of the records that a line ends."""
    try:
        text = line.decode()
    except UnicodeDecodeError:
        reader.broken = True
        yield reader.line, None, INVALID_UTF8, False
        return
    if not reader.inside and '"' not in text and "\r" not in text[:-1]:
        text = text.removesuffix("\r")
        if text:
            yield reader.line, text.split(","), None, False
        reader.line += 1
        return
    before = reader.line
    for at, fields, early in reader.feed(text):
        yield at, fields, None, early
    if reader.broken:
        yield before, None, MALFORMED, False


def block_records(lines: Iterator[tuple[bytes, bool]], inside: bool = False,
                  closes: bool = False) -> Iterator[tuple[int, list[str] | None, str | None]]:
    """(line, fields, failure) of the records that begin in a block, up to its first failure."""
    reader, begun = RecordReader(inside), not inside
    for line, after in lines:
        if after and not (reader.inside and closes):
            break
        if after and not begun:  # the record open at the start goes on beyond the block
            return
        for at, fields, failure, early in line_records(reader, line):
            begun = True
            if not early:
                yield at, fields, failure
            if failure or after:
                return
    if reader.inside and begun and not closes:
        yield reader.line, None, MALFORMED


def _batches(path: str, block: int, before: int, records: Iterator) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for place, (line, fields, failure) in enumerate(records):
        out.append((path, block, line, place, "record" if failure is None else "error", fields, failure, before + line + 1))
        if len(out) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _EVENTS, strict=True)], schema=_EVENTS)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _EVENTS, strict=True)], schema=_EVENTS)


def _block_events(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, failure, inside, closes, before in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if failure is None:
                    try:
                        with open_bytes(path) as file:
                            yield from _batches(path, block, before, block_records(
                                block_lines(file, block, block + block_bytes), inside, closes))
                        continue
                    except OSError:
                        failure = SOURCE_ACCESS
                yield from _batches(path, block, before, iter([(0, None, failure)]))

    return run


def file_events(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The events of the files listed in ``files`` (path, length), block by block."""
    parts = files.agg(F.sum(F.ceil(F.greatest("length", F.lit(1)) / F.lit(block_bytes)))).first()[0] or 1
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")),
                        F.lit(block_bytes).cast("long"))
    # rows of a path and a number, dealt out evenly; a task per block up to a number that Spark schedules well
    blocks = files.select("path", F.explode(starts).alias("block")).repartition(min(int(parts), 100_000))
    effects = blocks.mapInArrow(_effects(block_bytes), _EFFECT).checkpoint()
    states = start_states(effects).repartition(min(int(parts), 100_000))
    return states.mapInArrow(_block_events(block_bytes), _EVENT)


def _document(data: bytes | pa.Buffer) -> Iterator[tuple]:
    """The rows of :data:`PARSED_SCHEMA` of one document: its `file` row and, if it is sound, its records.

    Holds a batch of records at most: a longer document is read again for them."""
    records = lambda: block_records(block_lines(io.BytesIO(data), 0, 1 << 62))
    headers = failure = at = expected = actual = None
    held, n = [], 0
    for line, fields, failure in records():
        if failure is not None:
            break
        if headers is None:
            headers = fields
            failure = EMPTY_HEADER if "" in fields else DUPLICATE_HEADER if len(set(fields)) < len(fields) else None
        elif len(fields) != len(headers):
            failure, expected, actual = ROW_WIDTH, len(headers), len(fields)
        else:
            n += 1
            if n <= BATCH:
                held.append((line, fields))
        if failure is not None:
            at = line + 1
            break
    if headers is None and failure is None:
        failure = MISSING_HEADER
    if failure is not None:
        yield "file", at, None, None, failure, expected, actual, None
        return
    yield "file", None, headers, None, None, None, None, n
    for line, fields in held if n <= BATCH else ((line, fields) for line, fields, _ in islice(records(), 1, None)):
        yield "row", line + 1, headers, fields, None, None, None, None


_PARSED = pa.schema([("kind", pa.string()), ("row_number", pa.int64()), ("headers", pa.list_(pa.string())),
                     ("vals", pa.list_(pa.string())), ("failure_category", pa.string()),
                     ("expected_field_count", pa.int32()), ("actual_field_count", pa.int32()),
                     ("data_row_count", pa.int64())])


def _parsed(key: str):
    """Listing rows with the rows of their documents in place of ``content``."""
    def with_listing(listing: pa.RecordBatch, out: list[tuple]) -> pa.RecordBatch:
        of, *columns = zip(*out, strict=True)
        of = pa.array(of, pa.int64())
        return pa.RecordBatch.from_arrays(
            [*[c.take(of) for c in listing.columns], *[pa.array(c, f.type) for c, f in zip(columns, _PARSED, strict=True)]],
            names=[*listing.schema.names, *_PARSED.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listing = batch.select([c for c in batch.schema.names if c != "content"])
            out: list[tuple] = []
            for i, (name, content) in enumerate(zip(batch.column(key), batch.column("content"), strict=True)):
                # a row without a name has no records
                data = content.as_buffer() if name.is_valid and content.is_valid else b""
                for row in _document(data):
                    out.append((i, *row))
                    if len(out) == BATCH:
                        yield with_listing(listing, out)
                        out = []
            if out:
                yield with_listing(listing, out)

    return run


def parse_events(events: DataFrame) -> DataFrame:
    """Records and failures of documents from their events.

    One `file` row per document that has any (status) and, if its structure is sound, one
    `row` row per data record."""
    ensure_checkpoint_dir(events.sparkSession)
    events = events.checkpoint()  # read by every step below
    whole = events.select("path", F.struct("block", "line", "place").alias("at"), "row_number", "kind", "fields", "failure")
    header = whole.where("kind = 'record'").groupBy("path").agg(
        F.min_by(F.struct("row_number", "fields"), "at").alias("h"), F.min("at").alias("header_at"))
    header = header.select("path", "header_at", F.col("h.fields").alias("headers"),
                           F.col("h.row_number").alias("header_row"))
    rows = spread_join(whole, header, "path", "left", by=("at",))

    is_header = F.col("at") == F.col("header_at")
    bad = (F.when(F.col("kind") == "error", F.col("failure"))
           .when(is_header & F.array_contains("headers", F.lit("")), F.lit(EMPTY_HEADER))
           .when(is_header & (F.size(F.array_distinct("headers")) < F.size("headers")), F.lit(DUPLICATE_HEADER))
           .when(F.size("fields") != F.size("headers"), F.lit(ROW_WIDTH)))
    rows = rows.withColumn("bad", bad)
    width = F.col("bad") == ROW_WIDTH
    where_known = F.col("bad").isin(EMPTY_HEADER, DUPLICATE_HEADER, ROW_WIDTH)
    status = rows.groupBy("path").agg(
        F.min_by(F.when(F.col("bad").isNotNull(), F.struct(
            "bad", F.when(where_known, F.col("row_number")).alias("row_number"),
            F.when(width, F.size("headers")).alias("expected"), F.when(width, F.size("fields")).alias("actual"))),
            F.when(F.col("bad").isNotNull(), F.col("at"))).alias("f"),
        F.count_if((F.col("kind") == "record") & ~is_header).alias("n"),
        F.any_value("headers").alias("headers"))
    category = F.when(F.col("f.bad").isNotNull(), F.col("f.bad")).when(F.col("headers").isNull(), F.lit(MISSING_HEADER))
    sound = category.isNull()
    status = status.select(
        "path", F.lit("file").alias("kind"), F.col("f.row_number").alias("row_number"),
        F.when(sound, F.col("headers")).alias("headers"), F.lit(None).cast("array<string>").alias("vals"),
        category.alias("failure_category"), F.col("f.expected").alias("expected_field_count"),
        F.col("f.actual").alias("actual_field_count"), F.when(sound, F.col("n")).alias("data_row_count"))
    good = status.where("failure_category is null").select("path")
    none = F.lit(None)
    records = spread_join(rows.where((F.col("kind") == "record") & ~is_header), good, "path", "left_semi",
                          by=("at",)).select(
        "path", F.lit("row").alias("kind"), "row_number", "headers", F.col("fields").alias("vals"),
        none.cast("string").alias("failure_category"), none.cast("int").alias("expected_field_count"),
        none.cast("int").alias("actual_field_count"), none.cast("long").alias("data_row_count"))
    return status.unionByName(records)


def read_governed_csv(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Parse every file of a listing.

    With a ``content`` column the bytes of each row are parsed; without it the files are
    read by ``path`` in blocks of ``block_bytes``. Returns the listing columns (without
    content) plus :data:`PARSED_SCHEMA`: `file` rows for per-file status and `row` rows
    for records. A listed file that can't be read any more is a `source_access` failure."""
    ensure_checkpoint_dir(files.sparkSession)
    keep = [c for c in files.columns if c != "content"]
    if "content" in files.columns:
        out = StructType([*files.select(*keep).schema, *StructType.fromDDL(PARSED_SCHEMA)])
        return files.select(*keep, "content").mapInArrow(_parsed("source_id"), out)
    key = "path"
    parsed = parse_events(file_events(files.select("path", "length"), block_bytes))
    rows = spread_join(parsed.where("kind = 'row'"), files.select(*keep), key, "inner")
    # a file without events has no header either
    status = files.select(*keep).join(parsed.where("kind = 'file'"), key, "left")
    status = status.withColumn("failure_category", F.when(F.col("kind").isNull(), MISSING_HEADER).otherwise(
        F.col("failure_category"))).withColumn("kind", F.lit("file"))
    out = [*keep, *[c.split()[0] for c in PARSED_SCHEMA.split(", ")]]
    return status.select(*out).unionByName(rows.select(*out))


def parse_text_rows(texts: DataFrame, text_col: str = "csv_text") -> DataFrame:
    """S8 over CSV documents held as text (e.g. assembled by Spark from
    tables): same output as :func:`read_governed_csv`."""
    files = texts.withColumn("content", F.encode(F.col(text_col), "UTF-8")).drop(text_col)
    return read_governed_csv(files)


class GovernedCsv:
    """The parser as a table function, one file at a time in the order of its blocks.

    ``governed_csv(TABLE(blocks) PARTITION BY path ORDER BY block)`` over rows of (path, block,
    content), where the contents of a path's blocks make up the file, cut anywhere. Gives one
    `row` row per data record before the file's first failure and one `file` row with its status at the
    end; rows of a file whose status names a failure are not valid."""

    def __init__(self):
        self.reader, self.rest, self.first = RecordReader(), b"", True
        self.path = self.headers = self.failure = None
        self.at = self.expected = self.actual = None
        self.rows = 0

    def _line(self, line: bytes) -> Iterator[tuple]:
        if self.first:
            line, self.first = line.removeprefix(codecs.BOM_UTF8), False
        for at, fields, failure, _ in line_records(self.reader, line):
            if failure:
                self.failure = failure
            elif self.headers is None:
                self.headers = fields
                self.failure = (EMPTY_HEADER if "" in fields else
                                DUPLICATE_HEADER if len(set(fields)) < len(fields) else None)
                self.at = at + 1 if self.failure else None
            elif len(fields) != len(self.headers):
                self.failure, self.at, self.expected, self.actual = ROW_WIDTH, at + 1, len(self.headers), len(fields)
            else:
                self.rows += 1
                yield self.path, "row", at + 1, self.headers, fields, None, None, None, None
            if self.failure:
                return

    def eval(self, row) -> Iterator[tuple]:
        self.path = row["path"]
        lines = (self.rest + (row["content"] or b"")).split(b"\n")
        self.rest = lines.pop()
        for line in lines:
            if self.failure:
                return
            yield from self._line(line)

    def terminate(self) -> Iterator[tuple]:
        if self.path is None:
            return
        if not self.failure and self.rest:
            yield from self._line(self.rest)
        if not self.failure and self.reader.inside:
            self.failure = MALFORMED
        if not self.failure and self.headers is None:
            self.failure = MISSING_HEADER
        sound = self.failure is None
        yield (self.path, "file", self.at, self.headers if sound else None, None, self.failure, self.expected,
               self.actual, self.rows if sound else None)


def register_governed_csv(spark: SparkSession, name: str = "governed_csv") -> None:
    """Make :class:`GovernedCsv` callable from SQL under ``name``."""
    spark.udtf.register(name, F.udtf(GovernedCsv, returnType=f"path string, {PARSED_SCHEMA}"))
