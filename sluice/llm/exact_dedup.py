"""Exact dedup by content-defined chunk recipes.

A text is cut where its content says so, each chunk gets an identifier, and a
text becomes the ordered list of its identifiers (its recipe). Chunk bytes move
through one shuffle, in which equal chunks meet and identifiers are verified
against the bytes; documents are then compared by recipe only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import attach, materialize, pick, values

#: Bounds of a chunk in bytes; between them it ends where a hash of 8 bytes has 12 zero bits.
LEAST, MOST, ZERO_BITS = 1024, 16384, 12
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text, each run of ASCII white space replaced by one space."""
    data = (text or "").encode()
    if not data:
        return b""
    body = b" ".join(data.split())
    if not body:
        return b" "
    return b" " * (data[0] in _SPACE) + body + b" " * (data[-1] in _SPACE)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; equal texts have equal cuts, by content alone."""
    n = len(data)
    ends, start = [], 0
    if n > LEAST:
        # every 8-byte view of a block, hashed at once
        found = []
        for at in range(0, n - 7, 1 << 20):
            size = min(1 << 20, n - 7 - at)
            words = np.ndarray((size,), "<u8", data, at, (1,))
            found.append(np.flatnonzero((words * _ODD) >> np.uint64(64 - ZERO_BITS) == 0) + (at + 8))
        for end in np.concatenate(found).tolist():
            while end - start > MOST:
                start += MOST
                ends.append(start)
            if end - start >= LEAST:
                ends.append(end)
                start = end
    while n - start > MOST:
        start += MOST
        ends.append(start)
    if n > start or not ends:
        ends.append(n)
    return ends


def chunk_id(chunk: bytes) -> bytes:
    """A 16-byte name; it counts as an identifier only once its bytes are verified."""
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), values(batch.column(1)), strict=True):
            data = normalise(text)
            start, names = 0, []
            for end in cuts(data):
                names.append(chunk_id(data[start:end]))
                start = end
            out.append((doc_id, hashlib.sha256(data).hexdigest(), b"".join(names)))
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary())],
            names=["doc_id", "text_sha256", "recipe"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct chunks of each batch with their names."""
    for batch in batches:
        seen: dict[bytes, bytes] = {}
        clash: list[tuple[bytes, bytes]] = []
        for text in values(batch.column(0)):
            data, start = normalise(text), 0
            for end in cuts(data):
                chunk = data[start:end]
                name, start = chunk_id(chunk), end
                if seen.setdefault(name, chunk) != chunk:
                    clash.append((name, chunk))
        rows = [*seen.items(), *clash]
        for at in range(0, len(rows), 2048):
            part = rows[at:at + 2048]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.binary()),
                                              pa.array([r[1] for r in part], pa.binary())],
                                             names=["name", "chunk"])


def verified_names(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(name, n_chunks): how many different chunks share a name.

    1 makes the name a verified identifier. Equal chunks are folded before the
    shuffle and meet in it, the only movement of the texts."""
    text = pick(docs, text=(text_col, "string"))
    chunks = text.mapInArrow(_chunks, "name binary, chunk binary")
    return chunks.groupBy("name", "chunk").agg(F.lit(1).alias("one")).groupBy("name").agg(
        F.count("*").alias("n_chunks"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_rows.

    Texts are equal when identical after white-space runs become one space.
    Of equal texts the row with the smallest id stays.

    * null text: empty; all empty texts are one group.
    * null id: never the smallest one; kept only if no copy has an id (keep_id null).
    * rows that repeat an id and its text: one document, returned once;
      group_size counts every row of the group, n_rows those of the document.
    * one id with different texts: one row for each text.
    * empty table: no rows; other columns are ignored, whatever their names.

    Raises if two different chunks share a 128-bit name, rather than return a
    group that isn't one."""
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    recipes = materialize(rows.mapInArrow(
        _recipes, "doc_id long, text_sha256 string, recipe binary"), "recipes")
    wrong = verified_names(docs, text_col).where("n_chunks > 1").limit(1).count()
    if wrong:
        raise ValueError("two different chunks share a name; use a longer digest")
    each = recipes.groupBy("recipe", "text_sha256", "doc_id").agg(F.count("*").alias("n_rows"))
    groups = each.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"),
                                        F.sum("n_rows").alias("group_size"))
    out = attach(each, groups, "recipe", "group_size", recipes.count(), "doc_id")
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_rows")
