"""Best-fit packing with certified bin counts.

Documents are tokenised once; only (length, identity) rows are packed. Each
partition packs its rows by best-fit decreasing and compares its bin count with lower
bounds from dual feasible functions. A partition that meets its bound is
certified and gives up its emptiest bin alone; a partition with a gap
gives up every bin that is not full. What was given up is dealt anew to fewer
partitions and packed again, until one partition holds it or nothing is gained."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import blocks, pieces, vocabulary_path
from sluice.llm.common import materialize, pick

CAPACITY = 2048
#: Pieces that one partition packs, and rounds of exchange at most (each has fewer partitions).
PART = 20_000
#: Pieces of text whose ids are remembered, twice.
CACHE_PIECES = 400_000
ROUNDS = 8


class _Tokens:
    """Ids by the tokenizers library, which is asked only for pieces not seen lately."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):  # rare: the library does it all
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        out = []
        for block in blocks(text):
            split = pieces(block)
            known = self.known
            new = [p for p in dict.fromkeys(split) if p not in known]
            if new:
                if len(known) + len(new) > CACHE_PIECES:  # what is still used comes back from the older half
                    self.known, self.older = {}, known
                    known, new = self.known, list(dict.fromkeys(split))
                older = self.older
                known.update((p, older[p]) for p in new if p in older)
                new = [p for p in new if p not in known]
                for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                    known[p] = array("I", e.ids).tobytes()
            out.append(b"".join([known[p] for p in split]))
        return np.frombuffer(b"".join(out), "<u4")


@lru_cache(2)
def _tokens(path: str) -> _Tokens:
    return _Tokens(path)


PIECE = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, path: str) -> DataFrame:
    """The pieces of every document: its ids and one id 0, cut into ``capacity``
    tokens if longer; the first piece takes the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens, count = _tokens(path), TaskContext.get().partitionId() << 36
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(tokens.encode(text.as_py() or ""), np.uint32(0)).astype("<u4")
                start = 0
                for piece in range(-(-len(ids) // capacity)):
                    end = start + ((len(ids) - 1) % capacity + 1 if not piece else capacity)
                    out.append((count, doc_id, piece, start, end - start, zlib.crc32(ids[start:end])))
                    start, count = end, count + 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(run, PIECE)


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual feasible functions; ``count[l]`` items have length l.

    Each function maps lengths so that no full bin maps above 1; the sum of the mapped
    lengths, rounded up, is then a bound. In whole numbers throughout."""
    size = np.flatnonzero(count)
    n = count[size].astype(np.int64)
    if not len(size):
        return 0
    best = -(-int(n @ size) // capacity)
    for k in range(1, 21):  # rounding down to multiples of 1/k, which those of 1/(k+1) escape
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, k * size, scaled // capacity * capacity)
        best = max(best, -(-int(n @ value) // (k * capacity)))
    for low in size[size <= capacity // 2].tolist():
        # small items vanish, their complements count whole
        value = np.where(size > capacity - low, capacity, np.where(size < low, 0, size))
        best = max(best, -(-int(n @ value) // capacity))
        # halves are counted by how many items of this length fit beside them
        fit = capacity // low
        value = np.where(2 * size > capacity, 2 * (fit - (capacity - size) // low),
                         np.where(2 * size == capacity, fit, 2 * (size // low)))
        best = max(best, -(-int(n @ value) // (2 * fit)))
    return best


def best_fit(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each item and the free space of each bin."""
    bin_of, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    free: list[int] = []
    some = 0  # bit f: a bin with f free exists
    for i in np.argsort(-length, kind="stable").tolist():
        size = int(length[i])
        fits = some >> size
        if fits:
            f = size + (fits & -fits).bit_length() - 1
            b = waiting[f].pop()
            if not waiting[f]:
                some ^= 1 << f
        else:
            f, b = capacity, len(free)
            free.append(capacity)
        bin_of[i], offset[i] = b, capacity - f
        free[b] = f - size
        if free[b]:
            waiting[free[b]].append(b)
            some |= 1 << free[b]
    return bin_of, offset, np.array(free, np.int64)


def _pack_part(capacity: int, code: int, last: bool):
    """One partition: every row with its bin; ``open`` rows are in bins given up."""
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("row", "ascending")])
        length = part["length"].to_numpy()
        bins, offset, free = best_fit(length, capacity)
        if last:
            given = np.zeros(len(free), bool)
        elif len(free) == lower_bound(np.bincount(length, minlength=capacity + 1), capacity):
            given = np.arange(len(free)) == free.argmax()
        else:
            given = free > 0
        number = code << 52 | int(part["part"][0].as_py()) << 24
        return part.select(["row", "doc_id", "piece", "start", "length", "ids_crc32"]).append_column(
            "sequence_id", pa.array(number + bins)).append_column("offset", pa.array(offset)).append_column(
            "open", pa.array(given[bins]))
    return run


def pack_pieces(cut: DataFrame, capacity: int = CAPACITY, part: int = PART) -> DataFrame:
    """Place the rows of ``cut`` (written, see PIECE) into sequences of at most ``capacity``."""
    full = cut.where(F.col("length") == capacity).select(
        "*", (F.col("row") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, done, before = cut.where(F.col("length") < capacity), [full], None
    for code in range(1, ROUNDS + 1):
        rows = rest.count()
        if not rows:
            break
        parts = -(-rows // part)
        last = parts == 1 or code == ROUNDS
        placed = rest.select(*cut.columns).withColumn("part", F.pmod(F.xxhash64("row", F.lit(code)), F.lit(parts)))
        placed = materialize(placed.groupBy("part").applyInArrow(
            _pack_part(capacity, code, last), f"{PIECE}, sequence_id long, offset long, open boolean"), "round")
        if before is not None:  # an exchange that gains nothing ends the rounds
            bins = placed.agg(F.count_distinct("sequence_id")).first()[0]
            if bins >= before:
                placed, last = rest.withColumn("open", F.lit(False)), True
        done.append(placed.where("not open").drop("open"))
        if last:
            break
        rest = placed.where("open").drop("open")
        before = rest.agg(F.count_distinct("sequence_id")).first()[0]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, path: str | None = None, part: int = PART) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    * null or empty text: one piece that holds the closing id 0.
    * null id: packed like any other, returned with the null.
    * repeated rows: each is packed by itself; equal lengths: by id and piece.
    * empty table: no rows; other columns are ignored, whatever their names."""
    cut = materialize(cut_pieces(docs, id_col, text_col, capacity, path or vocabulary_path()), "pieces")
    out = pack_pieces(cut, capacity, part)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def certificate(cut: DataFrame, capacity: int = CAPACITY) -> int:
    """The lower bound for all pieces together; the driver gets one count per length."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        count[length] = n
    return lower_bound(count, capacity)
