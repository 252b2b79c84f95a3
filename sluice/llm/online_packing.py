"""Sum-of-squares online packing.

Each task streams its documents into windows of ``capacity`` tokens. A level array counts the
partially filled windows by fill level. A document goes to the level that leaves the
least sum of squared counts, so no level piles up and a window that completes another
is usually open. Whole windows are cut from longer documents; only what is left of them is
placed. When too many windows are open, and at the end, gaps are closed by cutting: the
emptiest windows are dealt into the gaps of the fullest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sluice.llm.bpe import vocabulary_path
from sluice.llm.common import pick
from sluice.llm.units import byte_ids

CAPACITY = 1024
#: Windows that a task holds open, and rows of one batch of results.
OPEN = 4096
BATCH = 16_384

PLACED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")

#: What lies in an open window: document, place in it, ids, tokens of the document.
Item = tuple[object, int, np.ndarray, int]
Window = list[Item]


def fill(window: Window) -> int:
    return sum(len(item[2]) for item in window)


def whole(size: int) -> bool:
    """Whether a sequence of this size needs no padding besides ``capacity`` itself."""
    return size & (size - 1) == 0


class Levels:
    """The partially filled windows of a task by fill level."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.waiting: list[list[Window]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def best(self, size: int) -> int:
        """The level (0: a new window) whose window takes ``size`` tokens with the least sum of
        squared counts after it; of equal ones the fullest."""
        last = self.capacity - size
        levels = np.flatnonzero(self.count[:last + 1])
        # (n - 1)^2 - n^2 where the window leaves, (n + 1)^2 - n^2 where it arrives; none for full ones
        change = 1 - 2 * self.count[levels]
        change += np.where(levels < last, 2 * self.count[levels + size] + 1, 0)
        new = 2 * int(self.count[size]) + 1 if last else 0
        if not len(levels):
            return 0
        at = len(levels) - 1 - int(change[::-1].argmin())
        return int(levels[at]) if change[at] <= new else 0

    def put(self, item: Item) -> Window | None:
        """Place an item; the window, if that fills it."""
        size = len(item[2])
        level = self.best(size)
        window = self.take(level) if level else []
        window.append(item)
        if level + size == self.capacity:
            return window
        self.add(window, level + size)
        return None

    def add(self, window: Window, level: int) -> None:
        self.waiting[level].append(window)
        self.count[level] += 1
        self.open += 1

    def take(self, level: int) -> Window:
        self.count[level] -= 1
        self.open -= 1
        return self.waiting[level].pop()

    def drain(self) -> list[Window]:
        """All open windows, the fullest first; none is open afterwards."""
        return [self.take(level) for level in range(self.capacity, 0, -1) for _ in range(self.count[level])]


def close_gaps(windows: list[Window], capacity: int) -> tuple[list[Window], Window]:
    """Full windows and the rest, less than a window, of ``windows`` (the fullest first).

    The emptiest window's items go to the gap of the fullest; one that is too long is cut."""
    done, low = [], len(windows) - 1
    sizes = [fill(w) for w in windows]
    at = 0
    while at < low:
        gap = capacity - sizes[at]
        while gap and at < low:
            doc_id, start, ids, total = windows[low].pop()
            part = min(gap, len(ids))
            windows[at].append((doc_id, start + len(ids) - part, ids[len(ids) - part:], total))
            if part < len(ids):
                windows[low].append((doc_id, start, ids[:len(ids) - part], total))
            gap, sizes[at], sizes[low] = gap - part, sizes[at] + part, sizes[low] - part
            low -= not windows[low]
        if not gap:
            done.append(windows[at])
            at += 1
    return done, windows[at] if at <= low else []


def split_rest(rest: Window) -> list[Window]:
    """A window cut into sequences whose sizes are powers of two."""
    out, left = [], fill(rest)
    items = rest[::-1]
    while left:
        size = 1 << left.bit_length() - 1
        window, room = [], size
        while room:
            doc_id, start, ids, total = items.pop()
            part = min(room, len(ids))
            window.append((doc_id, start, ids[:part], total))
            if part < len(ids):
                items.append((doc_id, start + part, ids[part:], total))
            room -= part
        out.append(window)
        left -= size
    return out


def pack(docs: Iterator[tuple[object, Iterator[np.ndarray]]], capacity: int, first: int,
         most_open: int = OPEN) -> Iterator[tuple]:
    """Rows (see PLACED) of a stream of documents, each with its ids in parts; sequences are
    numbered from ``first``."""
    levels, number = Levels(capacity), first

    def rows(windows: list[Window]) -> Iterator[tuple]:
        nonlocal number
        for window in windows:
            offset = 0
            for doc_id, start, ids, total in window:
                yield doc_id, start, len(ids), zlib.crc32(ids), total, number, offset
                offset += len(ids)
            number += 1

    for doc_id, parts in docs:
        full, held, start = [], np.zeros(0, "<u4"), 0
        for part in parts:
            held = np.concatenate((held, part)) if len(held) else part
            # the last window stays, so what is placed is never empty
            for at in range(0, (len(held) - 1) // capacity * capacity, capacity):
                full.append((start, zlib.crc32(held[at:at + capacity])))
                start += capacity
            held = held[(len(held) - 1) // capacity * capacity:] if len(held) else held
        total = start + len(held)
        for at, crc in full:
            yield doc_id, at, capacity, crc, total, number, 0
            number += 1
        window = levels.put((doc_id, start, held.copy(), total))
        if window:
            yield from rows([window])
        if levels.open > most_open:
            done, rest = close_gaps(levels.drain(), capacity)
            yield from rows(done)
            if rest:
                levels.add(rest, fill(rest))
    left = levels.drain()
    yield from rows([w for w in left if whole(fill(w))])
    done, rest = close_gaps([w for w in left if not whole(fill(w))], capacity)
    yield from rows(done)
    yield from rows(split_rest(rest))


def online_packing(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and one id 0. Every sequence is full or its size is a power of
    two, so none needs padding where only other sizes are padded. One pass without a shuffle; a
    task holds OPEN windows and one document at most, and what it returns depends on its own
    rows alone, so a repeated task replaces all of it.
    * null or empty text: one piece that holds the closing id 0.
    * null id: packed like any other, returned with the null.
    * repeated rows: each is packed by itself. Ties between levels: the fullest.
    * empty table: no rows; other columns are ignored, whatever their names."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = byte_ids(path)
        close = np.zeros(1, "<u4")

        def parts(text: str) -> Iterator[np.ndarray]:
            yield from ids.parts(text)
            yield close

        def texts() -> Iterator[tuple[object, Iterator[np.ndarray]]]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield doc_id, parts(text.as_py() or "")

        names = [c.split()[0] for c in PLACED.split(", ")]
        out: list[tuple] = []
        for row in pack(texts(), capacity, TaskContext.get().partitionId() << 40):
            out.append(row)
            if len(out) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(run, PLACED)
