"""Substring dedup by seed and extend.

Seeds are winnowed word k-grams: every window of WINDOW words holds at least one, chosen by the
window's words alone, so equal windows hold equal seeds. Documents are joined on the seeds (anchors)
that more than one of them has. Every occurrence of an anchor is compared with one holder, the
smallest document's: the match is extended to both sides, word by word, and is a
repeat if it reaches the window. What an occurrence doesn't share with that holder
it may share with another, so the windows left over go on with longer anchors: the anchor and
what all windows of a part of them have around it, first halves, then quarters, then eighths,
then single windows. Occurrences whose anchor no other document has drop out, so most take part
once or twice. There are no pairs of occurrences, however many documents an anchor has. Matches
on one diagonal that touch are one maximal repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import BLOCK, WHITESPACE, attach, materialize, pick, small_batches, values

WINDOW = 50
SEED_WORDS = 16
#: Words of a segment; words, rows (texts or segments) and matches that are looked at in one go; and
#: bytes of a word's hash in a holder's context.
SEGMENT = 16_384
GROUP_WORDS = 50_000
BATCH_ROWS = 250
MATCHES = 8192
CONTEXT_BYTES = 6
_CONTEXT_BITS = np.uint64((1 << 8 * CONTEXT_BYTES) - 1)

_rng = np.random.default_rng(0x5EED)
_BYTES = _rng.integers(0, 2**64, (2, 256), np.uint64)
_BASES = [int(b) | 1 for b in _rng.integers(0, 2**64, 6, np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2^64, and their inverses."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(2 * n, 1 << 15)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        known = _powers[base] = tuple(made)
    return known[0][:n], known[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _block_hashes(data: bytes, family: int) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random values of its bytes."""
    b = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([True], _SPACE[b], [True])).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(_BASES[family], len(b))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[family][b] * up)))
    return _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: bytes, family: int) -> np.ndarray:
    """Hashes of the words of UTF-8 text. Equal words have equal hashes at any place.

    Works in blocks; a word longer than a block is hashed by itself."""
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            cut = WHITESPACE.search(data, end)
            end = cut.start() if cut else len(data)
        block = data[at:end]
        last = block.rsplit(None, 1)[-1:] if len(block) > BLOCK else []
        if last and len(last[0]) > BLOCK:
            out.append(_block_hashes(block[:block.rindex(last[0])], family))
            name = hashlib.blake2b(last[0], digest_size=8, key=b"%d" % family).digest()
            out.append(np.frombuffer(name, np.uint64))
        else:
            out.append(_block_hashes(block, family))
        at = end
    return np.concatenate(out)


def rolling(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(words) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + size - 1]
        up, down = _power(base, len(part))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * up)))
        m = len(part) - size + 1
        out[at:at + m] = _mix((total[size:] - total[:m]) * down[:m])
    return out


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places of the rightmost least hash of each ``span`` neighbours."""
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(hashes) - span + 1, BLOCK):
        h = hashes[at:at + BLOCK + span - 1]
        best, width = np.arange(len(h)), 1
        while width < span:
            step = min(width, span - width)
            a, b = best[:-step], best[step:]
            best = np.where(h[b] <= h[a], b, a)
            width += step
        found.append(np.unique(best) + at)
    return np.unique(np.concatenate(found))


def seeds(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the seeds of a document; none if it is shorter than a window."""
    size = min(SEED_WORDS, window)
    grams = rolling(words, size, _BASES[2])
    places = winnow(grams, window - size + 1)
    return grams[places], places


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate([np.zeros(0, kind.to_pandas_dtype()), *values]).astype(kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _words_sha(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def _scan(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha, hashes, places = [], [], [], []
            for text in values(batch.column(1)):
                data = (text or "").encode()
                words = data.split()
                n.append(len(words))
                sha.append(_words_sha(words))
                del words
                h, p = (seeds(word_hashes(data, 0), window) if n[-1] >= window
                        else (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                hashes.append(h.view(np.int64))
                places.append(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
                 _lists(hashes, pa.int64()), _lists(places, pa.int32())],
                names=["doc_id", "n_words", "sha", "seeds", "places"])
    return run


def _size(window: int) -> int:
    return min(SEED_WORDS, window)


def _segments(window: int):
    """Documents in segments of their words, with the margin that extension looks at, and
    the places of shared seeds in each: (doc_id, tag, seg, base, text, places)."""
    margin, size = window - _size(window), _size(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, tag, text, places in zip(*[values(batch.column(i)) for i in range(4)], strict=True):
                words, p = text.encode().split(), np.unique(np.array(places, np.int64))
                for seg in np.unique(p // SEGMENT).tolist():
                    base = max(0, seg * SEGMENT - margin)
                    part = words[base:(seg + 1) * SEGMENT + size + margin]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), pa.array([tag], pa.int64()), pa.array([seg], pa.int32()),
                         pa.array([base], pa.int64()), pa.array([len(part)], pa.int64()),
                         pa.array([b" ".join(part).decode()], pa.string()),
                         pa.array([p[p // SEGMENT == seg].tolist()], pa.list_(pa.int64()))],
                        names=["doc_id", "tag", "seg", "base", "n", "text", "places"])
    return run


SEGMENTS = "doc_id long, tag long, seg int, base long, n long, text string, places array<long>"


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (with their number of words in ``n``) in groups of about GROUP_WORDS words."""
    for batch in batches:
        group = (np.cumsum(batch.column("n").to_numpy(zero_copy_only=False)) - 1) // GROUP_WORDS
        cut = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if batch.num_rows else [0]
        for at, end in zip(cut, cut[1:], strict=False):
            yield batch.slice(at, end - at)


class _Segments:
    """The word hashes of some segments, one after the other, and digests of runs of their words."""

    def __init__(self, batch: pa.RecordBatch, window: int):
        self.margin, self.size = window - _size(window), _size(window)
        column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        self.data = b" ".join([t.encode() for t in values(batch.column("text"))])
        n = column("n")
        self.start = np.cumsum(n) - n
        self.end = self.start + n
        self.shift = self.start - column("base")
        self._words: dict[int, np.ndarray] = {}
        self._runs: dict[int, list[np.ndarray]] = {}

    def words(self, family: int) -> np.ndarray:
        if family not in self._words:
            self._words[family] = word_hashes(self.data, family)
        return self._words[family]

    def keys(self, row: np.ndarray, place: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """128-bit digests of what all windows that begin ``low`` to ``high`` words before a place share."""
        length = self.size + low + self.margin - high
        if length not in self._runs:
            self._runs = {length: [rolling(self.words(f), length, _BASES[3 + f]) for f in (0, 1)]}
        at = self.shift[row] + place - low
        first, second = self._runs[length]
        return first[at].view(np.int64), second[at].view(np.int64)

    def around(self, row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words before (nearest first) and after each place's seed, and how many
        there are on each side."""
        words, step = self.words(0), np.arange(self.margin)
        at = self.shift[row] + place
        left = np.minimum(self.margin, at - self.start[row])
        right = np.minimum(self.margin, self.end[row] - at - self.size)
        both = np.concatenate((words[np.maximum(at[:, None] - 1 - step, 0)],
                               words[np.minimum(at[:, None] + self.size + step, len(words) - 1)]), axis=1)
        return both & _CONTEXT_BITS, left, right


def _fields(structs: pa.StructArray) -> dict[str, pa.Array]:
    return dict(zip([f.name for f in structs.type], structs.flatten(), strict=True))


def _lists_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each element of a list column, and the elements."""
    sizes = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), sizes), column.flatten()


def _pack(context: np.ndarray) -> pa.Array:
    """Rows of word hashes, CONTEXT_BYTES each, as binary values."""
    rows = np.ascontiguousarray(context, "<u8").view(np.uint8).reshape(*context.shape, 8)[:, :, :CONTEXT_BYTES]
    width = context.shape[1] * CONTEXT_BYTES
    ends = pa.py_buffer((np.arange(len(context) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(context), [None, ends, pa.py_buffer(rows.tobytes())])


def _unpack(packed: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(packed), width, 8), np.uint8)
    ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
    flat = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    out[:, :, :CONTEXT_BYTES] = flat.reshape(len(packed), width, CONTEXT_BYTES)
    return out.reshape(len(packed), 8 * width).view("<u8")


def _first_anchors(window: int):
    """The occurrences of shared seeds: (k1, k2, low, doc_id, tag, seg, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            row, places = _lists_of(batch.column("places"))
            places = places.to_numpy(zero_copy_only=False)
            k1, k2 = _Segments(batch, window).keys(row, places, 0, window - _size(window))
            names = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), pa.array(np.zeros(len(row), np.int32)),
                 *[batch.column(c).take(names) for c in ("doc_id", "tag", "seg")], pa.array(places)],
                names=["k1", "k2", "low", "doc_id", "tag", "seg", "place"])
    return run


ANCHORS = "k1 long, k2 long, low int, doc_id long, tag long, seg int, place long"


def _contexts(window: int):
    """The words around the holders' occurrences: (k1, k2, low, of_doc, of_place, left, right, context)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            row, held = _lists_of(batch.column("held"))
            own, fields = _Segments(batch, window), _fields(held)
            for at in range(0, len(row), MATCHES):
                h, some = {c: x.slice(at, MATCHES) for c, x in fields.items()}, row[at:at + MATCHES]
                context, left, right = own.around(some, h["place"].to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays(
                    [h["k1"], h["k2"], h["low"].cast(pa.int32()), batch.column("doc_id").take(pa.array(some)), h["place"],
                     pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), _pack(context)],
                    names=["k1", "k2", "low", "of_doc", "of_place", "left", "right", "context"])
    return run


CONTEXTS = "k1 long, k2 long, low int, of_doc long, of_place long, left int, right int, context binary"


def parts_of(margin: int) -> list[list[tuple[int, int]]]:
    """By level, the parts of the places 0 to ``margin`` that a window can begin before a seed:
    all, halves, quarters, eighths, single ones. Each part lies in one of the level before."""
    levels = [[(0, margin)]]
    for _ in range(3):
        levels.append([x for a, b in levels[-1] for x in (
            ((a, (a + b) // 2), ((a + b) // 2 + 1, b)) if a < b else ((a, b),))])
    levels.append([(o, o) for o in range(margin + 1)])
    return [x for i, x in enumerate(levels) if not i or x != levels[i - 1]]


def _extend(window: int, level: int):
    """Matches of a segment's occurrences with their holders' words, extended both ways.

    kind 0: a repeat, ``place`` to ``high`` of the document and from ``of_place`` of ``of_doc``.
    kind 1: an occurrence some of whose windows in a part of the next level no holder has matched."""
    size, margin = _size(window), window - _size(window)
    levels = parts_of(margin)
    later = levels[level + 1] if level + 1 < len(levels) else []

    low_of, high_of = np.array(levels[level]).T
    fits = [(a, b, (low_of <= a) & (b <= high_of)) for a, b in later]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            own = _Segments(batch, window)
            rows, met = _lists_of(batch.column("met"))
            fields = _fields(met)
            for at in range(0, len(rows), MATCHES):
                row, m = rows[at:at + MATCHES], {c: x.slice(at, MATCHES) for c, x in fields.items()}
                place, low, of_doc, of_place, their_left, their_right = (m[c].to_numpy(zero_copy_only=False) for c in (
                    "place", "low", "of_doc", "of_place", "left", "right"))
                mine, left, right = own.around(row, place)
                equal = mine == _unpack(m["context"], 2 * margin)
                to_left, to_right = (np.minimum(np.minimum(a, b), np.logical_and.accumulate(e, axis=1).sum(axis=1)) for a, b, e in (
                    (left, their_left, equal[:, :margin]), (right, their_right, equal[:, margin:])))
                del mine, equal
                doc_id = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
                repeat = (to_left + to_right >= margin) & (of_doc < doc_id)
                yield _extended(0, batch, *_merged(row[repeat], of_doc[repeat], (place - to_left)[repeat],
                                                   (place + size + to_right)[repeat], (of_place - to_left)[repeat]))
                # windows that begin so many words before the seed: possible ones, and matched ones
                here = np.searchsorted(low_of, low)
                first, last = np.maximum(low_of[here], margin - right), np.minimum(high_of[here], left)
                for a, b, inside in fits:
                    x, y = np.maximum(first, a), np.minimum(last, b)
                    some = inside[here] & (x <= y) & ~((margin - to_right <= x) & (y <= to_left))
                    if some.any():
                        yield _extended(1, batch, row[some], None, place[some], None, None, a, own.keys(row[some], place[some], a, b))
    return run


EXTENDED = ("kind int, k1 long, k2 long, low int, doc_id long, tag long, seg int, place long, high long, "
            "of_doc long, of_place long")


def _extended(kind: int, batch: pa.RecordBatch, row: np.ndarray, of_doc, place: np.ndarray, high, of_place, low=None,
              keys=(None, None)) -> pa.RecordBatch:
    """Rows of :data:`EXTENDED` for segments of a batch."""
    n, of = len(row), pa.array(row, pa.int64())
    column = lambda x, t=pa.int64(): pa.nulls(n, t) if x is None else pa.array(x, t)
    return pa.RecordBatch.from_arrays(
        [column(np.full(n, kind), pa.int32()), column(keys[0]), column(keys[1]),
         column(None if low is None else np.full(n, low), pa.int32()), *[batch.column(c).take(of) for c in ("doc_id", "tag", "seg")],
         column(place), column(high), column(of_doc), column(of_place)], names=[c.split()[0] for c in EXTENDED.split(", ")])


def _merged(row: np.ndarray, of_doc: np.ndarray, start: np.ndarray, end: np.ndarray,
            of_start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches of a segment on one diagonal that touch as one: (row, of_doc, start, end, of_start)."""
    order = np.lexsort((start, start - of_start, of_doc, row))
    row, of_doc, start, end, of_start = (x[order] for x in (row, of_doc, start, end, of_start))
    if not len(row):
        return row, of_doc, start, end, of_start
    line = np.stack((row, of_doc, start - of_start))
    new = np.concatenate(([True], (line[:, 1:] != line[:, :-1]).any(axis=0)))
    # the highest end so far on the same diagonal: lines are lifted above each other
    lift = np.cumsum(new) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return row[at], of_doc[at], start[at], np.maximum.reduceat(end, at), of_start[at]


def _kept(with_text: bool):
    """What stays of documents without their spans, and the digest of all their words, by which a row
    is told from others of its id: (doc_id, tag, n_removed, kept_sha, sha) and, if asked for, kept_text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, kept_sha, sha, texts = [], [], [], []
            for text, starts, ends in zip(*[values(batch.column(i)) for i in (2, 3, 4)], strict=True):
                words = (text or "").encode().split()
                sha.append(_words_sha(words))
                mark = np.zeros(len(words) + 1, np.int32)  # the spans may be those of a longer row of the id
                np.add.at(mark, np.minimum(np.array(starts, np.int64), len(words)), 1)
                np.add.at(mark, np.minimum(np.array(ends, np.int64), len(words)), -1)
                stay = np.cumsum(mark)[:-1] == 0
                kept = b" ".join([words[i] for i in np.flatnonzero(stay).tolist()])
                n.append(int(len(words) - stay.sum()))
                kept_sha.append(hashlib.sha256(kept).digest())
                if with_text:
                    texts.append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(kept_sha, pa.binary()),
                 pa.array(sha, pa.binary()), *([pa.array(texts, pa.string())] if with_text else [])],
                names=["doc_id", "tag", "n_removed", "kept_sha", "sha", *(["kept_text"] if with_text else [])])
    return run


def _tag():
    """A row's name among the rows of its id: 64 bits of its words' SHA-256."""
    return F.xxhash64("sha")


def _scanned(rows: DataFrame, window: int) -> DataFrame:
    """Every row with its number of words, seeds, and whether a smaller document has the same words."""
    scan = materialize(rows.mapInArrow(_scan(window), "doc_id long, n_words long, sha binary, "
                                       "seeds array<long>, places array<int>"), "scan")
    # a document whose whole word sequence a smaller one has needs no seeds
    same = scan.where("doc_id is not null").groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n_rows")).where("n_rows > 1")
    scan = attach(scan, same, "sha", "n_rows", scan.count(), "doc_id").withColumn(
        "copy", F.col("first") < F.col("doc_id")).withColumn("tag", _tag())
    return materialize(scan.select("doc_id", "tag", "n_words", "sha", "seeds", "places",
                                   F.coalesce("copy", F.lit(False)).alias("copy")), "scan-copies")


def _repeats(rows: DataFrame, scan: DataFrame, window: int) -> DataFrame:
    """Repeats with smaller documents: (doc_id, tag, place, high, of_doc, of_place), merged by segment."""
    own = scan.where("doc_id is not null and not copy")
    shared = own.select("doc_id", F.explode("seeds").alias("seed")).groupBy("seed").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n_rows"))
    shared = materialize(shared.where("least < most").select("seed", "n_rows"), "shared-seeds")
    total = shared.agg(F.sum("n_rows")).first()[0] or 0
    found = own.select("doc_id", "tag", F.explode(F.arrays_zip("seeds", "places")).alias("at")).select(
        "doc_id", "tag", F.col("at.seeds").alias("seed"), F.col("at.places").alias("place"))
    found = attach(found, shared, "seed", "n_rows", total, "place").where("n_rows is not null").groupBy(
        "doc_id", "tag").agg(F.collect_set("place").alias("places"))
    # rows of one id with equal words are one document here
    near = _texts_of(rows, found, "places").dropDuplicates(["doc_id", "tag"])
    near = materialize(near.select("doc_id", "tag", "text", "places").mapInArrow(_segments(window), SEGMENTS), "segments")

    key, segment = F.struct("k1", "k2", "low").alias("key"), ["doc_id", "tag", "seg"]
    anchors = materialize(near.mapInArrow(_first_anchors(window), ANCHORS), "first-anchors")
    done = []
    for level in range(len(parts_of(window - _size(window)))):
        groups = anchors.groupBy("k1", "k2", "low").agg(
            F.min(F.struct(*segment, "place")).alias("holder"), F.max("doc_id").alias("most"), F.count("*").alias("n_rows"))
        groups = materialize(groups.where("holder.doc_id < most").drop("most"), "anchors")
        total = groups.agg(F.sum("n_rows")).first()[0] or 0
        if not total:
            break
        held = groups.select("holder.doc_id", "holder.tag", "holder.seg", F.struct(
            "k1", "k2", "low", F.col("holder.place").alias("place")).alias("h")).groupBy(*segment).agg(F.collect_list("h").alias("held"))
        contexts = near.join(held, segment).select("doc_id", "base", "n", "text", "held").mapInArrow(_contexts(window), CONTEXTS)
        sizes = groups.select(key, "n_rows")
        holders = sizes.join(contexts.select(key, "of_doc", "of_place", "left", "right", "context"), "key")
        met = attach(anchors.select(key, *segment, "place"), holders, "key", "n_rows", total, "place", sizes).where(
            "n_rows is not null").select(*segment, F.struct(
                "place", F.col("key.low").alias("low"), "of_doc", "of_place", "left", "right", "context").alias("m"))
        met = near.join(met.groupBy(*segment).agg(F.collect_list("m").alias("met")), segment)
        out = materialize(met.select("doc_id", "tag", "seg", "base", "n", "text", "met").mapInArrow(
            _extend(window, level), EXTENDED), "extended")
        done.append(out.where("kind = 0").select("doc_id", "tag", "place", "high", "of_doc", "of_place"))
        anchors = out.where("kind = 1").select(*[c.split()[0] for c in ANCHORS.split(", ")])
    if not done:
        return rows.sparkSession.createDataFrame([], "doc_id long, tag long, place long, high long, of_doc long, of_place long")
    return reduce(DataFrame.unionByName, done)


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, start, n_words, of_doc_id, of_start: runs of at least ``window`` words that a document
    shares with a smaller one, as long as the two go on alike.

    Every word that :func:`substring_dedup` takes from a document lies in one of them, except in a
    document all of whose words a smaller one has in the same order: it is left out here. A run that
    several smaller documents have is given for the smallest holder of each of its anchors.
    Nulls, repeated rows and empty tables as there; a row without an id has no runs."""
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    with small_batches(docs.sparkSession, BATCH_ROWS):
        spans = _repeats(rows, _scanned(rows, window), window)
    spans = spans.withColumn("diagonal", F.col("place") - F.col("of_place"))
    # matches of several anchors and segments on one diagonal: islands of spans that touch
    line = Window.partitionBy("doc_id", "tag", "of_doc", "diagonal")
    spans = spans.withColumn("before", F.max("high").over(line.orderBy("place", "high").rowsBetween(Window.unboundedPreceding, -1)))
    island = F.sum(F.when(F.col("before") >= F.col("place"), 0).otherwise(1)).over(line.orderBy("place", "high"))
    return spans.withColumn("island", island).groupBy("doc_id", "tag", "of_doc", "diagonal", "island").agg(
        F.min("place").alias("start"), F.max("high").alias("high")).select(
        "doc_id", "start", (F.col("high") - F.col("start")).alias("n_words"), F.col("of_doc").alias("of_doc_id"),
        (F.col("start") - F.col("diagonal")).alias("of_start"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text
    and words_sha256 (of all its words, joined by one space: it tells rows of one id apart).

    A word goes if it lies in a run of ``window`` words that also starts in a
    document with a smaller id. kept_text is null where nothing goes (the text
    stays as it is), else the kept words joined by one space.

    * null text or white space only: no words, nothing removed.
    * null id: nothing is removed from such a row, nor from others for its sake.
    * repeated rows, and rows of one id with different texts: none is smaller
      than the other; each is judged by itself against smaller ids.
    * empty table: no rows; other columns are ignored, whatever their names."""
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    # rows hold texts, segments also the contexts of their matches: few at a time go to Python
    with small_batches(docs.sparkSession, BATCH_ROWS):
        scan = _scanned(rows, window)
        spans = _repeats(rows, scan, window).groupBy("doc_id", "tag").agg(
            F.collect_list(F.struct("place", "high")).alias("spans"))
        cut = rows.join(spans, "doc_id").select("doc_id", "tag", "text", "spans.place", "spans.high").mapInArrow(
            _kept(with_text), "doc_id long, tag long, n_removed long, kept_sha binary, sha binary" + ", kept_text string" * with_text)
        cut = materialize(cut.where(F.col("tag") == _tag()).drop("sha"), "cut")
    out = scan.drop("seeds", "places").join(cut.dropDuplicates(["doc_id", "tag"]), ["doc_id", "tag"], "left")
    gone = F.col("copy") & (F.col("n_words") >= window)
    empty = hashlib.sha256(b"").hexdigest()
    sha = F.lower(F.hex(F.coalesce("kept_sha", "sha")))
    out = out.select("doc_id", "n_words",
                     F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                     F.when(gone, F.lit(empty)).otherwise(sha).alias("kept_sha256"),
                     *([F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
                        F.lower(F.hex("sha")).alias("words_sha256")] if with_text else []))
    return out


def _texts_of(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """Texts of the rows named in ``found`` by id and by the hash of their words."""
    both = rows.join(found, "doc_id").select("doc_id", "tag", "text", column)
    kind = both.schema[column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha = [_words_sha((t or "").encode().split()) for t in values(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sha, pa.binary())],
                                             names=[*batch.schema.names, "sha"])

    return both.mapInArrow(run, f"doc_id long, tag long, text string, {column} {kind}, sha binary").where(
        F.col("tag") == _tag()).drop("sha")
