"""Alignment of two tokenizers' tokens, by exact-text deduplication.

Rows are shuffled by their full text, and each different text is tokenised and aligned once.
A text's tokens are aligned unit by unit (see units.py), since both tokenizers end a token where
a unit ends. Tasks write texts as unit numbers in chunks, each with a dictionary of its units
and of the pairs of ids linked in it. Pair counts, weighted by the number of rows that hold a text,
are one aggregation of these dictionaries; the corpus-wide counts join the dictionaries,
not the links, and come back to the chunk. Measures are then joined to the rows by the
text's SHA-256."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import vocabulary, vocabulary_path
from sluice.llm.common import attach, materialize, pick
from sluice.llm.units import BLOCK_CHARS, Memo, byte_ids, is_plain, unit_blocks, units

#: Units of text, and links of different units, that a chunk holds before it ends.
CHUNK_UNITS = 2_000_000
CHUNK_LINKS = 1_000_000
#: Units whose alignment is remembered by a task, twice.
CACHE_UNITS = 200_000


def piece_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def align(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """Groups, as ``a1,a2|b1;a3|b2``, and links of two tokenisations of the same bytes.

    Both lists of ends go up to the same last one. Each step meets one overlapping pair."""
    groups, links, i, j, i0, j0 = [], [], 0, 0, 0, 0
    while i < len(a):
        links.append((a[i], b[j]))
        ea, eb = a_ends[i], b_ends[j]
        i += ea <= eb
        j += eb <= ea
        if ea == eb:
            groups.append(f"{','.join(map(str, a[i0:i]))}|{','.join(map(str, b[j0:j]))}")
            i0, j0 = i, j
    return ";".join(groups), links


#: A unit's result: tokens of both, groups, their text and links (a << 32 | b, as bytes); None if the bytes differ.
Unit = tuple[int, int, int, bytes, bytes] | None


class Aligner:
    """Tokenises and aligns units, each with the space before it."""

    def __init__(self, byte_path: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.bytes_tokenizer = Tokenizer.from_file(byte_path)
        self.bytes_tokenizer.no_padding()
        self.bytes_tokenizer.no_truncation()
        self.bytes_tokenizer.encode_special_tokens = True
        self.plain = byte_ids(byte_path).plain
        v = vocabulary(byte_path)
        self.bytes_of_a = [v.bytes_of.get(i, b"") for i in range(max(v.bytes_of) + 1)]
        sp = self.piece_tokenizer = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_of_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                           for i, p in enumerate(sp.id_to_piece(list(range(sp.get_piece_size()))))]
        if any(not sp.is_control(i) and not sp.is_byte(i) and " " in p.decode().lstrip(" ")
               for i, p in enumerate(self.bytes_of_b)):
            raise ValueError("a piece goes on beyond a space that follows something else")
        self.space = sp.piece_to_id("▁")
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_of_a, self.bytes_of_b))
        # what a token looks like in the text of groups: its id and what comes after it, inside or at the end
        self.text = [b"%d%c" % (i, c) for i in range(len(self.bytes_of_a)) for c in b",|"]
        self.from_b = len(self.text)
        self.text += [b"%d%c" % (i, c) for i in range(len(self.bytes_of_b)) for c in b",;"]
        self.any_differs = False
        self.memo = Memo(self._make, CACHE_UNITS)

    def fits(self, some: list[str]) -> bool:
        """Whether both tokenizers give back the bytes of all these units."""
        known = self.memo.fill(some)
        return not self.any_differs or None not in map(known.__getitem__, some)

    def _make(self, new: list[str]) -> list[Unit]:
        """All at once as one text, where its units can't run together; else one by one."""
        plain = [u for u in new if u and not u[-1].isspace()]
        made = dict(zip(plain, self._together(plain) or map(self._alone, plain), strict=True))
        out = [made[u] if u in made else self._alone(u) for u in new]
        self.any_differs = self.any_differs or None in out
        return out

    def _alone(self, unit: str) -> Unit:
        data = f" {unit}".encode()
        a = self.bytes_tokenizer.encode(f" {unit}", add_special_tokens=False).ids
        b = self.piece_tokenizer.encode(unit) if unit else [self.space]
        a_bytes, b_bytes = [self.bytes_of_a[i] for i in a], [self.bytes_of_b[i] for i in b]
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return None
        groups, links = align(a, list(accumulate(map(len, a_bytes))), b, list(accumulate(map(len, b_bytes))))
        return (len(a), len(b), len(a) + len(b) - len(links), groups.encode(),
                np.array([x << 32 | y for x, y in links], np.int64).tobytes())

    def _together(self, units: list[str]) -> list[Unit] | None:
        """The results of units by aligning the text that they make up; None if its bytes differ."""
        if not units:
            return []
        text = " ".join(units)
        data = f" {text}".encode()
        if self.plain and is_plain(text):
            a = np.array(self.plain.encode_ordinary(" " + text), np.int64)
        else:
            a = np.array(self.bytes_tokenizer.encode(" " + text, add_special_tokens=False).ids, np.int64)
        b = np.array(self.piece_tokenizer.encode(text), np.int64)
        if any(b"".join([t[i] for i in ids.tolist()]) != data for t, ids in ((self.bytes_of_a, a), (self.bytes_of_b, b))):
            return None
        a_ends, b_ends = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        # each stretch between neighbouring ends is one overlapping pair of tokens
        ends = np.union1d(a_ends, b_ends)
        of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        links = a[of_a] << 32 | b[of_b]
        both = ends[(a_ends[of_a] == ends) & (b_ends[of_b] == ends)]
        unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
        if not np.isin(unit_ends, both).all():
            return None
        # the text of the groups: of each group the tokens of a, then those of b
        a_last, b_last = np.isin(a_ends, both), np.isin(b_ends, both)
        group_a, group_b = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        place_a = np.arange(len(a)) + np.concatenate(([0], np.flatnonzero(b_last) + 1))[group_a]
        place_b = np.arange(len(b)) + (np.flatnonzero(a_last) + 1)[group_b]
        shown = np.empty(len(a) + len(b), np.int64)
        shown[place_a], shown[place_b] = 2 * a + a_last, self.from_b + 2 * b + b_last
        texts = list(map(self.text.__getitem__, shown.tolist()))
        at = [np.concatenate(([0], np.searchsorted(x, unit_ends, "right"))) for x in (a_ends, b_ends, both, ends)]
        counts = [np.diff(x).tolist() for x in at[:3]]
        word = (at[0] + at[1]).tolist()
        place, packed = (8 * at[3]).tolist(), links.tobytes()
        return [(n_a, n_b, n_groups, b"".join(texts[w:x])[:-1], packed[k:m]) for n_a, n_b, n_groups, w, x, k, m in zip(
            *counts, word, word[1:], place, place[1:], strict=False)]


@lru_cache(1)
def aligner(byte_path: str, pieces: str) -> Aligner:
    return Aligner(byte_path, pieces)


#: kind 0: part of a text held by ``weight`` rows, ``data`` its unit numbers. kind 1: a chunk's units, ``data`` the links' pair
#: numbers and ``ends`` where each unit's links end. kind 2: a pair of a chunk, number ``pair``.
ROWS = ("chunk long, kind int, sha string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "data binary, ends binary, pair int, a int, b int, weight long")
NAMES = [c.split()[0] for c in ROWS.split(", ")]
SCHEMA = pa.schema(list(zip(NAMES, [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 4, pa.string(),
                                    pa.binary(), pa.binary(), *[pa.int32()] * 3, pa.int64()], strict=True)))


class _Chunk:
    """Units and texts of a chunk while it grows."""

    def __init__(self, number: int):
        self.number = number
        self.code: dict[str, int] = {}
        self.units: list[Unit] = []
        self.n_links = self.n_units = 0
        self.weight = np.zeros(0, np.int64)
        self.texts: list[tuple] = []

    def codes(self, some: list[str], known: dict[str, Unit]) -> np.ndarray:
        code = self.code
        for u in dict.fromkeys([u for u in some if u not in code]):
            code[u] = len(code)
            self.units.append(known[u])
            self.n_links += len(known[u][4]) // 8
        return np.fromiter(map(code.__getitem__, some), np.uint32, len(some))

    def add(self, codes: np.ndarray, copies: int) -> None:
        if len(self.weight) < len(self.code):
            self.weight = np.concatenate((self.weight, np.zeros(2 * len(self.code) - len(self.weight), np.int64)))
        np.add.at(self.weight, codes, copies)
        self.n_units += len(codes)

    def full(self) -> bool:
        return self.n_units >= CHUNK_UNITS or self.n_links >= CHUNK_LINKS

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.texts:
            return
        sizes = np.array([u[:3] for u in self.units], np.int64)
        lengths = sizes[:, 0] + sizes[:, 1] - sizes[:, 2]
        pairs, numbers = np.unique(np.frombuffer(b"".join([u[4] for u in self.units]), np.int64), return_inverse=True)
        weight = np.zeros(len(pairs), np.int64)
        np.add.at(weight, numbers, np.repeat(self.weight[:len(lengths)], lengths))
        yield _batch(len(pairs), chunk=self.number, kind=2, pair=np.arange(len(pairs), dtype=np.int32),
                     a=(pairs >> 32).astype(np.int32), b=(pairs & 0xFFFFFFFF).astype(np.int32), weight=weight)
        yield _batch(1, chunk=self.number, kind=1, data=[numbers.astype("<u4").tobytes()],
                     ends=[np.cumsum(lengths).astype("<u4").tobytes()])
        for at in range(0, len(self.texts), 4096):
            sha, codes, groups, copies = zip(*self.texts[at:at + 4096], strict=True)
            n = np.array([sizes[c].sum(axis=0) for c in codes], np.int64).reshape(-1, 3)
            yield _batch(len(sha), chunk=self.number, kind=0, sha=sha, n_a=n[:, 0], n_b=n[:, 1], n_groups=n[:, 2],
                         n_links=n[:, 0] + n[:, 1] - n[:, 2], groups_sha256=groups, weight=copies,
                         data=[c.astype("<u4").tobytes() for c in codes])


def _batch(rows: int, **columns) -> pa.RecordBatch:
    def column(name: str, kind: pa.DataType) -> pa.Array:
        value = columns.get(name)
        if value is None or isinstance(value, int):
            return pa.array([value], kind).take(pa.array(np.zeros(rows, np.int64))) if rows else pa.array([], kind)
        return pa.array(value, kind)

    return pa.RecordBatch.from_arrays([column(f.name, f.type) for f in SCHEMA], schema=SCHEMA)


def _some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Texts by the megabyte: sha, units (None: a long text), the long text, copies."""
    held, size = [], 0
    for batch in batches:
        for sha, text, copies in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
            text = text.as_py()
            short = len(text) < BLOCK_CHARS
            held.append((sha.as_py(), units(text) if short else None, None if short else text, copies))
            size += len(text)
            if size >= BLOCK_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def chunks(texts: DataFrame, byte_path: str, pieces: str) -> DataFrame:
    """Chunks (see ROWS) of the different texts in ``texts``: sha, text, copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tool, number = aligner(byte_path, pieces), TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, number
            if chunk.full():
                yield from chunk.batches()
                number += 1
                chunk = _Chunk(number)

        for some in _some_texts(batches):
            tool.memo.fill(chain.from_iterable(parts for _, parts, _, _ in some if parts))
            for sha, parts, long, copies in some:
                blocks = lambda: iter([parts]) if parts is not None else unit_blocks(long)  # noqa: E731, B023
                # a text is looked through before any of it counts
                if not all(tool.fits(p) for p in blocks()):
                    continue
                digest, before, last = hashlib.sha256(), b"", None
                for part in blocks():
                    if last is not None:
                        chunk.texts.append((sha, last, None, copies))
                        yield from full()
                    known = tool.memo.fill(part)
                    last = chunk.codes(part, known)
                    chunk.add(last, copies)
                    digest.update(before + b";".join([known[u][3] for u in part]))
                    before = b";"
                chunk.texts.append((sha, last, digest.hexdigest(), copies))
                yield from full()
        yield from chunk.batches()

    return texts.select("sha", "text", "copies").mapInArrow(run, ROWS)


SUMS = "sha string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, copies long"


def _resolve(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The measures of a chunk's texts, from the corpus-wide counts of its pairs."""
    names = [c.split()[0] for c in SUMS.split(", ")]
    count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    count[right["pair"].to_numpy()] = right["count"].to_numpy()
    best[right["pair"].to_numpy()] = right["best"].to_numpy()
    kind = left["kind"].to_numpy()
    table = left.slice(int(np.flatnonzero(kind == 1)[0]), 1)
    links, ends = (np.frombuffer(table[c][0].as_py(), "<u4") for c in ("data", "ends"))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    unit_count, unit_best = np.add.reduceat(count[links], starts), np.add.reduceat(best[links], starts)
    texts = left.filter(pa.array(kind == 0))
    sums = [[], []]
    for data in texts["data"]:
        codes = np.frombuffer(data.as_py(), "<u4")
        sums[0].append(int(unit_best[codes].sum()))
        sums[1].append(int(unit_count[codes].sum()))
    return texts.select(["sha", "n_a", "n_b", "n_groups", "n_links"]).append_column(
        "n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64())).append_column(
        "groups_sha256", texts["groups_sha256"]).append_column("copies", texts["weight"]).select(names)


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, count and best: 1 where the count is the highest that b has with any a."""
    counts = rows.where("kind = 2").groupBy("a", "b").agg(F.sum("weight").alias("count"))
    counts = materialize(counts, "pairs")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def cross_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_path: str | None = None,
                    pieces: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    * null or empty text, or one whose tokens' bytes are not a space and the text: zeros
      and an empty ``groups_sha256``; it adds nothing to the counts.
    * null id: returned as it is. Repeated rows: returned as often as given, all counted.
    * ties for the highest count: all of them are best.
    * empty table: no rows; other columns are ignored, whatever their names.
    * very long texts: read in blocks of units; only a unit must fit in a task."""
    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    some = rows.where(F.length("text") > 0)
    texts = some.groupBy("text").agg(F.count("*").alias("copies")).withColumn("sha", F.sha2("text", 256))
    done = materialize(chunks(texts, byte_path or vocabulary_path(), pieces or piece_path()), "chunks")
    pairs = done.where("kind = 2").select(F.col("chunk").alias("of_chunk"), "pair", "a", "b")
    pairs = pairs.join(pair_counts(done), ["a", "b"]).select("of_chunk", "pair", "count", "best")
    left = done.where("kind < 2").select("chunk", "kind", "sha", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                                         "data", "ends", "weight")
    parts = left.groupBy("chunk").cogroup(pairs.groupBy("of_chunk")).applyInArrow(_resolve, SUMS)
    measures = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    per_text = materialize(parts.groupBy("sha").agg(*[F.sum(c).alias(c) for c in measures], F.max("copies").alias("copies"),
                                                    F.max("groups_sha256").alias("groups_sha256")), "texts")
    # rows without a text get a key of their own, so that they don't meet in one task
    sha = F.when(F.length("text") > 0, F.sha2("text", 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("doc_id")))
    out = attach(rows.select("doc_id", sha.alias("sha")), per_text, "sha", "copies", rows.count(), "doc_id")
    return out.select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in measures],
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
