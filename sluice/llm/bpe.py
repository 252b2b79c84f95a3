"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

The merge list is used through two facts. A token sequence is the encoding of
its bytes exactly if every neighbouring pair is the encoding of its own bytes, so
the last token of each prefix's encoding follows from the tokens before it. And the
encoding of any longer text passes through one of the last ``longest`` prefixes, so
what the paths to all of these have in common is stable and can be emitted. The
number of merges times the longest token is a sufficient lookahead: the paths
have met by then, in practice after a few tokens."""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import pick, values

#: Characters that one step looks at, and pieces of text whose ids are remembered.
BLOCK_CHARS = 1 << 20
CACHE_PIECES = 250_000
#: Bytes above which a piece is streamed rather than encoded at once.
LONG_PIECE = 512
#: Ids that one batch of results holds.
BATCH_IDS = 1_000_000
#: Ids of one long piece that are handed on together.
STREAM_IDS = 1 << 16
#: Neighbouring tokens whose test is remembered.
PAIRS = 500_000

#: The pattern that splits text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_any = regex.compile(PATTERN)
#: The same for texts below U+0250, with the classes spelled out for the faster library.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_latin = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_beyond = re.compile("[^\x00-ɏ]")
#: A place where no piece goes on: white space after something else.
_seam = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[\t-\r ])")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def blocks(text: str) -> Iterator[str]:
    """The text in blocks that end where no piece goes on."""
    at = 0
    while at < len(text):
        cut = _seam.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
        end = cut.start() if cut else len(text)
        yield text[at:end] if end - at < len(text) else text
        at = end


def pieces(block: str) -> list[str]:
    return (_any if not block.isascii() and _beyond.search(block) else _latin).findall(block)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable
    characters for themselves, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = spec["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in self.special}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.made = dict.fromkeys(self.bytes_of, (-1, -1, -1))  # rank, left and right part of each token
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[a], ids[b]] = rank, ids[a + b]
            if self.made[ids[a + b]][0] < 0:
                self.made[ids[a + b]] = rank, ids[a], ids[b]
        self.longest = max(map(len, self.id_of))
        self.lookahead = len(self.merges) * self.longest
        self.reach = [0] * 256  # the longest token that ends with each byte
        for b in self.id_of:
            self.reach[b[-1]] = max(self.reach[b[-1]], len(b))
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._pairs: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        width = max(self.bytes_of) + 1
        self.sizes = np.array([len(self.bytes_of.get(i, b"")) for i in range(width)], np.int64)
        self.places = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(width)), np.uint8)

    def merged(self, data: bytes) -> list[int]:
        """The encoding by definition: the earliest merge first, at its leftmost place."""
        ids = [self.id_of[data[i:i + 1]] for i in range(len(data))]
        while len(ids) > 1:
            rank, i, new = min((*self.merges.get(p, (1 << 60, 0))[:1], i, self.merges.get(p, (0, 0))[1])
                               for i, p in enumerate(zip(ids, ids[1:], strict=False)))
            if rank == 1 << 60:
                break
            ids[i:i + 2] = [new]
        return ids

    def alone(self, token: int) -> bool:
        """Whether a token is the encoding of its own bytes."""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def follows(self, a: int, b: int) -> bool:
        """Whether b can come after a: their bytes together are encoded as [a, b].

        Undoes the merges that made the two, the latest first, and looks at the tokens
        that then touch: they must not have a merge that comes before the next one
        undone (or, left of it, is the same)."""
        key = a << 20 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            known, before, merges, made = self.alone(a) and self.alone(b), 1 << 60, self.merges, self.made
            x, y = a, b
            while known:
                merge = merges.get((x, y))
                if merge is not None and merge[0] < before:
                    known = False
                    break
                (of_x, _, x_right), (of_y, y_left, _) = made[x], made[y]
                if of_x < 0 and of_y < 0:
                    break
                if of_x > of_y:
                    before, x = of_x, x_right
                else:
                    before, y = of_y + 1, y_left
            self._pairs[key] = known
        return known


class Transducer:
    """Encodes one piece given in any number of parts; holds what isn't stable yet."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.start(-1)

    def start(self, before: int) -> None:
        self.data = b""
        self.last = [before]  # the last token of the encoding of each prefix

    def _extend(self, part: bytes) -> None:
        v, last, at = self.v, self.last, len(self.data)
        self.data = data = self.data + part
        id_of, pairs, reach = v.id_of.get, v._pairs.get, v.reach
        for end in range(at + 1, len(data) + 1):
            for start in range(end - 1, max(0, end - reach[data[end - 1]]) - 1, -1):
                token = id_of(data[start:end])
                if token is not None:
                    a = last[start]
                    good = v.alone(token) if a < 0 else pairs(a << 20 | token)
                    if good or good is None and v.follows(a, token):
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def _path(self, end: int) -> list[int]:
        out = []
        while end:
            out.append(self.last[end])
            end -= len(self.v.bytes_of[out[-1]])
        return out[::-1]

    def feed(self, part: bytes) -> list[int]:
        """The tokens that became stable: no longer text can change them."""
        self._extend(part)
        size = len(self.data)
        live = set(range(max(0, size - self.v.longest + 1), size + 1))
        while len(live) > 1:
            far = max(live)
            live.remove(far)
            live.add(far - len(self.v.bytes_of[self.last[far]]) if far else 0)
        met = live.pop()
        out = self._path(met)
        if met:
            self.data, self.last = self.data[met:], self.last[met:]
        if len(self.data) > self.v.lookahead:  # the paths have met before; the bound is proven
            raise RuntimeError("more bytes wait than the merge list can look ahead")
        return out

    def finish(self) -> list[int]:
        out = self._path(len(self.data))
        self.start(-1)
        return out


class Encoder:
    """Encodes whole texts block by block, remembering the ids of short pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.transducer, self.known = vocabulary, Transducer(vocabulary), {}
        self.older: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """The ids of one piece as 32-bit integers."""
        data, t = text.encode(), self.transducer
        out = []
        for at in range(0, len(data), LONG_PIECE):
            if len(data) <= LONG_PIECE:
                t._extend(data)
            else:
                out += t.feed(data[at:at + LONG_PIECE])
        return np.array(out + t.finish(), "<i4").tobytes()

    def _block(self, block: str) -> bytes:
        known, out = self.known, []
        for p in pieces(block):
            ids = known.get(p)
            if ids is None:
                ids = self.older.get(p) or self.piece(p)
                if len(p) <= LONG_PIECE:
                    if len(known) >= CACHE_PIECES:
                        self.known, self.older = {}, known
                        known = self.known
                    known[p] = ids
            out.append(ids)
        return b"".join(out)

    def _long(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a block without seams longer than a block, as its pieces' tokens become stable."""
        t = self.transducer
        for match in (_any if _beyond.search(text) else _latin).finditer(text):
            out: list[int] = []
            for at in range(match.start(), match.end(), LONG_PIECE):
                out += t.feed(text[at:min(at + LONG_PIECE, match.end())].encode())
                if len(out) > STREAM_IDS:
                    yield np.array(out, "<i4")
                    out = []
            yield np.array(out + t.finish(), "<i4")

    def stream(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, part by part; never more of them than those of a block."""
        special, at = self.v.special, 0
        cuts = self.v.split.finditer(text) if self.v.split else ()
        for cut in cuts:
            yield from self._parts(text[at:cut.start()])
            yield np.array([special[cut.group()]], "<i4")
            at = cut.end()
        yield from self._parts(text[at:] if at else text)

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        for block in blocks(text):
            if len(block) > 2 * BLOCK_CHARS:
                yield from self._long(block)
            else:
                yield np.frombuffer(self._block(block), "<i4")

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<i4"), *self.stream(text)])


class Decoder:
    """Turns ids into text as they come; bytes of an unfinished character wait."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        size = self.v.sizes[ids]
        ends = np.cumsum(size)
        if not len(ids) or not ends[-1]:
            return ""
        at = np.repeat(self.v.places[ids] - (ends - size), size) + np.arange(ends[-1])
        return self.state.decode(self.v.all_bytes[at].tobytes())

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path))


def decode(ids: np.ndarray, v: Vocabulary, step: int = 1 << 18) -> str:
    d = Decoder(v)
    return "".join([d.feed(ids[at:at + step]) for at in range(0, len(ids), step)] + [d.finish()])


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, ids (array of int), no special tokens added.

    A special token's own string in a text is encoded as that token.
    * null or empty text: no ids. null id: returned as it is.
    * repeated rows: returned as often as given. Empty table: no rows.
    * other columns are ignored, whatever their names.
    ``path``: a vocabulary file with byte-level merges, present on every executor."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            held, size, ids, at = [], 0, batch.column(0), 0
            texts = batch.column(1)
            for i in range(batch.num_rows):
                held.append(enc.encode(texts[i].as_py() or ""))
                size += len(held[-1])
                if size > BATCH_IDS or i == batch.num_rows - 1:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held)))
                    yield pa.RecordBatch.from_arrays([ids.slice(at, len(held)), lists], names=["doc_id", "ids"])
                    held, size, at = [], 0, i + 1

    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
               path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, ids, text; special tokens are kept in the text.

    * null ids: an empty text. Bytes that are no UTF-8 become U+FFFD.
    * an id that the vocabulary has no token for stands for no bytes; one beyond its range, or
      below 0, fails the job.
    * null id of a document: returned as it is; repeated rows: as often as given; empty table:
      no rows; other columns are ignored."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            texts = [decode(lists[i].values.to_numpy() if lists[i].is_valid else np.zeros(0, np.int32), v)
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    rows = pick(tokens, doc_id=(id_col, "long"), ids=(ids_col, "array<int>"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text."""
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return decoded.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text, of every row.

    What :func:`digests` gives after :func:`bpe_encode` and :func:`bpe_decode`, without holding
    a document's ids or decoded text: ids go to the hash and through the decoder as
    they become stable. Nulls, repeated rows and other columns as in :func:`bpe_encode`."""
    path = path or vocabulary_path()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, v = encoder(path), vocabulary(path)
        number = [b"%d" % i for i in range(len(v.sizes))]

        def one(text: str) -> tuple[int, str, str]:
            n, before, decoder = 0, b"", Decoder(v)
            ids_sha, text_sha = hashlib.sha256(), hashlib.sha256()
            for ids in enc.stream(text):
                if len(ids):
                    ids_sha.update(before + b",".join(map(number.__getitem__, ids.tolist())))
                    text_sha.update(decoder.feed(ids).encode())
                    n, before = n + len(ids), b","
            text_sha.update(decoder.finish().encode())
            return n, ids_sha.hexdigest(), text_sha.hexdigest()

        for batch in batches:
            found = [one(text or "") for text in values(batch.column(1))]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(
                columns[1], pa.string()), pa.array(columns[2], pa.string())], names=names)

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
