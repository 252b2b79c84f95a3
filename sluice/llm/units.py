"""Texts as units: a text is cut at every space that follows something else than white
space. Neither the byte-level nor the piece vocabulary has a token that goes on beyond such
a place, so a text's tokens are those of its units, and a unit met again needs no new work."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np

from sluice.llm.bpe import PATTERN, _beyond, blocks, vocabulary

#: Characters looked at in one step, and units remembered by a task, twice.
BLOCK_CHARS = 1 << 20
CACHE_UNITS = 300_000
#: Longer units are not remembered.
LONG_UNIT = 256
#: Longer runs of one kind are not for a library that is quadratic in them.
LONG_RUN = 1000

_cut = re.compile(r"(?<=\S) ")
_gap = re.compile(r"\s{%d}" % LONG_RUN)
_odd = re.compile(r"\s |^ ")


def units(block: str) -> list[str]:
    """The units of a text or block, each without the space it was cut at."""
    return _cut.split(block) if _odd.search(block) else block.split(" ")


def unit_blocks(text: str) -> Iterator[list[str]]:
    """The units of a text in lists of about BLOCK_CHARS characters."""
    at = 0
    while True:
        cut = _cut.search(text, at + BLOCK_CHARS) if len(text) - at > BLOCK_CHARS else None
        yield units(text[at:cut.start()] if cut else text[at:])
        if not cut:
            return
        at = cut.end()


class Memo:
    """Results by unit, made for many new units at once; the lesser used half goes when it is full."""

    def __init__(self, make: Callable[[list[str]], Iterable], size: int = CACHE_UNITS):
        self.make, self.size = make, size
        self.known: dict[str, object] = {}
        self.older: dict[str, object] = {}
        self.long: list[str] = []

    def fill(self, wanted: Iterable[str]) -> dict[str, object]:
        """A dictionary that holds the results of ``wanted``, until the next call."""
        known = self.known
        for u in self.long:
            del known[u]
        self.long = []
        new = [u for u in dict.fromkeys(wanted) if u not in known]
        if not new:
            return known
        if len(known) + len(new) > self.size:
            self.known, self.older = {}, known
            known, new = self.known, list(dict.fromkeys(wanted))
        older = self.older
        known.update((u, older[u]) for u in new if u in older)
        new = [u for u in new if u not in known]
        known.update(zip(new, self.make(new), strict=True))
        self.long = [u for u in new if len(u) > LONG_UNIT]
        return known


class ByteIds:
    """Ids of whole texts, as the tokenizers library gives them.

    Plain text goes to the tiktoken library with the same vocabulary, which is faster: only characters
    below U+0250, whose classes no two libraries see differently, and no very long run, on which
    it is quadratic. The tokenizers library encodes the rest, unit by unit."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = Memo(self._ids, 10_000)
        self.later = Memo(lambda new: self._ids([" " + u for u in new]))
        v = vocabulary(path)
        made = [new for _, new in sorted(v.merges.values())]
        self.plain = None
        if made == sorted(made):  # merges in the order of their ids, as tiktoken takes them
            self.plain = tiktoken.Encoding("plain", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                b: i for i, b in v.bytes_of.items() if i not in v.special.values()})

    def _ids(self, new: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]

    def parts(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, part by part; a special token's string is that token."""
        if any(s in text for s in self.special):  # rare: the library does it all
            yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            return
        for block in blocks(text):
            if self.plain and is_plain(block):
                yield np.array(self.plain.encode_ordinary(block), "<u4")
                continue
            some = units(block)
            head = self.first.fill(some[:1])[some[0]]
            known = self.later.fill(some[1:])
            yield np.frombuffer(head + b"".join([known[u] for u in some[1:]]), "<u4")


def is_plain(text: str) -> bool:
    """Whether a text has only characters below U+0250 and no run of LONG_RUN like ones."""
    if not text.isascii() and _beyond.search(text):
        return False
    sizes = list(map(len, text.split()))
    spaces = len(text) - sum(sizes)
    return max(sizes, default=0) < LONG_RUN and (spaces - len(sizes) < LONG_RUN - 2 or not _gap.search(text))


@lru_cache(2)
def byte_ids(path: str) -> ByteIds:
    return ByteIds(path)
