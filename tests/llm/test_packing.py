"""Best-fit packing: round trips, bounds against exact search, bin counts."""

import random
import zlib
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from sluice.llm import packing as P
from sluice.llm.bpe import vocabulary_path


def _optimum(lengths, capacity):
    @lru_cache(None)
    def bins(left):
        if not left:
            return 0
        first, rest, best = left[0], left[1:], 99

        def fill(room, i, kept):
            nonlocal best
            best = min(best, 1 + bins(tuple(kept) + rest[i:])) if i == len(rest) else best
            if i < len(rest):
                if rest[i] <= room:
                    fill(room - rest[i], i + 1, kept)
                fill(room, i + 1, [*kept, rest[i]])
        fill(capacity - first, 0, [])
        return best
    return bins(tuple(sorted(lengths, reverse=True)))


def test_bound_never_exceeds_the_optimum():
    rng = random.Random(1)
    met = 0
    for _ in range(120):
        lengths = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 8))]
        bound = P.lower_bound(np.bincount(lengths, minlength=21), 20)
        best = _optimum(lengths, 20)
        assert bound <= best
        met += bound == best
        assert len(P.best_fit(np.array(lengths), 20)[2]) >= best
    assert met > 100
    assert P.lower_bound(np.zeros(21, int), 20) == 0


def test_pieces_and_sequences(spark):
    rng = random.Random(2)
    texts = [None, "", "a", "é <|endoftext|> b", "word " * 9000, "zq" * 4000, " ".join("xyz" for _ in range(2046))]
    texts += [" ".join(rng.choice(["the", "Haus", "12", "été!"]) for _ in range(rng.randrange(1, 1500)))
              for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, row int, PART string")
    tok = Tokenizer.from_file(vocabulary_path())
    expect = []
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for k in range(-(-len(ids) // 2048)):
            end = start + ((len(ids) - 1) % 2048 + 1 if k == 0 else 2048)
            expect.append((i, k, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            start = end
    for part in (P.PART, 25):  # 25: several partitions and rounds of exchange
        got = [tuple(r) for r in P.best_fit_packing(docs.repartition(4), part=part).collect()]
        assert sorted((g[:5] for g in got), key=str) == sorted(expect, key=str)
        bins = {}
        for g in got:
            bins.setdefault(g[5], []).append((g[6], g[3]))
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= 2048
        bound = P.lower_bound(np.bincount([e[3] for e in expect], minlength=2049), 2048)
        assert bound <= len(bins) <= bound + 1 + (part == 25)


def test_empty_table(spark):
    assert P.best_fit_packing(spark.createDataFrame([], "doc_id long, text string")).count() == 0
