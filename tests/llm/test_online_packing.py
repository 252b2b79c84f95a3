"""Sum-of-squares packing: choices by definition, exact pieces, no padding, few cuts, edges."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from sluice.llm import online_packing as P
from sluice.llm.bpe import vocabulary_path


def test_choice_has_the_least_sum_of_squares():
    rng = random.Random(1)
    for _ in range(300):
        levels = P.Levels(32)
        for size in range(1, 32):
            levels.count[size] = rng.choice([0, 0, 1, 2, 5])
        size = rng.randrange(1, 32)

        def after(level):
            count = levels.count.copy()
            if level:
                count[level] -= 1
            if level + size < 32:
                count[level + size] += 1
            return int((count ** 2).sum())
        allowed = [0] + [x for x in range(1, 33 - size) if levels.count[x]]
        least = min(map(after, allowed))
        assert levels.best(size) == max(x for x in allowed if after(x) == least)


def _check(rows, sizes, capacity):
    """Every id in one piece, every sequence gapless, full or of a size that needs no padding."""
    spans, windows = {}, {}
    for doc_id, start, length, _, total, sequence, offset in rows:
        assert length > 0 and total == sizes[doc_id]
        spans.setdefault(doc_id, []).append((start, length))
        windows.setdefault(sequence, []).append((offset, length))
    assert set(spans) == set(sizes)
    for parts, size in [(p, sizes[d]) for d, p in spans.items()] + [(w, None) for w in windows.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size if size else at == capacity or at & (at - 1) == 0 and at < capacity
    return windows


def test_streams_of_any_sizes():
    rng = random.Random(2)
    for sizes in ([], [1], [64], [63] * 400, [40] * 500, [rng.randrange(1, 64) for _ in range(2000)],
                  [rng.randrange(1, 900) for _ in range(300)], [33, 31] * 50):
        docs = [(i, iter(np.array_split(np.arange(n, dtype="<u4"), rng.randrange(1, 4)))) for i, n in enumerate(sizes)]
        rows = list(P.pack(iter(docs), 64, 5 << 40, most_open=40))
        windows = _check(rows, dict(enumerate(sizes)), 64)
        assert len(windows) <= sum(sizes) / 64 + 60
        for doc_id, start, length, crc, *_ in rows:
            assert crc == zlib.crc32(np.arange(start, start + length, dtype="<u4"))


def test_few_documents_are_cut():
    rng = random.Random(3)
    sizes = [rng.randrange(5, 500) for _ in range(20_000)]
    rows = list(P.pack(((i, iter([np.zeros(n, "<u4")])) for i, n in enumerate(sizes)), 1024, 0))
    _check(rows, dict(enumerate(sizes)), 1024)
    assert len(rows) < 1.03 * len(sizes)


def test_whole_texts(spark):
    rng = random.Random(4)
    texts = [None, "", "a", " a", "a ", "é <|endoftext|> b", "word " * 9000, "zq" * 4000, "x \n  y\t z  q", "  ", "\n"]
    texts += [" ".join(rng.choice(["the", "Haus", "12", "été!", "a\n", ""]) for _ in range(rng.randrange(1, 1500)))
              for _ in range(120)] + ["long words " * 150_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, START int, offset string")
    tok = Tokenizer.from_file(vocabulary_path())
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    got = [tuple(r) for r in P.online_packing(docs.repartition(3)).collect()]
    _check(got, {i: len(x) for i, x in ids.items()}, 1024)
    for doc_id, start, length, crc, *_ in got:
        assert crc == zlib.crc32(ids[doc_id][start:start + length])


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(3, "one two")] * 3 + [(None, "no id")], "doc_id long, text string")
    got = P.online_packing(docs.coalesce(1)).collect()
    assert sorted(str(r.doc_id) for r in got if r.start == 0) == ["3", "3", "3", "None"]
    assert sum(r.length for r in got) == 4 * 3
    assert P.online_packing(docs.limit(0)).count() == 0
