"""SimHash near-dedup against all pairs in plain Python."""

import random

import numpy as np
import xxhash

from sluice.llm import simhash as S
from sluice.llm.components import components


def _plain(text, n=4):
    words = [w for w in (text or "").encode().lower().replace(b"\v", b" ").replace(b"\f", b" ").split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprint_matches_definition(monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " \n", "One", "a B c", "a b c d", "x " * 50, "É é Straße 中文 words here"]
    texts += [" ".join(rng.choice("ab Cd é fG".split()) for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    assert [S.simhash((t or "").encode()) for t in texts] == [_plain(t) for t in texts]
    monkeypatch.setattr("sluice.llm.common.BLOCK", 37)
    assert [S.simhash((t or "").encode()) for t in texts] == [_plain(t) for t in texts]


def test_lower_bound_and_grids():
    rng = np.random.default_rng(3)
    masks = S.grids(4)
    assert len(masks) == 70
    for _ in range(300):
        a = rng.integers(0, 2**64, dtype=np.uint64)
        b = a
        for bit in rng.integers(0, 64, 4):
            b = b ^ (np.uint64(1) << np.uint64(bit))
        x = int(S.embed(np.array([a]))[0] ^ S.embed(np.array([b]))[0])
        assert x.bit_count() <= (int(a) ^ int(b)).bit_count()
        assert any(x & m == 0 for m in masks)


def _cluster(rng, n):
    """Chains and dense balls of fingerprints among random ones."""
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 60])):
            out.add(f)
            g = f
            for _ in range(rng.randrange(1, 5)):
                g ^= 1 << rng.randrange(64)
            f = g if rng.random() < 0.5 else f
            out.add(g)
    return sorted(out)


def test_links_connect_what_all_pairs_connect(spark):
    fps = _cluster(random.Random(4), 900)
    expect = _roots(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    for tile in (S.TILE, 16):  # 16: many cells are dealt to tiles
        links = S.fingerprint_links(spark.createDataFrame(signed, "fp long").repartition(5), 4, tile)
        rows = links.collect()
        assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4 for r in rows)
        found = _roots(fps, lambda a, b, s={(r.a % 2**64, r.b % 2**64) for r in rows}: (a, b) in s or (b, a) in s)
        classes = lambda r: {frozenset(k for k in r if r[k] == v) for v in set(r.values())}
        assert classes(found) == classes(expect)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 90 + i) for i in range(10)] + [(5, 5), (None, 3), (200, 201)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()))
    assert got == {i: 0 for i in range(61)} | {i: 90 for i in [*range(90, 101)]} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_operator(spark):
    rng = random.Random(6)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    rows = [(50 + i, base.replace(f"w{i} ", "other ", 1)) for i in range(12)] + [(3, ""), (4, None), (9, " \t")]
    rows += [(20 + i, " ".join(f"v{rng.randrange(5000)}" for _ in range(80))) for i in range(10)]
    rows += [(None, base), (None, "no id here at all"), (51, rows[1][1])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, ROOT string")
    got = sorted(map(tuple, S.simhash_dedup(docs).collect()), key=str)
    fps = [_plain(t) for _, t in rows]
    roots = _roots(list(range(len(rows))), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    expect = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in roots if roots[j] == roots[i] and rows[j][0] is not None]
        first = min(ids) if ids else None
        expect.append((doc_id, f"{fps[i]:016x}", first, doc_id == first))
    assert got == sorted(expect, key=str)
    assert S.simhash_dedup(docs.where("false")).count() == 0
