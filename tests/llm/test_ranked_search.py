"""Ranked search: the whole table against plain scoring, the trie against a full scan, edges."""

import math
import random
import re
from collections import Counter

import numpy as np

from sluice.llm import ranked_search as R

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def _plain(docs, items, top=10):
    docs = [(i, Counter(_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(_terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def test_terms_are_the_contracts():
    text = "Ab1_c É x\x00Z9ß—q ▁ ÀB" + "w " * 10
    assert [t.decode() for some in R.terms(text) for t in some] == _terms(text)
    assert [t for some in R.terms(None) for t in some] == []


def test_search_finds_what_plain_scoring_finds(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "ß2", "Über"]
    draw = lambda n: " ".join(rng.choice(words[:rng.choice([5, 20, 63])]).upper() for _ in range(n))
    docs = [(i, draw(rng.randrange(1, 60))) for i in range(500)]
    docs += [(i, docs[7][1]) for i in range(600, 900)] + [(7, docs[7][1]), (None, docs[7][1]), (901, None), (902, ""), (903, "., !")]
    docs += [(904, "w1 " * 50_000), (905, "nothing asked")]
    items = [(i, draw(rng.randrange(1, 12))) for i in range(12)] + [(20, None), (21, ""), (22, "unheard"), (None, "w3 w4")]
    items += [(23, docs[7][1])]
    left = spark.createDataFrame([(*r, 1, "p") for r in docs], "doc_id long, text string, RANK int, score string")
    right = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, TEXT2 string")
    expect = _plain(docs, items)
    for item_bytes in (R.ITEM_BYTES, 60):  # 60: several blocks of items
        got = R.ranked_search(left.repartition(5), right, item_bytes=item_bytes)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == expect


def test_tree_prunes_and_is_exact():
    rng = np.random.default_rng(5)
    p = 1 / np.arange(1, 81)
    rows = [np.unique(rng.choice(80, rng.integers(1, 12), p=p / p.sum())) for _ in range(3000)]
    codes, ends = np.concatenate(rows), np.cumsum([len(r) for r in rows])
    tfs, m = rng.integers(1, 5, len(codes)), rng.integers(10, 200, 3000)
    tree = R.Tree(np.arange(3000), np.zeros(3000, bool), m, ends, codes, tfs, leaf=4)
    seen = nodes = 0
    waiting = [tree.root]
    while waiting:
        nodes += 1
        waiting += waiting.pop().children
    for _ in range(20):
        weights = np.zeros(80, np.int64)
        weights[rng.choice(80, 6)] = rng.integers(1, 9000, 6)
        best = R.Best(10)
        seen += tree.search(weights, best)
        scores = np.add.reduceat(weights[codes] * R.share(tfs, np.repeat(m, [len(r) for r in rows])), [0, *ends[:-1]])
        order = np.lexsort((np.arange(3000), -scores))[:10]
        assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == scores[order].tolist()
    assert seen < 20 * nodes / 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.ranked_search(docs, items).count() == 0
    assert R.ranked_search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).count() == 0
