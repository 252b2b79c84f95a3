"""Weak labels: estimation on drawn votes, held-out labels, odd rows."""

from collections import Counter

import numpy as np

from sluice.llm import quality as Q


def test_estimates_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    right = [0.95, 0.8, 0.7, 0.9]
    v = np.stack([np.where(rng.random(20_000) < 0.3, Q.ABSTAIN,
                           np.where((rng.random(20_000) < r) == good, Q.GOOD, Q.BAD)) for r in right], axis=1)
    prior, rates = Q.fit_votes(Counter(map(tuple, v.tolist())))
    assert abs(prior - 0.7) < 0.03
    for j, r in enumerate(right):
        assert abs(rates[j, 1, Q.GOOD] / (1 - rates[j, 1, Q.ABSTAIN]) - r) < 0.03
    assert ((Q.posterior(v, prior, rates) > 0.5) == good).mean() > 0.85


def test_scorer_fits_soft_labels():
    rng = np.random.default_rng(2)
    x = rng.random((500, Q.DIM)).astype(np.float32) * (rng.random((500, Q.DIM)) < 0.02)
    y = (x[:, 5] + x[:, 9] > 0).astype(float)
    x[:, 5] += y
    w = Q.fit_scorer(x, y)
    assert (((x @ w[:-1] + w[-1]) > 0) == (y > 0.5)).mean() > 0.97


def test_facts():
    f = Q.facts("The cat. The cat sat!\n\n| | \nThe cat. The cat sat!".encode())
    assert (f.words, f.lines, f.bare, f.echo) == (12, 3, 2 / 12, 1 / 12)
    assert f.same_lines == 1 - 2 / 3 and f.stops == 4 / 12 and f.top == 4 / 12
    assert Q.votes(Q.facts(b" \n ")) == [Q.BAD] * Q.HEURISTICS


def test_agrees_with_labels_it_never_saw(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = Q.score(docs, Q.fit(docs)).join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.03 * n[0, False]


def test_odd_rows(spark):
    prose = "The quick brown fox jumps over a lazy dog. It runs away and hides, then sleeps well. " * 3
    rows = [(1, prose), (2, None), (3, ""), (4, " \n"), (None, prose), (1, prose), (5, "%%% ### " * 40)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, SCORE double")
    model = Q.fit(docs)
    got = sorted((tuple(r) for r in Q.score(docs, model).collect()), key=str)
    assert [g[0] for g in got] == sorted([r[0] for r in rows], key=str)
    assert all(not kept and s == 0 for i, s, kept in got if i in (2, 3, 4))
    kept = Q.good_rows(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(g[2] for g in got)
    assert Q.fit(docs.where("false")) is None and Q.score(docs.where("false"), model).count() == 0
    assert Q.score(docs, None).where("kept").count() == 0


def test_query_matches_plain_python(spark):
    """The model and every score, from votes and features taken document by document."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "rt", "ld")]
    texts = []
    for i in range(240):
        w = [words[k] for k in rng.integers(0, len(words), rng.integers(10, 200))]
        if i % 3:
            w = [x.title() if k % 9 == 0 else x + "." if k % 9 == 8 else x for k, x in enumerate(w)]
        elif i % 2:
            w = [w[0]] * len(w)
        texts.append(" ".join(w))
    texts += [None, "", " \n", "| % # " * 50, texts[0], texts[0]]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, PATTERN int")
    data = [(t or "").encode() for t in texts]
    found = [Q.facts(d) for d in data]
    v = [tuple(Q.votes(f)) for f in found]
    prior, rates = Q.fit_votes(Counter(v))
    some = sorted({(Q.features(d, f).tobytes(), p) for d, f, p in zip(data, found, v) if f.words})
    x = np.stack([np.frombuffer(b, np.float64 if len(b) == 8 * Q.DIM else np.float32) for b, _ in some]).astype(np.float32)
    w = Q.fit_scorer(x, Q.posterior(np.array([p for _, p in some]), prior, rates))
    got = {r.doc_id: r for r in Q.score(docs, Q.fit(docs)).collect()}
    assert len(got) == len(texts)
    both = set()
    for i, (d, f) in enumerate(zip(data, found)):
        score = 1 / (1 + np.exp(-(Q.features(d, f) @ w[:-1] + w[-1]))) if f.words else 0.0
        assert abs(got[i].score - score) < 1e-3
        assert abs(score - 0.5) < 1e-3 or got[i].kept == (score >= 0.5)
        both.add(got[i].kept)
    assert both == {True, False}
