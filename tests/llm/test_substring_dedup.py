"""Substring dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from sluice.llm import substring_dedup as S


def _brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if i is not None:
                least[key] = min(i, least.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and least[tuple(w[s:s + window])] < i:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode() if gone else None))
    return sorted(out, key=str)


def _corpus(rng):
    def prose(n):
        return [f"{rng.choice('abcdefé')}{rng.randrange(400)}" for _ in range(n)]
    shared = [prose(n) for n in (49, 50, 51, 120, 300)]
    rows = []
    for i in range(70):
        text = prose(rng.randrange(0, 90))
        for _ in range(rng.randrange(3)):
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            text += (p if rng.random() < .5 else p[a:]) + prose(rng.randrange(0, 70))
        rows.append((i * 3 % 71, " ".join(text)))
    rows += [(200, rows[5][1]), (201, rows[5][1].replace(" ", "\n ")), (202, "Shti " * 400), (203, "Shti " * 90),
             (204, "x " * 300 + " ".join(shared[3])), (205, None), (206, ""), (207, " \t"),
             (None, " ".join(shared[4])), (rows[5][0], rows[5][1]), (rows[6][0], " ".join(shared[4] + shared[3])),
             (208, "a b c " * 200), (209, "b c a " * 200)]
    return rows


def test_matches_brute_force(spark):
    rows = _corpus(random.Random(11))
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, start int, TAG string")
    got = sorted((tuple(r)[:5] for r in S.substring_dedup(docs.repartition(5)).collect()), key=str)
    assert got == _brute(rows, 50)
    short = sorted((tuple(r)[:5] for r in S.substring_dedup(docs, window=7).collect()), key=str)
    assert short == _brute(rows, 7)


def test_anchors_with_many_contexts_are_exact(spark):
    """A short passage in many documents, with copies of parts of its surroundings in some."""
    rng = random.Random(12)
    def prose(n):
        return [f"{rng.choice('abc')}{rng.randrange(900)}" for _ in range(n)]
    core = prose(20)
    sides = [(prose(45), prose(45)) for _ in range(12)]
    rows = []
    for i in range(160):
        (left, _), (_, right) = rng.choice(sides), rng.choice(sides)
        a, b = rng.randrange(46), rng.randrange(46)
        rows.append((rng.randrange(10_000), " ".join(prose(rng.randrange(9)) + left[a:] + core + right[:b] + prose(rng.randrange(9)))))
    rows.append((20_000, " ".join(core * 30)))
    rows.append((20_002, " ".join(core * 2500)))  # several segments
    rows.append((20_001, " ".join(core * 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r)[:5] for r in S.substring_dedup(docs.repartition(3)).collect()), key=str)
    assert got == _brute(rows, 50)


def test_segments_and_levels(monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 40)
    seg = S._segments(50)
    words = [f"w{i}" for i in range(130)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "tag": [2], "text": [" ".join(words)], "places": [[0, 39, 41, 100, 114]]})
    out = [r for b in seg(iter([batch])) for r in b.to_pylist()]
    assert [(r["seg"], r["base"], r["places"]) for r in out] == [(0, 0, [0, 39]), (1, 6, [41]), (2, 46, [100, 114])]
    assert out[1]["text"].split() == words[6:80 + 16 + 34]
    assert [len(x) for x in S.parts_of(34)] == [1, 2, 4, 8, 35] and S.parts_of(0) == [[(0, 0)]]
    for level, after in zip(S.parts_of(34), S.parts_of(34)[1:]):
        assert [o for a, b in after for o in range(a, b + 1)] == list(range(35))
        assert all(any(a <= x and y <= b for a, b in level) for x, y in after)


def test_maximal_repeats_are_runs_that_go_on_no_further(spark):
    rows = [r for r in _corpus(random.Random(14)) if r[0] is not None]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = {i: (t or "").split() for i, t in rows}
    got = S.maximal_repeats(docs).collect()
    assert len(got) > 30 and len(set(got)) == len(got)
    covered = {}
    for r in got:
        a, b = words[r.doc_id], words[r.of_doc_id]
        s, o, n = r.start, r.of_start, r.n_words
        assert r.of_doc_id < r.doc_id and n >= 50 and a[s:s + n] == b[o:o + n]
        covered.setdefault(r.doc_id, set()).update(range(s, s + n))
    for r in S.substring_dedup(docs).collect():
        if r.n_removed < r.n_words:
            assert len(covered.get(r.doc_id, ())) == r.n_removed


def test_empty_table(spark):
    out = S.substring_dedup(spark.createDataFrame([], "doc_id long, text string"), with_text=False)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    data = b" ".join([b"one", b"two", b"a" * 300, b"three", b"one"] * 40) + b"  "
    whole = S.word_hashes(data, 0)
    assert len(whole) == 200 and (whole.reshape(40, 5) == whole[:5]).all() and whole[0] == whole[4]
    monkeypatch.setattr(S, "BLOCK", 64)
    parts = S.word_hashes(data, 0).reshape(40, 5)
    assert (parts == parts[0]).all() and (parts[0][[0, 1, 3]] == whole[[0, 1, 3]]).all()


def test_every_window_has_a_seed_chosen_by_its_words():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2**64, 4000, np.uint64)
    _, places = S.seeds(words, 50)
    gaps = np.diff(np.concatenate(([-1], places, [len(words) - S.SEED_WORDS + 1])))
    assert gaps.max() <= 50 - S.SEED_WORDS + 1 and len(places) < len(words) / 15
    part = S.seeds(words[1000:1050], 50)[1] + 1000
    assert set(part) <= set(places)


def test_groups_of_segments_do_not_matter(monkeypatch):
    rng = random.Random(21)
    words = [[f"{rng.choice('ab')}{rng.randrange(9)}" for _ in range(rng.randrange(60, 200))] for _ in range(30)]
    places = [sorted(rng.sample(range(len(w) - 15), 5)) for w in words]
    rows = pa.RecordBatch.from_pydict({
        "doc_id": list(range(30)), "tag": list(range(30)), "seg": pa.array([0] * 30, pa.int32()), "base": [0] * 30,
        "n": [len(w) for w in words], "text": [" ".join(w) for w in words], "places": places})

    def run(size):
        monkeypatch.setattr(S, "GROUP_WORDS", size)
        anchors = pa.Table.from_batches(list(S._first_anchors(50)(iter([rows]))))
        held = [[{"k1": 1, "k2": 2, "low": 0, "place": p} for p in ps] for ps in places]
        contexts = pa.Table.from_batches(list(S._contexts(50)(iter([rows.append_column("held", pa.array(held))]))))
        met = [{c: r[c] for c in ("of_doc", "of_place", "left", "right", "context")} for r in contexts.to_pylist()]
        met = [[{"place": p, "low": 0, **met[(7 * i + k) % len(met)]} for k, p in enumerate(ps)] for i, ps in enumerate(places)]
        extended = pa.Table.from_batches(list(S._extend(50, 0)(iter([rows.append_column("met", pa.array(met))]))))
        # a context's words beyond its left and right mean nothing
        return [sorted(map(str, t.to_pylist())) for t in (anchors, contexts.drop_columns("context"), extended)]

    assert run(200_000) == run(150) == run(1)
    assert len(run(1)[2]) > 100


def test_few_rows_go_to_python_at_a_time(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def watched(made):
        def make(*args):
            run = made(*args)

            def few(batches):
                def counted():
                    for batch in batches:
                        seen.add(int(batch.num_rows > 250))
                        yield batch
                yield from run(counted())
            return few
        return make
    for name in ("_scan", "_segments", "_first_anchors", "_contexts", "_extend", "_kept"):
        monkeypatch.setattr(S, name, watched(getattr(S, name)))
    shared = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{i} {shared} {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = S.substring_dedup(docs)
    # what is read later needs no worker beside its own
    assert "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["doc_id"], r["n_removed"]) for r in out.collect()) == [(i, 60 if i else 0) for i in range(900)]
    assert seen.value == 0
