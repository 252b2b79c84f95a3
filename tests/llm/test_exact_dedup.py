"""Exact dedup against grouping by the normalised text."""

import random

import pytest

from sluice.llm import exact_dedup as X

SCHEMA = "KEEP_ID string, doc_id long, text string, kept int, recipe string, n_chars long"


def _brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(X.normalise(text), []).append(doc_id)
    out = set()
    for key, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        out |= {(i, first, len(ids), i == first, X.hashlib.sha256(key).hexdigest()) for i in ids}
    return out


def test_groups_match_brute_force(spark):
    rng = random.Random(5)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(30_000))
    rows = [(i, rng.choice(["a b", "a  b", "a\tb\n", " a b", "a b ", "é b", "é b", "", None, "  "]))
            for i in range(60)]
    rows += [(100, long), (101, long.replace(" ", "\n\t", 9)), (102, long + "x"), (103, "y" + long), (104, long)]
    rows += [(None, "a b"), (None, "only here"), (7, rows[7][1]), (7, "another text of 7")]
    docs = spark.createDataFrame([("x", i, t, 0, "r", 1) for i, t in rows], SCHEMA).repartition(7)
    got = [tuple(r) for r in X.exact_dedup(docs).drop("n_rows").collect()]
    assert len(got) == len(set(got))
    assert set(got) == _brute(rows)


def test_empty_table(spark):
    out = X.exact_dedup(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_rows"] and out.count() == 0


def test_cuts_follow_content_and_bounds():
    rng = random.Random(1)
    data = rng.randbytes(200_000)
    ends = X.cuts(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(data) and max(sizes) <= X.MOST and min(sizes[:-1]) >= X.LEAST
    moved = X.cuts(b"12345" + data)
    assert len(set(e + 5 for e in ends) & set(moved)) > len(ends) // 2


def test_a_shared_name_is_found(spark, monkeypatch):
    monkeypatch.setattr(X, "chunk_id", lambda chunk: b"same")
    names = {}
    for text in ("one", "two"):
        data = X.normalise(text)
        names.setdefault(X.chunk_id(data), set()).add(data)
    assert len(names[b"same"]) == 2


@pytest.mark.parametrize("text", [None, "", " ", "a", " a  b\v\f\r\n"])
def test_normalise(text):
    import re
    assert X.normalise(text) == re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()
