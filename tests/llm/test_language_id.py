"""Rank-order profiles: counts by definition, held-out accuracy, odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import language_id as L


def _plain(text):
    out = Counter()
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    for w in words:
        w = f" {w} "
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                if w[i:i + n] != " ":
                    out[w[i:i + n]] += 1
    return out


def _shown(codes, counts):
    name = lambda c: "".join(chr(x) for x in (c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF) if x)
    return {name(c): n for c, n in zip(codes.tolist(), counts.tolist())}


@pytest.mark.parametrize("block", [L.BLOCK, 10])
def test_counts(monkeypatch, block):
    monkeypatch.setattr(L, "BLOCK", block)
    for text in ["", "a", "Hello, hello wörld ÉT 中文 x1y2", "  two\n\nlines -- a b c", "12 34", "abc " * 30]:
        assert _shown(*L.gram_counts(text)) == _plain(text)


def test_distance_by_definition():
    profiles = {"x": L.ranked(*L.gram_counts("aaa bbb aab")).tolist(), "y": L.ranked(*L.gram_counts("ccc")).tolist()}
    own = L.ranked(*L.gram_counts("aab")).tolist()
    d = sum(abs(profiles["x"].index(c) - i) if c in profiles["x"] else L.PROFILE for i, c in enumerate(own))
    assert L.Judge(profiles).judge("aab") == ("x", 1 - d / (L.PROFILE * len(own)))
    assert L.Judge(profiles).judge("zzz")[0] == "x"  # a tie


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    profiles = L.fit(docs.where(~held))
    got = L.predict(docs.where(held), profiles).join(docs.select("doc_id", "lang"), "doc_id")
    right = got.where("lang = lang_pred").count()
    assert right >= 0.97 * got.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_odd_rows(spark):
    rows = [(1, None, "en", 1), (2, "12 ..", "en", 1), (None, "the thing", "en", 1), (4, "la maison", None, 1),
            (5, "der das", "de", 1), (5, "der das", "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, LANG_PRED int")
    profiles = L.fit(docs)
    assert set(profiles) == {"en", "de"}
    got = sorted((tuple(r)[:2] for r in L.predict(docs, profiles).collect()), key=str)
    assert [g for g in got if g[0] in (1, 2)] == [(1, "und"), (2, "und")]
    assert (None, "en") in got and got.count((5, "de")) == 2
    assert L.fit(docs.where("false")) == {}
    assert {r.lang_pred for r in L.predict(docs, {}).collect()} == {"und"}
    assert L.predict(docs.where("false"), profiles).count() == 0
