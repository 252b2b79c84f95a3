"""The pipeline against its stages in plain Python, on a small corpus."""

import glob
import random
import threading
import zlib

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline as C
from sluice.llm import quality
from sluice.llm.bpe import vocabulary_path
from sluice.llm.common import shared_dir

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus():
    rng = random.Random(3)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "rt", "ld", "mo")]

    def prose(n):
        out = []
        while len(out) < n:
            s = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 14))]
            out += [s[0].title(), *s[1:-1], s[-1] + "."]
        return out[:n]

    passage = prose(70)
    texts = [prose(rng.randrange(30, 300)) for _ in range(60)]
    for i in (7, 20, 33):
        texts[i] = texts[i][:20] + passage + texts[i][20:]
    texts = [" ".join(t) for t in texts]
    texts += [texts[3], texts[3].replace(" ", "\n", 4), texts[8]]
    for k in range(4):  # near copies
        words = texts[10].split()
        words[5 * k] = "changed"
        texts.append(" ".join(words))
    texts += ["%%% ### " * 60, "| | " * 90, "same " * 200, None, "", " \n"]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[0]]


def _fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if words else 0


def _brute(rows, judge):
    docs = {i: t for i, t, *_ in rows if judge(t) >= 0.5}
    first = {}
    for i in sorted(docs):
        first.setdefault(" ".join((" " + docs[i] + " ").split()), i)
    docs = {i: docs[i] for i in first.values()}
    prints = {i: _fingerprint(t) for i, t in docs.items()}
    group = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            for j in docs:
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    group[i] = min(group[i], group[j])
    docs = {i: docs[i] for i in docs if group[i] == i}
    least = {}
    for i in sorted(docs, reverse=True):
        w = docs[i].split()
        for s in range(len(w) - 49):
            least[tuple(w[s:s + 50])] = i
    out = {}
    for i, t in docs.items():
        w = t.split()
        gone = {k for s in range(len(w) - 49) if least[tuple(w[s:s + 50])] < i for k in range(s, s + 50)}
        out[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    return out


def test_pipeline_matches_brute_force(spark, tmp_path):
    rows = _corpus()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    judge = quality.scorer(quality.fit(spark.read.parquet(f"{tmp_path}/documents.parquet")))
    kept = _brute(rows, judge)
    assert len(kept) < 62 and any(kept[i] != t for i, t, *_ in rows if i in kept)
    tok = Tokenizer.from_file(vocabulary_path())
    expect = []
    for i, text in kept.items():
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert len(ids) <= 2048
        expect.append((i, 0, 0, len(ids), zlib.crc32(ids.tobytes())))
    got = C.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(expect)
    fill = {}
    for r in got:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 1


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == empty.columns and out.count() == 0
    assert C.STAGES[-1][1](spark, empty, str(tmp_path)).count() == 0
    assert 4 <= len(C.STAGES) <= 5


def test_extra_columns_pass_through(spark):
    text = "Some plain words that make a sentence of their own here. " * 3
    docs = spark.createDataFrame([(i, text + str(i % 2), "en", "s", 1, i, "k") for i in range(4)],
                                 COLUMNS + ", kept int, FP string")
    out = C.exact(spark, docs, "").collect()
    assert sorted(r.doc_id for r in out) == [0, 1] and {r.FP for r in out} == {"k"}


def test_stages_chain_without_writing_between_them(spark, tmp_path):
    rows = _corpus()
    long = " ".join(f"word{i % 977} goes on." for i in range(40_000))
    rows += [(None, rows[0][1], "en", "s", 1), (None, None, None, None, None), (500, long, "en", "s", 9), (501, long, "en", "s", 9)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    judge = quality.scorer(quality.fit(docs))
    lazy, expect = docs, _brute([r for r in rows if r[0] is not None], judge)
    for _, stage in C.STAGES[:-1]:
        lazy = stage(spark, lazy, str(tmp_path))
    got = {r.doc_id: r.text for r in lazy.where("doc_id is not null").collect()}
    assert got == expect and 500 in got and 501 not in got
    packed = C.STAGES[-1][1](spark, lazy, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} >= set(expect)


def test_two_pipelines_in_one_driver(spark, tmp_path):
    rows, found = _corpus(), {}
    for name, some in (("a", rows), ("b", rows[::2])):
        spark.createDataFrame(some, COLUMNS).write.parquet(f"{tmp_path}/{name}/documents.parquet")

    def one(name):
        found[name] = sorted(tuple(r)[:5] for r in C.run(spark, f"{tmp_path}/{name}").collect())

    threads = [threading.Thread(target=one, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    both = dict(found)
    for n in ("a", "b"):
        one(n)
    assert both == found and len(found["a"]) > len(found["b"]) > 0


def test_only_decisions_stay_behind(spark):
    docs = spark.createDataFrame(_corpus(), COLUMNS)
    folder = shared_dir(spark).removeprefix("file://") + "/sluice-llm/*"
    before = set(glob.glob(folder))
    for _, stage in C.STAGES[:-1]:
        stage(spark, docs, "")
    assert len(set(glob.glob(folder)) - before) == 3  # the quality filter's model is on the driver
