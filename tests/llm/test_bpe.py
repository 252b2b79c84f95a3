"""The transducer against the tokenizers library."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from sluice.llm import bpe

PATH = bpe.vocabulary_path()
TEXTS = ["", " ", "a<|endoftext|>b  \n <|endoftext|>", "x" * 5000, "ab" * 3000 + "\n\n  c", "the" * 2000,
         "中文字符 Ⅷ ½ ①  　x y'll we're 'S don't", "\x1c\x1d a \x85 b\xa0c   d", "émoji 👩‍👩‍👧 done",
         " " * 3000 + "x", "0123456789" * 400, "É" * 700, "\n\n\n", "áb ǅ ʰ ɏɐ",
         "=" * 3000 + "-" * 3000, "thththe" * 900]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _random_texts(n):
    rng = random.Random(7)
    letters = "aeiou thr sn'lld .,!?\n\t12é中😀ß- _"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(600))) for _ in range(n)]


@pytest.mark.parametrize("block", [bpe.BLOCK_CHARS, 13])
def test_encode_and_decode(library, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    enc = bpe.Encoder(bpe.vocabulary(PATH))
    for text in TEXTS + _random_texts(200):
        ids = enc.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids, enc.v, step=3) == text == library.decode(ids.tolist(), skip_special_tokens=False)


def test_pair_test_is_the_definition():
    v, rng = bpe.vocabulary(PATH), random.Random(3)
    tokens = [i for i in v.bytes_of if i not in v.special.values()]
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert v.follows(a, b) == (v.merged(v.bytes_of[a] + v.bytes_of[b]) == [a, b])


def test_streaming_holds_little_and_emits_stable_tokens():
    v, rng = bpe.vocabulary(PATH), random.Random(4)
    data = "".join(rng.choice(["th", "e", "in", "g", "x", "aa"]) for _ in range(20_000)).encode()
    t, out, most = bpe.Transducer(v), [], 0
    for at in range(0, len(data), 64):
        out += t.feed(data[at:at + 64])
        most = max(most, len(t.data))
    out += t.finish()
    whole = bpe.Transducer(v)
    whole._extend(data)
    assert out == whole.finish() and most < 4 * v.longest <= v.lookahead


def test_decoder_keeps_unfinished_characters(library):
    v = bpe.vocabulary(PATH)
    ids = library.encode("😀é", add_special_tokens=False).ids
    d = bpe.Decoder(v)
    assert "".join([d.feed(np.array([i])) for i in ids]) + d.finish() == "😀é"
    assert bpe.decode(np.array(ids[:2]), v) == library.decode(ids[:2], skip_special_tokens=False)


def test_operators(spark, library):
    rows = [(1, "héllo wörld"), (None, "x"), (2, None), (3, ""), (1, "héllo wörld"), (4, "z" * 3000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, IDS int")
    got = bpe.bpe_decode(bpe.bpe_encode(docs)).collect()
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=str) == sorted(
        ((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows), key=str)
    assert bpe.bpe_encode(docs.where("false")).count() == 0


def test_round_trip_is_encode_and_decode(spark):
    texts = [None, "", "a", "é <|endoftext|> b<|endoftext|>", "word " * 900, "zq" * 4000, "\U0001f600 \x00 ￿", "<|endoftext|>"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (2, "a")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, IDS int")
    long_way = bpe.digests(bpe.bpe_decode(bpe.bpe_encode(docs)))
    assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=str) == sorted(map(tuple, long_way.collect()), key=str)
    assert bpe.round_trip(docs.limit(0)).count() == 0
    assert bpe.bpe_decode(bpe.bpe_encode(docs.limit(0))).count() == 0


def test_long_pieces_are_streamed():
    enc, tok = bpe.encoder(bpe.vocabulary_path()), Tokenizer.from_file(bpe.vocabulary_path())
    text = "xyzzy" * 500_000 + " ünïcode" + "é" * 300_000 + "1" * 10
    parts = list(enc.stream(text))
    assert len(parts) > 10 and max(map(len, parts)) < bpe.BLOCK_CHARS
    assert np.concatenate(parts).tolist() == tok.encode(text, add_special_tokens=False).ids


def test_a_very_long_text_needs_little_memory():
    """60 MB in one go: the peak stays a small multiple of the text."""
    code = """
import resource, sys, pyarrow as pa
from sluice.llm import bpe as B
class Frame:
    columns = ["doc_id", "text"]
    def mapInArrow(self, run, schema): return run
B.pick = lambda docs, **_: docs
run = B.round_trip(Frame())
text = "some words of a rather long text, again and again.\\n" * 1_200_000
batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
del text
out = [r for b in run(iter([batch])) for r in b.to_pylist()]
print(out[0]["n_tokens"], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                          cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    tokens, more = map(int, done.stdout.split())
    assert tokens > 12_000_000 and more < 250_000  # kilobytes
