"""Cross-tokenizer alignment against whole texts encoded and compared pair by pair."""

import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm import alignment as A
from sluice.llm import units as U
from sluice.llm.bpe import vocabulary, vocabulary_path


def _ends(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def _plain(rows):
    tok = Tokenizer.from_file(vocabulary_path())
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=A.piece_path())
    of_a = vocabulary(vocabulary_path()).bytes_of
    texts, count = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            sa = [of_a[i] for i in a]
            sb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                  sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if not b"".join(sa) == b"".join(sb) == (" " + text).encode():
                a = b = []
        if not a:
            texts.append((doc_id, [], [], [], ""))
            continue
        ea, eb = _ends(sa), _ends(sb)
        links = [(x, y) for x, (s, e) in zip(a, ea) for y, (t, f) in zip(b, eb) if max(s, t) < min(e, f)]
        both = sorted({e for _, e in ea} & {e for _, e in eb})
        groups, at = [], 0
        for end in both:
            groups.append(",".join(str(x) for x, (s, e) in zip(a, ea) if at <= s < end) + "|"
                          + ",".join(str(y) for y, (s, e) in zip(b, eb) if at <= s < end))
            at = end
        texts.append((doc_id, a, b, links, ";".join(groups)))
        count.update(links)
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(((d, len(a), len(b), g.count(";") + 1 if g else 0, len(links),
                    sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for d, a, b, links, g in texts), key=str)


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  ", "  a  b", "a\n b\t\tc \n", "x <|endoftext|> y", "</s> <unk> <0x41>",
       "▁ a", "a▁b", " x   y", "　中文 中", "é é", "\U0001f600 \U0001f468‍\U0001f469",
       "1234567 89", "it's we'll", "\x00 \x1c a \x1f b", "Ａ ﬁ", "\u0085 a", "a  b", "tab\t a", "\r\n \r\n", "....  ...", "ab" * 700]


def test_units_hold_whole_tokens():
    rng = random.Random(1)
    tok = Tokenizer.from_file(vocabulary_path())
    tok.encode_special_tokens = True
    ids = U.ByteIds(vocabulary_path())
    sp = sentencepiece.SentencePieceProcessor(model_file=A.piece_path())
    letters = list("ab1é'.  \n\t  \x1c中") + ["the", "ing"]
    texts = [t for t in ODD if t] + ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    for text in texts:
        some = U.units(text)
        assert " ".join(some) == text
        assert [i for u in some for i in tok.encode(" " + u, add_special_tokens=False).ids] == tok.encode(
            " " + text, add_special_tokens=False).ids
        assert [i for u in some for i in (sp.encode(u) if u else [sp.piece_to_id("▁")])] == sp.encode(text)
        if "<|" not in text:
            assert [i for p in ids.parts(text) for i in p.tolist()] == tok.encode(text, add_special_tokens=False).ids


def test_units_together_and_alone_agree():
    rng = random.Random(7)
    tool = A.Aligner(vocabulary_path(), A.piece_path())
    letters = list("ab1é'.-\u2581中") + ["the", "ing", "\n", "\t", "  ", "ǌ"]
    for odd in (True, False):
        some = list(dict.fromkeys("".join(rng.choice(letters if odd else letters[:7]) for _ in range(rng.randrange(1, 9))) for _ in range(2000)))
        some = [u for x in some for u in U.units("x " + x + " y")]
        some = [u for u in dict.fromkeys(some) if u and not u[-1].isspace()]
        plain = [u for u in some if "\u2581" not in u]
        assert tool._together(plain) == [tool._alone(u) for u in plain]
        assert (tool._together(some) is None) == odd
        assert tool._make(some) == [tool._alone(u) for u in some]


def test_every_plain_character_is_classed_alike():
    ids = U.ByteIds(vocabulary_path())
    assert ids.plain
    tok = Tokenizer.from_file(vocabulary_path())
    marks = ["a", "1", "-", " ", "\n", "'", "é"]
    for c in map(chr, range(0x250)):
        text = "".join(f"{m}{c}{n}{c} {c}  {c}" for m in marks for n in marks)
        assert U.is_plain(text)
        assert [i for p in ids.parts(text) for i in p.tolist()] == tok.encode(text, add_special_tokens=False).ids
    assert not U.is_plain("x" * 1000) and not U.is_plain(" " * 1000) and not U.is_plain("\u0250")


def test_blocks_are_the_whole_text(monkeypatch):
    monkeypatch.setattr(U, "BLOCK_CHARS", 20)
    text = "  one two   three\nfour " * 9
    assert [u for some in U.unit_blocks(text) for u in some] == U.units(text)
    assert list(U.unit_blocks("")) == [[""]]


def test_memo_forgets_and_keeps_right():
    asked = []
    memo = U.Memo(lambda new: [asked.append(u) or u.upper() for u in new], size=3)
    for some in (["a", "b"], ["c", "a"], ["d", "a", "a"], ["e" * 300, "a"], ["f", "g", "h", "b"]):
        known = memo.fill(some)
        assert [known[u] for u in some] == [u.upper() for u in some]
    assert "e" * 300 not in memo.known and "e" * 300 not in memo.older


def test_measures_of_whole_tables(spark):
    rng = random.Random(2)
    words = ["the", "Haus", "ération", "été!", "12", "a\n", "", "naïve", "中文", "x"]
    rows = list(enumerate(ODD))
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 80)))) for i in range(80)]
    rows += [(300 + i, "the same text, copied") for i in range(50)] + [(300, "the same text, copied"), (None, "no id the")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, SHA int, chunk string")
    expect = _plain(rows)
    got = A.cross_alignment(docs.repartition(4))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expect


def test_long_texts_span_chunks():
    """Parts of one text in several chunks add up, and a text with other bytes counts nowhere."""
    import pyarrow as pa
    rng = random.Random(3)
    tool = A.aligner(vocabulary_path(), A.piece_path())
    parts = [[f"w{rng.randrange(50)}" for _ in range(100)] for _ in range(4)]
    sums, weights = [], Counter()
    for number, part in enumerate(parts):
        chunk = A._Chunk(number)
        chunk.texts.append(("s", chunk.codes(part, tool.memo.fill(part)), None, 2))
        chunk.add(chunk.texts[0][1], 2)
        batches = pa.Table.from_batches(list(chunk.batches()))
        rows = batches.to_pylist()
        for r in rows:
            if r["kind"] == 2:
                weights[r["a"], r["b"]] += r["weight"]
        sums += [r for r in rows if r["kind"] == 0]
    whole = " ".join(u for p in parts for u in p)
    row = _plain([(1, whole), (2, whole)])[0]
    assert tuple(sum(r[c] for r in sums) for c in ("n_a", "n_b", "n_groups", "n_links")) == row[1:5]
    links = Counter()
    for u in whole.split(" "):
        for x in np.frombuffer(tool.memo.fill([u])[u][4], np.int64).tolist():
            links[x >> 32, x & 0xFFFFFFFF] += 2
    assert links == weights


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert A.cross_alignment(docs).count() == 0
    only = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, A.cross_alignment(only).collect())) == [(1, *[0] * 6, ""), (2, *[0] * 6, ""), (2, *[0] * 6, "")]
