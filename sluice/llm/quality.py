"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or abstain on every document. Expectation-
maximisation over the counts of vote patterns estimates how accurate each of them
is, without any label. The posterior of a pattern is the soft label on which a
linear scorer over hashed features of the whole text is trained."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialize, pick, values, word_blocks

#: Documents (expected) on which the scorer is trained; the votes of all documents count.
SAMPLE = 8000
#: Hashed features of the scorer.
DIM = 2048

#: Bytes below which a text's trigrams count for little: a short text shows little of either kind.
SHORT = 200

BAD, ABSTAIN, GOOD = 0, 1, 2

#: Classes of bytes: letters, digits, gaps and other text; each ASCII sign is its own.
_CLASS = np.full(256, 5, np.int64)
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_signs = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_signs] = np.arange(6, 6 + len(_signs))
#: Signs that running text has: . , ; : ' " ! ? - ( )
_PROSE = np.zeros(256, bool)
_PROSE[list(b".,;:'\"!?-()")] = True
_SIGN = np.zeros(256, bool)
_SIGN[_signs] = True


@dataclass
class Facts:
    """What the heuristics look at, over the whole text."""
    words: int
    signs: float          # share of characters that are signs running text lacks
    bare: float           # share of words without a letter or digit
    top: float            # share of the most frequent word
    echo: float           # share of words that equal the word before
    lines: int
    same_lines: float     # share of lines that repeat an earlier one
    long: float           # mean bytes of a word
    upper: float          # share of ASCII letters that are capitals
    stops: float          # share of words that end in a full stop, ! or ?
    letters: float        # share of bytes that are letters
    distinct: float       # different words in relation to words


def facts(data: bytes) -> Facts:
    b = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, int(b.sum()))
    text = b[97:123].sum() + b[65:91].sum()
    count: Counter[bytes] = Counter()
    words = bare = echo = stops = 0
    before = None
    for block in word_blocks(data):
        count.update(block)
        words += len(block)
        echo += sum(map(bytes.__eq__, block, block[1:])) + (bool(block) and block[0] == before)
        before = block[-1] if block else before
    for w, n in count.items():
        if w[-1] in b".!?":
            stops += n
        if len(w) < 4 and not any(c > 127 or 48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 for c in w):
            bare += n
    lines = [x for x in data.split(b"\n") if x.strip()]
    n = max(1, words)
    return Facts(words, (b[_SIGN & ~_PROSE].sum()) / size, bare / n, max(count.values(), default=0) / n, echo / n,
                 len(lines), 1 - len(set(lines)) / max(1, len(lines)),
                 (size - b[[9, 10, 11, 12, 13, 32]].sum()) / n, b[65:91].sum() / max(1, text), stops / n,
                 (text + b[128:].sum()) / size, len(count) / n)


def votes(f: Facts) -> list[int]:
    """The heuristics' votes: nine look for one kind of junk each, three for prose.

    Their thresholds are rules of thumb about running text of any language; how
    far each is right is left to the model."""
    if not f.words:
        return [BAD] * HEURISTICS
    enough = f.words >= 20
    junk = (f.signs >= 0.06, f.bare >= 0.15, enough and f.top >= 0.35, enough and f.echo >= 0.15,
            f.lines >= 4 and f.same_lines >= 0.5, f.words >= 50 and f.distinct <= 0.1, f.upper >= 0.6,
            f.letters <= 0.5, f.long <= 2 or f.long >= 20)
    prose = (f.signs <= 0.02 and f.bare <= 0.02 and f.upper <= 0.3,
             f.echo <= 0.03 and (f.top <= 0.2 if enough else f.distinct >= 0.7),
             (0.02 <= f.stops <= 0.25 if enough else f.stops > 0) and 2 <= f.long <= 12)
    return [BAD if v else ABSTAIN for v in junk] + [GOOD if v else ABSTAIN for v in prose]


HEURISTICS = 12


def features(data: bytes, f: Facts) -> np.ndarray:
    """Hashed counts of byte-class trigrams (square roots of shares) and of levels of the facts."""
    c = _CLASS[np.frombuffer(data, np.uint8)]
    x = np.zeros(DIM, np.float32)
    if len(c) > 2:
        n = np.zeros(DIM, np.int64)
        for at in range(0, len(c) - 2, 1 << 20):
            part = c[at:at + (1 << 20) + 2]
            code = (part[:-2] << 12 | part[1:-1] << 6 | part[2:]) * 40503
            n += np.bincount(code >> 4 & (DIM - 1), minlength=DIM)
        x += np.sqrt(n / (len(c) + SHORT)).astype(np.float32)
    for i, v in enumerate((f.top, f.echo, f.same_lines, f.upper, f.bare, f.signs, f.stops, f.distinct)):
        v *= f.words / (f.words + 10)  # shares of few words say little
        for level in range(1 + min(7, int(v * 8))):  # a level implies the lower ones
            x[(i * 8 + level) * 2654435761 >> 7 & (DIM - 1)] += 0.5
    return x


def fit_votes(patterns: dict[tuple[int, ...], int], rounds: int = 200) -> tuple[float, np.ndarray]:
    """(share of good, table[heuristic, class, vote]) by expectation-maximisation.

    Starts from the votes, one against counting as four for; each table row has one
    pseudo-count per vote."""
    v = np.array(sorted(patterns))
    n = np.array([patterns[tuple(p)] for p in v.tolist()], np.float64)
    good = (v == GOOD).sum(axis=1) - 4.0 * (v == BAD).sum(axis=1)
    post = 1 / (1 + np.exp(-good))
    prior, rates = 0.5, np.zeros((v.shape[1], 2, 3))
    for _ in range(rounds):
        prior = float((n @ post + 1) / (n.sum() + 2))
        for c, weight in ((1, n * post), (0, n * (1 - post))):
            for vote in range(3):
                rates[:, c, vote] = weight @ (v == vote) + 1
        rates /= rates.sum(axis=2, keepdims=True)
        new = posterior(v, prior, rates)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return prior, rates


def posterior(v: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
    logit = np.full(len(v), np.log(prior) - np.log1p(-prior))
    for j in range(v.shape[1]):
        logit += np.log(rates[j, 1, v[:, j]]) - np.log(rates[j, 0, v[:, j]])
    return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels (Adam, whole batch); the last weight is the offset."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1, dtype=np.float32)
    y = y.astype(np.float32)
    w, m, s = np.zeros((3, x.shape[1]), np.float32)  # one kind of number, so no copy of x is made
    for t in range(1, rounds + 1):
        g = (1 / (1 + np.exp(-np.clip(x @ w, -40, 40))) - y) @ x / np.float32(len(x)) + np.float32(decay) * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


def _scan(per_million: int):
    """Vote pattern of each text (in base 3), and features of the sampled ones."""
    powers = 3 ** np.arange(HEURISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pattern, feats = [], []
            for text, taken in zip(values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode()
                f = facts(data)
                pattern.append(int(np.array(votes(f)) @ powers))
                if taken < per_million and f.words:
                    x = features(data, f)
                    at = np.flatnonzero(x).astype(np.uint16)
                    feats.append(at.tobytes() + x[at].tobytes())
                else:
                    feats.append(None)
            yield pa.RecordBatch.from_arrays([pa.array(pattern, pa.int32()), pa.array(feats, pa.binary())],
                                             names=["pattern", "features"])
    return run


@dataclass
class Model:
    prior: float
    rates: np.ndarray
    weights: np.ndarray


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fits on ``docs``: votes of every document, features of about ``sample`` of them.

    The driver gets one count per vote pattern (at most 2^HEURISTICS + 1) and the sample.
    Without a document that has words there is no model."""
    texts = pick(docs, text=(text_col, "string"))
    per_million = min(1_000_000, -(-sample * 1_000_000 // max(1, texts.count())))
    rows = texts.select("text", F.pmod(F.xxhash64("text"), F.lit(1_000_000)).alias("taken"))
    scan = materialize(rows.mapInArrow(_scan(per_million), "pattern int, features binary"), "votes")
    powers = 3 ** np.arange(HEURISTICS)
    split = lambda p: tuple((p // powers % 3).tolist())
    patterns = {split(r["pattern"]): r["count"] for r in scan.groupBy("pattern").count().collect()}
    # the sample is drawn evenly, so it seldom has more; if it has, a hash of the features decides
    some = scan.where("features is not null").groupBy("features", "pattern").count().orderBy(
        F.xxhash64("features"), "features", "pattern").limit(4 * sample).collect()
    if not some:
        return None
    prior, rates = fit_votes(patterns)
    x = np.zeros((len(some), DIM), np.float32)
    for i, r in enumerate(some):
        n = len(r["features"]) // 6
        x[i, np.frombuffer(r["features"], np.uint16, n)] = np.frombuffer(r["features"], np.float32, n, 2 * n)
    y = posterior(np.array([split(r["pattern"]) for r in some]), prior, rates)
    return Model(prior, rates, fit_scorer(x, y))


def scorer(model: Model | None):
    """Text to score; 0 without words or model."""
    def score(text: str | None) -> float:
        data = (text or "").encode()
        f = facts(data)
        if not f.words or model is None:
            return 0.0
        logit = float(features(data, f) @ model.weights[:-1] + model.weights[-1])
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
    return score


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score (0 to 1, higher: better), kept (score >= 0.5).

    * null text, or no words: score 0, not kept.
    * null id: returned with the null; repeated rows: as often as given.
    * empty table: no rows; other columns are ignored, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = scorer(model)
        for batch in batches:
            s = np.array([judge(t) for t in values(batch.column(1))], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array(s >= 0.5)],
                                             names=["doc_id", "score", "kept"])

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(
        run, "doc_id long, score double, kept boolean")


def good_rows(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, all columns as they are."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([judge(t) >= 0.5 for t in values(batch.column(place))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
