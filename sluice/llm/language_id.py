"""Language identification by rank-order profiles.

A language's profile is its PROFILE most frequent letter n-grams (n = 1 to 3, with word
ends) in order of frequency. A document's own most frequent n-grams are ranked
the same way; the language with the smallest out-of-place distance wins."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import BLOCK, pick, values

#: n-grams of a profile and of a document that are compared.
PROFILE = 300
#: Labelled documents per language (expected) whose whole texts make a profile.
SAMPLE = 2000
#: A model holds one profile per language; more languages are an error.
LANGUAGES = 5000

_gap = re.compile(r"\s")
_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    global _table
    if _table is None:
        made = np.full(0x110000, 32, np.int64)
        for c in range(0x110000):
            x = chr(c)
            if x.isalpha():
                low = x.lower()
                made[c] = ord(low) if len(low) == 1 else c
        _table = made
    return _table


def _grams(text: str) -> np.ndarray:
    """Codes of all n-grams: 21 bits per letter, so no two n-grams share a code."""
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    c = np.concatenate(([32], c, [32]))
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    two = c[:-1] << 21 | c[1:]
    three = (two[:-1] << 21 | c[2:])[c[1:-1] != 32]
    return np.concatenate((c[c != 32], two, three)) if len(c) > 1 else c[:0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) over the whole text, in blocks cut at white space."""
    codes, counts, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while at < len(text):
        cut = _gap.search(text, at + BLOCK) if len(text) - at > BLOCK else None
        end = cut.start() if cut else len(text)
        new, n = np.unique(_grams(text[at:end]), return_counts=True)
        if at:
            codes, back = np.unique(np.concatenate((codes, new)), return_inverse=True)
            counts = np.bincount(back, np.concatenate((counts, n))).astype(np.int64)
        else:
            codes, counts = new, n
        at = end
    return codes, counts


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes in order; ties by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))[:size]]


def share(id_col: Column, per_million: Column | int) -> Column:
    """Whether a row is in a sample of so many millionths, by a hash of its id."""
    return F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < per_million


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample: int = SAMPLE) -> dict[str, list[int]]:
    """Profiles from about ``sample`` documents of each language (all, if it has fewer).

    Rows without a language or a text teach nothing."""
    rows = pick(labelled, doc_id=(id_col, "long"), text=(text_col, "string"), lang=(lang_col, "string")).where(
        "lang is not null and text is not null")
    sizes = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not sizes:
        return {}
    rate = F.create_map(*[F.lit(x) for r in sizes
                          for x in (r["lang"], min(1_000_000, -(-sample * 1_000_000 // r["count"])))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            held: dict[str, list] = {}
            for lang, text in zip(langs, values(batch.column(0)), strict=True):
                held.setdefault(lang, []).append(gram_counts(text))
            for lang, parts in held.items():
                codes, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                    names=["lang", "code", "n"])

    counts = rows.where(share(F.col("doc_id"), rate[F.col("lang")])).select("text", "lang").mapInArrow(
        count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    profiles: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["code"])
    return profiles


class Judge:
    """Compares ranked n-grams with every profile."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        codes = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
        self.codes, self.place = codes, np.full((len(self.langs), len(codes) + 1), -1, np.int64)
        for i, lang in enumerate(self.langs):
            self.place[i, np.searchsorted(codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def judge(self, text: str | None) -> tuple[str, float]:
        """(language, score): 1 - distance / largest distance; `und` and 0 without letters."""
        codes, counts = gram_counts(text or "")
        if not len(codes) or not self.langs:
            return "und", 0.0
        own = ranked(codes, counts)
        at = np.searchsorted(self.codes, own)
        known = np.append(self.codes, -1)[at] == own
        place = self.place[:, np.where(known, at, len(self.codes))]
        distance = np.where(place < 0, PROFILE, np.abs(place - np.arange(len(own)))).sum(axis=1)
        best = int(distance.argmin())  # ties: the language that sorts first
        return self.langs[best], float(1 - distance[best] / (PROFILE * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, from the whole text alone.

    * null text, or one without letters: `und` with score 0; so with no profiles.
    * null id: returned with the null; repeated rows: as often as given.
    * equal distances: the language that sorts first.
    * empty table: no rows; other columns are ignored, whatever their names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(profiles)
        for batch in batches:
            out = [judge.judge(t) for t in values(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.string()),
                 pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return pick(docs, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double")
