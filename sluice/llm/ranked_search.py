"""Ranked lexical search over a document FP-tree.

Documents are read once: their terms that some item asks for, with their counts, are
written as short vectors, and with them the statistics. Each task then takes its vectors in
blocks, orders every vector by the terms' document frequency, the most frequent first, and
sorts them into a trie in which equal beginnings share a path. Every node knows for each term
below it the highest tf, and the least m of its documents, which bound any score below. An item
searches the trie depth first, the best bound first, and leaves out what cannot
reach its ten best so far."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialize, pick, word_blocks

TOP = 10
#: Bytes of item texts that are searched for in one pass over the documents.
ITEM_BYTES = 2 << 20
#: Entries of the vectors in one trie, and documents below which a node isn't split.
TREE_ENTRIES = 1 << 20
LEAF = 32
#: Tasks' results meet in so many parts per item first.
SALTS = 64

_ALNUM = re.compile(rb"[0-9A-Za-z\x80-\xff]")
#: Byte by byte: A-Z lower-cased, what parts terms as a space.
_TERMS = bytes(ord(chr(b).lower()) if b < 0x80 and _ALNUM.match(bytes([b])) else b if b >= 0x80 else 0x20
               for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in blocks: runs of letters, digits and anything beyond ASCII."""
    return word_blocks((text or "").encode().translate(_TERMS))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


VECTORS = "kind int, doc_id long, n long, codes binary, tfs binary, total long"
_ARROW = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("codes", pa.binary()),
                    ("tfs", pa.binary()), ("total", pa.int64())])


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """The documents restricted to ``vocabulary`` (numbers from 1), and statistics of all.

    kind 0: a document with its number of terms ``n``, and the numbers and counts of those in the
    vocabulary; documents without any are left out. kind 1: ``total`` documents of the task hold
    the term with number ``n``. kind 2: ``n`` documents of the task have terms, ``total`` in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary) + 1, np.int64)
        n_docs = all_terms = 0
        get = vocabulary.get
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, codes, tfs = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
                for words in terms(text.as_py()):
                    n += len(words)
                    found = np.array(list(filter(None, map(get, words))), np.int64)
                    codes = np.concatenate((codes, found))
                    tfs = np.concatenate((tfs, np.ones(len(found), np.int64)))
                    codes, place = np.unique(codes, return_inverse=True)
                    tfs = np.bincount(place, tfs, len(codes)).astype(np.int64)
                n_docs, all_terms = n_docs + (n > 0), all_terms + n
                if len(codes):
                    df[codes] += 1
                    out.append((0, doc_id, n, codes.astype("<u4").tobytes(), tfs.astype("<u4").tobytes(), None))
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in out], _ARROW)
        out = [(1, None, int(c), None, None, int(df[c])) for c in np.flatnonzero(df)]
        out.append((2, None, n_docs, None, None, all_terms))
        yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in out], _ARROW)

    return docs.mapInArrow(run, VECTORS)


class Node:
    """Documents ``low`` to ``high`` of a trie, in its order, and its children's bounds."""

    __slots__ = ("low", "high", "children", "codes", "bounds", "starts")

    def __init__(self, low: int, high: int):
        self.low, self.high, self.children = low, high, []


class Tree:
    """The trie of a block of vectors, whose codes are ranks by frequency."""

    def __init__(self, doc_ids: np.ndarray, nulls: np.ndarray, m: np.ndarray, ends: np.ndarray,
                 codes: np.ndarray, tfs: np.ndarray, leaf: int = LEAF):
        starts = np.concatenate(([0], ends[:-1]))
        inside = np.lexsort((codes, np.repeat(np.arange(len(ends)), ends - starts)))
        codes, tfs = codes[inside], tfs[inside]
        flat = codes.astype(">u4").tobytes()
        keys = [flat[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.keys = [keys[i] for i in order.tolist()]
        self.doc_ids, self.nulls, self.m = doc_ids[order], nulls[order], m[order]
        sizes = (ends - starts)[order]
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(self.ends[-1]) + np.repeat(starts[order] - self.ends[:-1], sizes)
        self.codes, self.tfs = codes[places], tfs[places]
        self.shares = share(self.tfs, np.repeat(self.m, sizes))
        self.leaf = leaf
        self.root = Node(0, len(keys))
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            self._split(node)
            waiting += node.children

    def _split(self, node: Node) -> None:
        low, high = node.low, node.high
        if high - low <= self.leaf:
            return
        keys = self.keys
        depth = len(commonprefix([keys[low], keys[high - 1]])) // 4 * 4
        if depth == len(keys[high - 1]):
            return  # equal vectors
        cut = [low] + [i for i in range(low + 1, high) if keys[i][depth:depth + 4] != keys[i - 1][depth:depth + 4]]
        node.children = [Node(a, b) for a, b in zip(cut, [*cut[1:], high], strict=True)]
        # the highest tf of each term below each child, with the child's least m
        a, b = self.ends[low], self.ends[high]
        child = np.repeat(np.arange(len(cut)), np.diff([*self.ends[cut], b]))
        order = np.lexsort((self.codes[a:b], child))
        child, codes, tfs = child[order], self.codes[a:b][order], self.tfs[a:b][order]
        new = np.flatnonzero(np.concatenate(([True], (child[1:] != child[:-1]) | (codes[1:] != codes[:-1]))))
        least = np.minimum.reduceat(self.m[low:high], np.array(cut) - low)
        node.codes = codes[new]
        node.bounds = share(np.maximum.reduceat(tfs, new), least[child[new]])
        node.starts = np.flatnonzero(np.concatenate(([True], child[new][1:] != child[new][:-1])))

    def search(self, weights: np.ndarray, best: Best) -> int:
        """Put the documents that reach ``best`` into it; the number of nodes looked at."""
        stack, seen = [(0, 0, self.root)], 0
        while stack:
            bound, _, node = stack.pop()
            if seen and bound < best.least:
                continue
            seen += 1
            if not node.children:
                a, b = self.ends[node.low], self.ends[node.high]
                scores = np.add.reduceat(weights[self.codes[a:b]] * self.shares[a:b], self.ends[node.low:node.high] - a)
                at = np.flatnonzero(scores >= best.least)
                if len(at):
                    best.add(scores[at], self.nulls[node.low + at], self.doc_ids[node.low + at])
                continue
            bounds = np.add.reduceat(weights[node.codes] * node.bounds, node.starts)
            at = np.flatnonzero(bounds >= best.least)
            for i in at[np.argsort(bounds[at], kind="stable")].tolist():
                stack.append((int(bounds[i]), i, node.children[i]))
        return seen


class Best:
    """The best documents of an item so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, top: int = TOP):
        self.top, self.least = top, 1
        self.score, self.null, self.doc_id = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc_id: np.ndarray) -> None:
        score, null, doc_id = (np.concatenate(x) for x in (
            (self.score, score), (self.null, null), (self.doc_id, doc_id)))
        keep = np.lexsort((doc_id, null, -score))[:self.top]
        self.score, self.null, self.doc_id = score[keep], null[keep], doc_id[keep]
        if len(keep) == self.top:
            self.least = max(1, int(self.score[-1]))


FOUND = "item long, part int, doc_id long, score long"


def search(found: DataFrame, asked: list[list[int]], rank: np.ndarray, weights: np.ndarray, n_docs: int,
           n_terms: int, top: int = TOP, entries: int = TREE_ENTRIES) -> DataFrame:
    """The best documents of every item within each task. ``found``: vectors; ``rank``: of each
    of their numbers; ``asked``: the ranks of each item's terms; ``weights``: of each rank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in asked]

        def look(rows: list[tuple]) -> None:
            doc_ids, n, codes, tfs = zip(*rows, strict=True)
            codes, tfs = ([np.frombuffer(x, "<u4") for x in c] for c in (codes, tfs))
            nulls = np.array([x is None for x in doc_ids])
            tree = Tree(np.array([x or 0 for x in doc_ids], np.int64), nulls,
                        np.array([10 + 90 * x * n_docs // n_terms for x in n], np.int64),
                        np.cumsum([len(c) for c in codes]), rank[np.concatenate(codes)],
                        np.concatenate(tfs).astype(np.int64))
            own = np.zeros(len(weights), np.int64)
            for ranks, its in zip(asked, best, strict=True):
                own[ranks] = weights[ranks]
                tree.search(own, its)
                own[ranks] = 0

        held, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append(row)
                size += len(row[2]) // 4
                if size >= entries:
                    look(held)
                    held, size = [], 0
        if held:
            look(held)
        part = TaskContext.get().partitionId() % SALTS
        for item, its in enumerate(best):
            if len(its.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(its.score), item)), pa.array(np.full(len(its.score), part, np.int32)),
                     pa.array(its.doc_id, mask=its.null), pa.array(its.score)], names=["item", "part", "doc_id", "score"])

    return found.select("doc_id", "n", "codes", "tfs").mapInArrow(run, FOUND)


def _best_of(rows: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", top: int = TOP,
                  item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Items are the stated queries. They are searched for in blocks of about ``item_bytes`` of text, each
    block in one pass over all documents, so the driver and the tasks hold one block's
    terms at a time, however many items there are.
    * null or empty text of an item, or one without terms: no rows. Null text of a
      document: it has no terms.
    * null ids of items and documents: returned as they are; documents with a null id come
      last among equal scores. Equal scores: the smaller doc_id first.
    * repeated rows: each document row is a document, each item row an item of its own.
    * empty tables: no rows; other columns are ignored, whatever their names."""
    spark = docs.sparkSession
    docs = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    items = materialize(pick(items, item_id=(item_col, "long"), text=(item_text, "string")), "items")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, out = -(-size // item_bytes), []
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        numbers: dict[bytes, int] = {}
        asked = [sorted({numbers.setdefault(t, len(numbers) + 1) for some in terms(r["text"]) for t in some}) for r in rows]
        if not numbers:
            continue
        written = materialize(vectors(docs, numbers), "vectors")
        df, n_docs, n_terms = np.zeros(len(numbers) + 1, np.int64), 0, 0
        # a row for each of the block's terms, and one
        counts = written.where("kind > 0").groupBy("kind", F.when(F.col("kind") == 1, F.col("n")).alias("term")).agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"))
        for kind, term, n, total in counts.collect():
            if kind == 1:
                df[term] = total
            else:
                n_docs, n_terms = n, total
        if not n_docs:
            continue
        rank = np.zeros(len(df), np.int64)  # the most frequent term has rank 0
        rank[1:][np.argsort(-df[1:], kind="stable")] = np.arange(len(numbers))
        weights = np.zeros(len(numbers), np.int64)
        weights[rank[1:]] = [weight(n_docs, int(x)) for x in df[1:]]
        found = search(written.where("kind = 0"), [rank[x].tolist() for x in asked], rank, weights,
                       n_docs, n_terms, top)
        found = _best_of(_best_of(found, ["item", "part"], top), ["item"], top)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item long, item_id long")
        out.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole

