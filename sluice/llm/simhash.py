"""SimHash near-dedup by segment popcounts.

Distinct fingerprints are mapped to the popcounts of their 2-bit segments. The
Manhattan distance of two such vectors never exceeds the Hamming distance of the
fingerprints, so a range join on the vectors finds every link; what it finds is
verified on the fingerprints.

The range join works on a grid with cells of side one: with the coordinates in
``max_distance + MATCH`` blocks, vectors within ``max_distance`` agree in all
coordinates of at least MATCH blocks, so each choice of MATCH blocks is a grid
and every link has both its ends in one cell of some grid."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import attach, materialize, pick, values, word_blocks
from sluice.llm.components import components

SEED = 42
#: Blocks that must agree; more of them make cells smaller and grids more.
MATCH = 4
#: Members of a cell that one task compares; larger cells are dealt to pairs of tiles.
TILE = 20_000
#: One fingerprint in so many is counted to find large cells (planning only).
PLAN_SAMPLE = 16
_LOW = 0x5555555555555555


def simhash(data: bytes, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles of UTF-8 text, A-Z lower-cased.

    Fewer words than a shingle: the whole sequence is one; no words: zero."""
    votes, total, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(data.lower()):
        words = carry + words
        n = len(words) - shingle + 1
        if n > 0:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
            hashes = np.array([digest(line[s:e], SEED)
                               for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)], "<u8")
            bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
            total += n
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if not total and carry:
        return digest(b" ".join(carry), SEED)
    return sum(1 << i for i in np.flatnonzero(votes * 2 > total).tolist())


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash((t or "").encode(), shingle) for t in values(batch.column(1))],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "fp"])

    rows = pick(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def embed(f: np.ndarray) -> np.ndarray:
    """Popcounts of the 2-bit segments in unary code (00, 01, 11), so that the
    Manhattan distance of two vectors is the popcount of their XOR."""
    low, pair = np.uint64(_LOW), f >> np.uint64(1)
    return ((f | pair) & low) | ((f & pair & low) << np.uint64(1))


def _embed_column(f: Column) -> Column:
    pair = F.shiftrightunsigned(f, 1)
    low = F.lit(_LOW)
    return (f.bitwiseOR(pair).bitwiseAND(low)).bitwiseOR(
        F.shiftleft(f.bitwiseAND(pair).bitwiseAND(low), 1))


def grids(max_distance: int) -> list[int]:
    """One mask for each choice of MATCH of the max_distance + MATCH blocks of 2-bit segments."""
    edges = [round(32 * i / (max_distance + MATCH)) * 2 for i in range(max_distance + MATCH + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(blocks, MATCH)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _tree(f: np.ndarray, most: int) -> np.ndarray:
    """Links that join what is connected in one cell: each found member is
    compared with those not yet found, so a dense cell takes about one pass."""
    out, left = [np.zeros((0, 2), np.uint64)], f
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(embed(left) ^ embed(x)) <= most
            near[near] = np.bitwise_count(left[near] ^ x) <= most
            found = left[near]
            out.append(np.stack([np.full(len(found), x), found], axis=1))
            todo.extend(found)
            left = left[~near]
    return np.concatenate(out)


def _links(most: int, small: int = 32):
    """mapInArrow over rows sorted by cell: (a, b) links that join each cell."""
    masks = np.array(grids(most), np.uint64)

    def cells(cell: np.ndarray, f: np.ndarray) -> np.ndarray:
        new = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]).any(axis=1))))
        size = np.diff(np.append(new, len(f)))
        run = np.repeat(np.arange(len(new)), size)
        out = [np.zeros((0, 2), np.uint64)]
        few = (size[run] <= small) & (size[run] > 1)
        g, r, grid = f[few], run[few], cell[few, 0]
        v = embed(g)
        for step in range(1, small):
            same = np.flatnonzero(r[step:] == r[:-step])
            if not len(same):
                break
            same = same[np.bitwise_count(v[same] ^ v[same + step]) <= most]
            same = same[np.bitwise_count(g[same] ^ g[same + step]) <= most]
            # only the first of the grids in which the two share a cell reports them
            first = ((v[same] ^ v[same + step])[:, None] & masks == 0).argmax(axis=1)
            same = same[first == grid[same]]
            out.append(np.stack([g[same], g[same + step]], axis=1))
        for k in np.flatnonzero(size > small).tolist():
            out.append(_tree(f[new[k]:new[k] + size[k]], most))
        return np.concatenate(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # the rows of the cell that is still open

        def send(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            ends = cells(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            cell, f = np.stack(cols[:4], axis=1), cols[4].view(np.uint64)
            if not len(f):
                continue
            other = np.flatnonzero((cell != cell[-1]).any(axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut or held and (held[0][0][0] != cell[-1]).any():
                yield send([*held, (cell[:cut], f[:cut])])
                held = []
            held.append((cell[cut:], f[cut:]))
        if held:
            yield send(held)

    return run


def fingerprint_links(fps: DataFrame, max_distance: int, tile: int = TILE) -> DataFrame:
    """(a, b): links of distinct fingerprints (column fp) that connect all that are
    within ``max_distance`` bits of each other.

    Not every link is returned, but enough of them that the components are
    those of all links. A cell with more than ``tile`` members (found by counting a
    sample) is dealt to every pair of its tiles, so no task holds a whole hot cell."""
    at = F.explode(F.array(*[
        F.struct(F.lit(i).alias("grid"), _embed_column(F.col("fp")).bitwiseAND(F.lit(_signed(m))).alias("cell"))
        for i, m in enumerate(grids(max_distance))]))
    members = fps.select("fp", at.alias("at")).select("at.grid", "at.cell", "fp")
    total = fps.count()
    plan = members.where(F.lit(False)).groupBy("grid", "cell").count()
    if total > tile:
        sample = max(1, min(PLAN_SAMPLE, tile // 8))
        plan = (members.where(F.pmod(F.xxhash64("fp"), F.lit(sample)) == 0)
                .groupBy("grid", "cell").agg((F.count("*") * sample).alias("count"))
                .where(F.col("count") > tile))
        plan = materialize(plan, "large-cells")
        n = plan.count()
        tiles = F.ceil(F.col("count") / tile).cast("int")
        plan = plan.select("grid", "cell", tiles.alias("tiles"))
        if n:
            plan = F.broadcast(plan) if n <= 100_000 else plan
            mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int")
            members = (members.join(plan, ["grid", "cell"], "left")
                       .withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("mine", mine)
                       .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
                       .select("grid", "cell", F.least("mine", "other").alias("t0"),
                               F.greatest("mine", "other").alias("t1"), "fp"))
    if "t0" not in members.columns:
        members = members.select("grid", "cell", F.lit(0).alias("t0"), F.lit(0).alias("t1"), "fp")
    key = ["grid", "cell", "t0", "t1"]
    return members.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _links(max_distance), "a long, b long")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 4, max_distance: int = 4, tile: int = TILE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    component_id: the smallest doc_id among all documents that links of at most
    ``max_distance`` differing bits reach, itself included.

    * null or blank text: fingerprint zero, linked like any other.
    * null id: takes part in links, gets the smallest id reached (null if none),
      kept only if its component has no id at all.
    * repeated rows: returned as often as given, with equal results.
    * empty table: no rows; other columns are ignored, whatever their names."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first"),
                                                  F.count("*").alias("n_rows")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp"), max_distance, tile))
    known = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    known = materialize(known, "roots")
    first = known.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n_fps"))
    by_fp = attach(known.select("fp", "root", "n_rows"), first, "root", "n_fps", known.count(), "fp")
    out = attach(rows, by_fp.select("fp", "n_rows", "component_id"), "fp", "n_rows", rows.count(), "doc_id")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
