"""Embedding near-dedup by sorted projection passes.

Each pass draws random hyperplanes, concatenates the signs of a vector into one key,
sorts all vectors by group and key, and compares each with its next WINDOW
neighbours. Where vectors crowd, so that more share the leading signs than a window
holds, all of that run are compared tile by tile; so a pair whose leading signs agree
is compared whatever lies around it. Pairs verified by their cosine in double precision
are united over the passes. Links inside the components found are then counted tile by
tile, so the window bounds neither the search nor the counts."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluice.llm.common import attach, materialize, pick
from sluice.llm.components import components

BITS = 64
WINDOW = 32
#: Share of the pairs at the threshold that all passes together may miss.
MISS = 0.01
#: Rows of a sorted part, and of a tile in which links are counted.
PART, TILE = 8192, 2048


def leading(n: int, window: int = WINDOW) -> int:
    """Leading signs after which runs of n evenly spread vectors fit the window."""
    return min(BITS, max(1, math.floor(math.log2(max(2.0, n / window)))))


def passes_for(n: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``.

    One pass finds it if the leading log2(n / window) signs agree, also in a crowd (crowded_links)."""
    if threshold >= 1:
        return 1
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** max(1.0, math.log2(max(2.0, n / window)))
    return max(2, math.ceil(math.log(miss) / math.log(1 - found)))


def unit(values: list[float | None] | None) -> bytes | None:
    """The vector scaled to length one as doubles; None if it can't be compared."""
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, np.float64)
    if not np.isfinite(v).all() or not v.any():
        return None
    v = v / np.abs(v).max()  # so that squares neither overflow nor vanish
    return (v / np.sqrt(v @ v)).tobytes()


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [unit(v) if g is not None else None
               for g, v in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                         names=["vec_id", "label", "unit"])


def _matrix(units: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units.to_pylist()), np.float64).reshape(-1, dim)


def _signs(units: list[bytes], number: int, planes: dict[tuple[int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, keys) of vectors in one pass: a key holds the signs as an ordered long."""
    dims = np.array([len(u) // 8 for u in units], np.int32)
    key = np.zeros(len(units), np.int64)
    for dim in np.unique(dims).tolist():
        if (number, dim) not in planes:
            planes[number, dim] = np.random.default_rng([number, dim]).standard_normal((dim, BITS))
        at = np.flatnonzero(dims == dim)
        x = np.frombuffer(b"".join([units[i] for i in at.tolist()]), np.float64).reshape(-1, dim)
        bits = np.packbits(x @ planes[number, dim] > 0, axis=1, bitorder="big")
        key[at] = (bits.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
    return dims, key


def _keys(number: int):
    """(row, label, dim, key, unit)"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            dims, key = _signs(batch.column(2).to_pylist(), number, planes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims), pa.array(key), batch.column(2)],
                names=["row", "label", "dim", "key", "unit"])
    return run


def _run_keys(passes: int, bits: int):
    """(row, weight, pass, label, dim, lead) of every pass; lead: the leading signs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            units = batch.column(2).to_pylist()
            for number in range(passes):
                dims, key = _signs(units, number, planes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(3), pa.array(np.full(len(units), number, np.int32)),
                     batch.column(1), pa.array(dims), pa.array(key >> np.int64(BITS - bits))],
                    names=["row", "weight", "pass", "label", "dim", "lead"])
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the pairs that join two sets not joined before."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(i)
    return out


def _near(group: np.ndarray, row: np.ndarray, units: pa.Array, window: int, least: float,
          seam: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of sorted rows to the next ``window`` ones of their group; with a seam
    only those that cross it."""
    n = len(row)
    if not n:
        return row, row
    a, b = [], []
    for dim in np.unique(group[:, 1]).tolist():
        at = np.flatnonzero(group[:, 1] == dim)
        x, g = _matrix(units.take(pa.array(at)), dim), group[at, 0]
        for step in range(1, min(window, len(at) - 1) + 1):
            i = np.flatnonzero(g[step:] == g[:-step])
            if seam is not None:
                i = i[(at[i] < seam) & (at[i + step] >= seam)]
            i = i[np.einsum("ij,ij->i", x[i], x[i + step]) >= least]
            a.append(row[at[i]])
            b.append(row[at[i + step]])
    a = np.concatenate([row[:0], *a])
    b = np.concatenate([row[:0], *b])
    keep = _forest(a, b)
    return a[keep], b[keep]


_OUT = "a long, b long, part int, side int, place int, label long, dim int, unit binary"


def _windows(window: int, least: float):
    """Per sorted part: links (side 0), and its first (1) and last (2) rows for the seams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        part, n = TaskContext.get().partitionId(), t.num_rows
        row, units = t["row"].to_numpy(), t["unit"].combine_chunks()
        units = units.chunk(0) if isinstance(units, pa.ChunkedArray) else units
        group = np.stack([t["label"].to_numpy(), t["dim"].to_numpy()], axis=1)
        a, b = _near(group, row, units, window, least)
        none = lambda k, m: pa.nulls(m, k)
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        names = [x.split()[0] for x in _OUT.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(b), none(kinds[0], len(a)), pa.array(np.zeros(len(a), np.int32)),
             none(kinds[1], len(a)), none(kinds[2], len(a)), none(kinds[3], len(a)), none(kinds[4], len(a))],
            names=names)
        for side, ends in ((1, np.arange(min(window, n))), (2, np.arange(max(0, n - window), n))):
            m = len(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[ends]), none(pa.int64(), m), pa.array(np.full(m, part - (side == 1), np.int32)),
                 pa.array(np.full(m, side, np.int32)), pa.array(ends.astype(np.int32)),
                 pa.array(group[ends, 0]), pa.array(group[ends, 1].astype(np.int32)), units.take(pa.array(ends))],
                names=names)
    return run


def _seam(window: int, least: float):
    """Links between the last rows of a part and the first ones of the next."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("side", "descending"), ("place", "ascending")]).combine_chunks()
        group = np.stack([t["label"].to_numpy(), t["dim"].to_numpy()], axis=1)
        units = t["unit"].combine_chunks()
        units = units.chunk(0) if isinstance(units, pa.ChunkedArray) else units
        a, b = _near(group, t["a"].to_numpy(), units, window, least,
                     int((t["side"].to_numpy() == 2).sum()))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})
    return run


def projection_links(vectors: DataFrame, threshold: float, number: int, window: int = WINDOW,
                     part: int = PART, n: int | None = None) -> DataFrame:
    """(a, b): verified links of one pass over (row, label, unit), as spanning forests.

    ``n``: the number of vectors, if it is known. Without vectors there are no links."""
    keyed = vectors.select("row", "label", "unit").mapInArrow(
        _keys(number), "row long, label long, dim int, key long, unit binary")
    order = ["label", "dim", "key", "unit", "row"]  # equal vectors side by side: each links to the next
    parts = max(1, -(-(vectors.count() if n is None else n) // part))
    swept = materialize(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _windows(window, threshold), _OUT), "pass")
    seams = swept.where("side > 0").groupBy("part").applyInArrow(_seam(window, threshold), "a long, b long")
    return swept.where("side = 0").select("a", "b").unionByName(seams)


def _tree(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with near[i, j] that join all that is joined by the true places of a matrix."""
    i_left, j_left = near.any(axis=1), near.any(axis=0)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first in np.flatnonzero(i_left).tolist():
        todo = [first] if i_left[first] else []
        i_left[first] = False
        while todo:
            i = todo.pop()
            found = np.flatnonzero(near[i] & j_left)
            j_left[found] = False
            a.append(np.full(len(found), i))
            b.append(found)
            for j in found.tolist():
                more = np.flatnonzero(near[:, j] & i_left)
                i_left[more] = False
                a.append(more)
                b.append(np.full(len(more), j))
                todo += more.tolist()
    return np.concatenate(a), np.concatenate(b)


def _near_tiles(t: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (i, j, near) of a pair of tiles: every pair of places once, or of one tile
    twice (i, j and j, i) without the places themselves."""
    mine, units = t["mine"].to_numpy(), t["unit"].to_pylist()
    x = np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)
    both = int(t["t0"][0].as_py()) != int(t["t1"][0].as_py())
    left = np.flatnonzero(mine == mine.min()) if both else np.arange(len(mine))
    right = np.flatnonzero(mine != mine.min()) if both else left
    for at in range(0, len(left), 1024):
        i = left[at:at + 1024]
        near = x[i] @ x[right].T >= least
        if not both:
            near[np.arange(len(i)), at + np.arange(len(i))] = False
        yield i, right, near


def _count_links(t: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, n) links between different vectors of a pair of tiles."""
    row, n = t["row"].to_numpy(), np.zeros(t.num_rows, np.int64)
    both = int(t["t0"][0].as_py()) != int(t["t1"][0].as_py())
    for i, j, near in _near_tiles(t, least):
        n[i] += near.sum(axis=1)
        if both:
            n[j] += near.sum(axis=0)
    return row, n


def _find_links(t: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) links that join all that the links of a pair of tiles join."""
    row, a, b = t["row"].to_numpy(), [], []
    for i, j, near in _near_tiles(t, least):
        p, q = _tree(near)
        a.append(row[i[p]])
        b.append(row[j[q]])
    a, b = np.concatenate([row[:0], *a]), np.concatenate([row[:0], *b])
    keep = _forest(a, b)
    return a[keep], b[keep]


def _per_cell(links, least: float, names: list[str]):
    """Run ``links`` on every pair of tiles (rows sorted by it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        cell = None

        def send() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links(pa.concat_tables(held), least)],
                                                 names=names)
                held.clear()

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))) if len(keys) else []
            for a, b in zip(new, [*new[1:], len(keys)], strict=True):
                if cell is not None and (keys[a] != cell).any():
                    yield from send()
                cell = keys[a]
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        yield from send()

    return run


def _cells(members: DataFrame, vectors: DataFrame, tile: int) -> DataFrame:
    """Members (row, root, size) dealt to the pairs of tiles of their root, sorted by these."""
    members = members.withColumn("tiles", F.ceil(F.col("size") / tile).cast("int")).withColumn(
        "mine", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    pairs = members.join(vectors.select("row", "unit"), "row").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    key = ["root", "t0", "t1"]
    cells = pairs.select("root", F.least("mine", "other").alias("t0"), F.greatest("mine", "other").alias("t1"),
                         "mine", "row", "unit")
    return cells.repartition(*key).sortWithinPartitions(*key)


def link_counts(vectors: DataFrame, roots: DataFrame, threshold: float, tile: int = TILE) -> DataFrame:
    """(row, n_links): every link between members of a component, counted pair of
    tiles by pair of tiles; no list of pairs is made."""
    members = roots.withColumnRenamed("node", "row")
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    members = attach(members, sizes, "root", "size", members.count(), "row")
    counts = _cells(members, vectors, tile).mapInArrow(
        _per_cell(_count_links, threshold, ["row", "n"]), "row long, n long")
    return counts.groupBy("row").agg(F.sum("n").alias("n_links"))


def crowded_links(vectors: DataFrame, threshold: float, passes: int, bits: int, window: int = WINDOW,
                  tile: int = TILE) -> DataFrame:
    """(a, b): links of the crowded runs of every pass, as spanning forests of tiles.

    A run holds the vectors of one label and length whose ``bits`` leading signs agree. With
    more rows than ``window`` reaches it is crowded, and all its different vectors are
    compared, tile by tile. Equal vectors, which the passes chain, stand in it as one. Without
    vectors there are no runs."""
    folded = materialize(vectors.groupBy("label", "unit").agg(F.min("row").alias("row"), F.count("*").alias("weight")),
                         "folded")
    run = ["pass", "label", "dim", "lead"]
    keyed = folded.select("row", "label", "unit", "weight").mapInArrow(
        _run_keys(passes, bits), "row long, weight long, pass int, label long, dim int, lead long").select(
        F.struct(*run).alias("run"), "row", "weight")
    runs = keyed.groupBy("run").agg(F.count("*").alias("size"), F.sum("weight").alias("rows")).where(
        (F.col("rows") > window + 1) & (F.col("size") > 1))
    runs = materialize(runs.select("run", "size", F.monotonically_increasing_id().alias("root")), "crowded")
    total = folded.count() * passes
    members = attach(keyed.select("run", "row"), runs, "run", "size", total, "row").where("size is not null")
    return _cells(members.drop("run"), folded, tile).mapInArrow(
        _per_cell(_find_links, threshold, ["a", "b"]), "a long, b long")


def embedding_dedup(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.98, window: int = WINDOW,
                    passes: int | None = None, part: int = PART, tile: int = TILE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (vec_id = component_id).

    Links join vectors of equal label and length whose cosine is at least
    ``threshold``. ``passes``: by default enough for the number of rows (passes_for).

    * labels of any kind; other than whole numbers, as they read as text.
    * null label; null, empty or zero vector; a null or non-finite component: no links.
    * null id: links like any other row, gets the smallest id reached (null if none).
    * rows equal in id, label and vector are one vector, returned once; rows of one
      id that differ are vectors of their own.
    * empty table: no rows; other columns are ignored, whatever their names."""
    whole = isinstance(table.schema[table.columns.index(label_col)].dataType, IntegralType)
    rows = pick(table, vec_id=(id_col, "long"), label=(label_col, "long" if whole else "string"), v=(vector_col, "array<double>"))
    if not whole:  # labels of other kinds are told apart by a 64-bit hash of their text
        rows = rows.withColumn("label", F.when(F.col("label").isNotNull(), F.xxhash64("label")))
    rows = rows.mapInArrow(_units, "vec_id long, label long, unit binary").distinct().withColumn(
        "row", F.monotonically_increasing_id())
    rows = materialize(rows, "vectors")
    vectors = rows.where("unit is not null")
    n = vectors.count()
    passes = passes or passes_for(n, threshold, window)
    links = crowded_links(vectors, threshold, passes, leading(n, window), window, tile)
    for more in [projection_links(vectors, threshold, k, window, part, n) for k in range(passes)]:
        links = links.unionByName(more)
    roots = materialize(components(links), "roots")
    counts = link_counts(vectors, roots, threshold, tile)
    ids = rows.select("row", "vec_id").join(roots.withColumnRenamed("node", "row"), "row", "left").join(
        counts, "row", "left").withColumn("root", F.coalesce("root", "row"))
    ids = materialize(ids, "linked")
    first = ids.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count("*").alias("size"))
    out = attach(ids, first, "root", "size", ids.count(), "row")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
