"""Embedding near-dedup against all pairs."""

import numpy as np

from sluice.llm import embedding_dedup as E


def _brute(rows):
    """rows: distinct (id, label, vector)."""
    units = [E.unit(v) if g is not None else None for _, g, v in rows]
    n = len(rows)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if units[i] and units[j] and rows[i][1] == rows[j][1] and len(units[i]) == len(units[j]):
                near[i, j] = near[j, i] = np.frombuffer(units[i]) @ np.frombuffer(units[j]) >= 0.98
    out, seen = [], {}
    for i in range(n):
        if i not in seen:
            todo, group = [i], {i}
            while todo:
                for j in np.flatnonzero(near[todo.pop()]).tolist():
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in group if rows[j][0] is not None]
            seen |= dict.fromkeys(group, min(ids) if ids else None)
        out.append((rows[i][0], int(near[i].sum()), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=str)


def _rows(rng, n=400):
    out = []
    for c in range(n // 8):
        base = rng.standard_normal(16)
        for k in range([1, 1, 2, 3, 40][c % 5]):
            out.append((len(out) * 7 % 1009, c % 3, (base + k % 5 * 0.03 * rng.standard_normal(16)).tolist()))
    v = out[0][2]
    bad = [None, [], [0.0] * 16, [None, *v[1:]], [float("nan"), *v[1:]], [float("inf"), *v[1:]]]
    out += [(2000 + i, 0, b) for i, b in enumerate(bad)]
    out += [(2100, None, v), (2101, None, v), (None, 0, v), (2102, 0, v[:8]), (2103, 0, v[:8]),
            (2104, 0, [x * 1e200 for x in v]), (2105, 0, [x * 1e-200 for x in v]), (out[3][0], 0, v)]
    return out


def test_matches_brute_force(spark):
    rows = _rows(np.random.default_rng(3))
    table = spark.createDataFrame([(*r, 1, "x") for r in [*rows, rows[1], rows[-1]]],
                                  "vec_id long, label int, embedding array<double>, row int, UNIT string")
    for window, part, tile in ((E.WINDOW, E.PART, E.TILE), (8, 50, 7)):  # small: seams and tiles
        got = E.embedding_dedup(table.repartition(3), window=window, part=part, tile=tile, passes=12).collect()
        assert sorted(map(tuple, got), key=str) == _brute(rows)


def test_empty_table(spark):
    assert E.embedding_dedup(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_recall_with_the_default_passes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(3000):
        base = rng.standard_normal(64)
        rows.append((len(rows), 0, base.tolist()))
        if c % 6 == 0:  # a pair just above the threshold
            other = rng.standard_normal(64)
            other -= (other @ base) / (base @ base) * base
            other *= np.linalg.norm(base) / np.linalg.norm(other)
            rows.append((len(rows), 0, (0.981 * base + np.sqrt(1 - 0.981**2) * other).tolist()))
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    found = sum(r.n_links for r in E.embedding_dedup(table).collect())
    assert 0.95 * 1000 <= found <= 1000


def test_hot_cluster_with_the_default_passes(spark):
    """A crowd at cosine 0.9 to 0.985 that holds near pairs, and many equal vectors, against all pairs."""
    rng = np.random.default_rng(11)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)

    def beside(v, cosine):
        other = rng.standard_normal(64)
        other -= (other @ v) / (v @ v) * v
        return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)

    x = [beside(centre, rng.uniform(0.9, 0.985) ** 0.5) for _ in range(4000)]
    x += [beside(v, 0.981) for v in x[:1000]] + [x[0]] * 60 + [*rng.standard_normal((1000, 64))]
    order = rng.permutation(len(x))
    table = spark.createDataFrame([(i, 0, x[k].tolist()) for i, k in enumerate(order)],
                                  "vec_id long, label int, embedding array<double>")
    units = np.array([x[k] / np.linalg.norm(x[k]) for k in order])
    near = units @ units.T >= 0.98
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in E.embedding_dedup(table).collect()}
    assert len(got) == len(x)
    n = near.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= n).all() and found.sum() >= 0.98 * n.sum()
    assert (found == n).mean() >= 0.97


def test_labels_of_any_kind(spark):
    """1.2 and 1.7 are two labels, and so are two texts."""
    v = [1.0, 0.0, 0.0]
    for kind, labels in (("double", [1.2, 1.2, 1.7, None]), ("string", ["a", "a", "b", None]), ("int", [1, 1, 2, None])):
        rows = spark.createDataFrame([(i, label, v) for i, label in enumerate(labels)], f"vec_id long, label {kind}, embedding array<double>")
        got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_dedup(rows).collect()}
        assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2), 3: (0, 3)}
