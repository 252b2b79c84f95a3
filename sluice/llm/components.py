"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import attach, materialize


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root: the smallest node reachable.

    ``links`` holds undirected links between 64-bit nodes; repeats and loops
    are allowed, null ends are not linked. Each round hangs larger neighbours
    on the smallest one (large star), then smaller neighbours (small star),
    until nothing changes: O(log n) rounds in practice. Every round is two
    aggregations and joins on node keys, written to the shared folder; the neighbours of
    a hub are dealt to many tasks; nothing is collected but a count and a checksum.
    Without links there are no rows."""
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = materialize(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v")))
                      .distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        large = (attach(both, least, "u", "n", 2 * mark[0], "v").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = attach(large, least, "u", "n", large.count(), "v").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
                          "small-star")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
