"""Equality of multisets of rows (U2, U6) without moving equal rows.

Every group of rows has a signature that doesn't depend on their order: their number and two
sums of independent 64-bit row hashes. One aggregate per side gives the signatures; only
the rows of groups whose signatures differ are compared row by row. Two different groups with
equal signatures would be missed; for hashes that spread evenly that happens
once in 2^128 pairs. The hashes are not secret, so rows made on purpose to collide are
out of scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir

#: Groups of a table that is compared as a whole.
GROUPS = 1 << 16
#: Differing groups that are broadcast; more of them are joined by a shuffle.
BROADCAST_GROUPS = 500_000


def _hash(columns: list[str], salt: int) -> Column:
    # hash functions pass over nulls, so a mark says where they are
    marked = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(salt), *marked)


def signatures(rows: DataFrame, by: Column) -> DataFrame:
    """group, n, s1, s2: the signature of every group."""
    wide = [_hash(rows.columns, salt).cast("decimal(38,0)") for salt in (1, 2)]
    return rows.select(by.alias("group"), wide[0].alias("h1"), wide[1].alias("h2")).groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))


def multiset_difference(first: DataFrame, second: DataFrame, by: str | None = None,
                        sides: tuple[str, str] = ("first", "second")) -> DataFrame:
    """Rows that one side has more often than the other, as often as it has more, with ``side``.

    ``by`` names a column whose groups are compared; without it rows are grouped by hash. Equal
    tables cost one aggregate each; the signatures are looked at before the rest is planned."""
    ensure_checkpoint_dir(first.sparkSession)
    second = second.select(*first.columns)
    group = F.col(by) if by else F.pmod(_hash(first.columns, 3), F.lit(GROUPS))
    a, b = signatures(first, group), signatures(second, group)
    b = b.select(F.col("group").alias("g2"), F.col("n").alias("n2"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    same = (F.col("n").eqNullSafe(F.col("n2")) & F.col("s1").eqNullSafe(F.col("t1")) & F.col("s2").eqNullSafe(F.col("t2")))
    differ = a.join(b, F.col("group").eqNullSafe(F.col("g2")), "full_outer").where(~same).select(
        F.when(F.col("n").isNull(), F.col("g2")).otherwise(F.col("group")).alias("_group")).checkpoint()
    n = differ.count()
    if not n:
        return first.limit(0).withColumn("side", F.lit(sides[0]))
    few = F.broadcast(differ) if n <= BROADCAST_GROUPS else differ
    left, right = (x.join(few, group.eqNullSafe(F.col("_group")), "left_semi") for x in (first, second))
    # one aggregate over both sides: how many more times the first has a row than the second
    more = left.withColumn("_n", F.lit(1).cast("long")).unionByName(right.withColumn("_n", F.lit(-1).cast("long"))).groupBy(
        *first.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    side = F.when(F.col("_n") > 0, F.lit(sides[0])).otherwise(F.lit(sides[1])).alias("side")
    return more.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.abs("_n").cast("int")))).select(
        *first.columns, side)
