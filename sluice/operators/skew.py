"""Joins of many rows with one row per file, when one file may hold a third of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A file's rows are dealt to so many parts; its one row is repeated for each of them.
BUCKETS = 32


#: Rows of a table, one per file, that are broadcast whole (about 80 MB); more of them are shuffled.
FEW_FILES = 500_000


def spread_join(rows: DataFrame, per_key: DataFrame, keys: str | Sequence[str], how: str,
                by: Sequence[str] = ("row_number",), few: bool = False) -> DataFrame:
    """``rows.join(per_key, keys, how)`` for ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    ``per_key`` has at most one row per key. If it is known to be small (``few``) or Spark measures
    it so, it is broadcast; else the shuffle is by key and a bucket of ``by``, so that the
    rows of a hot key meet their row in BUCKETS tasks. The result is not
    partitioned by key: an aggregation by key above it pre-aggregates first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if few:
        return rows.join(F.broadcast(per_key), keys, how)
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int")
    left = rows.withColumn("_bucket", bucket)
    right = per_key.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))))
    return left.join(right, [*keys, "_bucket"], how).drop("_bucket")
