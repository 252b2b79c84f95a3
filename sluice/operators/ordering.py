"""Ordered edges (O2, O3): total orders by range partitions, never by one task.

A result that leaves the engine in order is dealt to ranges of its key, each sorted by itself, so
partition i holds nothing that belongs before partition i - 1. The keys end in the row's own
identity, so a hot file or transaction is cut within and no two rows tie."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import ensure_checkpoint_dir

RECORD_ORDER = ("source_id", "row_number")
GROUP_ORDER = ("sales_channel_code", "source_transaction_number", "source_id", "row_number")


def in_order(rows: DataFrame, keys: tuple[str, ...], partitions: int | None = None) -> DataFrame:
    """``rows`` in the total order of ``keys`` over range partitions."""
    by = [F.col(k).asc_nulls_first() for k in keys]
    dealt = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by)


def order_records(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """O2: records by file and row."""
    return in_order(records, RECORD_ORDER, partitions)


def order_groups(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """O3: sales lines by (channel, transaction), within one by file and row."""
    return in_order(lines, GROUP_ORDER, partitions)


def with_position(ordered: DataFrame) -> DataFrame:
    """``position`` of each row in the whole, from 1.

    The number within a partition and the sizes of the partitions before it; the latter is
    one row per partition. The ordered rows are checkpointed, so that both read the same ranges."""
    ensure_checkpoint_dir(ordered.sparkSession)
    rows = ordered.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        "position", F.col("_before") + within + 1).drop("_id", "_part", "_before")


def partition_borders(ordered: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The least and the greatest key of every partition, as structs, to check an order with."""
    key = F.struct(*keys)
    return ordered.select(F.spark_partition_id().alias("partition"), key.alias("key")).groupBy("partition").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("n"))
