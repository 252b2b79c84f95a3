"""Sinks of canonical records.

The store has a fixed number of buckets of source files per contract version, so its number of
directories doesn't grow with the files. A replay rewrites the buckets it touches and no other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.session import ensure_checkpoint_dir

#: Buckets of a contract version. A store keeps the number that it was begun with.
BUCKETS = 64
_PARTITIONS = ("contract_id", "contract_version", "bucket")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def replace_partitions(rows: DataFrame, path: str, keys: Sequence[str], touched: DataFrame,
                       options: dict[str, str] | None = None) -> None:
    """Write ``rows`` (already cut off from ``path``) over the partitions they have, and delete
    those of ``touched`` for which they have none.

    ``touched`` is bounded by the number of partitions, not of rows."""
    spark = rows.sparkSession
    emptied = touched.select(*keys).distinct().join(rows.select(*keys).distinct(), list(keys), "left_anti").collect()
    # a partition is as many files as its size asks for: large ones are split, small ones share a task
    (rows.write.mode("overwrite").partitionBy(*keys).options(**(options or {}))
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    for r in emptied:
        place = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{k}={r[k]}" for k in keys]]))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_canonical(records: DataFrame, path: str, replaced: DataFrame | None = None, buckets: int = BUCKETS) -> None:
    """Store canonical records by (contract, version, bucket of the source file).

    A file that is ingested again replaces its own rows: the stored rows of a touched bucket
    whose file is among the new ones are left out, the others are written back with the new
    ones. ``replaced`` (contract_id, contract_version, source_id) names files to replace
    besides those with records, such as files that have none any more."""
    spark = records.sparkSession
    ensure_checkpoint_dir(spark)
    new = records.withColumn("bucket", bucket_of("source_id", buckets))
    keys = [*_PARTITIONS, "source_id"]
    files = new.select(*keys)
    if replaced is not None:
        files = files.unionByName(replaced.withColumn("bucket", bucket_of("source_id", buckets)).select(*keys))
    touched = files.limit(0)
    if path_exists(spark, path):
        files = files.distinct().checkpoint()
        stored = spark.read.schema(new.schema).parquet(path)
        touched = files.select(*_PARTITIONS).distinct()
        # at most buckets x versions rows; they prune the partitions that are read
        kept = stored.join(F.broadcast(touched), list(_PARTITIONS), "left_semi").join(files, keys, "left_anti")
        new = new.unionByName(kept.select(*new.columns)).checkpoint()  # read before its place is overwritten
    replace_partitions(new.hint("rebalance", *_PARTITIONS), path, _PARTITIONS, touched)


def read_canonical(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The stored records; with ``schema`` also where no record was ever stored."""
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return stored.drop("bucket")
