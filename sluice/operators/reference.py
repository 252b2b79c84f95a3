"""Reference-data reconciliation.

Approved reference rows are compared with what a table already holds:
missing rows are appended (left anti join), conflicting rows (same code,
another name) stop the whole append, unrelated extra rows are left alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.compare import multiset_difference


def reference_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """An inline relation of approved rows (bounded by the spec)."""
    return spark.createDataFrame(list(rows), schema)


def missing_reference(approved: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """J2 + U3: approved rows whose key is not present yet."""
    return approved.join(existing.select(key), key, "left_anti")


def conflicting_reference(approved: DataFrame, existing: DataFrame, key: str,
                          value: str) -> DataFrame:
    """Same key, different value."""
    e = existing.select(key, F.col(value).alias("existing_" + value))
    return (approved.join(e, key, "inner")
            .where(~F.col(value).eqNullSafe(F.col("existing_" + value)))
            .select(key, F.col(value).alias("approved_" + value), "existing_" + value))


def exact_reference_state(approved: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows that keep the table from equalling the approved set exactly
    (both directions, duplicates counted), tagged with their side."""
    return multiset_difference(approved, existing, sides=("missing", "unexpected"))


def append_missing_reference(approved: DataFrame, existing: DataFrame, key: str, value: str,
                             path: str | None = None) -> DataFrame:
    """The rows to insert (empty when any conflict exists, since then
    nothing is written).  With ``path``, the rows are appended to the
    Parquet table there; a second run appends none."""
    conflicts = conflicting_reference(approved, existing, key, value)
    missing = missing_reference(approved, existing, key)
    # All-or-nothing: rows are kept only when no conflicting key exists; the
    # conflict flag is a global aggregate (one row), joined on a constant.
    flag = conflicts.agg(F.count(F.lit(1)).alias("_n")).withColumn("_j", F.lit(1))
    to_insert = (missing.withColumn("_j", F.lit(1)).join(F.broadcast(flag), "_j")
                 .where(F.col("_n") == 0).drop("_j", "_n"))
    if path is not None:
        to_insert.write.mode("append").parquet(path)
    return to_insert


def audit_ledger(recorded: DataFrame, manifest: DataFrame, key: str = "version",
                 name: str = "filename", checksum: str = "checksum") -> DataFrame:
    """J7 (re-aimed to a source-file ledger): classify every version of the
    recorded ledger against the current manifest.

    ``non_contiguous``: a recorded version although an earlier one of the manifest is
    not recorded. The first such gap is one aggregate, so no ordering of the
    whole manifest is needed."""
    r = recorded.select(F.col(key).alias("_k"), F.col(name).alias("_rn"), F.col(checksum).alias("_rc"),
                        F.lit(True).alias("_recorded"))
    m = manifest.select(F.col(key).alias("_k"), F.col(name).alias("_mn"), F.col(checksum).alias("_mc"),
                        F.lit(True).alias("_listed"))
    j = r.join(m, "_k", "full_outer").withColumn("_j", F.lit(1))
    gap = j.where(F.col("_recorded").isNull()).agg(F.min("_k").alias("_gap")).withColumn("_j", F.lit(1))
    j = j.join(F.broadcast(gap), "_j")  # one row
    status = (F.when(F.col("_listed").isNull(), F.lit("unknown_version"))
              .when(F.col("_recorded").isNull(), F.lit("not_applied"))
              .when(~F.col("_rn").eqNullSafe(F.col("_mn")), F.lit("filename_mismatch"))
              .when(~F.col("_rc").eqNullSafe(F.col("_mc")), F.lit("checksum_mismatch"))
              .when(F.col("_k") > F.col("_gap"), F.lit("non_contiguous"))
              .otherwise(F.lit("ok")))
    return j.select(F.col("_k").alias(key), status.alias("status"))
