"""Continuous ingestion of governed CSV files.

New files under a contract directory are picked up by the streaming
``binaryFile`` source; every micro-batch runs the same batch operators
(listing -> parse -> validate -> canonicalise -> quality -> verdict) through
``foreachBatch``.  A file is always wholly inside one micro-batch, so file
atomicity holds.  Results are partitioned by epoch and a replayed epoch replaces
its own partitions; the checkpoint lies beside them, so a restart goes on where
the last run stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.contracts import Contract, ContractRegistry
from sluice.operators.skew import spread_join
from sluice.plans.ingest import ingest_files, verdicts_for
from sluice.sources.files import files_from_binary


def ingest_stream(spark: SparkSession, root: str, contract: Contract, sink: str,
                  checkpoint: str | None = None, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery`` (await or stop it)."""
    root = root.rstrip("/")
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = (spark.readStream.format("binaryFile").schema(schema)
              .option("pathGlobFilter", "*.csv")
              .load(f"{root}/{contract.directory}"))
    registry = ContractRegistry.of(contract)
    ckpt = checkpoint or f"{sink.rstrip('/')}/_checkpoint/{contract.contract_id}-{contract.version}"

    def replace_epoch(frame: DataFrame, epoch_id: int, name: str) -> None:
        (frame.withColumn("epoch_id", F.lit(epoch_id)).write.mode("overwrite").partitionBy("epoch_id")
         .option("partitionOverwriteMode", "dynamic").parquet(f"{sink}/{name}"))

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        files = files_from_binary(batch, root, registry)
        ing = ingest_files(spark, root, contract, registry, run_id=f"stream-{epoch_id}", files=files)
        verdicts = verdicts_for(ing).drop("stages")
        replace_epoch(verdicts, epoch_id, "verdicts")
        # Only files that SUCCEEDED publish their canonical records.
        published = verdicts.where(F.col("state") == "SUCCEEDED").select("source_id")
        replace_epoch(spread_join(ing.records, published, "source_id", "left_semi"), epoch_id, "records")
        ing.release()

    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
