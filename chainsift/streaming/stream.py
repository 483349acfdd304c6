"""Structured Streaming decode: new raw-log files (or node blocks) -> decoded tables + batch records.

``decode`` is stateless, so the batch operator applies to each micro-batch as is.
``foreachBatch`` reads every micro-batch once and lands it idempotently: its rows, sorted, go to
``batch_id=<n>`` with dynamic partition overwrite (a replayed batch replaces its
own output), malformed logs go to ``quarantine``, and ``batches`` has one record of counters per
micro-batch.  No block coverage is journalled: files may hold any blocks, and the stream's own
checkpoint is what says which files are done.
``trigger(availableNow=True)`` turns the stream into an incremental catch-up job:
each run processes exactly the files/blocks that arrived since the last one
(tracked in the checkpoint), which is the reference's "from coverage to latest".
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decode as D
from ..registry import Registry
from ..schema import RAW_LOGS, ROW_ORDER
from ..session import scratch_path
from ..sinks.snapshots import delete


def _replace(rows: DataFrame, key: str, fmt: str, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).format(fmt).save(path)


def _land(registry: Registry, out_dir: str, semantics: str):
    data_path = os.path.join(out_dir, "data")

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # the micro-batch is read once; what is told of it comes from the staged columns
        raw = F.when(F.col("filter_reason").isin(*D.ERROR_REASONS), F.struct(*batch.columns))
        stage = scratch_path(spark, "batch")
        D.decode(batch, registry, semantics, tags={"raw": raw}).write.parquet(stage)
        staged = spark.read.parquet(stage)
        kept = F.col("filter_reason").isNull()
        decoded = staged.where(kept).drop("filter_reason", "raw").withColumn("batch_id", F.lit(batch_id))
        _replace(decoded.repartitionByRange(*ROW_ORDER).sortWithinPartitions(*ROW_ORDER), "batch_id", "parquet", data_path)
        rejected = staged.where(F.col("raw").isNotNull()).select("raw.*", "filter_reason").withColumn("batch_id", F.lit(batch_id))
        _replace(rejected, "batch_id", "parquet", os.path.join(out_dir, "quarantine"))
        stats = staged.agg(
            F.min("block_number").alias("min_block"),
            F.max("block_number").alias("max_block"),
            F.count(F.lit(1)).alias("logs"),
            F.count_if(kept).alias("decoded"),
            F.count_if(~kept).alias("filtered"),
        ).where(F.col("logs") > 0)
        _replace(stats.withColumn("batch_id", F.lit(batch_id)), "batch_id", "json", os.path.join(out_dir, "batches"))
        delete(spark, stage)

    return land


def stream_decode_files(
    spark: SparkSession, source_dir: str, registry: Registry, out_dir: str, checkpoint: str,
    semantics: str = "reference", max_files_per_trigger: int | None = None,
) -> str:
    """Catch up on all raw-log Parquet files under ``source_dir`` (availableNow)."""
    reader = spark.readStream.schema(RAW_LOGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    q = (
        stream.writeStream.foreachBatch(_land(registry, out_dir, semantics))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return os.path.join(out_dir, "data")


def stream_decode_source(
    spark: SparkSession, stream: DataFrame, registry: Registry, out_dir: str, checkpoint: str,
    semantics: str = "reference",
) -> str:
    """Same landing for any streaming raw-log DataFrame (e.g. the ``evm_logs`` source)."""
    q = (
        stream.writeStream.foreachBatch(_land(registry, out_dir, semantics))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return os.path.join(out_dir, "data")
