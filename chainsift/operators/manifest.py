"""Coverage-journal (manifest) operators: planning, per-chunk counters, run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranges import FROM, TO

# Upper bound on chunk rows shipped to every executor for the log -> chunk join.
BROADCAST_CHUNKS_MAX = 2_000_000


def latest_status(manifest: DataFrame) -> DataFrame:
    """Last record per exact ``(from_block, to_block)`` key (by ``updated_at``)."""
    return manifest.groupBy(FROM, TO).agg(F.max_by("status", "updated_at").alias("status"))


def pending_chunks(chunks: DataFrame, manifest: DataFrame, rerun_failed: bool = False) -> DataFrame:
    """Raw-fetch planning: grid chunks minus those whose latest record is ``done``
    (always) or ``failed`` (unless ``rerun_failed``)."""
    skip = ["done"] if rerun_failed else ["done", "failed"]
    done = latest_status(manifest).where(F.col("status").isin(skip)).select(FROM, TO)
    return chunks.join(done, [FROM, TO], "left_anti")


def assign_chunks(logs: DataFrame, chunks: DataFrame, bucket: int, n_chunks: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Attach ``chunk_from, chunk_to`` (and the chunk's ``carry`` columns) to each log whose block lies in a chunk (range join).

    Chunks are disjoint intervals no longer than ``bucket`` blocks.  Each chunk is
    listed under the (at most two) buckets ``floor(block / bucket)`` it touches, so
    the range join becomes an equi-join on the bucket plus a range predicate.  The
    chunk table is broadcast only when its row count is known to be small;
    otherwise both sides shuffle on the bucket.
    """
    c = chunks.select(F.col(FROM).alias("chunk_from"), F.col(TO).alias("chunk_to"), *carry)
    c = c.withColumn(
        "_bk",
        F.explode(F.sequence(F.floor(F.col("chunk_from") / bucket), F.floor(F.col("chunk_to") / bucket))),
    )
    n = n_chunks if n_chunks is not None else chunks.count()
    side = F.broadcast(c) if n <= BROADCAST_CHUNKS_MAX else c
    lg = logs.withColumn("_bk", F.floor(F.col("block_number") / bucket))
    cond = (lg["_bk"] == side["_bk"]) & (lg["block_number"] >= side["chunk_from"]) & (lg["block_number"] <= side["chunk_to"])
    return lg.join(side, cond, "inner").drop("_bk")


def chunk_stats(classified: DataFrame, chunks: DataFrame, bucket: int, n_chunks: int | None = None) -> DataFrame:
    """Per chunk: logs, decoded, filtered (incl. zero rows for empty chunks)."""
    j = assign_chunks(classified, chunks, bucket, n_chunks)
    agg = j.groupBy("chunk_from", "chunk_to").agg(
        F.count(F.lit(1)).alias("logs"),
        F.count_if(F.col("filter_reason").isNull()).alias("decoded"),
        F.count_if(F.col("filter_reason").isNotNull()).alias("filtered"),
    )
    base = chunks.select(F.col(FROM).alias("chunk_from"), F.col(TO).alias("chunk_to"))
    out = base.join(agg, ["chunk_from", "chunk_to"], "left")
    return out.select(
        F.col("chunk_from").alias(FROM),
        F.col("chunk_to").alias(TO),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("logs", "decoded", "filtered")],
    )


def run_stats(manifest: DataFrame) -> DataFrame:
    """Run totals: ok / failed ranges, executed ranges and summed counters of done ranges."""
    done = F.col("status") == "done"
    return manifest.agg(
        F.count_if(done).alias("processed_ok"),
        F.count_if(F.col("status") == "failed").alias("processed_failed"),
        F.count_if(F.col("status").isin("done", "failed")).alias("executed_subranges"),
        F.coalesce(F.sum(F.when(done, F.col("logs"))), F.lit(0)).cast("long").alias("total_logs"),
        F.coalesce(F.sum(F.when(done, F.col("decoded"))), F.lit(0)).cast("long").alias("total_decoded"),
        F.coalesce(F.sum(F.when(done, F.col("filtered"))), F.lit(0)).cast("long").alias("total_filtered"),
        F.coalesce(F.sum(F.when(done, F.col("shards"))), F.lit(0)).cast("long").alias("shards_written"),
    )


def raw_fetch_summary(manifest: DataFrame) -> DataFrame:
    """Per latest status of each chunk: chunk count and logs."""
    last = manifest.groupBy(FROM, TO).agg(
        F.max_by("status", "updated_at").alias("status"), F.max_by("logs", "updated_at").alias("logs")
    )
    return last.groupBy("status").agg(F.count(F.lit(1)).alias("chunks"), F.sum("logs").cast("long").alias("logs"))


def done_intervals(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") == "done").select(FROM, TO)
