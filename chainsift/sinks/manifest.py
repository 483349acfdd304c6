"""Coverage journal writes: one JSON-lines record per chunk, appended after the data commit."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MANIFEST


def manifest_records(stats: DataFrame, run_id: str, status: str = "done", attempts: int = 1,
                     rows_per_event: DataFrame | None = None, extra: tuple[str, ...] = (), **columns: Column) -> DataFrame:
    """Manifest rows from per-chunk counters (``from_block, to_block, logs, decoded, filtered``, and what else of the
    journal's columns they have); ``extra`` names further ``columns`` that follow."""
    df = stats.withColumns(columns) if columns else stats
    if rows_per_event is not None:
        df = df.join(rows_per_event, ["from_block", "to_block"], "left")
    elif "rows_per_event" not in df.columns:
        df = df.withColumn("rows_per_event", F.lit(None).cast("map<string,bigint>"))
    if "shards" not in df.columns:
        df = df.withColumn("shards", F.lit(0).cast("long"))
    if "shards_written" not in df.columns:
        df = df.withColumn("shards_written", F.lit(None).cast("map<string,bigint>"))
    df = df.select(
        F.lit(run_id).alias("run_id"),
        F.col("from_block").cast("long"),
        F.col("to_block").cast("long"),
        F.lit(status).alias("status"),
        (F.col("attempts") if "attempts" in df.columns else F.lit(attempts)).cast("int").alias("attempts"),
        (F.col("error") if "error" in df.columns else F.lit(None)).cast("string").alias("error"),
        F.col("logs").cast("long"),
        F.col("decoded").cast("long"),
        F.col("shards").cast("long"),
        F.lit(time.time()).alias("updated_at"),
        F.col("filtered").cast("long"),
        F.col("shards_written"),
        F.col("rows_per_event"),
        *extra,
    )
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MANIFEST.fields], *extra)


def append_manifest(records: DataFrame, path: str) -> str:
    """Append records as JSON lines (``.json`` part files under ``path``), as many files as the records come in."""
    records.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path
