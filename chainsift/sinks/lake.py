"""Landing raw logs as a Parquet lake clustered by block number."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame

ROWS_PER_FILE, LEAST_ROWS = 500_000, 20_000


def clustered(rows: DataFrame, block: Column, *log: Column) -> DataFrame:
    """``rows`` in ranges of ``block``, sorted by block and log index (where it varies): to be encoded into raw logs, which then need no exchange.

    As many ranges as the rows need, so a range stays the same size at any size of the table (small tables: a range per core)."""
    n = rows.count()  # from the files' footers
    parts = max(math.ceil(n / ROWS_PER_FILE), min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / LEAST_ROWS)), 1)
    return rows.repartitionByRange(parts, block).sortWithinPartitions(block, *log)


def write_clustered(raw: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Raw logs of ``clustered`` rows, as they come."""
    raw.write.mode(mode).option("compression", "zstd").parquet(path)
    return path


def write_lake(raw: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite") -> str:
    """Range-partition by ``block_number`` and sort inside files, so block-range
    predicates prune whole files / row groups through Parquet min-max stats."""
    parts = [partitions] if partitions else []
    (
        raw.repartitionByRange(*parts, "block_number")
        .sortWithinPartitions("block_number", "log_index")
        .write.mode(mode)
        .option("compression", "zstd")
        .parquet(path)
    )
    return path
