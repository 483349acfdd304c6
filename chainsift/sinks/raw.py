"""Raw (undecoded) log dumps, one directory per chunk that has logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.manifest import assign_chunks


def write_raw_dump(logs: DataFrame, chunks: DataFrame, path: str, bucket: int, fmt: str = "parquet",
                   n_chunks: int | None = None) -> str:
    """Write ``logs`` under ``chunk_from=<start>/`` of the chunk holding each log.

    Only non-empty chunks get a directory.  ``fmt="json"`` writes NDJSON (one log
    object per line), ``"parquet"`` zstd Parquet.
    """
    j = assign_chunks(logs, chunks, bucket, n_chunks).drop("chunk_to")
    w = j.repartitionByRange("chunk_from", "block_number").sortWithinPartitions("chunk_from", "block_number", "log_index")
    # a chunk that is fetched again replaces its own directory
    w = w.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_from")
    if fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.option("compression", "zstd").parquet(path)
    else:
        raise ValueError("fmt must be 'parquet' or 'json'")
    return path
