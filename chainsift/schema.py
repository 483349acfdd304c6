"""Table schemas of the engine and validation of registry-derived column names."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

RAW_LOGS = StructType(
    [
        StructField("address", StringType()),
        StructField("topic0", StringType()),
        StructField("topics", ArrayType(StringType())),
        StructField("data", StringType()),
        StructField("block_number", LongType()),
        StructField("block_timestamp", LongType()),
        StructField("tx_hash", StringType()),
        StructField("log_index", LongType()),
    ]
)

# Base columns of a decoded table, in output order; dynamic columns follow sorted by name.
BASE_COLUMNS = ["block_number", "block_timestamp", "tx_hash", "log_index", "contract", "event"]

# Sort order of rows inside written files: tx_hash sorts before log_index.
ROW_ORDER = ["block_number", "tx_hash", "log_index"]

MANIFEST = StructType(
    [
        StructField("run_id", StringType()),
        StructField("from_block", LongType()),
        StructField("to_block", LongType()),
        StructField("status", StringType()),
        StructField("attempts", IntegerType()),
        StructField("error", StringType()),
        StructField("logs", LongType()),
        StructField("decoded", LongType()),
        StructField("shards", LongType()),
        StructField("updated_at", DoubleType()),
        StructField("filtered", LongType()),
        StructField("shards_written", MapType(StringType(), LongType())),
        StructField("rows_per_event", MapType(StringType(), LongType())),
    ]
)

MANIFEST_STATUSES = ("started", "done", "failed")


def validate_dynamic_names(names: list[str]) -> None:
    """Reject output names that would collide in a Spark table."""
    seen: dict[str, str] = {}
    for n in names:
        if not n:
            raise ValueError("empty output column name (unnamed ABI input?)")
        if n in BASE_COLUMNS or n.lower() in BASE_COLUMNS:
            raise ValueError(f"output column {n!r} collides with a base column")
        k = n.lower()
        if k in seen and seen[k] != n:
            raise ValueError(f"output columns {seen[k]!r} and {n!r} differ only by case")
        seen[k] = n
