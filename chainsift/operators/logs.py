"""Row-level operators on raw logs."""

from __future__ import annotations

from pyspark.sql import DataFrame

LOG_KEY = ["block_number", "tx_hash", "log_index"]


def dedupe_logs(logs: DataFrame) -> DataFrame:
    """Keep one row per log key (re-read ranges must not duplicate rows).

    The key is near-unique, so the shuffle spreads evenly even when one block
    or one contract dominates.
    """
    return logs.dropDuplicates(LOG_KEY)
