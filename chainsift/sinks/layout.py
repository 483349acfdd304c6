"""Dataset keys of the logs of an address, and the folders and run names made of them."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint_of(topic0s: Column) -> Column:
    """Order-insensitive fingerprint of an array of topic0: distinct and sort the full
    lower-case topics, cut each to 10 characters, join with 'x'; none -> 'none'."""
    t = F.array_sort(F.array_distinct(F.filter(F.transform(topic0s, lambda x: F.lower(x)), lambda x: x.isNotNull() & (x != ""))))
    fp = F.array_join(F.transform(t, lambda x: F.substring(x, 1, 10)), "x")
    return F.when(F.size(t) == 0, F.lit("none")).otherwise(fp)


def topics_fingerprint(logs: DataFrame) -> DataFrame:
    """Per address: fingerprint of the topic0 set it emitted (distinct first, then a small set per address)."""
    pairs = logs.select(F.lower("address").alias("address"), F.lower("topic0").alias("t0")).distinct()
    return pairs.groupBy("address").agg(fingerprint_of(F.collect_list("t0")).alias("fingerprint"))


# Fixed values of the key's text: the infix below, "none" for no topics, ten characters per topic joined by "x".


def dataset_keys(logs: DataFrame) -> DataFrame:
    fp = topics_fingerprint(logs)
    return fp.select("address", F.concat(F.col("address"), F.lit("__topics-"), F.col("fingerprint")).alias("dataset_key"))


def dataset_folder(root: str, address: str | None, topic0s: list[str], layout: str = "legacy", protocol: str | None = None, contract: str | None = None) -> str:
    """Where a job's dataset lies: ``<address>__topics-<fingerprint>``, or ``<protocol>/<contract>`` for the layout
    ``per_event`` if both names are given (else the former, without a word)."""
    if layout not in ("legacy", "per_event"):
        raise ValueError("layout must be 'legacy' or 'per_event'")
    if layout == "per_event" and protocol and contract:
        return f"{root}/{protocol}/{contract}"
    topics = sorted({t.lower() for t in topic0s if t})
    return f"{root}/{(address or 'any').lower()}__topics-{'x'.join(t[:10] for t in topics) or 'none'}"


def run_name(start: int, end: int) -> str:
    """Name of an attempt: when it began (UTC), what it covers, and what tells it from others of the same second."""
    return f"run_{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}_{start}_{end}_{uuid.uuid4().hex[:8]}"
