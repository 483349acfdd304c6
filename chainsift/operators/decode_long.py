"""Registry as a join instead of compiled expressions -- for very large registries.

``decode`` compiles the registry into CASE expressions, which is the fastest
form for tens of events.  With hundreds of events (e.g. every ABI of a
protocol), the registry is better treated as data: its fields become a small
table ``(place, event, field, slot, const)`` joined to the logs
on the event's place.  The table has one row per projected field, so its size is known
on the driver; it is broadcast below ``BROADCAST_FIELDS_MAX`` rows and shuffled
otherwise.  Each output row is one decoded field (long form); a log's values are computed
once, as in ``decode``, one for each distinct (kind, index, type) of the registry, and its fields take theirs by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.udfs import checksum_address
from ..registry import Registry
from . import decode as D

BROADCAST_FIELDS_MAX = 200_000


def field_table(registry: Registry, semantics: str = "reference"):
    """``(event's place, event, field, place of its value among a log's values, const)`` and the values' columns."""
    conv = D.Conversions(registry, semantics)
    slots = {key: n for n, key in enumerate(conv.values)}
    rows = [(k, s.name, out, None if ref.kind in ("const", "none") else slots[D.field_key(s, ref, semantics)], ref.value if ref.kind == "const" else None)
            for k, s in enumerate(registry, 1) for out, ref in s.projection]
    return rows, conv


FIELD_SCHEMA = "place int, event string, field string, slot int, const string"


def decode_long(logs: DataFrame, registry: Registry, semantics: str = "reference") -> DataFrame:
    """``block_number, block_timestamp, tx_hash, log_index, contract, event, field, value`` (null values omitted)."""
    from ..session import ship_package

    spark = logs.sparkSession
    ship_package(spark)
    rows, conv = field_table(registry, semantics)
    fields = spark.createDataFrame(rows, FIELD_SCHEMA)
    if len(rows) <= BROADCAST_FIELDS_MAX:
        fields = F.broadcast(fields)
    # a log's values are made once, before the join makes a row of each field
    kept = conv.over(D.kept(logs, registry, semantics), ["block_number", "block_timestamp", "tx_hash", "log_index"], contract=checksum_address(F.col("address")))
    kept = kept.select(
        F.col("block_number").cast("long").alias("block_number"),
        F.coalesce(F.col("block_timestamp").cast("long"), F.lit(0).cast("long")).alias("block_timestamp"),
        "tx_hash",
        F.col("log_index").cast("long").alias("log_index"),
        "contract",
        D.EVENT,
        (F.array(*conv.values.values()) if conv.values else F.array().cast("array<string>")).alias("__values"),
    )
    value = F.coalesce("const", F.get(F.col("__values"), F.col("slot")))
    out = kept.join(fields, kept[D.EVENT] == fields["place"])
    return out.select("block_number", "block_timestamp", "tx_hash", "log_index", "contract", "event", "field", value.alias("value")).where("value is not null")
