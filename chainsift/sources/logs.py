"""Raw-log sources: the Parquet/JSON log lake and JSON-RPC style log dumps.

``read_logs`` is the range scan of the reference's node client re-expressed over
a lake: address, topic0 list and the inclusive block range become top-level
predicates that Parquet receives as pushed filters (row groups / files pruned by
min-max statistics, since the lake is clustered by block number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..schema import RAW_LOGS


def normalize_topics(topics: Column) -> Column:
    """Lower-case topics and drop empty entries."""
    return F.filter(F.transform(topics, lambda t: F.lower(t)), lambda t: t.isNotNull() & (t != ""))


def read_logs(
    spark: SparkSession,
    path: str,
    address: str | None = None,
    topic0s: list[str] | None = None,
    from_block: int | None = None,
    to_block: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Logs of one contract whose ``topic0`` is in ``topic0s`` within ``[from_block, to_block]``."""
    df = spark.read.format(fmt).schema(RAW_LOGS).load(path) if fmt != "parquet" else spark.read.parquet(path)
    cond = F.lit(True)
    if address is not None:
        cond = cond & (F.col("address") == address.lower())
    if topic0s:
        cond = cond & F.col("topic0").isin([t.lower() for t in topic0s if t])
    if from_block is not None:
        cond = cond & (F.col("block_number") >= from_block)
    if to_block is not None:
        cond = cond & (F.col("block_number") <= to_block)
    return df.where(cond)


def resolve_range(logs: DataFrame, start, end) -> DataFrame:
    """One row ``(start_block, end_block)``: 'earliest'/'genesis' -> 0, 'latest' -> head
    (max block of the lake), numeric strings accepted; ``start > end`` raises."""

    def lit_of(v):
        if isinstance(v, int):
            return F.lit(v).cast("long"), v
        s = str(v).strip().lower()
        if s in ("earliest", "genesis"):
            return F.lit(0).cast("long"), 0
        if s == "latest":
            return F.col("head"), None
        return F.lit(int(s, 0)).cast("long"), int(s, 0)

    (a, av), (b, bv) = lit_of(start), lit_of(end)
    if av is not None and bv is not None and av > bv:
        raise ValueError(f"start {av} > end {bv}")
    head = logs.agg(F.max("block_number").alias("head"))
    # the check is part of a returned column, so pruning cannot drop it
    checked = F.when(a > b, F.raise_error(F.lit("start > end")).cast("long")).otherwise(a)
    return head.select(checked.alias("start_block"), b.alias("end_block"))


RPC_LOG = StructType(
    [
        StructField("address", StringType()),
        StructField("topics", ArrayType(StringType())),
        StructField("data", StringType()),
        StructField("blockNumber", StringType()),
        StructField("logIndex", StringType()),
        StructField("transactionHash", StringType()),
        StructField("transaction_hash", StringType()),
        StructField("blockTimestamp", StringType()),
        StructField("removed", StringType()),
    ]
)


def hex_or_int(c: Column) -> Column:
    """'0x..' hex text or a decimal number -> long (null stays null)."""
    s = F.lower(F.trim(c))
    digits = F.regexp_replace(F.substring(s, F.lit(3), F.length(s)), "^0+(?=.)", "")
    number = F.when(F.length(digits) <= 16, F.conv(digits, 16, 10).cast("long"))  # longer ones fit no block number
    return F.when(s.startswith("0x"), number).otherwise(s.cast("long"))


def normalize_raw(rpc: DataFrame) -> DataFrame:
    """JSON-RPC log objects -> ``raw_logs`` rows.

    lower-case address / topics / tx hash; hex block number and log index; block
    timestamp as hex, decimal or absent; missing/empty data -> ``0x``; tx hash key
    ``transactionHash`` else ``transaction_hash`` else ''.  Reorged logs
    (``removed = true``) are dropped.
    """
    df = rpc
    if "removed" in df.columns:
        df = df.where(F.coalesce(F.lower(F.col("removed").cast("string")), F.lit("false")) != "true")
    topics = normalize_topics(F.coalesce(F.col("topics"), F.array().cast("array<string>")))
    data = F.lower(F.col("data"))
    data = F.when(data.isNull() | (data == ""), F.lit("0x")).otherwise(data)
    tx = F.lower(F.coalesce(F.col("transactionHash"), F.col("transaction_hash"), F.lit("")))
    out = df.select(
        F.lower(F.col("address")).alias("address"),
        F.get(topics, 0).alias("topic0"),
        topics.alias("topics"),
        data.alias("data"),
        hex_or_int(F.col("blockNumber")).alias("block_number"),
        hex_or_int(F.col("blockTimestamp")).alias("block_timestamp"),
        tx.alias("tx_hash"),
        hex_or_int(F.col("logIndex")).alias("log_index"),
    )
    return out


def read_rpc_json(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON dump of JSON-RPC log objects (all scalar fields read as text)."""
    return spark.read.schema(RPC_LOG).option("primitivesAsString", "true").json(path)
