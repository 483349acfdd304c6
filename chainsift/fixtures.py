"""Raw-log fixtures encoded from the driver's tables by Spark expressions.

The test data has no EVM logs, so each fixture ABI-encodes rows of a given
table into the ``raw_logs`` schema.  The encoding is a projection of the source
table (no driver-side data), so it scales with the table; an oracle can state
the expected decoded values straight from the source columns.

The lake wants its logs ordered by block and log index: ``arrange(rows, block[, log])`` does that to the narrow source rows,
before they are encoded to many times their size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import registry as R
from .session import ensure_engine_conf

# Fixture contract addresses, chosen by ``key % 3``.
ADDRESSES = [
    "0xd8da6bf26964af9d7eed9e03e53415d37aa96045",
    "0xb2cc224c1c9fee385f8ad6a55b4d94e92359dc59",
    "0x88e6a0c2ddd26feeb64f039a2c41296fcb3f5640",
]
UNKNOWN_T0 = "0x" + "ab" * 32


def _digits(x: Column) -> Column:
    """A long's 16 lower-case hex digits, two's complement."""
    return F.lpad(F.lower(F.hex(x)), 16, "0")


def w(x: Column) -> Column:
    """One 32-byte word, two's complement, 64 lower-case hex digits."""
    x = x.cast("long")
    return F.concat(F.when(x < 0, F.lit("f" * 48)).otherwise(F.lit("0" * 48)), _digits(x))


def wide(hi: Column, lo: Column) -> Column:
    """Word holding ``hi * 2^64 + lo`` (both non-negative)."""
    return F.concat(F.lit("0" * 32), _digits(hi.cast("long")), _digits(lo.cast("long")))


def tw(x: Column) -> Column:
    return F.concat(F.lit("0x"), w(x))


def address_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(a) for a in ADDRESSES]), (key % 3).cast("int") + 1)


def epoch_seconds(ts: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def tx_of(key: Column) -> Column:
    return F.concat(F.lit("0x"), F.sha2(key.cast("string"), 256))


Arrange = Callable[..., DataFrame]


def _as_read(df: DataFrame, *order: Column) -> DataFrame:
    return df


def _raw(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        *extra,
        "address",
        F.get(F.col("topics"), 0).alias("topic0"),
        "topics",
        "data",
        F.col("block_number").cast("long").alias("block_number"),
        F.col("block_timestamp").cast("long").alias("block_timestamp"),
        "tx_hash",
        F.col("log_index").cast("long").alias("log_index"),
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_engine_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_logs_events(spark: SparkSession, sf_dir: str, keep_id: bool = False, arrange: Arrange = _as_read) -> DataFrame:
    """Fixture A: clpool Mint/Burn, nfpm IncreaseLiquidity, gauge Deposit and one kind per filter rule."""
    ev = _table(spark, sf_dir, "events")
    eid, uid = F.col("event_id"), F.col("user_id")
    c = F.round(F.col("value") * 100).cast("long")
    z = F.when(eid % 7 == 0, F.lit(0)).otherwise(F.lit(1)).cast("long")
    kind = (
        F.when(F.col("event_type") == "purchase", "Mint")
        .when(F.col("event_type") == "click", "Burn")
        .when(F.col("event_type") == "view", "IncreaseLiquidity")
        .when(F.col("event_type") == "signup", "Deposit")
        .otherwise(F.element_at(F.array(*[F.lit(k) for k in ("unknown", "none", "missing", "short")]), (eid % 4).cast("int") + 1))
    )
    block, log = F.lit(1000000) + F.floor(eid / 10), eid % 10
    ev = arrange(ev.select("event_id", "user_id", "ts", "event_type", "value"), block, log)
    df = ev.select("event_id", "user_id", "ts", kind.alias("kind"), c.alias("c"), z.alias("z"))
    k, c, z = F.col("kind"), F.col("c"), F.col("z")
    t0 = (
        F.when(k.isin("Mint", "missing"), F.lit(R.MINT_T0))
        .when(k.isin("Burn", "short"), F.lit(R.BURN_T0))
        .when(k == "IncreaseLiquidity", F.lit(R.INCREASE_LIQUIDITY_T0))
        .when(k == "Deposit", F.lit(R.DEPOSIT_T0))
    )
    tp = (
        F.when(k == "none", F.array().cast("array<string>"))
        .when(k == "unknown", F.array(F.lit(UNKNOWN_T0)))
        .when(k == "missing", F.array(t0, tw(uid)))
        .when(k == "IncreaseLiquidity", F.array(t0, tw(eid)))
        .when(k == "Deposit", F.array(t0, tw(uid), tw(eid), tw(c)))
        .otherwise(F.array(t0, tw(uid), tw(-(eid % 100)), tw(eid % 100)))
    )
    dt = (
        F.when(k.isin("Mint", "missing"), F.concat(w(uid + 1), w(eid * z), w(c * z), wide((eid + 1) * z, c * z)))
        .when(k.isin("Burn", "IncreaseLiquidity"), F.concat(w(eid * z), w(c * z), w(z)))
        .when(k == "short", w(eid))
        .otherwise(F.lit(""))
    )
    out = df.select(
        address_of(uid).alias("address"),
        tp.alias("topics"),
        F.concat(F.lit("0x"), dt).alias("data"),
        block.alias("block_number"),
        epoch_seconds(F.col("ts")).alias("block_timestamp"),
        tx_of(eid).alias("tx_hash"),
        log.alias("log_index"),
        eid.alias("event_id"),
    )
    return _raw(out, "event_id") if keep_id else _raw(out)


def swap_price(li: DataFrame) -> Column:
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
    return F.round(F.col("l_extendedprice") * 100).cast("long") * sign


def raw_logs_lineitem(spark: SparkSession, sf_dir: str, arrange: Arrange = _as_read) -> DataFrame:
    """Fixture B: one Swap log per lineitem row (signed words; the benchmark input)."""
    li = _table(spark, sf_dir, "lineitem")
    p = swap_price(li)
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    li = arrange(li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_returnflag", "l_extendedprice"), ok, ln)
    out = li.select(
        F.lit(ADDRESSES[1]).alias("address"),
        F.array(F.lit(R.SWAP_T0), tw(F.col("l_suppkey")), tw(F.col("l_partkey"))).alias("topics"),
        F.concat(F.lit("0x"), w(p), w(-p), wide(ok + 1, ln), w(F.col("l_partkey")), w(ln - 4)).alias("data"),
        ok.alias("block_number"),
        epoch_seconds(F.col("l_shipdate")).alias("block_timestamp"),
        tx_of(ok).alias("tx_hash"),
        ln.alias("log_index"),
    )
    return _raw(out)


def raw_logs_orders(spark: SparkSession, sf_dir: str, arrange: Arrange = _as_read) -> DataFrame:
    """Fixture C/gauge: F -> Deposit, O -> Withdraw, P -> ClaimRewards."""
    o = _table(spark, sf_dir, "orders")
    st, key, cust = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    t0 = F.when(st == "F", F.lit(R.DEPOSIT_T0)).when(st == "O", F.lit(R.WITHDRAW_T0)).otherwise(F.lit(R.CLAIM_REWARDS_T0))
    topics = F.when(st == "P", F.array(t0, tw(cust))).otherwise(F.array(t0, tw(cust), tw(key), tw(cents)))
    data = F.when(st == "P", F.concat(F.lit("0x"), w(cents))).otherwise(F.lit("0x"))
    o = arrange(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice"), key)
    out = o.select(
        address_of(cust).alias("address"),
        topics.alias("topics"),
        data.alias("data"),
        key.alias("block_number"),
        epoch_seconds(F.col("o_orderdate")).alias("block_timestamp"),
        tx_of(key).alias("tx_hash"),
        F.lit(0).alias("log_index"),
    )
    return _raw(out)


def raw_logs_customer(spark: SparkSession, sf_dir: str, arrange: Arrange = _as_read) -> DataFrame:
    """Fixture C/vfat: one Deploy per customer."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    c = arrange(c.select("c_custkey", "c_nationkey"), key)
    out = c.select(
        address_of(key).alias("address"),
        F.array(F.lit(R.DEPLOY_T0), tw(key)).alias("topics"),
        F.concat(F.lit("0x"), w(F.col("c_nationkey"))).alias("data"),
        key.alias("block_number"),
        F.lit(None).cast("long").alias("block_timestamp"),
        tx_of(key).alias("tx_hash"),
        F.lit(1).alias("log_index"),
    )
    return _raw(out)


def raw_logs_part(spark: SparkSession, sf_dir: str, arrange: Arrange = _as_read) -> DataFrame:
    """Fixture C/nfpm: ``p_size % 3`` = 0 Collect, 1 DecreaseLiquidity, 2 Transfer."""
    p = _table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    m = size % 3
    topics = (
        F.when(m == 0, F.array(F.lit(R.NFPM_COLLECT_T0), tw(key)))
        .when(m == 1, F.array(F.lit(R.DECREASE_LIQUIDITY_T0), tw(key)))
        .otherwise(F.array(F.lit(R.TRANSFER_T0), tw(size), tw(key), tw(key)))
    )
    data = F.when(m == 2, F.lit("")).otherwise(F.concat(w(size), w(key), w(cents)))
    p = arrange(p.select("p_partkey", "p_size", "p_retailprice"), F.lit(5000000) + key, size)
    out = p.select(
        address_of(key).alias("address"),
        topics.alias("topics"),
        F.concat(F.lit("0x"), data).alias("data"),
        (F.lit(5000000) + key).alias("block_number"),
        (F.lit(1700000000) + key * 12).alias("block_timestamp"),
        tx_of(key).alias("tx_hash"),
        size.alias("log_index"),
    )
    return _raw(out)


def manifest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage journal encoded from orders: status F -> done, O -> failed, P -> started."""
    o = _table(spark, sf_dir, "orders")
    key, cust, st = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    frm = (key % 5000) * 100
    filtered = key % 5
    return o.select(
        F.concat(F.lit("r"), (key % 4).cast("string")).alias("run_id"),
        frm.cast("long").alias("from_block"),
        (frm + cust % 150).cast("long").alias("to_block"),
        F.when(st == "F", "done").when(st == "O", "failed").otherwise("started").alias("status"),
        F.lit(1).cast("int").alias("attempts"),
        F.when(st == "O", F.lit("timeout")).alias("error"),
        cust.cast("long").alias("logs"),
        (cust - filtered).cast("long").alias("decoded"),
        F.lit(0).cast("long").alias("shards"),
        (F.lit(1.7e9) + key.cast("double")).alias("updated_at"),
        filtered.cast("long").alias("filtered"),
        key.alias("seq"),
    )


def manifest_lines(manifest: DataFrame) -> DataFrame:
    """JSON lines of a journal; records whose ``seq % 97 = 0`` are written corrupt."""
    body = F.to_json(F.struct(*[c for c in manifest.columns if c not in ("seq",)]))
    line = F.when(F.col("seq") % 97 == 0, F.lit('{"bad')).otherwise(body)
    return manifest.select("run_id", "seq", line.alias("value"))


def raw_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A as JSON-RPC log objects (one JSON text per row).

    hex ``blockNumber``/``logIndex``; ``blockTimestamp`` hex / decimal / absent by
    ``event_id % 3``; upper-case address; ``transaction_hash`` spelling when
    ``event_id % 5 = 0``.
    """
    a = raw_logs_events(spark, sf_dir, keep_id=True)
    eid = F.col("event_id")
    hx = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    base = F.to_json(
        F.struct(
            F.upper("address").alias("address"),
            F.col("topics").alias("topics"),
            F.col("data").alias("data"),
            hx(F.col("block_number")).alias("blockNumber"),
            hx(F.col("log_index")).alias("logIndex"),
            F.when(eid % 5 != 0, F.col("tx_hash")).alias("transactionHash"),
            F.when(eid % 5 == 0, F.col("tx_hash")).alias("transaction_hash"),
        )
    )
    ts = (
        F.when(eid % 3 == 0, F.concat(F.lit('"'), hx(F.col("block_timestamp")), F.lit('"')))
        .when(eid % 3 == 1, F.col("block_timestamp").cast("string"))
    )
    text = F.when(ts.isNull(), base).otherwise(
        F.concat(F.regexp_replace(base, "}$", ""), F.lit(',"blockTimestamp":'), ts, F.lit("}"))
    )
    return a.select(text.alias("value"))
