"""DuckDB oracle SQL for the registered queries.

Each statement recomputes the expected result straight from the driver's
source tables (the fixtures' encoding rules applied in reverse), so it checks
the whole encode -> scan -> classify -> decode path.
"""

from __future__ import annotations

TWO256 = "115792089237316195423570985008687907853269984665640564039457584007913129639936"

# Fixture contract addresses and their EIP-55 forms, by key % 3.
CONTRACT = (
    "CASE ({k}) % 3 WHEN 0 THEN '0xd8dA6BF26964aF9D7eEd9e03E53415D37aA96045' "
    "WHEN 1 THEN '0xb2cc224c1c9feE385f8ad6a55b4d94E92359DC59' "
    "ELSE '0x88e6A0c2dDD26FEEb64F039a2c41296FcB3f5640' END"
)


def addr(x: str) -> str:
    return f"('0x' || lpad(lower(hex({x})), 40, '0'))"


def neg_u256(m: str) -> str:
    """Text of 2^256 - m for 0 < m (m = 0 -> '0')."""
    return f"(CASE WHEN ({m}) = 0 THEN '0' ELSE ('{TWO256}'::BIGNUM - ({m})::BIGNUM)::VARCHAR END)"


def wide(hi: str, lo: str) -> str:
    return f"(({hi})::HUGEINT * 18446744073709551616::HUGEINT + ({lo}))::VARCHAR"


A = f"""a AS (
  SELECT *,
    1000000 + event_id // 10 AS block_number,
    epoch_us(ts) // 1000000 AS block_timestamp,
    '0x' || sha256(CAST(event_id AS VARCHAR)) AS tx_hash,
    event_id % 10 AS log_index,
    {CONTRACT.format(k='user_id')} AS contract
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c,
          CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS z,
          CASE event_type WHEN 'purchase' THEN 'Mint' WHEN 'click' THEN 'Burn'
            WHEN 'view' THEN 'IncreaseLiquidity' WHEN 'signup' THEN 'Deposit'
            ELSE (['unknown', 'none', 'missing', 'short'])[event_id % 4 + 1] END AS kind
        FROM events))"""

# filter reason of every fixture-A row under the merged built-in registry (order F1..F6)
A_REASON = """CASE WHEN kind = 'none' THEN 'no_topics'
  WHEN kind = 'unknown' THEN 'unknown_topic'
  WHEN kind IN ('Mint', 'Burn', 'IncreaseLiquidity', 'missing') AND z = 0 THEN 'fast_zero'
  WHEN kind = 'missing' THEN 'missing_topic'
  WHEN kind = 'short' THEN 'short_data'
  ELSE NULL END"""

KEYS = "block_number, tx_hash, log_index"

# topic0 literals of the fixture kinds (same constants as the registries).
_T0 = {
    "Mint": "0x7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde",
    "Burn": "0x0c396cd989a39f4459b5fa1aed6a9a8dcdbc45908acfd67e028cd568da98982c",
    "IncreaseLiquidity": "0x3067048beee31b25b2f1681f88dac838c8bba36af25bfb2b7cf7473a5847e35f",
    "Deposit": "0x1c8ab8c7f45390d58f58f1d655213a82cca5d12179761a87c16f098813b8f211",
}
T0_OF_KIND = ("CASE WHEN kind IN ('Mint', 'missing') THEN '{Mint}' WHEN kind IN ('Burn', 'short') THEN '{Burn}' "
              "WHEN kind = 'IncreaseLiquidity' THEN '{IncreaseLiquidity}' WHEN kind = 'Deposit' THEN '{Deposit}' "
              "WHEN kind = 'unknown' THEN '0x" + "ab" * 32 + "' END").format(**_T0)
NTOP_OF_KIND = ("CASE kind WHEN 'none' THEN 0 WHEN 'unknown' THEN 1 WHEN 'missing' THEN 2 "
                "WHEN 'IncreaseLiquidity' THEN 2 ELSE 4 END")
ADDR_LC = ("CASE user_id % 3 WHEN 0 THEN '0xd8da6bf26964af9d7eed9e03e53415d37aa96045' "
           "WHEN 1 THEN '0xb2cc224c1c9fee385f8ad6a55b4d94e92359dc59' ELSE '0x88e6a0c2ddd26feeb64f039a2c41296fcb3f5640' END")
BASE = "block_number, block_timestamp, tx_hash, log_index, contract"


def clpool_rows() -> str:
    return f"""SELECT {BASE}, kind AS event,
  CAST(c AS VARCHAR) AS amount0,
  CASE kind WHEN 'Mint' THEN {wide('event_id + 1', 'c')} ELSE '1' END AS amount1,
  CAST(event_id AS VARCHAR) AS liquidity,
  {addr('user_id')} AS owner,
  NULL::VARCHAR AS recipient,
  CASE kind WHEN 'Mint' THEN {addr('user_id + 1')} END AS sender,
  {neg_u256('event_id % 100')} AS tick_lower,
  CAST(event_id % 100 AS VARCHAR) AS tick_upper
FROM a WHERE kind IN ('Mint', 'Burn') AND z = 1"""


def builtin_rows() -> str:
    """Fixture A under all built-in registries (clpool + gauge + vfat + nfpm)."""
    return f"""SELECT {BASE}, kind AS event,
  NULL::VARCHAR AS admin, NULL::VARCHAR AS amount,
  CASE WHEN kind = 'Deposit' THEN NULL ELSE CAST(c AS VARCHAR) END AS amount0,
  CASE kind WHEN 'Mint' THEN {wide('event_id + 1', 'c')} WHEN 'Deposit' THEN NULL ELSE '1' END AS amount1,
  NULL::VARCHAR AS "from",
  CASE WHEN kind = 'Deposit' THEN CAST(c AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS liquidity,
  CASE WHEN kind = 'IncreaseLiquidity' THEN NULL ELSE {addr('user_id')} END AS owner,
  NULL::VARCHAR AS recipient,
  CASE kind WHEN 'Mint' THEN {addr('user_id + 1')} END AS sender,
  NULL::VARCHAR AS sickle,
  CASE WHEN kind IN ('Mint', 'Burn') THEN {neg_u256('event_id % 100')} END AS tick_lower,
  CASE WHEN kind IN ('Mint', 'Burn') THEN CAST(event_id % 100 AS VARCHAR) END AS tick_upper,
  NULL::VARCHAR AS "to",
  CASE WHEN kind IN ('IncreaseLiquidity', 'Deposit') THEN CAST(event_id AS VARCHAR) END AS token_id
FROM a WHERE kind = 'Deposit' OR (kind IN ('Mint', 'Burn', 'IncreaseLiquidity') AND z = 1)"""


ORDERS = f"""o AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    o_orderkey AS block_number, epoch_us(o_orderdate) // 1000000 AS block_timestamp,
    '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS tx_hash, CAST(0 AS BIGINT) AS log_index,
    {CONTRACT.format(k='o_custkey')} AS contract,
    CASE o_orderstatus WHEN 'F' THEN 'Deposit' WHEN 'O' THEN 'Withdraw' ELSE 'ClaimRewards' END AS event
  FROM orders)"""


def gauge_rows() -> str:
    return f"""SELECT {BASE}, event,
  CASE WHEN event = 'ClaimRewards' THEN CAST(cents AS VARCHAR) END AS amount,
  CASE WHEN event <> 'ClaimRewards' THEN CAST(cents AS VARCHAR) END AS liquidity,
  {addr('o_custkey')} AS owner,
  CASE WHEN event <> 'ClaimRewards' THEN CAST(o_orderkey AS VARCHAR) END AS token_id
FROM o"""


LI = """li AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS p,
    l_linenumber - 4 AS t
  FROM lineitem)"""

ABI_A_COLS = ["amount", "amount0", "amount1", "feeProtocol0New", "feeProtocol0Old", "feeProtocol1New", "feeProtocol1Old",
              "liquidity", "observationCardinalityNextNew", "observationCardinalityNextOld", "owner", "paid0", "paid1",
              "recipient", "sender", "sqrtPriceX96", "tick", "tickLower", "tickUpper"]


def swap_rows(semantics: str) -> str:
    tick = ("CAST(t AS VARCHAR)" if semantics == "abi" else
            f"CASE WHEN t >= 0 THEN CAST(t AS VARCHAR) ELSE ('{TWO256}'::BIGNUM + t::BIGNUM - 16777216::BIGNUM)::VARCHAR END")
    vals = {
        "amount0": "CAST(p AS VARCHAR)", "amount1": "CAST(-p AS VARCHAR)", "liquidity": "CAST(l_partkey AS VARCHAR)",
        "recipient": addr("l_partkey"), "sender": addr("l_suppkey"), "sqrtPriceX96": wide("l_orderkey + 1", "l_linenumber"),
        "tick": tick,
    }
    cols = ", ".join(f'{vals.get(c, "NULL::VARCHAR")} AS "{c}"' for c in ABI_A_COLS)
    return f"""SELECT l_orderkey AS block_number, epoch_us(l_shipdate) // 1000000 AS block_timestamp,
  '0x' || sha256(CAST(l_orderkey AS VARCHAR)) AS tx_hash, CAST(l_linenumber AS BIGINT) AS log_index,
  '0xb2cc224c1c9feE385f8ad6a55b4d94E92359DC59' AS contract, 'Swap' AS event, {cols}
FROM li"""


M = """m AS (
  SELECT 'r' || CAST(o_orderkey % 4 AS VARCHAR) AS run_id, (o_orderkey % 5000) * 100 AS from_block,
    (o_orderkey % 5000) * 100 + o_custkey % 150 AS to_block,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'started' END AS status,
    1 AS attempts, o_custkey AS logs, o_custkey - o_orderkey % 5 AS decoded, o_orderkey % 5 AS filtered,
    1.7e9 + o_orderkey AS updated_at, o_orderkey AS seq
  FROM orders)"""


def islands(src: str) -> str:
    """Gaps-and-islands merge of inclusive (from_block, to_block) rows of ``src``."""
    return f"""(SELECT min(from_block) AS from_block, max(to_block) AS to_block FROM (
  SELECT *, sum(CASE WHEN pmax IS NULL OR from_block > pmax + 1 THEN 1 ELSE 0 END)
      OVER (ORDER BY from_block, to_block ROWS UNBOUNDED PRECEDING) AS isl
  FROM (SELECT *, max(to_block) OVER (ORDER BY from_block, to_block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pmax
        FROM ({src}))) GROUP BY isl)"""


def gaps(src: str, lo: int, hi: int) -> str:
    return f"""(SELECT * FROM (
  SELECT lag(t) OVER (ORDER BY f, t) + 1 AS from_block, f - 1 AS to_block FROM (
    SELECT greatest(from_block, {lo}) AS f, least(to_block, {hi}) AS t FROM {islands(src)}
    WHERE to_block >= {lo} AND from_block <= {hi}
    UNION ALL SELECT {lo - 1}, {lo - 1} UNION ALL SELECT {hi + 1}, {hi + 1}))
  WHERE from_block IS NOT NULL AND from_block <= to_block)"""


def chunks(src: str, step: int) -> str:
    return f"""(SELECT x AS from_block, least(e, x + {step - 1}) AS to_block FROM (
  SELECT unnest(generate_series(from_block, to_block, {step})) AS x, to_block AS e FROM ({src}) WHERE from_block <= to_block))"""


DONE = "SELECT from_block, to_block FROM m WHERE status = 'done'"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["decode_clpool"] = f"WITH {A} {clpool_rows()}"
    q["dedupe_logs"] = q["decode_clpool"]
    q["decode_builtin"] = f"WITH {A} {builtin_rows()}"
    mint_cols = "amount0, amount1, liquidity, owner, sender, tick_lower, tick_upper"
    q["decode_events_only"] = (f"WITH {A} SELECT {BASE}, event, {mint_cols}, token_id FROM ({builtin_rows()}) "
                               "WHERE event IN ('Mint', 'Deposit')")
    q["flagship"] = f"WITH {A} SELECT {BASE}, event, {mint_cols} FROM ({clpool_rows()}) WHERE event = 'Mint'"
    q["decode_gauge"] = f"WITH {ORDERS} {gauge_rows()}"
    q["decode_vfat"] = f"""SELECT c_custkey AS block_number, CAST(0 AS BIGINT) AS block_timestamp,
  '0x' || sha256(CAST(c_custkey AS VARCHAR)) AS tx_hash, CAST(1 AS BIGINT) AS log_index,
  {CONTRACT.format(k='c_custkey')} AS contract, 'Deploy' AS event,
  {addr('c_custkey')} AS admin, {addr('c_nationkey')} AS sickle
FROM customer"""
    q["decode_nfpm"] = f"""SELECT 5000000 + p_partkey AS block_number, 1700000000 + p_partkey * 12 AS block_timestamp,
  '0x' || sha256(CAST(p_partkey AS VARCHAR)) AS tx_hash, CAST(p_size AS BIGINT) AS log_index,
  {CONTRACT.format(k='p_partkey')} AS contract,
  CASE p_size % 3 WHEN 0 THEN 'Collect' WHEN 1 THEN 'DecreaseLiquidity' ELSE 'Transfer' END AS event,
  CASE WHEN p_size % 3 < 2 THEN CAST(p_partkey AS VARCHAR) END AS amount0,
  CASE WHEN p_size % 3 < 2 THEN CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) END AS amount1,
  CASE WHEN p_size % 3 = 2 THEN {addr('p_size')} END AS "from",
  CASE WHEN p_size % 3 = 1 THEN CAST(p_size AS VARCHAR) END AS liquidity,
  CASE WHEN p_size % 3 = 0 THEN {addr('p_size')} END AS recipient,
  CASE WHEN p_size % 3 = 2 THEN {addr('p_partkey')} END AS "to",
  CAST(p_partkey AS VARCHAR) AS token_id
FROM part"""
    q["decode_custom_const"] = f"""WITH {A} SELECT {BASE}, 'Mint' AS event, CAST(c AS VARCHAR) AS amount0,
  NULL::VARCHAR AS memo, 'clpool' AS pool_kind, {addr('user_id')} AS position_owner
FROM a WHERE kind = 'Mint' AND z = 1"""
    q["filter_reason_counts"] = f"""WITH {A} SELECT coalesce({A_REASON}, 'kept') AS filter_reason, count(*) AS n
FROM a GROUP BY 1"""
    for reason in ("no_topics", "unknown_topic", "fast_zero", "missing_topic", "short_data"):
        q[f"filter_{reason}"] = f"WITH {A} SELECT {KEYS} FROM a WHERE ({A_REASON}) = '{reason}'"
    q["filter_all_zero"] = f"WITH {A} SELECT {KEYS} FROM a WHERE kind = 'Burn' AND z = 0"
    q["decode_quarantine"] = f"""WITH {A} SELECT block_number, tx_hash || '-bad' AS tx_hash, log_index,
  'bad_hex' AS filter_reason FROM a WHERE kind <> 'none'"""
    q["rows_per_event"] = f"""WITH {A} SELECT event, count(*) AS rows FROM ({builtin_rows()}) GROUP BY event"""
    q["union_dynamic"] = f"""WITH {A}, {ORDERS} SELECT * FROM ({clpool_rows()}) UNION ALL BY NAME SELECT * FROM ({gauge_rows()})"""
    q["decode_abi_registry"] = f"WITH {LI} {swap_rows('reference')}"
    q["decode_abi_signed"] = f"WITH {LI} {swap_rows('abi')}"
    q["sorted_swaps"] = (f"WITH {LI} SELECT block_number, block_timestamp, log_index, tx_hash, amount0, amount1, tick "
                         f"FROM ({swap_rows('reference')})")
    q["merge_coverage"] = f"WITH {M} SELECT * FROM {islands(DONE)}"
    q["uncovered_ranges"] = f"WITH {M} SELECT * FROM {gaps(DONE, 50, 480000)}"
    q["coverage_gaps"] = f"""WITH {M} SELECT CAST(50 AS BIGINT) AS requested_from, CAST(480000 AS BIGINT) AS requested_to,
  count(*) AS gaps, CAST(coalesce(sum(to_block - from_block + 1), 0) AS BIGINT) AS gap_blocks,
  CAST(480000 - 50 + 1 - coalesce(sum(to_block - from_block + 1), 0) AS BIGINT) AS covered_blocks
FROM {gaps(DONE, 50, 480000)}"""
    q["work_seeds"] = f"WITH {M} SELECT * FROM {chunks('SELECT * FROM ' + gaps(DONE, 50, 480000), 777)}"
    q["chunk_ranges"] = f"WITH {M} SELECT * FROM {chunks('SELECT from_block, to_block FROM m', 7)}"
    bounds = "SELECT min(from_block) AS from_block, max(to_block) AS to_block FROM m"
    q["raw_chunk_grid"] = f"WITH {M} SELECT * FROM {chunks(bounds, 1000)}"
    latest = "(SELECT from_block, to_block, arg_max(status, updated_at) AS status, arg_max(logs, updated_at) AS logs FROM m GROUP BY 1, 2)"
    for name, skip in (("pending_chunks", "('done', 'failed')"), ("pending_chunks_rerun", "('done')")):
        q[name] = f"""WITH {M} SELECT g.* FROM {chunks(bounds, 100)} g
WHERE NOT EXISTS (SELECT 1 FROM {latest} l WHERE l.from_block = g.from_block AND l.to_block = g.to_block AND l.status IN {skip})"""
    q["bisect_failed"] = f"""WITH {M}, f AS (SELECT from_block AS s, to_block AS e, (from_block + to_block) // 2 AS mid FROM m
  WHERE status = 'failed' AND attempts < 3 AND from_block <= to_block)
SELECT s AS parent_from, e AS parent_to, s AS from_block, e AS to_block FROM f WHERE s = e
UNION ALL SELECT s, e, s, mid FROM f WHERE s < e
UNION ALL SELECT s, e, mid + 1, e FROM f WHERE s < e"""
    q["run_stats"] = f"""WITH {M} SELECT count(*) FILTER (WHERE status = 'done') AS processed_ok,
  count(*) FILTER (WHERE status = 'failed') AS processed_failed,
  count(*) FILTER (WHERE status IN ('done', 'failed')) AS executed_subranges,
  CAST(coalesce(sum(logs) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS total_logs,
  CAST(coalesce(sum(decoded) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS total_decoded,
  CAST(coalesce(sum(filtered) FILTER (WHERE status = 'done'), 0) AS BIGINT) AS total_filtered,
  CAST(0 AS BIGINT) AS shards_written FROM m"""
    q["raw_fetch_summary"] = f"""WITH {M} SELECT status, count(*) AS chunks, CAST(sum(logs) AS BIGINT) AS logs FROM {latest} GROUP BY status"""
    q["manifest_done"] = f"""WITH {M}, cut AS (SELECT run_id, min(seq) AS c FROM m WHERE seq % 97 = 0 GROUP BY run_id)
SELECT from_block, to_block FROM m LEFT JOIN cut USING (run_id)
WHERE status = 'done' AND seq % 97 <> 0 AND (c IS NULL OR seq < c)"""
    evc = f"""c AS {chunks('SELECT min(block_number) AS from_block, max(block_number) AS to_block FROM a', 50)}"""
    q["logs_per_chunk"] = f"""WITH {A}, {evc} SELECT c.from_block AS chunk_from, c.to_block AS chunk_to, {KEYS}
FROM a JOIN c ON a.block_number BETWEEN c.from_block AND c.to_block"""
    q["chunk_stats"] = f"""WITH {A}, {evc} SELECT c.from_block, c.to_block, count(a.event_id) AS logs,
  count(a.event_id) FILTER (WHERE ({A_REASON}) IS NULL) AS decoded,
  count(a.event_id) FILTER (WHERE ({A_REASON}) IS NOT NULL) AS filtered
FROM c LEFT JOIN a ON a.block_number BETWEEN c.from_block AND c.to_block GROUP BY 1, 2"""
    q["scan_logs_range"] = f"""WITH {A} SELECT {ADDR_LC} AS address, {T0_OF_KIND} AS topic0, {KEYS} FROM a
WHERE user_id % 3 = 0 AND kind IN ('Mint', 'missing', 'Burn', 'short') AND block_number BETWEEN 1000100 AND 1000600"""
    q["resolve_range"] = f"WITH {A} SELECT CAST(0 AS BIGINT) AS start_block, max(block_number) AS end_block FROM a"
    q["normalize_raw"] = f"""WITH {A} SELECT {ADDR_LC} AS address, {T0_OF_KIND} AS topic0, CAST({NTOP_OF_KIND} AS BIGINT) AS n_topics,
  block_number, CASE WHEN event_id % 3 = 2 THEN NULL ELSE block_timestamp END AS block_timestamp, tx_hash, log_index FROM a"""
    q["shards_scan"] = q["union_dynamic"]
    q["raw_dump_json"] = f"""WITH {A}, mn AS (SELECT min(block_number) AS m FROM a)
SELECT m + ((block_number - m) // 50) * 50 AS chunk_from, {KEYS} FROM a, mn"""
    q["write_shards"] = q["decode_clpool"]
    q["compact_tail"] = q["decode_clpool"]
    q["write_per_event"] = f"WITH {A} SELECT * FROM ({builtin_rows()})"
    q["shards_per_event"] = f"WITH {A} SELECT event, CAST(ceil(count(*) / 500.0) AS BIGINT) AS files FROM ({builtin_rows()}) GROUP BY event"
    q["shard_sizes"] = f"""WITH {A}, n AS (SELECT count(*) AS n FROM ({clpool_rows()}))
SELECT CAST(least(500, n - i * 500) AS BIGINT) AS rows FROM n, unnest(range(0, CAST(ceil(n / 500.0) AS BIGINT))) AS t(i)"""
    q["raw_dump"] = f"""WITH {A}, mn AS (SELECT min(block_number) AS m FROM a)
SELECT m + ((block_number - m) // 50) * 50 AS chunk_from, {KEYS} FROM a, mn"""
    ranked = f"(SELECT {KEYS}, row_number() OVER (ORDER BY block_number, tx_hash, log_index) - 1 AS rn FROM a)"
    q["shard_assignment"] = f"WITH {A} SELECT {KEYS}, rn // 250 AS shard_id FROM {ranked}"
    q["full_shards_only"] = f"""WITH {A} SELECT {KEYS}, rn // 250 AS shard_id FROM {ranked}
WHERE rn < ((SELECT count(*) FROM a) // 250) * 250"""
    q["manifest_write"] = f"""WITH {A}, {evc} SELECT 'run-1' AS run_id, c.from_block, c.to_block, 'done' AS status,
  CAST(1 AS INTEGER) AS attempts, count(a.event_id) AS logs,
  count(a.event_id) FILTER (WHERE ({A_REASON}) IS NULL) AS decoded,
  count(a.event_id) FILTER (WHERE ({A_REASON}) IS NOT NULL) AS filtered
FROM c LEFT JOIN a ON a.block_number BETWEEN c.from_block AND c.to_block GROUP BY 2, 3"""
    fp = (f"array_to_string(list_transform(list_sort(list(DISTINCT {T0_OF_KIND}) FILTER (WHERE {T0_OF_KIND} IS NOT NULL)), "
          "lambda x: substr(x, 1, 10)), 'x')")
    q["topics_fingerprint"] = f"WITH {A} SELECT {ADDR_LC} AS address, {fp} AS fingerprint FROM a GROUP BY 1"
    q["dataset_key"] = f"WITH {A} SELECT {ADDR_LC} AS address, {ADDR_LC} || '__topics-' || {fp} AS dataset_key FROM a GROUP BY 1"
    q["pipeline_run"] = q["decode_clpool"]
    q["stream_decode"] = q["decode_clpool"]
    q["pipeline_crash_named"] = q["decode_clpool"]
    q["pipeline_two_registries"] = f"WITH {A} SELECT * FROM ({builtin_rows()})"
    q["pipeline_failed_ranges"] = f"WITH {A} SELECT * FROM ({clpool_rows()}) WHERE block_number % 97 <> 0"
    q["pipeline_records"] = f"""WITH {A}, {evc}, d AS (
  SELECT block_number, event, (row_number() OVER (ORDER BY block_number, tx_hash, log_index) - 1) // 500 AS shard FROM ({builtin_rows()})),
e AS (SELECT c.from_block, event, count(*) AS n, count(DISTINCT shard) AS files FROM d JOIN c ON block_number BETWEEN c.from_block AND c.to_block GROUP BY ALL),
m AS (SELECT from_block, string_agg(event || '=' || files, ',' ORDER BY event) AS shards_written, string_agg(event || '=' || n, ',' ORDER BY event) AS rows_per_event
      FROM e GROUP BY 1),
f AS (SELECT c.from_block, count(DISTINCT shard) AS shards FROM d JOIN c ON block_number BETWEEN c.from_block AND c.to_block GROUP BY 1)
SELECT 'run-1' AS run_id, c.from_block, c.to_block, 'done' AS status, CAST(1 AS INTEGER) AS attempts, NULL::VARCHAR AS error, count(a.event_id) AS logs,
  count(a.event_id) FILTER (WHERE ({A_REASON}) IS NULL) AS decoded, count(a.event_id) FILTER (WHERE ({A_REASON}) IS NOT NULL) AS filtered,
  coalesce(any_value(f.shards), 0) AS shards, coalesce(any_value(m.shards_written), '') AS shards_written,
  coalesce(any_value(m.rows_per_event), '') AS rows_per_event, true AS dated
FROM c LEFT JOIN a ON a.block_number BETWEEN c.from_block AND c.to_block LEFT JOIN m ON m.from_block = c.from_block LEFT JOIN f ON f.from_block = c.from_block
GROUP BY 2, 3"""
    clp = ["amount0", "amount1", "liquidity", "owner", "recipient", "sender", "tick_lower", "tick_upper"]
    q["join_registry_map"] = (f"WITH {A} SELECT {BASE}, event, field, value FROM ({clpool_rows()}) "
                              f"UNPIVOT (value FOR field IN ({', '.join(clp)}))")
    abi = ", ".join(f'"{c}"' for c in ABI_A_COLS)
    q["join_registry_abi"] = (f"WITH {LI} SELECT {BASE}, event, field, value FROM ({swap_rows('reference')}) "
                              f"UNPIVOT (value FOR field IN ({abi}))")
    q["pipeline_journal"] = f"WITH {A} SELECT min(block_number) AS from_block, max(block_number) AS to_block FROM a"
    return q
