"""Interval planning against set-of-blocks models; journal scan; ABI registry; shard cut."""

import os
import random

import pytest
from pyspark.sql import functions as F

from chainsift import catalog as C
from chainsift.operators import manifest as M
from chainsift.operators import ranges as G
from chainsift.session import scratch_path
from chainsift.sinks import shards as S
from chainsift.sources.abi import FIXTURE_ABIS, registry_from_abi
from chainsift.sources.manifest import done_coverage, scan_manifest


def blocks(ivs):
    return {b for s, e in ivs for b in range(s, e + 1)}


def runs_of(covered):
    """Maximal runs of a set of blocks: where one begins, and where the next missing block is."""
    begins = [b for b in covered if b - 1 not in covered]
    ends = [b for b in covered if b + 1 not in covered]
    return list(zip(sorted(begins), sorted(ends)))


def test_merge_subtract_chunk_match_models(spark):
    rng = random.Random(3)
    ivs = []
    for _ in range(300):
        s = rng.randrange(0, 3000)
        ivs.append((s, s + rng.randrange(0, 40)))
    df = spark.createDataFrame(ivs, "from_block long, to_block long")
    merged = sorted(tuple(r) for r in G.merge(df).collect())
    assert merged == runs_of(blocks(ivs))
    gaps = sorted(tuple(r) for r in G.subtract(df, 100, 2900).collect())
    want = blocks([(100, 2900)]) - blocks(ivs)
    assert blocks(gaps) == want and len(gaps) == len(runs_of(want))
    seeds = sorted(tuple(r) for r in G.work_seeds(df, 100, 2900, 7).collect())
    assert blocks(seeds) == want and all(e - s < 7 for s, e in seeds)
    grid = sorted(tuple(r) for r in G.grid(spark, 5, 27, 10).collect())
    assert grid == [(5, 14), (15, 24), (25, 27)]


@pytest.mark.parametrize("whole", [True, False])
def test_sweeps_by_key_over_many_partitions(spark, whole):
    rng = random.Random(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(whole).lower())
    try:
        ivs = [(rng.choice(["a", "b", "c"]), s, s + rng.choice([0, 3, 30, 700])) for s in (rng.randrange(0, 9000) for _ in range(400))]
        ivs += [("a", 10, 5)]  # empty
        df = spark.createDataFrame(ivs, "topic string, from_block long, to_block long").repartition(5)
        own = {k: blocks([(s, e) for t, s, e in ivs if t == k]) for k in "abcd"}
        merged = sorted(tuple(r) for r in G.merge(df, ("topic",)).collect())
        assert merged == [(k, *r) for k in "abc" for r in runs_of(own[k])]
        every = spark.createDataFrame([("a",), ("b",), ("d",)], "topic string")
        gaps = sorted(tuple(r) for r in G.subtract(df, 50, 8000, every).collect())
        assert gaps == [(k, *r) for k in "abd" for r in runs_of(set(range(50, 8001)) - own[k])]
        seeds = G.topic_seeds(df, ["a", "b", "d"], 50, 8000, 40).collect()
        open_at = {}
        for r in seeds:
            assert r.to_block - r.from_block < 40
            for x in range(r.from_block, r.to_block + 1):
                assert x not in open_at
                open_at[x] = set(r["keys"])
        for x in range(50, 8001):
            assert open_at.get(x, set()) == {k for k in "abd" if x not in own[k]}
        assert G.topic_seeds(df, ["a"], 10, 9, 5).collect() == []
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bisect_rules(spark):
    df = spark.createDataFrame([(10, 10, 1), (10, 13, 1), (20, 21, 3)], "from_block long, to_block long, attempts int")
    got = sorted((r["from_block"], r["to_block"]) for r in G.bisect(df, max_attempts=3).collect())
    assert got == [(10, 10), (10, 11), (12, 13)]  # single block not split, exhausted range dropped


def test_journal_scan_corrupt_tail(spark):
    path = scratch_path(spark, "journal-test")
    os.makedirs(path)
    lines = [
        '{"from_block":0,"to_block":4999,"status":"done","attempts":1,"logs":7,"decoded":6,"filtered":1}',
        "",
        '{"from_block":5000,"to_block":9999,"status":"failed","attempts":1}',
        '{"bad',
        '{"from_block":10000,"to_block":14999,"status":"done","attempts":1}',
    ]
    with open(os.path.join(path, "run_a.jsonl"), "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(path, "run_b.jsonl"), "w") as f:
        f.write('{"from_block":20000,"to_block":20009,"status":"done"}\n[1,2]\n')
    got = sorted(tuple(r) for r in done_coverage(spark, path).collect())
    assert got == [(0, 4999), (20000, 20009)]
    assert scan_manifest(spark, path, exclude_basename="run_b.jsonl").where("status = 'done'").count() == 1
    with pytest.raises(ValueError):
        scan_manifest(spark, path + "-missing").count()


def test_abi_registries(spark):
    for name in ("pool_a", "pool_b"):
        reg = registry_from_abi(spark, FIXTURE_ABIS[name])
        assert len(reg) == 9
    a = registry_from_abi(spark, FIXTURE_ABIS["pool_a"])
    swap = a.specs["0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"]
    assert [f.index for f in swap.topic_fields] == [1, 2]
    assert [f.word_index for f in swap.data_fields] == [0, 1, 2, 3, 4]


def test_shard_cut_is_exact(spark, sf_small):
    d = C.lake(spark, sf_small, "events").select("block_number", "tx_hash", "log_index")
    a = S.assign_shards(d, 70).orderBy("row_idx").collect()
    keys = [(r["block_number"], r["tx_hash"], r["log_index"]) for r in a]
    assert keys == sorted(keys)
    assert [r["row_idx"] for r in a] == list(range(len(a)))
    full, pending = S.full_shards_only(d, 70, tail_rows=30)
    n = d.count()
    assert full.count() == ((30 + n) // 70) * 70 - 30 and full.count() + pending.count() == n


def test_chunk_stats_counts_empty_chunks(spark):
    logs = spark.createDataFrame([(5, None), (6, "fast_zero"), (25, None)], "block_number long, filter_reason string")
    chunks = spark.createDataFrame([(0, 9), (10, 19), (20, 29)], "from_block long, to_block long")
    got = sorted(tuple(r) for r in M.chunk_stats(logs, chunks, bucket=10).collect())
    assert got == [(0, 9, 2, 1, 1), (10, 19, 0, 0, 0), (20, 29, 1, 1, 0)]


def test_abi_tuple_signatures(spark):
    import json

    from chainsift.functions.keccak import keccak256_hex

    path = scratch_path(spark, "abi-tuple")
    os.makedirs(path)
    ev = {"type": "event", "name": "Order", "anonymous": False, "inputs": [
        {"indexed": True, "internalType": "address", "name": "maker", "type": "address"},
        {"indexed": False, "internalType": "struct O", "name": "o", "type": "tuple",
         "components": [{"internalType": "uint256", "name": "a", "type": "uint256"},
                        {"internalType": "struct P[]", "name": "p", "type": "tuple[]",
                         "components": [{"name": "x", "type": "address"}, {"name": "y", "type": "bytes32"}]}]}]}
    with open(os.path.join(path, "x.json"), "w") as f:
        json.dump([ev], f)
    ref = registry_from_abi(spark, os.path.join(path, "x.json"), "reference")
    abi = registry_from_abi(spark, os.path.join(path, "x.json"), "abi")
    assert list(ref.specs) == [keccak256_hex("Order(address,tuple)")]
    assert list(abi.specs) == [keccak256_hex("Order(address,(uint256,(address,bytes32)[]))")]


def test_abi_tuples_of_any_depth(spark):
    import json

    from chainsift.functions.keccak import keccak256_hex

    leaf = [{"name": "x", "type": "address"}, {"name": "y", "type": "bytes32"}]
    nested, kind = leaf, "(address,bytes32)"
    for level in range(4):
        suffix = "[2]" if level % 2 else ""
        nested, kind = [{"name": "n", "type": "uint256"}, {"name": "t", "type": f"tuple{suffix}", "components": nested}], f"(uint256,{kind}{suffix})"
    entry = {"type": "event", "name": "Deep", "anonymous": False, "inputs": [
        {"indexed": True, "internalType": "address", "name": "who", "type": "address"},
        {"indexed": False, "internalType": "struct S[]", "name": "s", "type": "tuple[]", "components": nested}]}
    path = scratch_path(spark, "abi-deep")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "x.json"), "w") as f:
        json.dump([entry], f)
    abi = registry_from_abi(spark, os.path.join(path, "x.json"), "abi")
    assert list(abi.specs) == [keccak256_hex(f"Deep(address,{kind}[])")]


def test_a_journal_over_several_splits(spark):
    import json

    path = scratch_path(spark, "journal-splits")
    os.makedirs(path)
    for name, bad_at in (("a", None), ("b", 700), ("c", 3)):
        with open(f"{path}/{name}.jsonl", "w") as f:
            for i in range(1000):
                f.write("[]\n" if i == bad_at else "\n" if i % 10 == 9 else json.dumps({"from_block": i, "to_block": i, "status": "done", "run_id": name}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = scan_manifest(spark, path)
        got = {}
        for r in rows.collect():
            assert r.line_no == r.from_block
            got.setdefault(r.run_id, []).append(r.line_no)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {n: [i for i in range(1000) if i % 10 != 9 and (cut is None or i < cut)] for n, cut in (("a", None), ("b", 700), ("c", 3))}
    assert {k: sorted(v) for k, v in got.items()} == want
