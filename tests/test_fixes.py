"""Cases in which rows were once lost, nulled, doubled or wrongly journalled."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainsift import catalog as C
from chainsift import registry as R
from chainsift.functions import udfs
from chainsift.operators import decode as D
from chainsift.plans import pipeline as P
from chainsift.session import scratch_path
from chainsift.sinks import raw, shards
from chainsift.sources.logs import hex_or_int, resolve_range
from chainsift.streaming.stream import stream_decode_files

from test_decode import logs, word


def mint(**more):
    topics = [R.MINT_T0, "0x" + word(7), "0x" + word(1), "0x" + word(3)]
    return {"topics": topics, "data": "0x" + "".join(word(x) for x in (1, 2, 3, 4))} | more


def bounds(df):
    return df.agg(F.min("block_number"), F.max("block_number"), F.percentile_approx("block_number", 0.5)).first()


def test_checksums_survive_eviction(monkeypatch):
    monkeypatch.setattr(udfs, "_CACHE_LIMIT", 3)
    names = [f"0x{k:040x}" for k in range(12)]
    for batch in (names[:3], names[1:6], names):
        got = udfs.checksum_address.func(pd.Series([*batch, None]))
        assert [x and x.lower() for x in got.tolist()[:-1]] == batch and got.isna().sum() == 1


def test_payload_without_prefix_and_null_topic(spark):
    reg = R.clpool_registry()
    df = logs(spark, [mint(), mint(data=mint()["data"][2:]), {"topics": [None], "data": "0x"}, {"topics": [], "data": ""}])
    assert D.decode(df, reg).count() == 2
    reasons = [r[0] for r in D.classify(df, reg).select("filter_reason").collect()]
    assert reasons == [None, None, "unknown_topic", "no_topics"]


def test_event_filter_ignores_the_case_of_topics(spark):
    up = mint(topics=[R.MINT_T0.replace("a", "A"), *mint()["topics"][1:]])
    df = logs(spark, [mint(), up])
    assert D.decode(df, R.clpool_registry(), events=["Mint"]).count() == 2 == D.decode(df, R.clpool_registry()).count()


def test_start_behind_end_fails(spark):
    df = logs(spark, [mint(block=5)])
    with pytest.raises(Exception, match="start > end"):
        resolve_range(df, 10**9, "latest").collect()
    assert tuple(resolve_range(df, "earliest", "latest").first()) == (0, 5)


def test_long_numbers_are_not_cut(spark):
    df = spark.createDataFrame([("0x" + "0" * 70 + "1f",), ("0x1" + "0" * 40,), ("12",)], "x string")
    assert [r[0] for r in df.select(hex_or_int(F.col("x"))).collect()] == [31, None, 12]


def test_compaction_keeps_the_columns_of_all_schemas(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    a, b = D.decode(lake, R.clpool_registry()), D.decode(lake, R.gauge_registry())
    path = scratch_path(spark, "mixed")
    for df in (a, b, a.limit(0)):
        shards.compact_tail(spark, path, df, 10**6)
    got = shards.read_shards(spark, path)
    expected = a.unionByName(b, allowMissingColumns=True)
    assert sorted(got.columns) == sorted(expected.columns)
    assert got.select(expected.columns).exceptAll(expected).count() == 0 and got.count() == expected.count()


@pytest.mark.parametrize("after", ["staging", "commit"])
def test_compaction_survives_a_crash(spark, sf_small, monkeypatch, after):
    rows = D.decode(C.lake(spark, sf_small, "events"), R.clpool_registry())
    path = scratch_path(spark, "crash")
    shards.compact_tail(spark, path, rows, 10**6)

    def crash(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(shards, "_finish" if after == "commit" else "_jvm_fs", crash) if after == "commit" else m.setattr(shards, "write_shards", crash)
        with pytest.raises(RuntimeError):
            shards.compact_tail(spark, path, rows, 10**6)
    assert shards.read_shards(spark, path).count() == rows.count()
    shards.recover(spark, path)
    assert shards.read_shards(spark, path).count() == rows.count() * (2 if after == "commit" else 1)


def test_a_run_id_serves_several_ranges(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    lo, hi, mid = bounds(lake)
    out = scratch_path(spark, "daily")
    for a, b in ((lo, mid), (lo, hi)):
        res = P.run(spark, lake, R.clpool_registry(), out, int(a), int(b), step=50, run_id="daily")
    assert P.read_decoded(spark, res.data_path).count() == D.decode(lake, R.clpool_registry()).count()


def test_coverage_is_kept_for_each_topic_set(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    lo, hi, _ = bounds(lake)
    out = scratch_path(spark, "two")
    for reg in (R.clpool_registry(), R.gauge_registry(), R.gauge_registry()):
        res = P.run(spark, lake, reg, out, int(lo), int(hi), step=50)
    assert res.seeds == 0
    n = sum(D.decode(lake, reg).count() for reg in (R.clpool_registry(), R.gauge_registry()))
    assert P.read_decoded(spark, res.data_path).count() == n


def test_malformed_logs_reach_quarantine(spark):
    df = logs(spark, [mint(block=1), mint(block=2, data="0xzz"), mint(block=3)])
    out = scratch_path(spark, "quarantine")
    res = P.run(spark, df, R.clpool_registry(), out, 1, 3, step=10)
    bad = spark.read.parquet(f"{out}/quarantine").collect()
    assert [(r.block_number, r.filter_reason) for r in bad] == [(2, "bad_hex")] and res.decoded == 2


def test_a_stream_claims_no_blocks(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    lo, hi, _ = bounds(lake)
    out = scratch_path(spark, "ends")
    ends = scratch_path(spark, "ends-lake")
    lake.where((F.col("block_number") == lo) | (F.col("block_number") == hi)).write.parquet(ends)
    stream_decode_files(spark, ends, R.clpool_registry(), out, f"{out}/_checkpoint")
    assert spark.read.json(f"{out}/batches").agg(F.sum("logs")).first()[0] > 0
    res = P.run(spark, lake, R.clpool_registry(), scratch_path(spark, "x"), int(lo), int(hi), step=50)
    assert res.logs == lake.count() and P.run(spark, lake, R.clpool_registry(), out, int(lo), int(hi), step=50).logs == lake.count()


def test_a_dump_done_again_replaces_itself(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    lo, hi, _ = bounds(lake)
    chunks = spark.createDataFrame([(int(lo), int(hi))], "from_block long, to_block long")
    path = scratch_path(spark, "dump")
    for _ in range(2):
        raw.write_raw_dump(lake, chunks, path, int(hi - lo + 1))
    assert spark.read.parquet(path).count() == lake.count()
