"""Runs as attempts: crashes at any step, fencing, coverage by topic, failed ranges, counters."""

import pytest
from pyspark.sql import functions as F

from chainsift import catalog as C
from chainsift import registry as R
from chainsift.operators import decode as D
from chainsift.plans import pipeline as P
from chainsift.session import scratch_path
from chainsift.sinks import layout
from chainsift.sinks import snapshots as N

from test_decode import logs, word


def mint(**more):
    topics = [R.MINT_T0, "0x" + word(7), "0x" + word(1), "0x" + word(3)]
    return {"topics": topics, "data": "0x" + "".join(word(x) for x in (1, 2, 3, 4))} | more


def count(spark, out):
    return P.read_decoded(spark, f"{out}/data").count() if N.latest(spark, f"{out}/data").commits else 0


def test_a_stop_at_any_step_loses_and_doubles_nothing(spark, sf_small, monkeypatch):
    lake = C.lake(spark, sf_small, "events")
    n = D.decode(lake, R.clpool_registry()).count()
    out = scratch_path(spark, "stops")
    for where, name in ((P.N, "publish"), (P.S, "stage_append"), (P, "append_manifest")):  # an open attempt is fenced by publishing, so this comes first
        with monkeypatch.context() as m:
            m.setattr(where, name, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                P.run(spark, lake, R.clpool_registry(), out, step=100, run_id="daily")
        assert count(spark, out) == 0
    res = P.run(spark, lake, R.clpool_registry(), out, step=100, run_id="daily", rows_per_shard=100)
    assert count(spark, out) == n == res.decoded and res.shards == -(-n // 100)
    states = list(P.attempts(spark, out).values())
    assert sorted(states) == ["abandoned"] * 3 + ["committed"]
    assert P.run(spark, lake, R.clpool_registry(), out, step=100).seeds == 0


def test_a_fenced_attempt_can_publish_no_more(spark, sf_small, monkeypatch):
    lake = C.lake(spark, sf_small, "events")
    out = scratch_path(spark, "zombie")
    n = D.decode(lake, R.clpool_registry()).count()
    real = P.append_manifest

    def overtaken(records, path):
        monkeypatch.setattr(P, "append_manifest", real)
        P.run(spark, lake, R.clpool_registry(), out, step=500)  # another driver takes over meanwhile
        return real(records, path)

    monkeypatch.setattr(P, "append_manifest", overtaken)
    with pytest.raises(Exception):  # noqa: B017 - its files are gone, or its generation is taken
        P.run(spark, lake, R.clpool_registry(), out, step=500)
    assert count(spark, out) == n


def test_adding_an_event_decodes_only_its_old_blocks(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    out = scratch_path(spark, "added")
    few = R.clpool_registry().only(["Mint"])
    P.run(spark, lake, few, out, step=200)
    res = P.run(spark, lake, R.builtin_registry(), out, step=200, topics_only=True)
    rest = D.decode(lake, R.builtin_registry()).where("event <> 'Mint'").count()
    assert res.decoded == rest
    every = D.decode(lake, R.builtin_registry())
    got = P.read_decoded(spark, res.data_path)
    assert got.count() == every.count() and got.select(every.columns).exceptAll(every).count() == 0


def test_failing_blocks_are_isolated_and_tried_again(spark):
    rows = [mint(block=b, data="0xzz" if b in (5, 23) else mint()["data"]) for b in range(1, 41)]
    out = scratch_path(spark, "failing")
    res = P.run(spark, logs(spark, rows), R.clpool_registry(), out, 1, 40, step=16, on_error="fail")
    assert res.decoded == 38 == count(spark, out)
    failed = P.journal(spark, out).where("status = 'failed'")
    single = {(r.from_block, r.error) for r in failed.where("from_block = to_block").collect()}
    assert single == {(5, "malformed log (bad_hex)"), (23, "malformed log (bad_hex)")}
    assert failed.agg(F.max("attempts")).first()[0] == 5 and res.failed == 10
    good = logs(spark, [mint(block=b) for b in range(1, 41)])
    again = P.run(spark, good, R.clpool_registry(), out, 1, 40, step=16, on_error="fail")
    assert again.decoded == 2 and again.seeds == 2 and count(spark, out) == 40


def test_attempts_are_bounded(spark):
    rows = [mint(block=b, data="0xzz" if b == 5 else mint()["data"]) for b in range(1, 17)]
    out = scratch_path(spark, "bounded")
    res = P.run(spark, logs(spark, rows), R.clpool_registry(), out, 1, 16, step=16, on_error="fail", max_attempts=3)
    assert res.decoded == 12 and res.failed == 3  # 1-16, 1-8, 5-8 failed


def test_rows_held_back_are_neither_seen_nor_lost(spark):
    out = scratch_path(spark, "held")
    df = logs(spark, [mint(block=b) for b in range(1, 26)])
    res = P.run(spark, df, R.clpool_registry(), out, 1, 25, step=5, rows_per_shard=8, final_partial=False)
    assert count(spark, out) == 24 and res.decoded == 25
    more = logs(spark, [mint(block=b) for b in range(1, 31)])
    res = P.run(spark, more, R.clpool_registry(), out, 1, 30, step=5, rows_per_shard=8, final_partial=False)
    assert count(spark, out) == 24 and res.decoded == 5
    P.S.compact_tail(spark, f"{out}/data", P.S.read_shards(spark, f"{out}/data").limit(0), 8)
    assert count(spark, out) == 30


def test_dataset_folders():
    t = ["0xBBBBBBBBBBBB", "0xaaaaaaaaaaaa", ""]
    assert layout.dataset_folder("/r", "0xAB", t) == "/r/0xab__topics-0xaaaaaaaax0xbbbbbbbb"
    assert layout.dataset_folder("/r", "0xAB", [], "per_event", "uni", "pool") == "/r/uni/pool"
    assert layout.dataset_folder("/r", "0xAB", [], "per_event", "uni", None) == "/r/0xab__topics-none"
    with pytest.raises(ValueError):
        layout.dataset_folder("/r", "0xAB", [], "other")


def test_one_call_for_an_address_and_a_layout(spark, sf_small):
    lake = C.lake(spark, sf_small, "events")
    address = lake.where("size(topics) > 0").first()["address"]
    root = scratch_path(spark, "jobs")
    res = P.fetch(spark, lake, R.builtin_registry(), root, address.upper().replace("0X", "0x"), step=500, layout="per_event", protocol="uni", contract="pool", rows_per_shard=40)
    own = D.decode(lake.where(F.lower("address") == address.lower()), R.builtin_registry())
    got = P.read_decoded(spark, f"{root}/uni/pool/data")
    assert res.data_path == f"{root}/uni/pool/data" and got.select(own.columns).exceptAll(own).count() == 0 and got.count() == own.count()
    sizes = {}
    for r in P.S.shard_sizes(spark, res.data_path, ("event",)).collect():
        sizes.setdefault(r["event"], []).append(r["rows"])
    assert all(sum(x < 40 for x in v) <= 1 and max(v) <= 40 for v in sizes.values())
    assert P.fetch(spark, lake, R.clpool_registry(), root, address, step=500, layout="per_event", protocol="uni", contract="pool").seeds == 0
