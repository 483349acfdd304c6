"""Exact shards, and tables whose readers see one generation or the next."""

import pytest
from pyspark.sql import functions as F

from chainsift import catalog as C
from chainsift import registry as R
from chainsift.operators import decode as D
from chainsift.session import scratch_path
from chainsift.sinks import shards as S
from chainsift.sinks import snapshots as G

KEYS = ["block_number", "tx_hash", "log_index"]


def decoded(spark, sf):
    return D.decode(C.lake(spark, sf, "events"), R.clpool_registry())


def sizes(spark, path):
    return sorted(r["rows"] for r in S.shard_sizes(spark, path).collect())


def cut(n, limit):
    return sorted([limit] * (n // limit) + ([n % limit] if n % limit else []))


def test_shards_are_exact_and_sorted(spark, sf_small):
    rows = decoded(spark, sf_small).repartition(7)
    path = S.write_shards(rows, scratch_path(spark, "exact"), 50)
    assert sizes(spark, path) == cut(rows.count(), 50)
    placed = spark.read.parquet(path).select(*KEYS, F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    files = {}
    for r in sorted(placed.collect(), key=lambda r: (r.f, r.i)):
        files.setdefault(r.f, []).append(tuple(r)[:3])
    assert all(x == sorted(x) for x in files.values())
    ranges = sorted((x[0], x[-1]) for x in files.values())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # files do not overlap


def test_shards_of_each_event_are_exact(spark, sf_small):
    rows = decoded(spark, sf_small)
    path = S.write_per_event(rows, scratch_path(spark, "exact-event"), 40)
    got = {}
    for r in S.shard_sizes(spark, path, ("event",)).collect():
        got.setdefault(r["event"], []).append(r["rows"])
    want = {r["event"]: cut(r["count"], 40) for r in rows.groupBy("event").count().collect()}
    assert {k: sorted(v) for k, v in got.items()} == want


def test_positions_with_equal_keys_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a", 0, i) for i in range(25)] + [(0, "b", 0, 99)], "block_number long, tx_hash string, log_index long, v int")
    got = S.assign_shards(rows, 10, tail_rows=4).collect()
    assert sorted(r.row_idx for r in got) == list(range(26)) and {r.shard_id for r in got} == {0, 1, 2}
    assert next(r.row_idx for r in got if r.v == 99) == 0
    assert S.assign_shards(rows.limit(0), 10).collect() == []


@pytest.mark.parametrize("per_event", [False, True])
def test_top_ups_refill_the_last_shard_only(spark, sf_small, per_event):
    rows = decoded(spark, sf_small)
    total, path, replaced = 0, scratch_path(spark, "top-up"), []
    for i in range(4):
        part = rows.where(F.col("log_index") % 4 == i)
        before = set(G.latest(spark, path).commits)
        replaced.append(set(S.compact_tail(spark, path, part, 30, per_event)))
        total += part.count()
        assert replaced[-1] <= before and S.read_shards(spark, path).count() == total
        if not per_event:
            assert sizes(spark, path) == cut(total, 30)
    assert S.read_shards(spark, path).select(rows.columns).exceptAll(rows).count() == 0
    S.compact_tail(spark, path, rows.limit(0), 30, per_event)
    assert S.read_shards(spark, path).count() == total


def test_a_reader_between_any_two_steps_sees_old_or_new(spark, sf_small, monkeypatch):
    rows = decoded(spark, sf_small)
    n = rows.count()
    path = scratch_path(spark, "steps")
    S.compact_tail(spark, path, rows, 60)
    seen, calls = [], 0
    steps = {name: getattr(G, name) for name in ("write_text", "move", "rename_new", "delete")}

    def watched(name):
        def step(*args):
            seen.append(S.read_shards(spark, path).count())
            out = steps[name](*args)
            seen.append(S.read_shards(spark, path).count())
            return out

        return step

    with monkeypatch.context() as m:
        for name in steps:
            m.setattr(G, name, watched(name))
        S.compact_tail(spark, path, rows, 60)
    assert set(seen) == {n, 2 * n} and seen == sorted(seen)

    for k in (1, 2, 4, 6):  # a stop at each step, then another writer
        stop = iter(range(k))

        def failing(name):
            def step(*args):
                if next(stop, None) is None:
                    raise RuntimeError("lost")
                return steps[name](*args)

            return step

        before = S.read_shards(spark, path).count()
        with monkeypatch.context() as m:
            for name in ("write_text", "move", "rename_new"):
                m.setattr(G, name, failing(name))
            try:
                S.compact_tail(spark, path, rows.limit(7), 60)
                calls += 1
            except RuntimeError:
                pass
        now = S.read_shards(spark, path).count()
        assert now in (before, before + 7)
        S.recover(spark, path)
        assert S.read_shards(spark, path).count() in (now, before + 7)
    assert calls  # late steps let it pass


def test_of_two_writers_one_gets_through(spark, sf_small):
    rows = decoded(spark, sf_small)
    path = scratch_path(spark, "two")
    S.compact_tail(spark, path, rows, 60)
    snap = G.latest(spark, path)
    slow = S.stage_append(spark, path, snap, rows, 60)
    S.compact_tail(spark, path, rows, 60)
    with pytest.raises(G.ConcurrentCommit):
        G.publish(spark, path, G.prepare(spark, path, snap.next(*slow)))
    assert S.read_shards(spark, path).count() == 2 * rows.count()
    for _ in range(3):
        S.compact_tail(spark, path, rows.limit(1), 60)
    live = {f"commit={c}" for c in G.latest(spark, path).commits}
    left = {n for n in G.names(spark, path) if n.startswith("commit=")}
    assert live <= left and not {f"commit={c}" for c in slow[0]} & left  # the loser's files are gone


def test_a_plain_folder_is_taken_over(spark, sf_small):
    rows = decoded(spark, sf_small)
    path = S.write_shards(rows, scratch_path(spark, "plain"), 70)
    S.compact_tail(spark, path, rows, 70)
    assert sizes(spark, path) == cut(2 * rows.count(), 70)
