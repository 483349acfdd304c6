"""Incremental runs: resumable, idempotent, no duplicates after a crash between data and journal."""

import os

import pytest
from pyspark.sql import functions as F

from chainsift import catalog as C, registry as R
from chainsift.operators import decode as D
from chainsift.plans import pipeline as P
from chainsift.session import scratch_path


def _expected(spark, sf):
    return D.decode(C.lake(spark, sf, "events"), R.clpool_registry())


def test_resume_after_crash_has_no_duplicates(spark, sf_small, monkeypatch):
    logs = C.lake(spark, sf_small, "events")
    lo = logs.agg(F.min("block_number")).collect()[0][0]
    out = scratch_path(spark, "pipe-test")
    real = P.append_manifest
    calls = {"n": 0}

    def crash_on_done(records, path):
        if records.where(F.col("status") == "done").limit(1).count():
            calls["n"] += 1
            raise RuntimeError("executor lost before journal commit")
        return real(records, path)

    monkeypatch.setattr(P, "append_manifest", crash_on_done)
    with pytest.raises(RuntimeError):
        P.run(spark, logs, R.clpool_registry(), out, int(lo), "latest", step=20)
    monkeypatch.setattr(P, "append_manifest", real)
    P.run(spark, logs, R.clpool_registry(), out, int(lo), "latest", step=20)  # replays the crashed run
    P.run(spark, logs, R.clpool_registry(), out, int(lo), "latest", step=20)  # nothing left
    got = P.read_decoded(spark, os.path.join(out, "data")).drop("run_id")
    exp = _expected(spark, sf_small)
    assert got.count() == exp.count()
    assert got.select(*exp.columns).subtract(exp).count() == 0
    assert got.dropDuplicates(["block_number", "tx_hash", "log_index"]).count() == got.count()
