"""Driver contract: flagship query and registry of queries / oracles."""

import __spark_entry__ as E


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns[:6] == ["block_number", "block_timestamp", "tx_hash", "log_index", "contract", "event"]
    rows = df.collect()
    assert rows and all(r["event"] == "Mint" for r in rows)
    ts = [(r["block_timestamp"], r["log_index"]) for r in rows]
    assert ts == sorted(ts)


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50
