"""Decoder semantics on literal logs, including the reference's documented quirks."""

import pytest
from pyspark.sql import functions as F

from chainsift import registry as R
from chainsift.operators import decode as D
from chainsift.schema import RAW_LOGS

ADDR = "0xd8da6bf26964af9d7eed9e03e53415d37aa96045"
T2256 = 1 << 256


def word(v: int) -> str:
    return format(v % T2256, "064x")


def logs(spark, rows):
    full = []
    for r in rows:
        topics = r.get("topics", [])
        full.append((r.get("address", ADDR), topics[0] if topics else None, topics, r.get("data", "0x"),
                     r.get("block", 1), r.get("ts", 1000), r.get("tx", "0xtx"), r.get("li", 0)))
    return spark.createDataFrame(full, RAW_LOGS)


def test_topic_address_and_data_word(spark):
    spec = R.EventSpec("0xabc1", "Paid", (R.TopicField("payer", 1, "address"),), (R.DataField("units", 0, "uint256"),),
                       (("payer", R.topic_ref("payer")), ("units", R.data_ref("units"))))
    payer = "0x" + "5e" * 20
    df = logs(spark, [{"topics": ["0xabc1", "0x" + payer[2:].rjust(64, "0")], "data": "0x" + word(73)}, {"topics": ["0xdef2"]}])
    [r] = D.decode(df, R.Registry.of(spec)).collect()
    assert (r["event"], r["payer"], r["units"]) == ("Paid", payer, "73")
    assert r["contract"].lower() == ADDR and r["contract"] != ADDR


def _mint_like(spark, tick_topic: int, data_words):
    reg = R.clpool_registry()
    t = [R.MINT_T0, "0x" + word(7), "0x" + word(tick_topic), "0x" + word(3)]
    return reg, logs(spark, [{"topics": t, "data": "0x" + "".join(word(x) for x in data_words)}])


def test_topic_ints_are_unsigned_in_reference_mode(spark):
    reg, df = _mint_like(spark, -5, [1, 2, 3, 4])
    r = D.decode(df, reg).collect()[0]
    assert r["tick_lower"] == str(T2256 - 5)
    r = D.decode(df, reg, semantics="abi").collect()[0]
    assert r["tick_lower"] == "-5"


def test_narrow_signed_data_words(spark):
    swap = R.EventSpec(R.SWAP_T0, "Swap", (), (R.DataField("tick", 0, "int24"), R.DataField("a", 1, "int256")),
                       (("tick", R.data_ref("tick")), ("a", R.data_ref("a"))))
    reg = R.Registry.of(swap)
    df = logs(spark, [{"topics": [R.SWAP_T0], "data": "0x" + word(-3) + word(-12345)}])
    r = D.decode(df, reg).collect()[0]
    assert r["tick"] == str(T2256 - 3 - (1 << 24))  # reference rule on a sign-extended word
    assert r["a"] == "-12345"
    r = D.decode(df, reg, semantics="abi").collect()[0]
    assert r["tick"] == "-3" and r["a"] == "-12345"


def test_filter_order_and_reasons(spark):
    reg = R.clpool_registry()
    burn4 = [R.BURN_T0, "0x" + word(1), "0x" + word(2), "0x" + word(3)]
    df = logs(spark, [
        {"topics": [], "tx": "a"},                                             # no topics
        {"topics": ["0x" + "ab" * 32], "tx": "b"},                             # unknown
        {"topics": burn4, "data": "0x" + word(0) * 2, "tx": "c"},              # fast zero (partial words count)
        {"topics": burn4[:2], "data": "0x" + word(0) * 3, "tx": "d"},          # fast zero beats missing topic
        {"topics": burn4[:2], "data": "0x" + word(5) * 3, "tx": "e"},          # missing topic
        {"topics": burn4, "data": "0x" + word(9), "tx": "f"},                  # short data
        {"topics": burn4, "data": "0x" + word(1) * 3 + "zz", "tx": "g"},       # malformed hex
        {"topics": burn4, "data": "0x" + word(1) * 3, "tx": "h", "address": "0x12"},  # bad address
        {"topics": burn4, "data": "0x" + word(1) * 3, "tx": "i"},              # kept
    ])
    got = {r["tx_hash"]: r["filter_reason"] for r in D.classify(df, reg).collect()}
    assert got == {"a": "no_topics", "b": "unknown_topic", "c": "fast_zero", "d": "fast_zero",
                   "e": "missing_topic", "f": "short_data", "g": "bad_hex", "h": "bad_address", "i": None}
    assert [r["tx_hash"] for r in D.decode(df, reg).collect()] == ["i"]
    assert sorted(r["tx_hash"] for r in D.rejects(df, reg).collect()) == ["g", "h"]
    with pytest.raises(Exception):
        D.decode(df, reg, on_error="fail").collect()


def test_all_zero_rule_and_quirks(spark):
    spec = R.EventSpec("0xabc", "E", (), (R.DataField("x", 0, "int24"), R.DataField("y", 1, "uint256")),
                       (("x", R.data_ref("x")),), (), ("x", "y", "not_a_field"))
    reg = R.Registry.of(spec)
    df = logs(spark, [
        {"topics": ["0xabc"], "data": "0x" + word(0) + word(0), "tx": "zero"},
        {"topics": ["0xabc"], "data": "0x" + word(1 << 24) + word(0), "tx": "quirk"},  # 2^24 - 2^24 == 0
        {"topics": ["0xabc"], "data": "0x" + word(1) + word(0), "tx": "keep"},
    ])
    got = {r["tx_hash"]: r["filter_reason"] for r in D.classify(df, reg).collect()}
    assert got == {"zero": "all_zero", "quirk": "all_zero", "keep": None}
    got = {r["tx_hash"]: r["filter_reason"] for r in D.classify(df, reg, semantics="abi").collect()}
    assert got["quirk"] == "all_zero"  # low 24 bits are zero as well


def test_constant_none_and_null_timestamp(spark):
    spec = R.EventSpec("0xabc", "E", (), (), (("k", R.const_ref("v")), ("n", R.NO_VALUE)))
    df = logs(spark, [{"topics": ["0xABC"], "ts": None}])
    r = D.decode(df, R.Registry.of(spec)).collect()[0]
    assert (r["k"], r["n"], r["block_timestamp"]) == ("v", None, 0)


def test_registry_validation_and_merge(spark):
    with pytest.raises(ValueError):
        R.EventSpec("0x1", "E", (), (), (("a", R.topic_ref("missing")),))
    with pytest.raises(ValueError):
        R.Registry.of(R.EventSpec("0x1", "E", (), (), (("event", R.const_ref("x")),))).output_columns()
    a = R.clpool_registry()
    b = R.Registry.of(R.EventSpec(R.MINT_T0, "Other", (), (), ()))
    assert a.merge(b).specs[R.MINT_T0].name == "Other"
    back = R.Registry.from_df(R.builtin_registry().to_df(spark))
    assert back.specs == R.builtin_registry().specs
    assert len(R.builtin_registry()) == 12 and len(R.empty_registry()) == 0


def test_event_restriction_pushes_topic0_filter(spark, sf_small):
    from chainsift import catalog as C

    d = D.decode(C.lake(spark, sf_small, "events"), R.builtin_registry(), events=["Mint"])
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "topic0" in plan
    assert {r["event"] for r in d.select("event").distinct().collect()} <= {"Mint"}


def test_registry_table_merge_last_wins(spark):
    a = R.clpool_registry().to_df(spark)
    b = R.Registry.of(R.EventSpec(R.MINT_T0, "Other", (), (), ())).to_df(spark)
    merged = R.Registry.from_df(R.merge_registry_tables(a, b))
    assert merged.specs[R.MINT_T0].name == "Other" and len(merged) == 4
