"""Values of a log are made once, wide integers of a log go to Python in one text; results against plain Python."""

import random

from chainsift import registry as R
from chainsift.operators.decode import classify, decode
from chainsift.operators.decode_long import decode_long

from test_decode import logs, word
from test_words import expected

TYPES = ("uint256", "int256", "int24", "uint128", "int128", "address", "bytes32")


def many() -> R.Registry:
    """Events of all types in topics and words, under changing columns."""
    specs = []
    for e in range(6):
        types = TYPES[e:] + TYPES[:e]
        topics = tuple(R.TopicField(f"t{i}", i + 1, t) for i, t in enumerate(types[:3]))
        words = tuple(R.DataField(f"w{i}", i, t) for i, t in enumerate(types))
        specs.append(R.EventSpec("0x" + f"{e:x}" * 64, f"E{e}", topics, words, tuple(
            [(f"t{i}", R.topic_ref(f"t{i}")) for i in range(3)] + [(f"c{(i + e) % 9}", R.data_ref(f"w{i}")) for i in range(7)] + [("kind", R.const_ref(f"k{e}")), ("no", R.NO_VALUE)])))
    return R.Registry.of(*specs)


def value(digits: str, typ: str, topic: bool, semantics: str) -> str:
    if typ == "address":
        return "0x" + digits[-40:]
    if typ == "bytes32":
        return "0x" + digits
    n = int(typ.lstrip("uint"))
    unsigned = typ.startswith("uint") or (topic and semantics == "reference")
    return expected(digits, 0 if unsigned else n if semantics == "reference" else -n)


def rows_and_values(semantics):
    rng, registry = random.Random(2), many()
    rows, want = [], {}
    for k in range(300):
        spec = rng.choice(list(registry))
        v = [rng.choice([rng.getrandbits(rng.choice([8, 59, 61, 64, 70, 128, 160, 256])), -rng.getrandbits(rng.choice([8, 59, 60, 63, 90])), 0, 2**255]) for _ in range(10)]
        t, d = [word(x) for x in v[:3]], [word(x) for x in v[3:]]
        for i, f in enumerate(spec.topic_fields):  # a topic's digits may be fewer or more than a word's
            if f.type.startswith(("int", "uint")) and rng.random() < 0.2:
                t[i] = rng.choice(["7", "f" * 63, *(["1" + "0" * 70] if f.type != "int24" else [])])
        data = "".join(d) + rng.choice(["", "ab"])
        rows.append({"topics": [rng.choice([spec.topic0, spec.topic0.upper().replace("0X", "0x")]), *("0x" + x for x in t)], "tx": str(k), "data": rng.choice(["0x" + data, "0X" + data.upper(), data])})
        want[str(k)] = {"event": spec.name, "kind": f"k{spec.name[1]}"} | {
            c: value(t[int(c[1])] if ref.kind == "topic" else d[int(ref.value[1])], (spec.topic_field if ref.kind == "topic" else spec.data_field)(ref.value).type, ref.kind == "topic", semantics)
            for c, ref in spec.projection if ref.kind in ("topic", "data")}
    return registry, rows, want


def test_all_types_against_python(spark):
    for semantics in ("reference", "abi"):
        registry, rows, want = rows_and_values(semantics)
        df = logs(spark, rows)
        got = {r.tx_hash: {c: v for c, v in r.asDict().items() if v is not None and c in ("event", *registry.output_columns())} for r in decode(df, registry, semantics).collect()}
        assert got == want
        fields = {}
        for r in decode_long(df, registry, semantics).collect():
            assert fields.setdefault(r.tx_hash, {"event": r.event}).setdefault(r.field, r.value) == r.value
        assert fields == want


def test_payloads_that_are_no_digits(spark):
    spec = R.EventSpec("0xabc", "E", (), (R.DataField("x", 0, "uint256"),), (("x", R.data_ref("x")),), (0,))
    data = {"odd": "0x" + word(1) + "a", "sign": "0x" + word(1)[:-1] + "-", "twice": "0x0x" + word(1), "wide letter": "0x" + word(1)[:-2] + "é", "none": None,
            "empty": "0x", "bare": word(5), "part": "0x00", "short": "0x01", "zero": "0x" + word(0)}
    df = logs(spark, [{"topics": ["0xABC"], "data": d, "tx": tx} for tx, d in data.items()])
    got = {r.tx_hash: r.filter_reason for r in classify(df, R.Registry.of(spec)).collect()}
    assert got == dict.fromkeys(("odd", "sign", "twice", "wide letter"), "bad_hex") | dict.fromkeys(("none", "empty", "part", "zero"), "fast_zero") | {"bare": None, "short": "short_data"}
    assert [(r.tx_hash, r.x) for r in decode(df, R.Registry.of(spec)).collect()] == [("bare", "5")]


def test_python_gets_a_log_once(spark):
    registry, rows, _ = rows_and_values("reference")
    df = logs(spark, rows)
    wide, long = (x._jdf.queryExecution().optimizedPlan().toString() for x in (decode(df, registry), decode_long(df, registry)))
    assert wide.count("wide_int_to_decimal(") == 1  # one for each kind of integer before
    assert long.count("wide_int_to_decimal(") == 1 and long.index("wide_int_to_decimal(") > long.index("Join")  # after the join, for each field, before
    assert wide.count("Generate inline") == long.count("Generate inline") == 1  # a generator's expressions are interpreted
