"""Registry-driven decoding of raw logs into wide event tables.

The registry is compiled into Column expressions, so ``decode`` is a single
``select`` over the scan -- Catalyst keeps the filters next to the Parquet scan,
prunes unused output columns and fuses the hex arithmetic into whole-stage
codegen; only over-wide integers and EIP-55 checksums go through Arrow UDFs.

Every input row gets one ``filter_reason`` (first match wins, in the order the
reference applies its checks):

  no_topics, bad_hex*, unknown_topic, fast_zero, missing_topic | bad_topic*,
  short_data, all_zero | bad_zero_field*, bad_address*

(``*`` = malformed input: the reference raises there; here such rows go to a
quarantine table, or fail the job with ``on_error="fail"``).  Rows with no
reason are decoded.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import words as W
from ..functions.udfs import checksum_address, wide_int_to_decimal
from ..registry import EventSpec, Ref, Registry
from ..schema import BASE_COLUMNS

FILTER_REASONS = ("no_topics", "unknown_topic", "fast_zero", "missing_topic", "short_data", "all_zero")
ERROR_REASONS = ("null_block", "bad_hex", "bad_topic", "bad_zero_field", "bad_address")

_REASON = "filter_reason"
# The event's place in the registry (from 1; 0: unknown), the payload in bytes (null: no hex digits) and the topic
# count are computed once per row and exposed through a one-row ``inline`` generator.  Catalyst pushes filters below
# projections by inlining aliases, so plain helper columns would be re-evaluated
# at every use inside the (large) reason expression; a predicate on generator
# output cannot be pushed below the generator, so these stay computed once.
EVENT, _BYTES, _NTOPC = "__event", "__bytes", "__ntop"
_PREP = (EVENT, _BYTES, _NTOPC)
_WIDE = "__wide"


_EXPR_CACHE: dict[tuple, object] = {}


def _cached(kind: str, registry: Registry, semantics: str, build):
    """Compiled expressions per (registry, semantics): building them is thousands of
    py4j calls, and the same registry is typically decoded many times per session."""
    from pyspark import SparkContext
    from pyspark.sql import SparkSession

    from ..session import ship_package

    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    key = (kind, id(SparkContext._active_spark_context), tuple(registry.specs.values()), semantics)
    if key not in _EXPR_CACHE:
        if len(_EXPR_CACHE) > 256:
            _EXPR_CACHE.clear()
        _EXPR_CACHE[key] = build()
    return _EXPR_CACHE[key]


def _payload() -> Column:
    """The bytes of ``data``, with or without ``0x`` in front; null if it is no hex text of even length."""
    data = F.coalesce(F.col("data"), F.lit("0x"))
    body = F.when(F.substring(data, 1, 2).isin("0x", "0X"), F.substring(data, F.lit(3), F.octet_length(data))).otherwise(data)
    return F.when(F.octet_length(data) % 2 == 0, F.unhex(body))


def _prepare(logs: DataFrame, registry: Registry) -> DataFrame:
    topic0 = F.lower(F.get(F.col("topics"), 0))
    places = F.create_map(*[F.lit(x) for k, s in _events(registry) for x in (s.topic0, k)]) if len(registry) else None
    st = F.struct(
        (F.lit(0) if places is None else F.coalesce(F.try_element_at(places, topic0), F.lit(0))).alias(EVENT),
        _payload().alias(_BYTES),
        F.coalesce(F.size("topics"), F.lit(0)).alias(_NTOPC),
    )
    return logs.select("*", F.inline(F.array(st)))


def _bytes() -> Column:
    return F.col(_BYTES)


def _ntop() -> Column:
    return F.col(_NTOPC)


def _topic(i: int) -> Column:
    return F.get(F.col("topics"), i)


def _is_event(k: int) -> Column:
    return F.col(EVENT) == F.lit(k)


def _events(registry: Registry) -> Iterable[tuple[int, EventSpec]]:
    """The specs with their place, as ``_prepare`` numbers them."""
    return enumerate(registry, 1)


def _spec_reason(spec: EventSpec, semantics: str) -> Column:
    """Ordered checks of one spec after the topic0 lookup succeeded; null = keep."""
    branches: list[tuple[Column, str]] = []
    if spec.fast_zero_words:
        fz = None
        for first, count in W.runs(spec.fast_zero_words):
            z = W.is_zero_bytes(W.byte_words(_bytes(), first, count), 32 * count)
            fz = z if fz is None else fz & z
        branches.append((fz, "fast_zero"))
    for f in spec.topic_fields:
        branches.append((_ntop() <= F.lit(f.index), "missing_topic"))
        if W.is_int_type(f.type):
            branches.append((~W.is_hex(W.topic_body(_topic(f.index)), allow_empty=False, even=False), "bad_topic"))
    if spec.data_fields:
        need = max(f.word_index for f in spec.data_fields) + 1
        branches.append((F.length(_bytes()) < F.lit(32 * need), "short_data"))
    if spec.drop_if_all_zero_fields:
        # all(...) short-circuits: a non-integer field is only reached (and raises in
        # the reference) when every field before it decoded to zero.
        prefix_zero: Column = F.lit(True)
        for name in spec.drop_if_all_zero_fields:
            f = spec.data_field(name)
            if f is None:
                continue  # not a data field: counts as zero
            z = W.zero_value_test(W.byte_words(_bytes(), f.word_index), f.type, semantics)
            if z is None:
                branches.append((prefix_zero, "bad_zero_field"))
                prefix_zero = F.lit(False)
                break
            prefix_zero = prefix_zero & z
        branches.append((prefix_zero, "all_zero"))
    expr = None
    for cond, reason in branches:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr if expr is not None else F.lit(None).cast("string")


def _reason(registry: Registry, semantics: str) -> Column:
    per_spec = None
    for k, s in _events(registry):
        r = _spec_reason(s, semantics)
        per_spec = F.when(_is_event(k), r) if per_spec is None else per_spec.when(_is_event(k), r)
    addr = F.coalesce(F.col("address"), F.lit(""))
    addr_ok = (F.length(addr) == 42) & (F.lower(F.substring(addr, 1, 2)) == "0x") & W.is_hex(F.substring(addr, 3, 40))
    expr = (
        F.when(F.col("block_number").isNull(), F.lit("null_block"))
        .when(_ntop() <= 0, F.lit("no_topics"))
        .when(_bytes().isNull(), F.lit("bad_hex"))
        .when(_is_event(0), F.lit("unknown_topic"))  # a null topic0 is unknown too
    )
    if per_spec is not None:
        expr = expr.when(per_spec.isNotNull(), per_spec)
    return expr.when(~addr_ok, F.lit("bad_address"))


def classify(logs: DataFrame, registry: Registry, semantics: str = "reference") -> DataFrame:
    """``logs`` plus ``filter_reason`` (null = decodable) -- the filter stage alone."""
    _check_semantics(semantics)
    # the reason is produced by a generator so that a later filter on it does not
    # inline (and duplicate) the whole expression next to the projection
    prep = _prepare(logs, registry)
    reason = _cached("reason", registry, semantics, lambda: _reason(registry, semantics))
    out = prep.select("*", F.inline(F.array(F.struct(reason.alias(_REASON)))))
    return out.drop(*_PREP)


class Conversions:
    """The distinct values that a registry's fields take from a log, each computed once per row and only in rows of the events that use it.

    A value is told by (kind, index, class, mode): the registry may have any number of events, the values are as many as places and types differ."""

    def __init__(self, registry: Registry, semantics: str) -> None:
        users: dict[tuple, set[int]] = {}
        self.places: dict[tuple[int, str], tuple] = {}  # (event, output column) -> key
        for k, spec in _events(registry):
            for out, ref in spec.projection:
                if ref.kind not in ("const", "none"):
                    key = self.places[k, out] = field_key(spec, ref, semantics)
                    users.setdefault(key, set()).add(k)
        self.words: list[Column] = []  # what several values are made from
        self.plans: list[Column] = []
        self.values: dict[tuple, Column] = {}
        for kind, i in dict.fromkeys(key[:2] for key in users if key[2] == "int"):
            used = F.col(EVENT).isin(sorted(set().union(*[e for key, e in users.items() if key[:3] == (kind, i, "int")])))
            self.words.append(F.when(used, W.topic_word(W.topic_body(_topic(i))) if kind == "topic" else W.byte_words(_bytes(), i)).alias(f"__{kind}{i}"))
        wide = []
        for n, (key, events) in enumerate(users.items()):
            kind, i, cls, mode = key
            used, v = F.col(EVENT).isin(sorted(events)), F.col(f"__v{n}")
            self.values[key] = v
            if cls == "int":
                name = f"__{kind}{i}"
                value, left = W.bytes_plan(F.col(name), mode)
                if left is not None:
                    digits = W.topic_body(_topic(i)) if kind == "topic" else F.hex(F.col(name))
                    wide.append(F.when(used & left, F.concat(F.lit(f"{n}:{mode}="), digits)))
                    self.values[key] = F.coalesce(v, F.col(_WIDE).getItem(str(n)))
            elif cls == "address":
                value = W.address_from_topic(_topic(i)) if kind == "topic" else W.address_from_bytes(W.byte_words(_bytes(), i))
            else:
                value = F.lower(_topic(i)) if kind == "topic" else F.concat(F.lit("0x"), F.lower(F.hex(W.byte_words(_bytes(), i))))
            self.plans.append(F.when(used, value).alias(f"__v{n}"))
        # a log's wide integers go to Python in one text, and nothing if it has none
        self.left = F.nullif(F.concat_ws(",", *wide), F.lit("")) if wide else None

    def over(self, kept: DataFrame, keep: list[str], **more: Column) -> DataFrame:
        """``keep``, ``more`` and the event of the prepared logs ``kept``, and the columns that ``values`` name."""
        kept = kept.select(*dict.fromkeys([*keep, "address", "topics", EVENT, _BYTES]), *self.words)
        left = [] if self.left is None else [self.left.alias(_WIDE)]
        kept = kept.select(*dict.fromkeys([*keep, "address", EVENT]), *self.plans, *left)
        # (two uses of the text keep Catalyst from moving the values above Python, into one generated method with all that follows)
        wide = {} if self.left is None else {
            _WIDE: F.when(F.col(_WIDE).isNotNull(), F.str_to_map(wide_int_to_decimal(F.col(_WIDE), F.lit(0)), F.lit(","), F.lit("=")))}
        made = more | wide
        return kept.select(*[c for c in kept.columns if c not in made and (c in keep or c != "address")], *[c.alias(n) for n, c in made.items()])


def field_key(spec: EventSpec, ref: Ref, semantics: str) -> tuple[str, int, str, int]:
    """``(kind, index, class, mode)`` of what a projection takes from a topic or a data word; the mode is ``W.bytes_plan``'s."""
    f = spec.topic_field(ref.value) if ref.kind == "topic" else spec.data_field(ref.value)
    idx = f.index if ref.kind == "topic" else f.word_index
    if f.type == "address":
        return ref.kind, idx, "address", 0
    if not W.is_int_type(f.type):
        return ref.kind, idx, "raw", 0
    if f.type.startswith("uint") or (ref.kind == "topic" and semantics == "reference"):
        return ref.kind, idx, "int", 0
    return ref.kind, idx, "int", W.int_bits(f.type) if semantics == "reference" else -W.int_bits(f.type)


def _output_column(registry: Registry, out: str, conv: Conversions) -> Column:
    expr = None
    for k, s in _events(registry):
        ref = dict(s.projection).get(out)
        if ref is None:
            continue
        v = F.lit(ref.value if ref.kind == "const" else None).cast("string") if ref.kind in ("const", "none") else conv.values[conv.places[k, out]]
        expr = F.when(_is_event(k), v) if expr is None else expr.when(_is_event(k), v)
    return expr if expr is not None else F.lit(None).cast("string")


def kept(logs: DataFrame, registry: Registry, semantics: str = "reference") -> DataFrame:
    """The decodable logs, prepared; the reason is looked at once, in a filter."""
    _check_semantics(semantics)
    reason = _cached("reason", registry, semantics, lambda: _reason(registry, semantics))
    return _prepare(logs, registry).where(reason.isNull())


def _check_semantics(semantics: str) -> None:
    if semantics not in ("reference", "abi"):
        raise ValueError("semantics must be 'reference' or 'abi'")


def _values(registry: Registry, outs: list[str], semantics: str) -> tuple[Conversions, Column, list[Column]]:
    conv = Conversions(registry, semantics)
    names = F.get(F.array(*[F.lit(s.name) for s in registry]), F.col(EVENT) - 1) if len(registry) else F.lit(None).cast("string")
    return conv, names, [_output_column(registry, o, conv).alias(o) for o in outs]


def restrict(logs: DataFrame, registry: Registry, events: Iterable[str] | None,
             lower_case: bool = False) -> tuple[DataFrame, Registry]:
    """Event-name filter rewritten to a ``topic0 IN (...)`` predicate on the scan.

    ``lower_case`` states that the logs' ``topic0`` column is lower-case already (as lakes
    written here are): then the predicate is on the bare column and reaches Parquet.
    Otherwise spellings are compared case-insensitively.
    """
    if events is None:
        return logs, registry
    reg = registry.only(events)
    if "topic0" in logs.columns:
        topic0 = F.col("topic0") if lower_case else F.lower("topic0")
        logs = logs.where(topic0.isin(reg.topic0s()))
    return logs, reg


def decode(
    logs: DataFrame,
    registry: Registry,
    semantics: str = "reference",
    events: Iterable[str] | None = None,
    on_error: str = "quarantine",
    keep_reason: bool = False,
    lower_case: bool = False,
    tags: dict[str, Column] | None = None,
) -> DataFrame:
    """Decode ``raw_logs`` rows with ``registry`` into the wide decoded table.

    With ``tags`` (columns over the raw logs and ``filter_reason``, by name) every log stays, one pass for all that is told of it: the tags and
    the reason follow the decoded columns, which are null in logs that are not decoded.

    Output: ``block_number, block_timestamp, tx_hash, log_index, contract, event``
    then one string column per projection key of the registry, sorted by name.
    """
    _check_semantics(semantics)
    if on_error not in ("quarantine", "fail"):
        raise ValueError("on_error must be 'quarantine' or 'fail'")
    logs, registry = restrict(logs, registry, events, lower_case)
    outs = registry.output_columns()
    reason = _cached("reason", registry, semantics, lambda: _reason(registry, semantics))
    df = _prepare(logs, registry).withColumn(_REASON, reason)
    if on_error == "fail":
        failing = F.col(_REASON).isin(*ERROR_REASONS)
        df = df.where(
            F.when(
                failing,
                F.raise_error(F.concat(F.lit("malformed log ("), F.col(_REASON), F.lit(") in tx "),
                                       F.coalesce(F.col("tx_hash"), F.lit("?")))),
            ).isNull()
        )
    if tags is None:
        df = df.where(F.col(_REASON).isNull())
    else:  # dropped logs lose their topic, so no conversion looks at them; the generator keeps the reason computed once
        kept = F.col(_REASON).isNull()
        fields = {EVENT: F.when(kept, F.col(EVENT)).otherwise(0), "address": F.when(kept, F.col("address")), _REASON: F.col(_REASON)} | tags
        columns = [c for c in df.columns if c not in fields]
        df = df.select(*columns, F.inline(F.array(F.struct(*[c.alias(n) for n, c in fields.items()]))))
        keep_reason = True
    extra = ([_REASON] if keep_reason else []) + list(tags or ())
    conv, names, values = _cached("values", registry, semantics, lambda: _values(registry, outs, semantics))
    df = conv.over(df, ["block_number", "block_timestamp", "tx_hash", "log_index", *extra], contract=checksum_address(F.col("address")))
    cols = [
        F.col("block_number").cast("long").alias("block_number"),
        F.coalesce(F.col("block_timestamp").cast("long"), F.lit(0).cast("long")).alias("block_timestamp"),
        F.col("tx_hash"),
        F.col("log_index").cast("long").alias("log_index"),
        "contract",
        names.alias("event"),
    ]
    return df.select(*cols, *values, *extra)


def decode_sorted(logs: DataFrame, registry: Registry, order_by: list[str], semantics: str = "reference",
                  events: Iterable[str] | None = None, lower_case: bool = False) -> DataFrame:
    """``decode`` with a global order on raw columns (e.g. block_timestamp, log_index).

    Decoding is row-wise and keeps row order, so the sort runs on the raw logs: the
    range-partitioning sample and the shuffle then see raw rows only, instead of
    evaluating the whole decode (and its Python UDFs) twice.  A null timestamp
    decodes to 0 and sorts first either way.
    """
    logs, registry = restrict(logs, registry, events, lower_case)
    keys = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c == "block_timestamp" else F.col(c) for c in order_by]
    return decode(logs.orderBy(*keys), registry, semantics)


def rejects(logs: DataFrame, registry: Registry, semantics: str = "reference", errors_only: bool = True) -> DataFrame:
    """Quarantine side table: the raw rows that were not decoded, with their reason."""
    df = classify(logs, registry, semantics)
    reasons = ERROR_REASONS if errors_only else ERROR_REASONS + FILTER_REASONS
    return df.where(F.col(_REASON).isin(*reasons))


def decoded_columns(registry: Registry) -> list[str]:
    return BASE_COLUMNS + registry.output_columns()
