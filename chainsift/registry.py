"""Declarative event registries.

A registry maps ``topic0`` (lower-case 0x-hex) to an :class:`EventSpec` that says
which topics / data words hold which typed fields, which output columns are
projected from them, and which zero-filters apply.  Registries are small
metadata (one entry per event type); they are kept as Python objects on the
driver, can be turned into / read back from a DataFrame (``to_df`` /
``from_df``), and are compiled by :mod:`chainsift.operators.decode` into Column
expressions, so the decode itself is a plain Catalyst plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .schema import validate_dynamic_names


@dataclass(frozen=True)
class TopicField:
    name: str
    index: int  # 0-based position in ``topics`` (topic0 is index 0)
    type: str


@dataclass(frozen=True)
class DataField:
    name: str
    word_index: int  # 0-based 32-byte word of ``data``
    type: str


@dataclass(frozen=True)
class Ref:
    """Source of one output column: a topic field, a data field, a constant or nothing."""

    kind: str  # "topic" | "data" | "const" | "none"
    value: str | None = None


def topic_ref(name: str) -> Ref:
    return Ref("topic", name)


def data_ref(name: str) -> Ref:
    return Ref("data", name)


def const_ref(value: str) -> Ref:
    return Ref("const", value)


NO_VALUE = Ref("none", None)


@dataclass(frozen=True)
class EventSpec:
    topic0: str
    name: str
    topic_fields: tuple[TopicField, ...] = ()
    data_fields: tuple[DataField, ...] = ()
    projection: tuple[tuple[str, Ref], ...] = ()
    fast_zero_words: tuple[int, ...] = ()
    drop_if_all_zero_fields: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "topic0", self.topic0.lower())
        object.__setattr__(self, "topic_fields", tuple(self.topic_fields))
        object.__setattr__(self, "data_fields", tuple(self.data_fields))
        proj = self.projection.items() if isinstance(self.projection, Mapping) else self.projection
        object.__setattr__(self, "projection", tuple((k, v) for k, v in proj))
        object.__setattr__(self, "fast_zero_words", tuple(self.fast_zero_words))
        object.__setattr__(self, "drop_if_all_zero_fields", tuple(self.drop_if_all_zero_fields))
        low = [f.name for f in self.topic_fields if f.index < 1]
        if low:
            raise ValueError(f"{self.name}: topics of fields start at 1, not so for {low}")
        allowed = {"topic": [f.name for f in self.topic_fields], "data": [f.name for f in self.data_fields]}
        for column, ref in self.projection:
            kind = ref.kind if isinstance(ref, Ref) else None
            if kind not in {*allowed, "const", "none"}:
                raise ValueError(f"{self.name}.{column}: {ref!r} is no Ref of a known kind")
            if ref.value not in allowed.get(kind, [ref.value]):
                raise ValueError(f"{self.name}.{column}: the event declares no {kind} field {ref.value!r}")

    def topic_field(self, name: str) -> TopicField | None:
        return next((f for f in self.topic_fields if f.name == name), None)

    def data_field(self, name: str) -> DataField | None:
        return next((f for f in self.data_fields if f.name == name), None)


@dataclass
class Registry:
    """Ordered topic0 -> EventSpec map; adding an existing topic0 replaces it (last wins)."""

    specs: dict[str, EventSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, *specs: EventSpec) -> Registry:
        r = cls()
        for s in specs:
            r.add(s)
        return r

    def add(self, spec: EventSpec) -> Registry:
        self.specs.pop(spec.topic0, None)
        self.specs[spec.topic0] = spec
        return self

    def merge(self, *others: Registry) -> Registry:
        out = Registry(dict(self.specs))
        for o in others:
            for s in o.specs.values():
                out.add(s)
        return out

    def only(self, events: Iterable[str] | None) -> Registry:
        """Restrict to events by name (both specs of a shared name are kept)."""
        if events is None:
            return self
        wanted = set(events)
        return Registry({t: s for t, s in self.specs.items() if s.name in wanted})

    def __iter__(self):
        return iter(self.specs.values())

    def __len__(self):
        return len(self.specs)

    def topic0s(self) -> list[str]:
        return list(self.specs)

    def output_columns(self) -> list[str]:
        names = sorted({out for s in self.specs.values() for out, _ in s.projection})
        validate_dynamic_names(names)
        return names

    # ---- DataFrame form -------------------------------------------------
    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                s.topic0,
                s.name,
                [(f.name, f.index, f.type) for f in s.topic_fields],
                [(f.name, f.word_index, f.type) for f in s.data_fields],
                [(out, ref.kind, ref.value) for out, ref in s.projection],
                list(s.fast_zero_words),
                list(s.drop_if_all_zero_fields),
            )
            for s in self.specs.values()
        ]
        return spark.createDataFrame(rows, REGISTRY_SCHEMA)

    @classmethod
    def from_df(cls, df: DataFrame) -> Registry:
        """Collect a registry table (one row per event type; bounded by the registry size)."""
        reg = cls()
        for r in df.select(*REGISTRY_SCHEMA.fieldNames()).collect():
            reg.add(
                EventSpec(
                    topic0=r["topic0"],
                    name=r["name"],
                    topic_fields=tuple(TopicField(f["name"], f["index"], f["type"]) for f in r["topic_fields"] or []),
                    data_fields=tuple(DataField(f["name"], f["word_index"], f["type"]) for f in r["data_fields"] or []),
                    projection=tuple((p["out"], Ref(p["kind"], p["ref"])) for p in r["projection"] or []),
                    fast_zero_words=tuple(r["fast_zero_words"] or ()),
                    drop_if_all_zero_fields=tuple(r["drop_if_all_zero_fields"] or ()),
                )
            )
        return reg


REGISTRY_SCHEMA = StructType(
    [
        StructField("topic0", StringType()),
        StructField("name", StringType()),
        StructField(
            "topic_fields",
            ArrayType(StructType([StructField("name", StringType()), StructField("index", IntegerType()), StructField("type", StringType())])),
        ),
        StructField(
            "data_fields",
            ArrayType(StructType([StructField("name", StringType()), StructField("word_index", IntegerType()), StructField("type", StringType())])),
        ),
        StructField(
            "projection",
            ArrayType(StructType([StructField("out", StringType()), StructField("kind", StringType()), StructField("ref", StringType())])),
        ),
        StructField("fast_zero_words", ArrayType(IntegerType())),
        StructField("drop_if_all_zero_fields", ArrayType(StringType())),
    ]
)


def merge_registry_tables(*tables: DataFrame) -> DataFrame:
    """Union registry tables; for a topic0 present in several, the last table wins."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    tagged = None
    for prio, t in enumerate(tables):
        x = t.select(*REGISTRY_SCHEMA.fieldNames()).withColumn("_prio", F.lit(prio))
        tagged = x if tagged is None else tagged.unionByName(x)
    w = Window.partitionBy(F.lower("topic0")).orderBy(F.col("_prio").desc())
    return tagged.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_prio")


# ---------------------------------------------------------------------------
# topic0 of the built-in events (keccak-256 of the event
# signatures; must equal the reference's constants for identical results).
# ---------------------------------------------------------------------------
MINT_T0 = "0x7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde"
BURN_T0 = "0x0c396cd989a39f4459b5fa1aed6a9a8dcdbc45908acfd67e028cd568da98982c"
COLLECT_T0 = "0x70935338e69775456a85ddef226c395fb668b63fa0115f5f20610b388e6ca9c0"
COLLECTFEES_T0 = "0x205860e66845f2bbc0966bfab80db9bf93fca93862ea2b9fcf6945748352b4a3"
DEPOSIT_T0 = "0x1c8ab8c7f45390d58f58f1d655213a82cca5d12179761a87c16f098813b8f211"
WITHDRAW_T0 = "0x8903a5b5d08a841e7f68438387f1da20c84dea756379ed37e633ff3854b99b84"
CLAIM_REWARDS_T0 = "0x1f89f96333d3133000ee447473151fa9606543368f02271c9d95ae14f13bcc67"
DEPLOY_T0 = "0xb1a29087760d8e8f9b263f598962f752e7bd23badd44897e2966d376d1a59dca"
NFPM_COLLECT_T0 = "0x40d0efd1a53d60ecbf40971b9daf7dc90178c3aadc7aab1765632738fa8b8f01"
INCREASE_LIQUIDITY_T0 = "0x3067048beee31b25b2f1681f88dac838c8bba36af25bfb2b7cf7473a5847e35f"
DECREASE_LIQUIDITY_T0 = "0x26f6a048ee9138f2c0ce266f322cb99228e8d619ae2bff30c67f8dcf9d2377b4"
TRANSFER_T0 = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
SWAP_T0 = "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"



def _project(topic_names: Iterable[str], data_names: Iterable[str], rename: Mapping[str, str] | None = None):
    rename = dict(rename or {})
    proj = [(rename.get(n, n), topic_ref(n)) for n in topic_names]
    proj += [(rename.get(n, n), data_ref(n)) for n in data_names]
    return tuple(proj)


# The fields of the built-in events (names, order, ABI types and output columns are the
# contracts' public interface), here and in the registries below.


def _pool_ticks() -> tuple[TopicField, ...]:
    return (TopicField("owner", 1, "address"), TopicField("tick_lower", 2, "int24"), TopicField("tick_upper", 3, "int24"))


def clpool_registry() -> Registry:
    """Concentrated-liquidity pool events: Mint, Burn, Collect, CollectFees."""
    mint_d = (
        DataField("sender", 0, "address"),
        DataField("liquidity", 1, "uint128"),
        DataField("amount0", 2, "uint256"),
        DataField("amount1", 3, "uint256"),
    )
    burn_d = (DataField("liquidity", 0, "uint128"), DataField("amount0", 1, "uint256"), DataField("amount1", 2, "uint256"))
    collect_d = (DataField("recipient", 0, "address"), DataField("amount0", 1, "uint128"), DataField("amount1", 2, "uint128"))
    fees_t = (TopicField("recipient", 1, "address"),)
    fees_d = (DataField("amount0", 0, "uint128"), DataField("amount1", 1, "uint128"))
    ticks = _pool_ticks()
    tick_names = [f.name for f in ticks]
    return Registry.of(
        EventSpec(MINT_T0, "Mint", ticks, mint_d, _project(tick_names, [f.name for f in mint_d]),
                  (1, 2, 3), ("liquidity", "amount0", "amount1")),
        EventSpec(BURN_T0, "Burn", ticks, burn_d, _project(tick_names, [f.name for f in burn_d]),
                  (0, 1, 2), ("liquidity", "amount0", "amount1")),
        EventSpec(COLLECT_T0, "Collect", ticks, collect_d, _project(tick_names, [f.name for f in collect_d]),
                  (1, 2), ("amount0", "amount1")),
        EventSpec(COLLECTFEES_T0, "CollectFees", fees_t, fees_d, _project(["recipient"], ["amount0", "amount1"]),
                  (0, 1), ("amount0", "amount1")),
    )


def gauge_registry() -> Registry:
    """Gauge staking events: Deposit, Withdraw, ClaimRewards."""
    stake_t = (TopicField("user", 1, "address"), TopicField("tokenId", 2, "uint256"), TopicField("liquidityToStake", 3, "uint128"))
    stake_p = (("owner", topic_ref("user")), ("liquidity", topic_ref("liquidityToStake")), ("token_id", topic_ref("tokenId")))
    return Registry.of(
        EventSpec(DEPOSIT_T0, "Deposit", stake_t, (), stake_p),
        EventSpec(WITHDRAW_T0, "Withdraw", stake_t, (), stake_p),
        EventSpec(CLAIM_REWARDS_T0, "ClaimRewards", (TopicField("from", 1, "address"),), (DataField("amount", 0, "uint256"),),
                  (("owner", topic_ref("from")), ("amount", data_ref("amount")))),
    )


def vfat_registry() -> Registry:
    """Sickle factory: Deploy."""
    return Registry.of(
        EventSpec(DEPLOY_T0, "Deploy", (TopicField("admin", 1, "address"),), (DataField("sickle", 0, "address"),),
                  (("admin", topic_ref("admin")), ("sickle", data_ref("sickle")))),
    )


def nfpm_registry() -> Registry:
    """Position manager: Collect, IncreaseLiquidity, DecreaseLiquidity, Transfer."""
    tok = (TopicField("tokenId", 1, "uint256"),)
    liq_d = (DataField("liquidity", 0, "uint128"), DataField("amount0", 1, "uint256"), DataField("amount1", 2, "uint256"))
    col_d = (DataField("recipient", 0, "address"), DataField("amount0", 1, "uint256"), DataField("amount1", 2, "uint256"))
    ren = {"tokenId": "token_id"}
    return Registry.of(
        EventSpec(NFPM_COLLECT_T0, "Collect", tok, col_d, _project(["tokenId"], [f.name for f in col_d], ren),
                  (1, 2), ("amount0", "amount1")),
        EventSpec(INCREASE_LIQUIDITY_T0, "IncreaseLiquidity", tok, liq_d, _project(["tokenId"], [f.name for f in liq_d], ren),
                  (0, 1, 2), ("liquidity", "amount0", "amount1")),
        EventSpec(DECREASE_LIQUIDITY_T0, "DecreaseLiquidity", tok, liq_d, _project(["tokenId"], [f.name for f in liq_d], ren),
                  (0, 1, 2), ("liquidity", "amount0", "amount1")),
        EventSpec(TRANSFER_T0, "Transfer",
                  (TopicField("from", 1, "address"), TopicField("to", 2, "address"), TopicField("tokenId", 3, "uint256")), (),
                  _project(["from", "to", "tokenId"], [], ren)),
    )


def builtin_registry() -> Registry:
    """All built-in registries merged (later wins on a shared topic0)."""
    return clpool_registry().merge(gauge_registry(), vfat_registry(), nfpm_registry())


def empty_registry() -> Registry:
    return Registry()
