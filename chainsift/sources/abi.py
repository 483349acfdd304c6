"""Contract ABI files -> event table -> registry (a small Spark job).

Each ABI file is a JSON array.  It is read whole (so the position of every
entry is known), exploded with its position, filtered to ``type = 'event'``
and turned into registry rows with higher-order functions:

* topic index = 1 + position among the indexed inputs,
* word index  = position among the non-indexed inputs,
* projection  = every input under its own name, no zero filters,
* topic0      = keccak-256 of ``Name(type,...)`` (Arrow UDF on distinct signatures).

``semantics="reference"`` keeps only the last event of a given name per file
(overloads collapse, as in the reference); ``"abi"`` keeps every overload.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from ..functions.udfs import keccak_topic
from ..registry import REGISTRY_SCHEMA, Registry

ABI_INPUT = StructType(
    [
        StructField("indexed", BooleanType()),
        StructField("internalType", StringType()),
        StructField("name", StringType()),
        StructField("type", StringType()),
        StructField("components", StringType()),  # JSON text: tuples nest to any depth
    ]
)
ABI_ENTRY = StructType(
    [
        StructField("type", StringType()),
        StructField("name", StringType()),
        StructField("anonymous", BooleanType()),
        StructField("inputs", ArrayType(ABI_INPUT)),
    ]
)

# The JSON files are public contract interfaces (event names, inputs, types).
FIXTURE_ABIS = {
    "pool_a": os.path.join(os.path.dirname(os.path.dirname(__file__)), "abi", "pool_a.json"),
    "pool_b": os.path.join(os.path.dirname(os.path.dirname(__file__)), "abi", "pool_b.json"),
}


def abi_events(spark: SparkSession, paths: list[str] | str, semantics: str = "reference") -> DataFrame:
    """``file, pos, name, anonymous, inputs`` -- one row per event entry."""
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.from_json("value", ArrayType(ABI_ENTRY)).alias("entries")
    )
    ev = raw.select("file", F.posexplode("entries").alias("pos", "e")).where(F.col("e.type") == "event").select(
        "file", "pos", F.col("e.name").alias("name"), F.col("e.anonymous").alias("anonymous"), F.col("e.inputs").alias("inputs")
    )
    if semantics == "reference":
        w = Window.partitionBy("file", "name").orderBy(F.col("pos").desc())
        ev = ev.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return ev


def _invalid_inputs(ev: DataFrame) -> DataFrame:
    bad = F.exists(F.coalesce("inputs", F.array()), lambda x: x["indexed"].isNull() | x["internalType"].isNull() | x["type"].isNull())
    return ev.where(bad)


def _canonical_type(kind: str, components: list | None) -> str:
    """ABI canonical type: ``tuple`` / ``tuple[..]`` become ``(component types)`` + suffix, to any depth."""
    if not kind.startswith("tuple") or not components:
        return kind
    return "(" + ",".join(_canonical_type(c["type"], c.get("components")) for c in components) + ")" + kind[5:]


@F.udf(ArrayType(StringType()))
def _canonical_all(kinds, components):
    return [k and _canonical_type(k, json.loads(c) if c else None) for k, c in zip(kinds, components, strict=True)]


def registry_table(ev: DataFrame, semantics: str = "reference") -> DataFrame:
    """Registry rows (``REGISTRY_SCHEMA`` + ``file``) from an ``abi_events`` table.

    ``reference`` hashes tuple inputs as the literal ``tuple`` (as the reference
    does, giving a topic0 no node emits); ``abi`` expands the components to any depth.
    """
    inputs = F.coalesce(F.col("inputs"), F.array().cast(ArrayType(ABI_INPUT)))
    types = F.transform(inputs, lambda x: x["type"])
    if semantics == "abi":
        types = _canonical_all(types, F.transform(inputs, lambda x: x["components"]))
    sig = F.concat(F.col("name"), F.lit("("), F.array_join(types, ","), F.lit(")"))
    indexed = F.filter(inputs, lambda x: x["indexed"])
    plain = F.filter(inputs, lambda x: ~x["indexed"])
    topic_fields = F.transform(
        indexed, lambda x, i: F.struct(x["name"].alias("name"), (i + 1).cast("int").alias("index"), x["type"].alias("type"))
    )
    data_fields = F.transform(
        plain, lambda x, i: F.struct(x["name"].alias("name"), i.cast("int").alias("word_index"), x["type"].alias("type"))
    )
    projection = F.transform(
        inputs,
        lambda x: F.struct(
            x["name"].alias("out"), F.when(x["indexed"], F.lit("topic")).otherwise(F.lit("data")).alias("kind"), x["name"].alias("ref")
        ),
    )
    return ev.select(
        "file",
        keccak_topic(sig).alias("topic0"),
        F.col("name"),
        topic_fields.alias("topic_fields"),
        data_fields.alias("data_fields"),
        projection.alias("projection"),
        F.array().cast("array<int>").alias("fast_zero_words"),
        F.array().cast("array<string>").alias("drop_if_all_zero_fields"),
    )


def registry_from_abi(spark: SparkSession, paths: list[str] | str, semantics: str = "reference") -> Registry:
    """Build a decode registry from ABI files (collects the small registry table)."""
    from ..session import ship_package

    ship_package(spark)
    ev = abi_events(spark, paths, semantics)
    bad = _invalid_inputs(ev).select("file", "name").limit(1).collect()
    if bad:
        raise ValueError(f"ABI event {bad[0]['name']} in {bad[0]['file']}: input without indexed/internalType/type")
    return Registry.from_df(registry_table(ev, semantics).orderBy("file", "topic0").select(*REGISTRY_SCHEMA.fieldNames()))
