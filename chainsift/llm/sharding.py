"""Uniform random sharding with exact shard sizes, by a hypergeometric communication matrix.

1. The rows' keys are written to the shared folder, so that their partitions stay as they are, and counted
   per partition.
2. A matrix (input partition x shard) with these row sums and with shard sizes at most one apart is drawn from
   the multivariate hypergeometric law: what a uniform shuffle of all rows would give.
3. Every partition permutes its own shard labels (batch by batch, each batch's share drawn by the same law), and gives
   each row a random place.
4. Rows are exchanged by shard and by the top bits of that place, and permuted again inside each such bucket by it;
   offsets of the buckets make the slots gapless.  A bucket holds about ``bucket_rows`` rows at any input size.

The law is ``rows``.  Equal texts are separate rows and may go to different shards.  Null texts have size 1 and the
checksum of the empty text; ids may be null or repeat; fewer rows than shards leave some empty; an empty table gives an
empty table.  Other columns travel inside a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_root
from .common import start, table, text_or_empty

BUCKET_ROWS = 200_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` out of ``good + bad`` are good; exact for populations of any size.

    The mass function is built from its ratios over all values within 40 deviations of the mean."""
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mean = drawn * (good / total)
    spread = 40 * (mean * (bad / total) * max(0.0, (total - drawn) / max(1, total - 1))) ** 0.5 + 40
    low, high = max(low, int(mean - spread)), min(high, int(mean + spread) + 1)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(drawn - k) - np.log(k + 1) - np.log(bad - drawn + k + 1)
    mass = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(mass - mass.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def split(rng: np.random.Generator, colours: list[int], drawn: int) -> list[int]:
    """A draw of ``drawn`` without replacement: how many of each colour."""
    out, rest = [], sum(colours)
    for c in colours:
        rest -= c
        got = hypergeometric(rng, c, rest, drawn)
        out.append(got)
        drawn -= got
    return out


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows for each shard from each partition; the column sums are at most one apart."""
    rng = np.random.default_rng(seed)
    n = sum(counts)
    left = [n // shards + (k < n % shards) for k in range(shards)]
    rng.shuffle(left)
    matrix = []
    for c in counts:
        row = split(rng, left, c)
        left = [a - b for a, b in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = sum(b.num_rows for b in batches)
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], ["part", "n"])


def _deal(shared, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, part])
        left = list(shared.value.get(part, ()))
        for b in batches:
            row = split(rng, left, b.num_rows)
            left = [x - y for x, y in zip(left, row, strict=True)]
            label = np.repeat(np.arange(len(row), dtype=np.int32), row)
            rng.shuffle(label)
            place = rng.integers(-(2**63), 2**63, b.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(label), pa.array(place)], ["row", "shard", "place"])

    return run


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(row, shard, slot)`` for every row of ``df``; ``row`` is a struct of its columns."""
    spark = df.sparkSession
    start(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    rows = df.select(F.struct("*").alias("row")).checkpoint()
    kind = rows.schema["row"].dataType.simpleString()
    counted = {r["part"]: r["n"] for r in rows.mapInArrow(_count, "part int, n long").collect()}  # a row for each partition
    parts = sorted(counted)
    matrix = communication_matrix([counted[p] for p in parts], shards, seed)
    shared = spark.sparkContext.broadcast(dict(zip(parts, matrix, strict=True)))
    dealt = rows.mapInArrow(_deal(shared, seed), f"row {kind}, shard int, place long")
    bits = max(0, int(sum(counted.values()) // (shards * bucket_rows)).bit_length())
    bucket = F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0).cast("long")
    dealt = dealt.withColumn("bucket", bucket)
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    placed = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("place", F.xxhash64("row"))))
    return placed.join(offsets, ["shard", "bucket"]).select("row", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = text_or_empty("text")
    # only what the result needs goes through the exchange; shuffle_into_shards itself takes whole rows too
    keys = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    found = shuffle_into_shards(keys, 8)
    return found.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
