"""Incremental, resumable fetch -> decode -> land job over a raw-log lake.

One ``run``:

1. resolve the requested range (``earliest`` / ``latest`` / numbers) against the lake;
2. read the coverage of the dataset: ``done`` records of committed journals, kept for each address and topic;
3. plan work seeds: chunks of the range with the topics that are not covered there, so a new event decodes only its own old blocks;
4. one pass over the lake: logs of the seeds are tagged with their chunk, classified and decoded into a staged table;
5. read from the staged columns: counters per chunk, malformed logs, and (``on_error="fail"``) which chunks fail: these go to halves in
   rounds, until what cannot be split further is ``failed`` for good; the other chunks are kept;
6. land the rows as exact shards (the under-full ones of earlier runs topped up), quarantine and journal records, in folders that nobody reads yet;
7. publish: one rename makes the next generation list both the rows and the journal of the attempt.

An attempt is ``planned``, ``written``, ``committed`` or ``abandoned`` (files under ``attempts/``).  What is not published does not exist for
readers, so a crash at any point neither loses nor doubles rows.  A later run abandons unfinished attempts: it first publishes
a generation of its own, after which the old attempt can publish no more (fencing), and deletes their files.

Only planning values reach the driver: range bounds, numbers of seeds and files, one summary per partition.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decode as D
from ..operators import manifest as M
from ..operators import ranges as G
from ..registry import Registry
from ..schema import MANIFEST
from ..session import scratch_path
from ..sinks import shards as S
from ..sinks import snapshots as N
from ..sinks.layout import dataset_folder, run_name
from ..sinks.manifest import append_manifest, manifest_records
from ..sources.manifest import scan_manifest

MAX_ATTEMPTS = 40  # of a range and its halves: as many as halvings of any range of 64-bit blocks matter


@dataclass
class RunOutput:
    run_id: str
    seeds: int
    logs: int
    decoded: int
    filtered: int
    data_path: str
    manifest_path: str
    shards: int = 0
    failed: int = 0


# ---------------------------------------------------------------- attempts


def _note(spark: SparkSession, out_dir: str, attempt: str, state: str, **more) -> None:
    N.write_text(spark, f"{out_dir}/attempts/{attempt}.{state}", json.dumps({"attempt": attempt, "state": state} | more))


def attempts(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Last state of each attempt."""
    order = ["planned", "written", "committed", "abandoned"]
    last: dict[str, str] = {}
    for name in N.names(spark, f"{out_dir}/attempts"):
        attempt, state = name.rsplit(".", 1)
        last[attempt] = max(state, last.get(attempt, state), key=order.index)
    return last


def _fenced(spark: SparkSession, out_dir: str, data_path: str) -> N.Snapshot:
    """The newest generation, with every unfinished attempt shut out and cleared away."""
    snap = N.latest(spark, data_path)
    listed = set(snap.state.get("journal", []))
    open_ones = []
    for attempt, state in attempts(spark, out_dir).items():
        if state in ("planned", "written"):
            if attempt in listed:  # published, only the note is missing
                _note(spark, out_dir, attempt, "committed", generation=snap.number)
            else:
                open_ones.append(attempt)
    if open_ones:
        snap = N.publish(spark, data_path, N.prepare(spark, data_path, snap.next([], list(snap.tails), [])))
    for attempt in open_ones:
        if attempt in snap.state.get("journal", []):
            continue
        for part in ("manifests", "quarantine"):
            N.delete(spark, f"{out_dir}/{part}/attempt={attempt}")
        _note(spark, out_dir, attempt, "abandoned", generation=snap.number)
    return snap


# ---------------------------------------------------------------- coverage and planning


def journal(spark: SparkSession, out_dir: str) -> DataFrame:
    """Records of committed attempts."""
    return _journal(spark, out_dir, N.latest(spark, f"{out_dir}/data"))


def _journal(spark: SparkSession, out_dir: str, snap: N.Snapshot) -> DataFrame:
    listed = [f"{out_dir}/manifests/attempt={a}" for a in snap.state.get("journal", [])]
    if not listed:
        empty = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MANIFEST.fields)
        return spark.createDataFrame([], f"file string, line_no int, {empty}, address string, topics array<string>")
    return scan_manifest(spark, listed, pattern="*.json")


def _coverage(spark: SparkSession, out_dir: str, snap: N.Snapshot, address: str | None) -> DataFrame:
    """``(topic, from_block, to_block)`` of what is done for the address (or for all addresses)."""
    done = _journal(spark, out_dir, snap).where(F.col("status") == "done")
    known = F.col("address").isNull()
    if address is not None:
        known = known | (F.col("address") == address.lower())
    return done.where(known).select(F.explode("topics").alias("topic"), "from_block", "to_block")


def _rounds(seeds: DataFrame, bad: DataFrame, step: int, max_attempts: int) -> tuple[DataFrame, DataFrame]:
    """Chunks without a malformed log ``(from, to, keys, attempts)``, and all that failed ``(.., attempts, error)``.

    ``bad(block_number, error)``: a failing chunk goes to halves, which are tried in the next round."""
    spark = seeds.sparkSession
    schema = seeds.withColumn("attempts", F.lit(1)).schema

    def tried(chunks: DataFrame, attempt: int) -> tuple[DataFrame, DataFrame]:
        hit = M.assign_chunks(bad, chunks, bucket=step).groupBy(F.col("chunk_from").alias("from_block"), F.col("chunk_to").alias("to_block")).agg(
            F.min("error").alias("error"))
        both = scratch_path(spark, "round")
        chunks.withColumn("attempts", F.lit(attempt)).join(hit, ["from_block", "to_block"], "left").write.parquet(both)
        found = spark.read.parquet(both)
        return found.where("error is null").select(schema.names), found.where("error is not null")

    kept, failing = tried(seeds, 1)
    failed = failing
    for attempt in range(2, max_attempts + 1):
        split = failing.where("from_block < to_block")
        if split.isEmpty():
            break
        halves = G.bisect(split).join(split.select(F.col("from_block").alias("parent_from"), F.col("to_block").alias("parent_to"), "keys"), ["parent_from", "parent_to"])
        good, failing = tried(halves.select("from_block", "to_block", "keys"), attempt)
        kept, failed = kept.unionByName(good), failed.unionByName(failing)
    return kept, failed


# ---------------------------------------------------------------- the run


def run(
    spark: SparkSession,
    logs: DataFrame,
    registry: Registry,
    out_dir: str,
    start="earliest",
    end="latest",
    step: int = 5_000,
    semantics: str = "reference",
    run_id: str | None = None,
    address: str | None = None,
    rows_per_shard: int = S.DEFAULT_ROWS_PER_SHARD,
    per_event: bool = False,
    final_partial: bool = True,
    on_error: str = "quarantine",
    max_attempts: int = MAX_ATTEMPTS,
    topics_only: bool = False,
) -> RunOutput:
    """Decode what the journal of this dataset does not cover yet, for each topic of the registry.

    ``topics_only`` leaves logs of other topics to the scan's filter (their ``topic0`` must be lower-case); else they are counted as filtered, in blocks
    where nothing was done before.  Without ``final_partial`` the rows of under-full shards are kept aside, unseen by readers, for a later run (or
    ``compact_tail``) to fill up.  ``on_error="fail"`` fails chunks with malformed logs; else such logs go to quarantine."""
    from ..sources.logs import resolve_range

    if on_error not in ("quarantine", "fail"):
        raise ValueError("on_error must be 'quarantine' or 'fail'")
    data_path, manifest_path = os.path.join(out_dir, "data"), os.path.join(out_dir, "manifests")
    topics = sorted(registry.topic0s())
    if address is not None:
        logs = logs.where(F.lower("address") == address.lower())
    if topics_only:
        logs = logs.where(F.col("topic0").isin(topics))
    snap = _fenced(spark, out_dir, data_path)
    bounds = resolve_range(logs, start, end).collect()[0]  # one row
    lo, hi = bounds["start_block"], bounds["end_block"]
    nothing = RunOutput(run_id or "", 0, 0, 0, 0, data_path, manifest_path)
    if lo is None or hi is None:
        return nothing
    seeds_path = scratch_path(spark, "seeds")
    G.topic_seeds(_coverage(spark, out_dir, snap, address), topics, int(lo), int(hi), step).write.parquet(seeds_path)
    seeds = spark.read.parquet(seeds_path)
    span = seeds.agg(F.count("*").alias("n"), F.min("from_block").alias("a"), F.max("to_block").alias("b")).first()
    if not span["n"]:
        return nothing
    attempt = run_name(span["a"], span["b"])
    run_id = run_id or attempt
    _note(spark, out_dir, attempt, "planned", run_id=run_id, from_block=span["a"], to_block=span["b"], base=snap.number)

    # one pass over the lake
    scoped = logs.where(F.col("block_number").between(span["a"], span["b"]))
    tagged = M.assign_chunks(scoped, seeds, bucket=step, n_chunks=span["n"] * max(1, len(topics)), carry=("keys",))
    t0 = F.lower(F.coalesce(F.get("topics", F.lit(0)), F.lit("")))
    tagged = tagged.where(F.array_contains("keys", t0) | (~t0.isin(topics) & (F.size("keys") == len(topics))))
    malformed = F.col("filter_reason").isin(*D.ERROR_REASONS)
    tags = {"chunk_from": F.col("chunk_from"), "chunk_to": F.col("chunk_to"), "raw": F.when(malformed, F.struct(*logs.columns))}
    stage = scratch_path(spark, "stage")
    D.decode(tagged, registry, semantics, tags=tags).write.option("compression", "zstd").parquet(stage)
    staged = spark.read.parquet(stage)

    bad = staged.where(F.col("raw").isNotNull())
    failed = None
    chunks = seeds.withColumn("attempts", F.lit(1))
    if on_error == "fail":
        reasons = bad.select(F.col("raw.block_number").alias("block_number"), F.concat(F.lit("malformed log ("), F.col("filter_reason"), F.lit(")")).alias("error"))
        reasons = reasons.where("block_number is not null").distinct()
        if not reasons.isEmpty():
            chunks, failed = _rounds(seeds, reasons, step, max_attempts)
            inner = M.assign_chunks(staged.drop("chunk_from", "chunk_to"), chunks, bucket=step)  # what failed finds no chunk
            again = scratch_path(spark, "stage")
            inner.write.option("compression", "zstd").parquet(again)
            staged = spark.read.parquet(again)
        bad = staged.where("false")

    rows = staged.where("filter_reason is null").drop("filter_reason", "raw", "chunk_to").withColumn("run_id", F.lit(attempt))
    add, tails, drop = S.stage_append(spark, data_path, snap, rows, rows_per_shard, per_event, final_partial)
    bad.select("raw.*", "filter_reason").write.mode("overwrite").parquet(os.path.join(out_dir, "quarantine", f"attempt={attempt}"))
    records = _records(spark, data_path, staged, chunks, failed, sorted({*add, *tails}), attempt, run_id)
    records = records.withColumn("address", F.lit(address.lower() if address else None).cast("string"))
    append_manifest(records, f"{manifest_path}/attempt={attempt}")
    _note(spark, out_dir, attempt, "written", commits=add)

    listed = [*snap.state.get("journal", []), attempt]
    done = N.publish(spark, data_path, N.prepare(spark, data_path, snap.next(add, tails, drop, snap.state | {"journal": listed})))
    _note(spark, out_dir, attempt, "committed", generation=done.number)
    landed = scan_manifest(spark, f"{manifest_path}/attempt={attempt}", pattern="*.json")
    t = M.run_stats(landed).first()
    files = 0 if not add else N.read(spark, data_path, tuple(add)).select(F.col("_metadata.file_path").alias("f")).distinct().count()
    return RunOutput(run_id, span["n"], t["total_logs"], t["total_decoded"], t["total_filtered"], data_path, manifest_path, files, t["processed_failed"])


def _records(spark, data_path, staged, chunks, failed, add, attempt, run_id) -> DataFrame:
    """Journal records, from the columns and files that were written."""
    chunk = ["from_block", "to_block"]
    of = [F.col("chunk_from").alias("from_block"), F.col("chunk_to").alias("to_block")]
    kept = F.col("filter_reason").isNull()
    stats = staged.groupBy(*of).agg(F.count("*").alias("logs"), F.count_if(kept).alias("decoded"), F.count_if(~kept).alias("filtered"))
    stats = chunks.join(stats, chunk, "left").na.fill(0, ["logs", "decoded", "filtered"])
    if add:
        landed = N.read(spark, data_path, tuple(add)).where(F.col("run_id") == attempt)
        files = landed.groupBy(F.col("chunk_from").alias("from_block"), "event", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
        per_event = files.groupBy("from_block", "event").agg(F.sum("n").alias("n"), F.count("*").alias("files"))
        per_chunk = per_event.groupBy("from_block").agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("event", "n")))).alias("rows_per_event"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("event", "files")))).alias("shards_written"))
        shards = files.select("from_block", "f").distinct().groupBy("from_block").agg(F.count("*").alias("shards"))
        stats = stats.join(per_chunk, "from_block", "left").join(shards, "from_block", "left").na.fill(0, ["shards"])
    else:
        none = F.lit(None).cast("map<string,bigint>")
        stats = stats.withColumn("rows_per_event", none).withColumn("shards_written", none).withColumn("shards", F.lit(0).cast("long"))
    done = manifest_records(stats, run_id, extra=("topics",), topics=F.col("keys"))
    if failed is None:
        return done
    lost = failed.select(*chunk, "keys", "attempts", "error", *[F.lit(0).cast("long").alias(c) for c in ("logs", "decoded", "filtered")])
    return done.unionByName(manifest_records(lost, run_id, status="failed", extra=("topics",), topics=F.col("keys")))


def fetch(
    spark: SparkSession, logs: DataFrame, registry: Registry, out_root: str, address: str, start="earliest", end="latest",
    layout: str = "legacy", protocol: str | None = None, contract: str | None = None, **options,
) -> RunOutput:
    """The whole job of one address in one call: its dataset's folder under ``out_root`` (by address and topic set, or by
    ``protocol`` and ``contract`` with one table of shards per event), then ``run`` with the other ``options``."""
    folder = dataset_folder(out_root, address, registry.topic0s(), layout, protocol, contract)
    per_event = layout == "per_event" and bool(protocol and contract)
    return run(spark, logs, registry, folder, start, end, address=address, per_event=per_event, **options)


def read_decoded(spark: SparkSession, data_path: str) -> DataFrame:
    """Decoded rows of all committed runs; ``run_id`` names the attempt that landed a row."""
    return S.read_shards(spark, data_path).drop("chunk_from")
