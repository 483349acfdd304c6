"""Sharded Parquet output of decoded tables.

* ``sorted_files`` / ``numbered`` -- rows sorted into files, and each row's exact position in the whole order (or within its
  group): the counts of earlier files plus the row's index in its own file.  No window over rows, no checkpoint.
* ``write_shards``     -- files of exactly ``rows_per_shard`` rows (the last one the rest), sorted by
  ``(block_number, tx_hash, log_index)``, zstd.
* ``write_per_event``  -- same, one directory per event (``partitionBy("event")``), each cut by itself.
* ``assign_shards``    -- position and shard id as columns.
* ``full_shards_only`` -- rows that fill complete shards; the remainder stays pending.
* ``compact_tail``     -- append to a sharded table: its under-full shards are re-written together with the new rows and
  one published generation replaces them (see ``snapshots``); ``recover`` publishes what a crash left decided.
* ``read_shards``      -- the newest generation (or a plain folder), schema merging, UINT_64 -> long.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..schema import ROW_ORDER
from ..session import scratch_path
from . import snapshots

DEFAULT_ROWS_PER_SHARD = 250_000
BYTES_PER_TASK = 256 << 20


def _parts(df: DataFrame, rows_per_shard: int, num_rows: int | None) -> int:
    """Partitions of an exchange: by rows if their number is known, else by the bytes of the scans below, at least the session's."""
    if num_rows is not None:
        return max(1, math.ceil(num_rows / rows_per_shard))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)  # a source that tells no size counts as nothing
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), known // BYTES_PER_TASK)


def sorted_files(df: DataFrame, order: list[str], rows_per_shard: int = DEFAULT_ROWS_PER_SHARD, num_rows: int | None = None) -> str:
    """Write ``df`` sorted, one file per range partition; returns the scratch path."""
    spark, path, made = df.sparkSession, scratch_path(df.sparkSession, "sorted"), None
    if "EvalPython" in df._jdf.queryExecution().optimizedPlan().toString():  # range partitioning reads its input twice: Python's rows are made once
        made = scratch_path(spark, "made")
        df.write.option("compression", "zstd").parquet(made)
        df = spark.read.schema(df.schema).parquet(made)
    df.repartitionByRange(_parts(df, rows_per_shard, num_rows), *order).sortWithinPartitions(*order).write.option("compression", "zstd").parquet(path)
    if made:
        snapshots.delete(spark, made)
    return path


def numbered(spark: SparkSession, path: str, schema, group: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``sorted_files`` (sorted by ``group`` first) with ``row_idx``, their 0-based position within the group."""
    rows = spark.read.schema(schema).parquet(path).select(
        "*", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy(*group, "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")).collect()  # a row per file (and group in it)
    offsets, so_far = [], {}
    for r in sorted(files, key=lambda r: r["_file"]):
        key = tuple(r[g] for g in group)
        offsets.append((*key, r["_file"], so_far.get(key, 0) - r["_first"]))
        so_far[key] = so_far.get(key, 0) + r["_n"]
    types = [f"`{g}` {schema[g].dataType.simpleString()}" for g in group]
    small = spark.createDataFrame(offsets, ", ".join([*types, "_file int", "_offset long"]))
    return rows.join(small, [*group, "_file"]).withColumn("row_idx", F.col("_row") + F.col("_offset")).drop("_file", "_row", "_offset")


def _write_cut(df: DataFrame, path: str, rows_per_shard: int, mode: str, num_rows: int | None, group: tuple[str, ...]) -> str:
    spark = df.sparkSession
    order = [*group, *ROW_ORDER]
    stage = sorted_files(df, order, rows_per_shard, num_rows)
    n = _parts(spark.read.schema(df.schema).parquet(stage), rows_per_shard, num_rows)
    rows = numbered(spark, stage, df.schema, group).withColumn("_shard", F.floor(F.col("row_idx") / rows_per_shard))
    # each task gets whole shards in order, so the limit cuts exactly between them
    out = rows.repartition(n, *group, "_shard").sortWithinPartitions(*group, "_shard", "row_idx").drop("_shard", "row_idx")
    writer = out.write.mode(mode).option("maxRecordsPerFile", rows_per_shard).option("compression", "zstd")
    (writer.partitionBy(*group) if group else writer).parquet(path)
    snapshots.delete(spark, stage)
    return path


def write_shards(
    decoded: DataFrame, path: str, rows_per_shard: int = DEFAULT_ROWS_PER_SHARD, mode: str = "append",
    num_rows: int | None = None,
) -> str:
    return _write_cut(decoded, path, rows_per_shard, mode, num_rows, ())


def event_dir(c: Column) -> Column:
    """Directory name of an event: empty / missing names go to ``unknown``."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def write_per_event(
    decoded: DataFrame, path: str, rows_per_shard: int = DEFAULT_ROWS_PER_SHARD, mode: str = "append",
    num_rows: int | None = None,
) -> str:
    return _write_cut(decoded.withColumn("event", event_dir(F.col("event"))), path, rows_per_shard, mode, num_rows, ("event",))


def _as_long(df: DataFrame) -> DataFrame:
    for f in df.schema.fields:
        if f.name in ("block_number", "block_timestamp", "log_index") and isinstance(f.dataType, DecimalType):
            df = df.withColumn(f.name, F.col(f.name).cast("long"))
    return df


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All live shards under ``path`` with the union schema; unsigned 64-bit ints read as long."""
    live = snapshots.read(spark, path)
    return _as_long(live if live is not None else spark.read.option("mergeSchema", "true").parquet(path))


def shard_sizes(spark: SparkSession, path: str, group: tuple[str, ...] = ()) -> DataFrame:
    """``(*group, file, rows)`` of the shards under ``path`` (from the files, not from what was asked for)."""
    rows = read_shards(spark, path)
    return rows.select(*group, F.col("_metadata.file_path").alias("file")).groupBy(*group, "file").agg(F.count(F.lit(1)).alias("rows"))


def assign_shards(df: DataFrame, rows_per_shard: int, tail_rows: int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``row_idx`` (0-based position in ``ROW_ORDER``) and ``shard_id``.

    ``shard_id = floor((tail_rows + row_idx) / rows_per_shard)``: ``tail_rows`` rows
    already sit in the open shard of an earlier run.
    """
    n = None if partitions is None else partitions * rows_per_shard
    out = numbered(df.sparkSession, sorted_files(df, ROW_ORDER, rows_per_shard, n), df.schema)
    return out.withColumn("shard_id", F.floor((F.col("row_idx") + F.lit(tail_rows)) / F.lit(rows_per_shard)).cast("long"))


def full_shards_only(df: DataFrame, rows_per_shard: int, tail_rows: int = 0) -> tuple[DataFrame, DataFrame]:
    """(rows of complete shards, pending remainder) -- the remainder is not written."""
    a = assign_shards(df, rows_per_shard, tail_rows)
    total = a.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    full_upto = ((tail_rows + total) // rows_per_shard) * rows_per_shard - tail_rows
    return a.where(F.col("row_idx") < full_upto), a.where(F.col("row_idx") >= full_upto)


# ---------------------------------------------------------------- sharded tables


def _adopted(spark: SparkSession, path: str) -> snapshots.Snapshot:
    """The newest generation; files that lie in a plain folder become its first commit."""
    snap = snapshots.latest(spark, path)
    if snap.number or not (loose := [n for n in snapshots.names(spark, path) if n.startswith("part-")]):
        return snap
    commit = snapshots.new_commit(snap)
    for n in loose:
        snapshots.move(spark, f"{path}/{n}", f"{path}/commit={commit}/{n}")
    return snapshots.publish(spark, path, snapshots.prepare(spark, path, snap.next([commit], [commit], [])))


def stage_append(spark: SparkSession, path: str, snap: snapshots.Snapshot, new_rows: DataFrame, rows_per_shard: int,
                 per_event: bool = False, final_partial: bool = True) -> tuple[list[str], list[str], list[str]]:
    """Write ``new_rows``, together with the under-full shards of ``snap``, as commits that nobody reads yet.

    Returns the commits to list, those that hold under-full shards, and the commits they replace.  Without
    ``final_partial`` the under-full shards are kept for the next top-up but not listed: readers see full shards only."""
    drop = list(snap.tails)
    rows = new_rows
    if drop:
        rows = snapshots.read(spark, path, tuple(drop)).unionByName(new_rows, allowMissingColumns=True)
    commit = snapshots.new_commit(snap)
    folder = f"{path}/commit={commit}"
    (write_per_event if per_event else write_shards)(rows, folder, rows_per_shard, mode="error")
    group = ("event",) if per_event else ()
    written = spark.read.option("basePath", path).parquet(folder) if any(n.startswith(("part-", "event=")) for n in snapshots.names(spark, folder)) else None
    if written is None:
        return [], [], drop
    sizes = written.select(F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    partial = [r["f"] for r in sizes.where(F.col("n") < rows_per_shard).collect()]  # one per event at most
    n_files = sizes.count()
    if not partial:
        return [commit], [], drop
    if len(partial) == n_files:
        return [commit] if final_partial else [], [commit], drop
    tail = snapshots.new_commit(snap)
    for f in partial:
        inside = f.split(f"commit={commit}/", 1)[1]
        snapshots.move(spark, f"{folder}/{inside}", f"{path}/commit={tail}/{inside}")
    return [commit, tail] if final_partial else [commit], [tail], drop


def _finish(spark: SparkSession, path: str, record: str) -> None:
    """Publish a decided compaction."""
    snapshots.publish(spark, path, record)


def recover(spark: SparkSession, path: str) -> None:
    """Publish compactions that were decided before a crash; those that came too late are dropped."""
    for name in snapshots.names(spark, path):
        if name.startswith(snapshots.PREPARED) and not name.endswith(".part"):
            try:
                _finish(spark, path, name)
            except snapshots.ConcurrentCommit:
                pass


def compact_tail(spark: SparkSession, path: str, new_rows: DataFrame, rows_per_shard: int, per_event: bool = False) -> list[str]:
    """Append ``new_rows``, topping up under-full shards (schemas merged by name).  Returns the commits that were replaced.

    Readers see the table before or after, never between; if another writer was faster, ``ConcurrentCommit`` is raised and
    nothing has changed."""
    recover(spark, path)
    snap = _adopted(spark, path)
    add, tails, drop = stage_append(spark, path, snap, new_rows, rows_per_shard, per_event)
    _finish(spark, path, snapshots.prepare(spark, path, snap.next(add, tails, drop)))
    return drop
