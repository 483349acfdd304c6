"""Inclusive block-interval operators as DataFrame jobs.

Intervals are rows ``(from_block, to_block)``, both ends inclusive; ``keys`` (e.g. a topic) keep sets of intervals apart.

* ``chunk``      -- split each interval into ``step``-sized pieces, in two explosions so that no row holds a whole range.
* ``merge``      -- union of overlapping **or adjacent** intervals.
* ``subtract``   -- parts of a requested interval not covered.
* ``work_seeds`` -- ``subtract`` then ``chunk``; chunks restart at each gap start.
* ``open_sets``  -- intervals of several keys to disjoint intervals with the set of keys open there.
* ``grid``       -- global chunk grid anchored at the range start.
* ``bisect``     -- split failed ranges in two, never producing empty halves.

``merge``, ``subtract`` and ``open_sets`` are sweeps over range partitions: each partition merges its own sorted rows, hands on one
summary row per key (its last end, its open keys), and the summaries, composed in order, are joined back as what the
partition starts from.  Only these summaries (one per partition and key) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_path, ship_package

FROM, TO = "from_block", "to_block"
SPAN = 10_000  # chunks that one row is exploded into at most


def chunk(intervals: DataFrame, step: int, keep: bool = False, start: str = FROM, end: str = TO) -> DataFrame:
    """Inclusive chunks ``[x, min(end, x + step - 1)]`` for x = start, start + step, ..."""
    if step <= 0:
        raise ValueError("step must be positive")
    wide = F.lit(step * SPAN).cast("long")
    first = F.explode(F.sequence(F.col(start), F.col(end), wide)).alias("_span")
    df = intervals.where(F.col(start) <= F.col(end)).select("*", first)
    last = F.least(F.col(end), F.col("_span") + wide - 1)
    df = df.select("*", F.explode(F.sequence(F.col("_span"), last, F.lit(step).cast("long"))).alias("chunk_from")).drop("_span")
    df = df.withColumn("chunk_to", F.least(F.col(end), F.col("chunk_from") + F.lit(step - 1)))
    if keep:
        return df
    return df.select(F.col("chunk_from").alias(FROM), F.col("chunk_to").alias(TO))


def _sweep(n_keys: int):
    """Local islands of a partition's sorted ``(keys.., from, to)``: adds the partition and the end before (null: none)."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: tuple | None = None  # the open island: keys, from, to, end before
        names = None
        for b in batches:
            names = b.schema.names
            if not b.num_rows:
                continue
            keys = [b.column(i) for i in range(n_keys)]
            lo, hi = (b.column(n_keys + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            new_key = np.zeros(len(lo), bool)
            new_key[0] = held is None or held[0] != [k[0].as_py() for k in keys]
            for k in keys:
                new_key[1:] |= np.array(pc.not_equal(k[1:], k[:-1]).to_pylist(), bool)
            ends = np.empty(len(lo), np.int64)
            cuts = np.append(np.flatnonzero(new_key), len(lo))
            if not new_key[0]:
                ends[: cuts[0]] = np.maximum(np.maximum.accumulate(hi[: cuts[0]]), held[2])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                ends[i:j] = np.maximum.accumulate(hi[i:j])
            before = np.append(0 if held is None else held[2], ends[:-1])
            starts = np.flatnonzero(new_key | (lo > before + 1))
            if not len(starts) or starts[0] > 0:
                held = (*held[:2], int(ends[(starts[0] if len(starts) else len(lo)) - 1]), held[3])
            if len(starts):
                if held is not None:
                    yield _rows(names, [held], part)
                last = np.append(starts[1:], len(lo)) - 1
                values = [k.take(pa.array(starts)).to_pylist() for k in keys]
                prior = [None if n else int(p) for n, p in zip(new_key[starts], before[starts], strict=True)]
                found = [([v[i] for v in values], int(lo[s]), int(ends[e]), p) for i, (s, e, p) in enumerate(zip(starts, last, prior, strict=True))]
                held = found.pop()
                if found:
                    yield _rows(names, found, part)
        if held is not None:
            yield _rows(names, [held], part)

    return sweep


def _rows(names: list[str], found: list[tuple], part: int) -> pa.RecordBatch:
    columns = [pa.array(list(c)) for c in zip(*(f[0] for f in found), strict=True)]
    columns += [pa.array([f[i] for f in found], pa.int64()) for i in (1, 2, 3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(found), pa.int64())], [*names, "before", "part"])


def _islands(intervals: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, list[tuple]]:
    """``keys, from, to, before, part``: islands as far as the partitions see them, ``before`` being the last end of all
    earlier rows of the key (null: none); a row with ``from > before + 1`` opens an island of the whole.  And the ``(part, *keys)``
    that occur, in order."""
    spark = intervals.sparkSession
    ship_package(spark)
    iv = intervals.select(*keys, F.col(FROM).cast("long").alias(FROM), F.col(TO).cast("long").alias(TO)).where(F.col(FROM) <= F.col(TO))
    order = [*keys, FROM, TO]
    schema = StructType([*iv.schema.fields, StructField("before", LongType()), StructField("part", LongType())])
    path = scratch_path(spark, "islands")
    iv.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep(len(keys)), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    ends = local.groupBy("part", *keys).agg(F.max(TO).alias("last")).collect()  # a row for each partition and key in it
    ends = sorted(((r["part"], *[r[k] for k in keys], r["last"]) for r in ends), key=lambda r: r[0])
    carried, so_far = [], {}
    for part, *key, last in ends:
        known = so_far.get(tuple(key))
        carried.append((part, *key, known))
        so_far[tuple(key)] = last if known is None else max(last, known)
    places = [r[:-1] for r in ends]
    if all(c[-1] is None for c in carried):
        return local, places
    return _handed(local, keys, carried, "_end").withColumn("before", F.greatest("before", "_end")).drop("_end"), places


def _handed(rows: DataFrame, keys: tuple[str, ...], values: list[tuple], name: str) -> DataFrame:
    """``rows`` with the value that their partition and key start from."""
    spark = rows.sparkSession
    names = ["_part", *[f"_{k}" for k in keys]]
    types = ["long", *[rows.schema[k].dataType.simpleString() for k in keys]]
    small = spark.createDataFrame(values, ", ".join(f"{n} {t}" for n, t in zip([*names, name], [*types, "long"], strict=True)))
    on = F.col("part") == F.col("_part")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return rows.join(small, on).drop(*names)


def merge(intervals: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Minimal set of inclusive intervals covering the same blocks, for each of ``keys``."""
    rows, places = _islands(intervals, keys)
    if len({p[0] for p in places}) <= 1:
        return rows.select(*keys, FROM, TO)
    opens = F.col("before").isNull() | (F.col(FROM) > F.col("before") + 1)
    firsts = rows.where(opens).groupBy("part", *keys).agg(F.max(FROM).alias("first")).collect()  # a row for each partition and key in it
    own = {(r["part"], *[r[k] for k in keys]): r["first"] for r in firsts}
    owners, last = [], {}
    for place in places:
        owners.append((*place, last.get(place[1:])))
        last[place[1:]] = own.get(place, last.get(place[1:]))
    # what does not open an island in its partition (its first rows) belongs to the last start of an earlier one
    placed = _handed(rows, keys, owners, "_owner").withColumn("_island", F.when(opens, F.col(FROM)).otherwise(F.col("_owner")))
    return placed.groupBy(*keys, "_island").agg(F.max(TO).alias(TO)).select(*keys, F.col("_island").alias(FROM), TO)


def subtract(covered: DataFrame, start: int, end: int, every: DataFrame | None = None) -> DataFrame:
    """Sub-intervals of ``[start, end]`` not covered by ``covered``; for each row of ``every``, if its columns keep coverages apart."""
    spark = covered.sparkSession
    keys = tuple(every.columns) if every is not None else ()
    if start > end:
        return (every if keys else spark.range(0).select()).where("false").select(*keys, F.lit(0).cast("long").alias(FROM), F.lit(0).cast("long").alias(TO))
    if keys:
        covered = covered.join(every, list(keys), "left_semi")
    inside = covered.where((F.col(TO) >= start) & (F.col(FROM) <= end)).select(
        *keys, F.greatest(F.col(FROM).cast("long"), F.lit(start)).alias(FROM), F.least(F.col(TO).cast("long"), F.lit(end)).alias(TO))
    ends = spark.createDataFrame([(start - 1, start - 1), (end + 1, end + 1)], f"{FROM} long, {TO} long")
    bounds = every.select(*keys, F.explode(F.array(*[F.struct(F.lit(x).cast("long").alias(FROM), F.lit(x).cast("long").alias(TO)) for x in (start - 1, end + 1)])).alias("x")).select(
        *keys, "x.*") if keys else ends
    rows, _ = _islands(inside.unionByName(bounds), keys)
    return rows.where(F.col(FROM) > F.col("before") + 1).select(*keys, (F.col("before") + 1).alias(FROM), (F.col(FROM) - 1).alias(TO))


def open_sets(intervals: DataFrame, key: str) -> DataFrame:
    """Disjoint ``(from, to, keys)``: maximal stretches of blocks in which the same set of ``key`` has an interval.

    A sweep of signed boundaries: +1 where an interval of a key begins, -1 behind its end, added up by key."""
    spark = intervals.sparkSession
    ship_package(spark)
    signed = F.explode(F.array(F.struct(F.col(FROM).alias("pos"), F.lit(1).alias("sign")), F.struct((F.col(TO) + 1).alias("pos"), F.lit(-1).alias("sign"))))
    events = intervals.select(F.col(key).alias("key"), signed.alias("e")).groupBy(F.col("e.pos").alias("pos"), "key").agg(F.sum("e.sign").alias("sign")).where("sign <> 0")
    path = scratch_path(spark, "boundaries")
    events.repartitionByRange("pos").withColumn("part", F.spark_partition_id()).write.parquet(path)
    events = spark.read.schema("pos long, key string, sign long, part int").parquet(path)
    first = {r["part"]: r["pos"] for r in events.groupBy("part").agg(F.min("pos").alias("pos")).collect()}
    changes = events.groupBy("part", "key").agg(F.sum("sign").alias("n")).where("n <> 0").collect()  # at most partitions times keys
    parts, state, begins = sorted(first), {}, {}
    for p in parts:
        begins[p] = dict(state)
        for r in changes:
            if r["part"] == p:
                state[r["key"]] = state.get(r["key"], 0) + r["n"]
    follows = {p: first[q] for p, q in zip(parts, parts[1:])}

    def sweep(t: pa.Table) -> pa.Table:
        rows = sorted(zip(*(t[c].to_pylist() for c in ("pos", "key", "sign")), strict=True))
        part = t["part"][0].as_py()
        open_now, out = dict(begins[part]), []
        for i, (pos, k, sign) in enumerate(rows):
            open_now[k] = open_now.get(k, 0) + sign
            until = rows[i + 1][0] if i + 1 < len(rows) else follows.get(part, pos)
            keys = sorted(k for k, n in open_now.items() if n > 0)
            if until > pos and keys:
                out.append((pos, until - 1, keys))
        return pa.table({FROM: pa.array([o[0] for o in out], pa.int64()), TO: pa.array([o[1] for o in out], pa.int64()),
                         "keys": pa.array([o[2] for o in out], pa.list_(pa.string()))})

    return events.groupBy("part").applyInArrow(sweep, f"{FROM} long, {TO} long, keys array<string>")


def work_seeds(covered: DataFrame, start: int, end: int, step: int) -> DataFrame:
    return chunk(subtract(covered, start, end), step)


def topic_seeds(covered: DataFrame, topics: list[str], start: int, end: int, step: int) -> DataFrame:
    """``(from, to, keys)``: chunks of ``[start, end]`` with the topics that ``covered(topic, from, to)`` does not have there."""
    spark = covered.sparkSession
    every = spark.createDataFrame([(t,) for t in sorted(set(topics))], "topic string")
    gaps = subtract(covered, start, end, every)
    pieces = chunk(open_sets(gaps, "topic"), step, keep=True)
    return pieces.select(F.col("chunk_from").alias(FROM), F.col("chunk_to").alias(TO), "keys")


def grid(spark: SparkSession, start: int, end: int, step: int) -> DataFrame:
    """Global chunk grid over ``[start, end]`` (raw-fetch planning)."""
    if step <= 0:
        raise ValueError("step must be positive")
    return spark.range(start, end + 1, step).select(F.col("id").alias(FROM), F.least(F.col("id") + (step - 1), F.lit(end)).alias(TO))


def bisect(failed: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Halves ``[s, mid]`` and ``[mid + 1, e]`` (mid = floor) of failed ranges.

    A single-block range is not split (it is retried as is); ranges that used up
    ``max_attempts`` are terminal and produce nothing.
    """
    df = failed
    if max_attempts is not None and "attempts" in df.columns:
        df = df.where(F.coalesce(F.col("attempts"), F.lit(0)) < max_attempts)
    s, e = F.col(FROM), F.col(TO)
    mid = F.floor((s + e) / 2).cast("long")
    halves = F.when(s == e, F.array(F.struct(s.alias("a"), e.alias("b")))).otherwise(
        F.array(F.struct(s.alias("a"), mid.alias("b")), F.struct((mid + 1).alias("a"), e.alias("b")))
    )
    out = df.where(s <= e).select(F.col(FROM).alias("parent_from"), F.col(TO).alias("parent_to"), F.explode(halves).alias("h"))
    return out.select("parent_from", "parent_to", F.col("h.a").alias(FROM), F.col("h.b").alias(TO))
