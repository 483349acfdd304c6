"""Connected components of an edge table, by alternating large-star and small-star steps.

Each partition first shrinks its own edges to a forest (union-find, memory bounded by the
partition's nodes), then the star steps run as joins and aggregations until the edges stop
changing.  Every round is written to the shared folder, so lineage stays short and a lost
executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import start, working_tables, written


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node and smallest node of its component, for nodes that are not the smallest."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        old = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(old, label):
            break
    keep = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[keep], nodes[label[keep]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        u = np.concatenate([u, b.column(0).to_numpy(zero_copy_only=False)])
        v = np.concatenate([v, b.column(1).to_numpy(zero_copy_only=False)])
        if len(u):
            u, v = forest(u, v)
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(u, v)``; component is the smallest node reached.

    Self-loops, repeated and reversed edges are harmless; rows with a null end are ignored;
    no edges give an empty table.  Only the last round's table stays."""
    spark = edges.sparkSession
    start(spark)
    with working_tables(spark):
        now = written(_stars(edges), "stars", outlives=True)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))


def _stars(edges: DataFrame) -> DataFrame:
    """``(u, v)``: every node but the smallest of its component, with that."""
    cleaned = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u is not null and v is not null and u <> v")
    now = written(cleaned.mapInArrow(_local, "u long, v long").distinct(), "cc")
    before = None
    while True:
        n, total = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not n or (n, total) == before:
            return now
        before = (n, total)
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = written(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
