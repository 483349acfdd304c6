"""Scan of JSON-lines coverage journals (manifest files).

Semantics kept from the reference journal reader: blank lines are skipped; the
first corrupt line of a file (unparseable, not an object, or a ``done`` record
without integer bounds) discards that line **and the rest of the file**, while
the lines before it still count.

Files are read in splits, each line parsed once: tasks number the lines of a split, a line's number in its file adds the counts of the
file's earlier splits, and the per-file cut-off is an aggregate joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

FIELDS = {
    "run_id": "string", "from_block": "bigint", "to_block": "bigint", "status": "string", "attempts": "int",
    "error": "string", "logs": "bigint", "decoded": "bigint", "shards": "bigint", "updated_at": "double",
    "filtered": "bigint", "shards_written": "map<string,bigint>", "rows_per_event": "map<string,bigint>",
    "address": "string", "topics": "array<string>",
}


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines ``(file, block, line)`` of each split, which come in order."""
    now, n = None, 0
    for b in batches:
        places = []
        for place in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if place != now:
                now, n = place, 0
            places.append(n)
            n += 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places, pa.int64())], ["file", "block", "line", "place"])


def scan_manifest(spark: SparkSession, path: str | list[str], pattern: str = "*.jsonl", exclude_basename: str | None = None) -> DataFrame:
    """Valid journal records: ``file, line_no`` + the manifest fields."""
    ship_package(spark)
    try:
        lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    except Exception as e:  # missing directory
        raise ValueError(f"manifest directory not readable: {path}") from e
    if exclude_basename:
        lines = lines.where(F.col("_metadata.file_name") != exclude_basename)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    lines = lines.mapInArrow(_lines, "file string, block long, line string, place long")
    v = F.col("v")
    is_obj = F.schema_of_variant(v).startswith("OBJECT")
    cols = {k: F.try_variant_get(v, f"$.{k}", t) for k, t in FIELDS.items()}
    bad = v.isNull() | ~F.coalesce(is_obj, F.lit(False)) | ((cols["status"] == "done") & (cols["from_block"].isNull() | cols["to_block"].isNull()))
    parsed = lines.select("file", "block", "place", (F.trim("line") == "").alias("_blank"), F.try_parse_json(F.trim("line")).alias("v"))
    parsed = parsed.select("file", "block", "place", "_blank", (bad & ~F.col("_blank")).alias("_bad"), *[c.alias(k) for k, c in cols.items()])
    at = scratch_path(spark, "journal")
    parsed.write.parquet(at)
    rec = spark.read.schema(parsed.schema).parquet(at)
    # a row per split, with the lines before it; and per file its first bad line
    blocks = rec.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("_bad"), F.col("place"))).alias("bad"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("cut", F.min(F.col("before") + F.col("bad")).over(Window.partitionBy("file"))).select("file", "block", "before", "cut")
    line_no = (F.col("before") + F.col("place")).cast("int").alias("line_no")
    good = rec.where(~F.col("_blank")).join(blocks, ["file", "block"]).select("file", line_no, "cut", *FIELDS)
    return good.where(F.col("cut").isNull() | (F.col("line_no") < F.col("cut"))).drop("cut")


def done_coverage(spark: SparkSession, path: str, pattern: str = "*.jsonl", exclude_basename: str | None = None) -> DataFrame:
    """``(from_block, to_block)`` of every valid ``done`` record (not yet merged)."""
    rec = scan_manifest(spark, path, pattern, exclude_basename)
    return rec.where(F.col("status") == "done").select("from_block", "to_block")
