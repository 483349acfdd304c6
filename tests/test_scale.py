"""What keeps exchanges narrow and Python's work single as tables grow."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainsift import catalog, registry as R
from chainsift.operators.decode_long import decode_long
from chainsift.schema import ROW_ORDER
from chainsift.sinks import lake, shards

SF = catalog.FIXTURES  # name -> raw logs of a folder's tables
DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SF))
def test_lake_ranges_follow_the_rows_and_only_source_columns_are_exchanged(spark, monkeypatch, tmp_path, name):
    monkeypatch.setattr(lake, "ROWS_PER_FILE", 40)
    raw = SF[name](spark, DIR, arrange=lake.clustered)
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "lpad" not in below and "sha2" not in below
    path = lake.write_clustered(raw, str(tmp_path / "lake"))
    got = spark.read.parquet(path)
    plain = SF[name](spark, DIR)
    assert got.schema.names == plain.schema.names
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    files = got.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).orderBy("f").collect()
    assert len(files) > 1 and all(a["hi"] < b["lo"] for a, b in zip(files, files[1:]))


def test_python_looks_once_at_a_log_and_once_at_a_field(spark):
    logs = SF["events"](spark, DIR)
    plan = decode_long(logs, R.clpool_registry())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("checksum_address(") == 1 and plan.index("checksum_address(") > plan.index("Join")
    assert plan.count("wide_int_to_decimal(") == 1


def test_rows_of_python_functions_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("string")
    def told(c: pd.Series) -> pd.Series:
        seen.add(len(c))
        return c.astype(str)

    df = spark.range(1000, numPartitions=3).select(
        F.col("id").alias("block_number"), told("id").alias("tx_hash"), F.lit(0).cast("long").alias("log_index"))
    path = shards.sorted_files(df, ROW_ORDER, 100, 1000)
    assert spark.read.parquet(path).count() == 1000 and seen.value == 1000
