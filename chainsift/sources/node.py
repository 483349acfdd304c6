"""``evm_logs``: a PySpark Python Data Source over a pluggable log transport.

Batch reads split ``[from_block, to_block]`` into ``step``-block input partitions
(one range request each, run in parallel by the executors); streaming reads use
the block number as offset (``latestOffset`` = head minus ``confirmations``), so a
``trigger(availableNow=True)`` query catches up from its checkpoint to the head.

The transport is named by the ``transport`` option (``"module:Class"``) and built
on the executors from the reader options.  It must offer

* ``get_logs(address, topic0s, from_block, to_block) -> pyarrow.Table`` (raw_logs schema)
* ``latest_block() -> int``

No transport is shipped: a log lake is read with ``spark.read`` (see ``sources/logs.py``), and JSON-RPC
objects become raw logs by ``normalize_raw``.
"""

from __future__ import annotations

import importlib
import json

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA_DDL = (
    "address string, topic0 string, topics array<string>, data string, block_number bigint, "
    "block_timestamp bigint, tx_hash string, log_index bigint"
)
ARROW_SCHEMA = pa.schema(
    [
        ("address", pa.string()),
        ("topic0", pa.string()),
        ("topics", pa.list_(pa.string())),
        ("data", pa.string()),
        ("block_number", pa.int64()),
        ("block_timestamp", pa.int64()),
        ("tx_hash", pa.string()),
        ("log_index", pa.int64()),
    ]
)


class BlockRange(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start = start
        self.end = end


def _transport(options: dict):
    spec = options.get("transport")
    if not spec:
        raise ValueError("option 'transport' names a 'module:Class'")
    mod, _, attr = spec.partition(":")
    return getattr(importlib.import_module(mod), attr)(options)


def _topic0s(options: dict) -> list[str]:
    raw = options.get("topic0s", "")
    return [t.strip().lower() for t in raw.split(",") if t.strip()]


def _ranges(start: int, end: int, step: int) -> list[BlockRange]:
    return [BlockRange(a, min(end, a + step - 1)) for a in range(start, end + 1, step)]


def _read(options: dict, part: BlockRange):
    t = _transport(options)
    table = t.get_logs(options.get("address"), _topic0s(options), part.start, part.end)
    yield from table.cast(ARROW_SCHEMA).to_batches()


class EvmLogsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        start = int(self.options.get("from_block", "0"))
        end = self.options.get("to_block", "latest")
        end = _transport(self.options).latest_block() if str(end).lower() == "latest" else int(end)
        return _ranges(start, end, int(self.options.get("step", "5000")))

    def read(self, partition):
        return _read(self.options, partition)


class EvmLogsStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options

    def initialOffset(self):
        return {"block": int(self.options.get("from_block", "0")) - 1}

    def latestOffset(self):
        head = _transport(self.options).latest_block() - int(self.options.get("confirmations", "0"))
        return {"block": head}

    def partitions(self, start, end):
        s = start["block"] + 1 if isinstance(start, dict) else json.loads(start)["block"] + 1
        e = end["block"] if isinstance(end, dict) else json.loads(end)["block"]
        if s > e:
            return []
        return _ranges(s, e, int(self.options.get("step", "5000")))

    def read(self, partition):
        return _read(self.options, partition)

    def commit(self, end):
        pass


class EvmLogsDataSource(DataSource):
    @classmethod
    def name(cls):
        return "evm_logs"

    def schema(self):
        return SCHEMA_DDL

    def reader(self, schema):
        return EvmLogsReader(self.options)

    def streamReader(self, schema):
        return EvmLogsStreamReader(self.options)


def register(spark) -> None:
    """Register ``evm_logs``.  The module is pickled by value, so the Python processes
    that plan and read the source (including the streaming planner, which does not
    see ``addPyFile`` archives) need not import this package."""
    import sys

    from pyspark import cloudpickle

    from ..session import ship_package

    ship_package(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(EvmLogsDataSource)
