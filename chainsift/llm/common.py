"""Shared helpers of the training-data operators: tables, scratch tables, Arrow text
buffers and vectorised word hashing.

Nothing here keeps more than one Arrow batch in memory; batches are cut into slices of
a bounded number of bytes (one text is the smallest slice).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root, ship_package
from ..sinks.snapshots import delete

SLICE_BYTES = 4 << 20
HASH_BLOCK = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def start(spark: SparkSession) -> None:
    """Make the package importable in the Python workers."""
    ship_package(spark)


_FOLDERS: ContextVar[tuple[str, ...]] = ContextVar("folders", default=())  # open working folders, innermost last
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; what is read later is written with ``outlives``."""
    folder = scratch(spark, "work")
    token = _FOLDERS.set((*_FOLDERS.get(), folder))
    try:
        yield
    finally:
        _FOLDERS.reset(token)
        delete(spark, folder)


def scratch(spark: SparkSession, name: str, outlives: bool = False) -> str:
    """A fresh path under the cluster's shared checkpoint folder (URI kept as it is), in the working folder if one is open."""
    folders = _FOLDERS.get()[: -1 if outlives else None]
    return f"{folders[-1] if folders else scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    return written_at(df, scratch(df.sparkSession, name, outlives))


def written_at(df: DataFrame, path: str) -> DataFrame:
    """The same at a path that the caller may delete early.

    The shuffle files of the write go with its end, since nothing reads them again; a lost task's are made anew while it runs."""
    spark = df.sparkSession
    schema = df.schema
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(schema).parquet(path)


def text_or_empty(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


# ---------------------------------------------------------------- Arrow text buffers


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets (one more than rows, from 0) of a string array; null is empty."""
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    o = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(batch: pa.RecordBatch, text_column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes (a longer text is a run by itself)."""
    n = batch.num_rows
    if n == 0:
        return
    _, o = text_buffer(batch.column(batch.schema.get_field_index(text_column)))
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(o, o[i] + limit, side="right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = min(j, n)


# ---------------------------------------------------------------- word hashing

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_SHIFT = _RNG.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    out[1:] = np.uint64(base)
    return np.cumprod(out, dtype=np.uint64)


_POW: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        m = max(n, 2 * HASH_BLOCK)
        _POW[0] = _powers(_BASE, m)
        _POW[1] = _powers(pow(_BASE, -1, 1 << 64), m)
    return _POW[0], _POW[1]


class Words:
    """Which bytes belong to words, and the byte that stands for each (case folding).

    ``separators`` are the bytes that are not part of words; A-Z count as a-z."""

    def __init__(self, separators: bytes) -> None:
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        lower = np.arange(256)
        lower[65:91] += 32
        self.inside[65:91] = self.inside[97:123]
        self.value = _BYTE[lower]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and how many words each text has."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        m = self.inside[data]
        before = np.empty_like(m)
        before[0] = False
        before[1:] = m[:-1]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        before[cuts] = False
        starts = np.flatnonzero(m & ~before)
        after = np.empty_like(m)
        after[-1] = False
        after[:-1] = m[1:]
        after[cuts[cuts > 0] - 1] = False
        ends = np.flatnonzero(m & ~after) + 1
        counts = np.diff(np.searchsorted(starts, offsets))
        return starts, ends, counts

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each folded word, in blocks of bytes so that memory stays bounded."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            lo = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, lo + HASH_BLOCK, side="right")))
            hi = int(ends[j - 1])
            if hi - lo > HASH_BLOCK:  # one very long word: block sums, each scaled by its place
                total = 0
                up, _ = _power_tables(HASH_BLOCK + 1)
                for k in range(lo, hi, HASH_BLOCK):
                    part = self.value[data[k : min(k + HASH_BLOCK, hi)]]
                    total += int(np.sum(part * up[: len(part)], dtype=np.uint64)) * pow(_BASE, k - lo, 1 << 64)
                out[i] = mix(np.array([(total + (hi - lo) * int(_STEP)) % (1 << 64)], np.uint64))[0]
                i += 1
                continue
            up, down = _power_tables(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(self.value[data[lo:hi]] * up[: hi - lo], dtype=np.uint64, out=sums[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _STEP)
            i = j
        return out


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes (``len(words) - size + 1`` of them)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        acc += words[k : k + n] * _SHIFT[k]
    return mix(acc)
