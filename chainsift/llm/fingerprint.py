"""Quartile bucket digests: locality-sensitive fingerprints of whole texts.

Every byte triplet of a text (three bytes next to each other, and two patterns with one byte left out) is hashed into one
of 256 buckets.  The digest holds two bits per bucket (the quartile of its count among all buckets), the ratios
of the quartiles, and the length on a logarithmic scale.  Two digests differ by a bounded score; likeness is
one less the score over its bound.

Null and empty texts have the digest of no triplets; equal texts have equal digests.  Texts of any length
are counted in blocks.  Empty tables give empty tables; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import start, table, text_or_empty, written

BUCKETS = 256
BLOCK = 1 << 20
_A, _B, _C = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
_SALTS = tuple(np.uint32(x) for x in (0x27D4EB2F, 0x165667B1, 0xD3A2646C))
_APART = np.array([0, 1, 3, 6])  # score of two quartile codes by their distance
LENGTH_STEPS, RATIO_STEPS = 24, 15
BOUND = 6 * BUCKETS * 0.5 + LENGTH_STEPS * 4 + 2 * RATIO_STEPS * 2


def _triplets(data: np.ndarray) -> np.ndarray:
    """Counts of the hashed triplets of one text."""
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, max(1, len(data)), BLOCK):
        d = data[lo : lo + BLOCK + 3].astype(np.uint32)
        n = len(d)
        for salt, (i, j) in zip(_SALTS, ((1, 2), (1, 3), (2, 3)), strict=True):
            m = min(BLOCK, n - j)
            if m > 0:
                h = (d[:m] * _A) ^ (d[i : i + m] * _B + salt) ^ (d[j : j + m] * _C)
                h = (h ^ (h >> np.uint32(15))) * _A
                counts += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return counts


def digest(text: bytes) -> str:
    """The digest in hex: length byte, two quartile ratios, then two bits for each bucket."""
    counts = _triplets(np.frombuffer(text, np.uint8))
    q1, q2, q3 = np.partition(counts, (63, 127, 191))[[63, 127, 191]]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(255, int(math.log(len(text) + 1, 1.1)))
    ratios = [int(q * RATIO_STEPS / q3) if q3 else 0 for q in (q1, q2)]
    return bytes([length, ratios[0] * 16 + ratios[1], *packed.tolist()]).hex()


def _codes(d: str) -> tuple[int, int, int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(d), np.uint8)
    codes = (raw[2:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return int(raw[0]), int(raw[1]) >> 4, int(raw[1]) & 15, codes.reshape(-1).astype(np.int64)


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 from the bound of the difference score on."""
    if a == b:
        return 1.0
    (la, pa_, qa, ca), (lb, pb, qb, cb) = _codes(a), _codes(b)
    score = int(_APART[np.abs(ca - cb)].sum()) + 4 * min(LENGTH_STEPS, abs(la - lb)) + 2 * (abs(pa_ - pb) + abs(qa - qb))
    return max(0.0, 1.0 - score / BOUND)


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = ("part int, head boolean, open boolean, doc_id long, text string, n_chars long, fingerprint string, edited_sha256 string, "
        "edited_fingerprint string, near_edited double, near_next double")
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_KINDS = [pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compare(doc_id: int | None, text: str, fp: str, following: str, following_fp: str) -> tuple:
    edited = _edited(text, following).encode()
    edited_fp = digest(edited)
    return (doc_id, None, len(text), fp, hashlib.sha256(edited).hexdigest(), edited_fp, likeness(fp, edited_fp), likeness(fp, following_fp))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each with the next one.  The first row's text is passed on; the last row stays open."""
    part = TaskContext.get().partitionId()
    last, rows = None, []
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), (x.as_py() for x in b.column(1)), strict=True):
            fp = digest(text.encode())
            if last is None:
                rows.append((part, True, False, None, text, None, fp, None, None, None, None))
            else:
                rows.append((part, False, False, *_compare(*last, text, fp)))
            last = (doc_id, text, fp)
            if len(rows) >= 1000:
                yield _batch(rows)
                rows = []
    if last is not None:
        rows.append((part, False, True, last[0], last[1], None, last[2], None, None, None, None))
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(_KINDS)], _NAMES)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield _batch([(r["part"], False, False, *_compare(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_fp"]))
                      for r in b.to_pylist()])


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its text with the second half replaced by the next row's beginning, and the
    likeness of both and of the next row's.  The order is descending id (nulls last), then text; the first follows the last.

    One exchange by ranges of the id; only the first and the last text of every range go further."""
    start(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    done = written(ranges.mapInArrow(_neighbours, _OUT), "fingerprints")
    heads = done.where("head")
    parts = [r["part"] for r in heads.select("part").orderBy("part").collect()]  # a number for each range
    following = docs.sparkSession.createDataFrame(
        [(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, next int")
    last = done.where("open").join(following, "part").join(
        heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp")), "next")
    closed = last.select("part", "doc_id", "text", "fingerprint", "next_text", "next_fp").mapInArrow(_close, _OUT)
    return done.where("not head and not open").unionAll(closed).drop("part", "head", "open", "text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([digest(x.as_py().encode()) for x in b.column(1)], pa.string())], ["row", "fingerprint"])


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(row, fingerprint)`` for every row; ``row`` is a struct of its columns."""
    start(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(_digests, f"row {rows.schema['row'].dataType.simpleString()}, fingerprint string")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
