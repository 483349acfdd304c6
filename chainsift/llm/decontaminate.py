"""Benchmark decontamination: windows of ten item words, looked up in every document.

The items' windows (an item of fewer words is one window) are normalised, hashed and broadcast as
a hash set; each document's token windows are scanned against it, hits are verified word by word,
and documents report or lose the hit words.  The set is broadcast only up to ``broadcast_limit``
windows.  Beyond that, a bit table of fixed size is broadcast as a first sieve and the windows that
pass it are joined with the items by a shuffle; results are the same.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` with A-Z folded.  Null texts have no words
(documents) or no windows (items).  An item without an id marks words but is not listed; rows with
the same item id are one item.  Repeated documents each get a row; empty tables give empty or unmarked
results; only the named columns are read, so further columns cannot clash (``decontaminate`` keeps them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, slices, start, table, text_buffer, text_or_empty, windows

WORDS = Words(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
BROADCAST_LIMIT = 500_000
SIEVE_BITS = 23

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_ROW = "n_words long, n_hit long, items array<string>, kept_text string"
_COLUMNS = ["n_words", "n_hit", "items", "kept_text"]


class _Texts:
    """Words of a run of texts: byte spans, hashes, and which text each word is in."""

    def __init__(self, part: pa.RecordBatch, column: str = "text") -> None:
        self.data, self.offsets = text_buffer(part.column(part.schema.get_field_index(column)))
        self.starts, self.ends, self.counts = WORDS.spans(self.data, self.offsets)
        self.hashes = WORDS.hashes(self.data, self.starts, self.ends)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)

    def at(self, i: int, n: int) -> bytes:
        """The folded words of window ``i``."""
        return b" ".join(self.data[self.starts[k] : self.ends[k]].tobytes().translate(_FOLD) for k in range(i, i + n))

    def places(self, n: int, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of ``n`` words inside one text that pass the sieve, and their hashes."""
        h = windows(self.hashes, n)
        i = np.flatnonzero(sieve[(h >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)]) if len(h) else np.zeros(0, np.int64)
        i = i[self.owner[i] == self.owner[i + n - 1]]
        return i, h[i]


def _item_windows(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b):
                t = _Texts(part)
                ids = part.column(0).to_pylist()
                rows: dict[str, list] = {"h": [], "n": [], "words": [], "item": []}
                for k, m in enumerate(t.counts.tolist()):
                    n, lo = min(size, m), int(t.first[k])
                    for i, h in enumerate(windows(t.hashes[lo : lo + m], n).view(np.int64).tolist() if n else []):
                        for column, value in zip(rows, (h, n, t.at(lo + i, n).decode(), ids[k]), strict=True):
                            rows[column].append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["h"], pa.int64()), pa.array(rows["n"], pa.int32()), pa.array(rows["words"], pa.string()),
                     pa.array(rows["item"], pa.string())], list(rows))

    return run


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct ``(h, n, words, item)`` of the items."""
    texts = items.select(F.col(id_col).cast("string").alias("item"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(_item_windows(size), "h long, n int, words string, item string").distinct()


def _sieve(hashes: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << SIEVE_BITS, bool)
    table[(hashes.view(np.uint64) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
    return table


def _row(t: _Texts, k: int, found: list[tuple[int, int, str | None]]) -> tuple:
    """Counts, items and the text without its hit words, of text ``k``; ``found``: word, length, item."""
    lo, m = int(t.first[k]), int(t.counts[k])
    whole = t.data[t.offsets[k] : t.offsets[k + 1]].tobytes()
    if not found:
        return m, 0, [], whole.decode("utf-8", "replace")
    edge = np.zeros(m + 1, np.int64)
    for i, n, _ in found:
        edge[i - lo] += 1
        edge[i - lo + n] -= 1
    hit = np.cumsum(edge)[:m] > 0
    change = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out, last, base = [], 0, int(t.offsets[k])
    for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
        out.append(whole[last : int(t.starts[lo + a]) - base])
        last = int(t.ends[lo + b - 1]) - base
    out.append(whole[last:])
    return m, int(hit.sum()), sorted({x for _, _, x in found if x is not None}), b"".join(out).decode("utf-8", "replace")


def _emit(part: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string()]
    new = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([part.column(0), *new], [part.schema.names[0], *_COLUMNS])


def _scan(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, sieve, known = shared.value
        for b in batches:
            for part in slices(b):
                t = _Texts(part)
                found: dict[int, list] = {}
                for n in lengths:
                    for i, h in zip(*(x.tolist() for x in t.places(n, sieve)), strict=True):
                        for words, item in known.get((h, n), ()):
                            if t.at(i, n) == words:
                                found.setdefault(int(t.owner[i]), []).append((i, n, item))
                yield _emit(part, [_row(t, k, found.get(k, [])) for k in range(part.num_rows)])

    return run


def _candidates(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, sieve = shared.value
        for b in batches:
            for part in slices(b):
                t, key = _Texts(part), part.column(0)
                for n in lengths:
                    i, h = t.places(n, sieve)
                    if len(i):
                        yield pa.RecordBatch.from_arrays(
                            [key.take(pa.array(t.owner[i])), pa.array(h.view(np.int64)), pa.array(np.full(len(i), n, np.int32)),
                             pa.array([t.at(x, n).decode() for x in i.tolist()]), pa.array(i - t.first[t.owner[i]])],
                            ["key", "h", "n", "words", "i"])

    return run


def _joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in slices(b):
            t = _Texts(part)
            found = part.column(part.schema.get_field_index("found")).to_pylist()
            yield _emit(part, [_row(t, k, [(int(t.first[k]) + x["i"], x["n"], x["item"]) for x in found[k] or []])
                               for k in range(part.num_rows)])


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
         size: int = 10, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``(row, n_words, n_hit, items, kept_text)`` for every row; ``row`` is a struct of its columns."""
    spark = docs.sparkSession
    start(spark)
    known = item_windows(items, item_id, item_text, size)
    texts = docs.select(F.struct("*").alias("row"), text_or_empty(text_col).alias("text"))
    row_type = texts.schema["row"].dataType.simpleString()
    sizes = known.groupBy("n").count().collect()  # at most `size` rows
    lengths = sorted(r["n"] for r in sizes)
    if sum(r["count"] for r in sizes) <= broadcast_limit:
        found: dict[tuple[int, int], list] = {}
        for r in known.collect():
            found.setdefault((r["h"] % (1 << 64), r["n"]), []).append((r["words"].encode(), r["item"]))
        sieve = _sieve(np.array([h for h, _ in found], np.uint64))
        return texts.mapInArrow(_scan(spark.sparkContext.broadcast((lengths, sieve, found))), f"row {row_type}, {_ROW}")
    bits = known.select(F.shiftrightunsigned("h", 64 - SIEVE_BITS).alias("bit")).distinct()
    sieve = np.zeros(1 << SIEVE_BITS, bool)
    for r in bits.toLocalIterator():  # fixed size: at most 2^23 small numbers, one partition at a time
        sieve[r["bit"]] = True
    shared = spark.sparkContext.broadcast((lengths, sieve))
    keyed = texts.withColumn("key", F.xxhash64("text"))
    passed = keyed.select("key", "text").mapInArrow(_candidates(shared), "key long, h long, n int, words string, i long")
    hits = passed.distinct().join(known, ["h", "n", "words"]).groupBy("key").agg(F.collect_list(F.struct("i", "n", "item")).alias("found"))
    return keyed.join(hits, "key", "left").select("row", "text", "found").mapInArrow(_joined_rows, f"row {row_type}, {_ROW}")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", remove: str = "spans", **options) -> DataFrame:
    """``docs`` without the hit words (``remove="spans"``) or without the rows that have any (``"documents"``)."""
    found = scan(docs, items, text_col, **options)
    if remove == "documents":
        return found.where("n_hit = 0").select("row.*")
    if remove != "spans":
        raise ValueError("remove is 'spans' or 'documents'")
    text = F.when(F.col("n_hit") > 0, F.col("kept_text")).otherwise(F.col(f"row.`{text_col}`"))
    return found.select(*[text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
