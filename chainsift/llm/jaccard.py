"""Grouped prefix join: documents whose sets of five-word shingles have Jaccard 0.75 or more.

1. **Order.**  Shingles are ordered from rare to frequent by a table of 2^20 counters over
   the top bits of their hashes (every document counted; fixed size, so it can be broadcast).
   Any order is right; this one keeps frequent passages out of the prefixes.
2. **Groups.**  Documents of one prefix and set size are one group; it lists its prefix once per
   input partition, so thousands of copies cost as much as one.
3. **Group pairs.**  Groups that share a prefix shingle are expanded to *classes* (distinct sets) and
   filtered by size, by the shorter prefix that suffices for the smaller set, and by 1,024-bit
   parity maps (the number of differing bits is a lower bound of the symmetric difference).
4. **Verification.**  Surviving pairs compare their whole sets.  Neighbours in each shingle's list
   are tried first; pairs that these links already connect are not tried again, every other
   pair is, so components are exact and a large group of near copies is not expanded to all pairs.

Words are the bytes between ASCII white space with A-Z folded.  A set holds the distinct
5-word shingles, or the whole sequence as its only member where there are fewer words.

Null or empty texts: an empty set, linked with nothing.  Rows that repeat (the same id, the same
text) each get a row.  A null id takes part in linking; ``component_id`` is the smallest id that is
not null, or null if there is none; a row without a set has its own id.  An empty table gives an empty table.  Only the
two named columns are read, so further columns cannot clash.  Sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Words, mix, slices, start, table, text_buffer, text_or_empty, windows, working_tables, written
from .graph import components

WORDS = Words(b" \t\n\x0b\x0c\r")
CELL_BITS, CHUNK = 20, 4096
MAP_WORDS = 16
BROADCAST_ROWS = 500_000  # of 24 bytes; beyond it the same join runs shuffled

_CUT = np.uint64(64 - CELL_BITS)
_LOW = np.uint64((1 << (64 - CELL_BITS)) - 1)
_PAIR = 0xD6E8FEB86659FD93


def shingle_sets(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    starts, ends, counts = WORDS.spans(data, offsets)
    words = WORDS.hashes(data, starts, ends)
    runs, first = windows(words, size), 0
    for n in counts.tolist():
        if n >= size:
            yield np.unique(runs[first : first + n - size + 1])
        else:
            yield windows(words[first : first + n], n) if n else np.zeros(0, np.uint64)
        first += n


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def _class_of(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    m = mix(s)
    both = int(np.sum(m, dtype=np.uint64)) ^ (int(np.bitwise_xor.reduce(m)) * _PAIR)
    return int(mix(np.array([(both + len(s)) % (1 << 64)], np.uint64))[0])


# ---------------------------------------------------------------- 1. the order


def _count_cells(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for b in batches:
            for part in slices(b):
                tokens = [s for s in shingle_sets(part, size) if len(s)]
                if tokens:
                    at, n = np.unique((np.concatenate(tokens) >> _CUT).astype(np.int64), return_counts=True)
                    cells[at] += n.astype(np.uint32)
        used = [k for k in range(0, len(cells), CHUNK) if cells[k : k + CHUNK].any()]
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k // CHUNK for k in used], pa.int32()), pa.array([cells[k : k + CHUNK].tobytes() for k in used], pa.binary())],
                ["chunk", "cells"])

    return run


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            total.setdefault(k, np.zeros(CHUNK, np.uint64))
            total[k] += np.frombuffer(c, np.uint32)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([c.tobytes() for c in total.values()], pa.binary())], ["chunk", "cells"])


def cell_ranks(docs: DataFrame, size: int) -> np.ndarray:
    """Rank of each of the 2^20 cells, rare first: 8 MB of counts reach the driver at any input size."""
    spark = docs.sparkSession
    schema = "chunk int, cells binary"
    parts = docs.select("text").mapInArrow(_count_cells(size), schema)
    tasks = max(1, min((1 << CELL_BITS) // CHUNK, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cells = np.zeros(1 << CELL_BITS, np.uint64)
    for k, c in parts.repartition(tasks, "chunk").mapInArrow(_add_cells, schema).collect():
        cells[k * CHUNK : (k + 1) * CHUNK] = np.frombuffer(c, np.uint64)
    rank = np.empty(1 << CELL_BITS, np.uint32)
    rank[np.argsort(cells, kind="stable")] = np.arange(1 << CELL_BITS, dtype=np.uint32)
    return rank


def _ordered(s: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set's members from rare to frequent, renamed so that the order is their numeric order."""
    return np.sort((rank[(s >> _CUT).astype(np.int64)].astype(np.uint64) << _CUT) | (s & _LOW))


def _prefix_length(n: int, percent: int) -> int:
    """Members of which one at least is shared with any linked set (sizes from percent of n up)."""
    return n - (percent * n + 99) // 100 + 1


def _short_prefix_length(n: int, percent: int) -> int:
    """The same for partners of size n or more."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


# ---------------------------------------------------------------- 2. groups and their prefixes

ROW_SCHEMA = ("doc_id long, th long, n int, gid long, cid long, "
              + ", ".join(f"m{k} long" for k in range(MAP_WORDS)))


def _doc_rows(size: int, percent: int, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        names = [x.split()[0] for x in ROW_SCHEMA.split(", ")]
        for b in batches:
            for part in slices(b):
                n, gid, cid, maps = [], [], [], []
                for s in shingle_sets(part, size):
                    o = _ordered(s, rank)
                    p = o[: _prefix_length(len(o), percent)] if len(o) else o
                    n.append(len(o))
                    cid.append(_class_of(o))
                    gid.append(_class_of(np.append(p, np.uint64(len(o)))))
                    bits = np.bincount((mix(o) >> np.uint64(54)).astype(np.int64), minlength=64 * MAP_WORDS) & 1
                    maps.append(np.packbits(bits.astype(np.uint8)).view(np.int64))
                maps = np.array(maps, np.int64).reshape(len(n), MAP_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int32()), _signed(gid), _signed(cid)]
                    + [pa.array(maps[:, k]) for k in range(MAP_WORDS)], names)

    return run


def _prefix_rows(size: int, percent: int, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = shared.value, set()
        for b in batches:
            for part in slices(b):
                tokens, gids, ns, at = [], [], [], []
                for s in shingle_sets(part, size):
                    if not len(s):
                        continue
                    o = _ordered(s, rank)
                    p = o[: _prefix_length(len(o), percent)]
                    g = _class_of(np.append(p, np.uint64(len(o))))
                    if g in seen:
                        continue
                    seen.add(g)
                    tokens.append(p)
                    gids.append(np.full(len(p), g, np.uint64))
                    ns.append(np.full(len(p), len(o), np.int32))
                    at.append(np.arange(len(p)) < _short_prefix_length(len(o), percent))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [_signed(np.concatenate(tokens)), _signed(np.concatenate(gids)), pa.array(np.concatenate(ns)),
                         pa.array(np.concatenate(at))], ["token", "gid", "n", "short"])

    return run


# ---------------------------------------------------------------- 3. candidates, 4. verification


def _may_link(percent: int) -> Column:
    """Filter on a pair (a, b) of classes: sizes, and a lower bound of the symmetric difference."""
    differing = sum((F.bit_count(F.col(f"a.m{k}").bitwiseXOR(F.col(f"b.m{k}"))) for k in range(MAP_WORDS)), F.lit(0))
    total = F.col("a.n") + F.col("b.n")
    return (
        (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)
        # links: (100 + p) * both >= p * total, and differing <= total - 2 * both
        & (differing * (100 + percent) <= total * (100 - percent))
    )


def _with_partner(lists: DataFrame, by_size, percent: int) -> DataFrame:
    """Rows of the lists that have a row of a linkable size beside them: a smaller one that lists the
    shingle in its short prefix, or a larger one if this row does so itself."""
    smaller = F.last(F.when(F.col("short"), F.col("n")), ignorenulls=True).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    larger = F.lead("n").over(by_size)
    return (lists.withColumn("smaller", smaller).withColumn("larger", larger)
            .where((F.col("smaller") * 100 >= F.col("n") * percent) | (F.col("short") & (F.col("n") * 100 >= F.col("larger") * percent))))


def _tokens_of(size: int, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for b in batches:
            for part in slices(b):
                sets = [_ordered(s, rank) for s in shingle_sets(part, size)]
                yield pa.RecordBatch.from_arrays(
                    [_signed([_class_of(o) for o in sets]), part.column(0), pa.array([o.tobytes() for o in sets], pa.binary())],
                    ["cid", "wanted", "tokens"])

    return run


def _verify(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            x, y = b.column(2), b.column(3)
            for i in range(b.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    keep.append(i)
            if keep:
                yield b.take(pa.array(keep)).select([0, 1])

    return run


class _Sets:
    """The whole sets of wanted classes, read from the documents again."""

    def __init__(self, docs: DataFrame, rows: DataFrame, size: int, shared) -> None:
        self.docs, self.size, self.shared = docs, size, shared
        self.first = rows.where("n > 0").groupBy("cid").agg(F.min(F.struct("th", "doc_id")).alias("at")).select("cid", "at.th", "at.doc_id")

    def of(self, wanted: DataFrame) -> DataFrame:
        at = written(self.first.join(wanted, "cid", "left_semi").select(
            F.col("cid").alias("wanted"), F.col("th").alias("w_th"), F.col("doc_id").alias("w_id")), "wanted")
        side = F.broadcast(at) if at.count() <= BROADCAST_ROWS else at
        hit = self.docs.join(side, (F.col("th") == F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
        sets = hit.select("wanted", "text").mapInArrow(_tokens_of(self.size, self.shared), "cid long, wanted long, tokens binary")
        return sets.where("cid = wanted").dropDuplicates(["cid"]).select("cid", "tokens")


def links_and_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                         percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Rows ``(doc_id, th: hash of the text, n_shingles, class_id, component, component_id)`` and verified links ``(u, v)`` between classes.

    ``links`` are enough to connect every component (not all pairs of a component)."""
    spark = docs.sparkSession
    start(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    with working_tables(spark):
        rows, links = _linked(docs, size, percent)
        return written(rows, "components", outlives=True), written(links, "links", outlives=True)


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows and links of ``(doc_id, text, th)``, read from working tables."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cell_ranks(docs, size))
    rows = written(docs.select("doc_id", "th", "text").mapInArrow(_doc_rows(size, percent, shared), ROW_SCHEMA), "sets")

    prefixes = docs.select("text").mapInArrow(_prefix_rows(size, percent, shared), "token long, gid long, n int, short boolean")
    by_token = Window.partitionBy("token")
    by_size = by_token.orderBy("n", "gid")
    # lists of shingles that only one group has make no pair; a group stays once in a list ...
    listed = (prefixes.withColumn("lo", F.min("gid").over(by_token)).withColumn("hi", F.max("gid").over(by_token)).where("lo <> hi")
              .withColumn("same", F.lag("gid").over(by_size)).where("same is null or same <> gid").select("token", "gid", "n", "short"))
    # ... and only if a group of a size that may link is in it too
    listed = _with_partner(listed, by_size, percent).select("token", "gid", "short")
    classes = rows.where("n > 0").select("gid", "cid", "n", *[f"m{k}" for k in range(MAP_WORDS)]).dropDuplicates(["cid"])
    crowded = (classes.groupBy("gid").agg(F.count("*").alias("c")).where("c > 1")
               .select(F.col("gid").alias("token"), "gid", F.lit(True).alias("short")))
    lists = written(listed.unionAll(crowded).join(classes.select("gid", "cid", "n"), "gid").select("token", "cid", "n", "short"), "lists")
    maps = classes.select("cid", "n", *[f"m{k}" for k in range(MAP_WORDS)])
    sets = _Sets(docs, rows, size, shared)

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("u").alias("cid")).unionAll(pairs.select(F.col("v").alias("cid"))).distinct()
        whole = sets.of(wanted)  # already dealt by class, which both joins use
        joined = (pairs.join(whole.select(F.col("cid").alias("u"), F.col("tokens").alias("x")), "u")
                  .join(whole.select(F.col("cid").alias("v"), F.col("tokens").alias("y")), "v").select("u", "v", "x", "y"))
        return joined.mapInArrow(_verify(percent), "u long, v long")

    # neighbours within each list, by two orders: linear in the lists
    before = []
    for order in (["n", F.xxhash64("cid", F.lit(1)), "cid"], [F.xxhash64("cid", F.lit(2)), "cid"]):
        w = by_token.orderBy(*order)
        before += [F.lag(F.struct("cid", "n"), k).over(w) for k in (1, 2)]
    near = lists.select("cid", "n", F.array(*before).alias("before")).select("cid", "n", F.explode("before").alias("o"))
    near = near.where((F.col("o.cid") != F.col("cid")) & (F.least("n", "o.n") * 100 >= F.greatest("n", "o.n") * percent))
    near = near.select(F.least("cid", "o.cid").alias("u"), F.greatest("cid", "o.cid").alias("v"))
    near = near.distinct()
    a, b = maps.alias("a"), maps.alias("b")
    tried = written(near.join(a, F.col("u") == F.col("a.cid")).join(b, (F.col("v") == F.col("b.cid")) & _may_link(percent)).select("u", "v"), "near")
    links = written(verified(tried), "links")
    comp = components(links)

    # every pair of a list whose ends are not connected yet
    label = lists.join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    open_lists = (label.withColumn("lo", F.min("component").over(by_token)).withColumn("hi", F.max("component").over(by_token))
                  .where("lo <> hi").select("token", "cid", "n", "short", "component"))
    open_lists = _with_partner(open_lists, by_token.orderBy("n", "cid"), percent).select("token", "cid", "short", "component")
    open_lists = written(open_lists.join(maps, "cid"), "open")
    a, b = open_lists.alias("a"), open_lists.alias("b")
    rest = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.component") != F.col("b.component"))
                  & ((F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.cid") < F.col("b.cid"))))
                  & F.col("a.short") & _may_link(percent))
    rest = rest.select(F.col("a.cid").alias("u"), F.col("b.cid").alias("v")).distinct().join(tried, ["u", "v"], "left_anti")
    rest = rest.join(tried.select(F.col("v").alias("u"), F.col("u").alias("v")), ["u", "v"], "left_anti")
    more = written(verified(written(rest, "rest")), "links")
    links = links.unionAll(more)
    if more.head(1):
        tree = comp.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v")
        comp = components(tree.unionAll(more))

    of_class = rows.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first"))
    of_class = of_class.join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    smallest = of_class.groupBy("component").agg(F.min("first").alias("component_id"))
    named = of_class.join(smallest, "component").select("cid", "component", "component_id")
    full = rows.select("doc_id", "th", "n", "cid").where("n > 0").join(named, "cid").select(
        "doc_id", "th", F.col("n").cast("long").alias("n_shingles"), F.col("cid").alias("class_id"), "component", "component_id")
    none = rows.where("n = 0").select("doc_id", "th", F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("class_id"),
                                      F.lit(None).cast("long").alias("component"), F.col("doc_id").alias("component_id"))
    return full.unionAll(none), links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """``(doc_id, th, n_shingles, class_id, component, component_id)`` of every row."""
    return links_and_components(docs, id_col, text_col, size, percent)[0]


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
