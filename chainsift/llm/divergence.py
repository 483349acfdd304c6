"""How far the sources of a language lie from each other and from the language, term by term, in exact integers.

Terms are runs of letters (ASCII letters and everything beyond ASCII; only A-Z is folded).  A language keeps the terms
that ``min_docs`` of its documents hold.  Counting runs over whole texts in Arrow batches and is aggregated before and
after the exchange; a group's counts then become arrays sorted by term id, cut into blocks of the vocabulary, so that no
array grows with the corpus.  Pair tasks co-group the blocks of two tiles of groups and price every unordered pair once:
a galloping intersection prices the terms that both hold, the one-sided terms are priced against the other's unseen
probability, and the terms that neither holds are priced once for all blocks; each value is then read both ways.

With p = 1 + floor(1e9 * (count + 2) / (N + 2 V)) the distance of a term is floor((p - q)^2 / (p + q)).  Counts up to
9e15 tokens of a group stay exact in 64 bits (the division goes by three digits at a time).

Null text, lang or source count as empty; a group without kept terms takes part with its unseen probability; a language
that keeps nothing gives pair values of 0 and no terms; equal values are ordered by the item's UTF-8 bytes; repeated rows
are documents of their own; empty tables give no rows; very long texts are counted in pieces cut between terms; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, start, table, text_buffer, text_or_empty, written

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
BLOCK_TERMS = 16_384
TILE_GROUPS = 32
PIECE_BYTES = 8 << 20
HELD_ROWS = 400_000
STRIDE = 256

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32

_COUNTS = "lang string, term string, docs long, sources array<string>, counts array<long>"


# ---------------------------------------------------------------- counting


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """All folded terms of the texts and the text each stands in."""
    inside = _LETTER[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] |= inside[cuts]
    starts = np.flatnonzero(first)
    kept = _FOLD[data[inside]]
    at = np.cumsum(inside, dtype=np.int64)
    begins = at[starts] - 1
    ends = np.append(begins, len(kept)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(kept))
    return words, np.searchsorted(offsets, starts, side="right") - 1


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """One long text in pieces that end between terms (an endless term is a piece by itself)."""
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        while end < len(data) and _LETTER[data[end - 1]]:
            gap = np.flatnonzero(~_LETTER[data[end : end + PIECE_BYTES]])
            end = end + int(gap[0]) + 1 if len(gap) else min(end + PIECE_BYTES, len(data))
        yield data[at:end]
        at = end


def _counted(words: pa.StringArray, group: np.ndarray, doc: np.ndarray) -> pa.Table:
    """``(group, term, n, docs)`` of one slice."""
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(1, len(coded.dictionary))
    places, n = np.unique(doc * width + code, return_counts=True)
    pair = group[places // width] * width + places % width
    keys, where, docs = np.unique(pair, return_inverse=True, return_counts=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, where, n)
    return pa.table({"group": keys // width, "term": coded.dictionary.take(pa.array(keys % width)), "n": total, "docs": docs})


def _merged(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return t.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])


def _sent(t: pa.Table, names: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """A row for each language and term, with the sources that hold it."""
    coded = pa.array([x[0] for x in names], pa.string()).dictionary_encode()  # numpy's strings would lose trailing NULs
    langs, lang_of = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    group = t["group"].to_numpy()
    t = t.append_column("lang", pa.array(lang_of[group])).append_column("source", pa.array([x[1] for x in names], pa.string()).take(pa.array(group)))
    t = t.group_by(["lang", "term"]).aggregate([("docs", "sum"), ("source", "list"), ("n", "list")])
    lang = langs.take(t["lang"].combine_chunks())
    yield from pa.table([lang, t["term"], t["docs_sum"], t["source_list"], t["n_list"]], names=["lang", "term", "docs", "sources", "counts"]).to_batches(max_chunksize=50_000)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows by language, source and term; sent on when they do not shrink any more."""
    names: dict[tuple[str, str], int] = {}
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for part in slices(batch):
            lang, source = part.column("lang").to_pylist(), part.column("source").to_pylist()
            group = np.array([names.setdefault(x, len(names)) for x in zip(lang, source, strict=True)], np.int64)
            data, offsets = text_buffer(part.column("text"))
            if part.num_rows == 1 and len(data) > PIECE_BYTES:
                one = np.zeros(1, np.int64)
                found = pa.concat_tables([_counted(words, group, one[doc]) for words, doc in (_terms(x, np.array([0, len(x)])) for x in _pieces(data))])
                found = found.group_by(["group", "term"]).aggregate([("n", "sum")]).rename_columns(["group", "term", "n"])
                found = found.append_column("docs", pa.array(np.ones(found.num_rows, np.int64)))
            else:
                words, doc = _terms(data, offsets)
                found = _counted(words, group, doc)
            held.append(found)
            rows += found.num_rows
            if rows > HELD_ROWS:
                held = [_merged(held)]
                rows = held[0].num_rows
                if rows > HELD_ROWS // 2:
                    yield from _sent(held[0], list(names))
                    held, rows, names = [], 0, {}
    if held:
        yield from _sent(_merged(held), list(names))


# ---------------------------------------------------------------- exact arithmetic


def _scaled(part: np.ndarray, whole: int) -> np.ndarray:
    out, rest = part // whole, part % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def _distance(p: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


# ---------------------------------------------------------------- pairs


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of the sorted ``few`` its place in the sorted ``many``: from where the last stride ended the step
    doubles until the stride's end is passed, then the stretch is searched by halves."""
    out = np.empty(len(few), np.int64)
    at = 0
    for i in range(0, len(few), STRIDE):
        some = few[i : i + STRIDE]
        step = STRIDE
        while at + step < len(many) and many[at + step] < some[-1]:
            step *= 2
        out[i : i + STRIDE] = at + np.searchsorted(many[at : at + step + 1], some)
        at = int(out[min(i + STRIDE, len(few)) - 1])
    return out


def _price(a: tuple, b: tuple) -> tuple[int, int]:
    """Distance over the terms that one of two groups holds, and how many these are."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids, p, unseen_p), (others, q, unseen_q) = a, b
    at = gallop(ids, others)
    both = np.zeros(len(ids), bool)
    inside = at < len(others)
    both[inside] = others[at[inside]] == ids[inside]
    alone = np.ones(len(others), bool)
    alone[at[both]] = False
    value = _distance(p[both], q[at[both]]).sum() + _distance(p[~both], unseen_q).sum() + _distance(q[alone], unseen_p).sum()
    return int(value), len(ids) + len(others) - int(both.sum())


_PRICED = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("id", pa.int64()), ("value", pa.int64()), ("held", pa.int64()), ("unseen", pa.int64())])
_PRICED_DDL = "lang string, source string, item string, id long, value long, held long, unseen long"


def _priced(top: int, same: bool, left: pa.Table, right: pa.Table) -> pa.Table:
    """Over a block of terms: every unordered pair of the groups of two tiles, ``(source, item, value, held, unseen)``.

    A tile with itself (``same``; ``right`` is empty, as it may be for a tile that got no group) also holds the language's own counts, as the group with a null source; against these
    each group's terms are priced, and its first ``top`` go out as ``(source, id, value)``."""

    def read(t: pa.Table) -> list[tuple]:
        out = []
        fixed = zip(*(t[c].to_pylist() for c in ("lang", "source", "n", "v")), strict=True)
        for (lang, source, n, v), held in zip(fixed, t["held"], strict=True):
            ids, counts = (np.asarray(held.values.field(i).to_numpy(zero_copy_only=False) if held.is_valid else [], np.int64) for i in (0, 1))
            order = np.argsort(ids)
            whole = max(1, n + 2 * v)
            out.append((lang, source, (ids[order], _scaled(counts[order] + 2, whole), int(_scaled(np.array([2]), whole)[0]))))
        return out

    a, b = read(left), read(right)
    whole = [x for x in a if x[1] is None]
    a = [x for x in a if x[1] is not None]
    rows = []
    for x, y in [(x, y) for i, x in enumerate(a) for y in a[i + 1 :]] if same else [(x, y) for x in a for y in b]:
        rows.append((x[0], x[1], y[1], None, *_price(x[2], y[2]), int(_distance(np.int64(x[2][2]), y[2][2]))))
    for language in whole:
        for lang, source, (ids, p, _) in a:
            q = language[2][1][gallop(ids, language[2][0])] if len(ids) else p
            value = np.where(p > q, _distance(p, q), -1)
            last = np.partition(value, -top)[-top] if len(value) > top else 0  # ties with the last stay: items decide later
            rows += [(lang, source, None, int(ids[i]), int(value[i]), None, None) for i in np.flatnonzero((value >= max(last, 0)) & (p > q))]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_PRICED), _PRICED, strict=True)], schema=_PRICED)


# ---------------------------------------------------------------- the audit


def _numbered(words: DataFrame) -> DataFrame:
    """``words(lang, term, n)`` with a 64-bit id by hash, of a seed under which no two terms of a language share one."""
    for seed in range(100):
        numbered = words.withColumn("id", F.xxhash64(F.lit(seed), "term"))
        if numbered.groupBy("lang", "id").count().where("count > 1").isEmpty():
            return numbered.withColumn("seed", F.lit(seed))
    raise ValueError("no seed gives distinct term ids")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for the rows of ``docs(text, lang, source)``."""
    start(docs.sparkSession)
    rows = docs.select(*[text_or_empty(c).alias(c) for c in ("lang", "source", "text")])
    seen = rows.mapInArrow(_count, _COUNTS)
    # dealt by term: a language's documents of a term and the counts of its sources need one exchange
    frequent = (
        seen.repartition("lang", "term").withColumn("docs", F.sum("docs").over(Window.partitionBy("lang", "term"))).where(F.col("docs") >= min_docs)
        .select("lang", "term", F.explode(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n"))).alias("x")))
    kept = written(frequent.groupBy("lang", "term", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("n")), "kept")
    words = written(kept.groupBy("lang", "term").agg(F.sum("n").alias("n")), "words")
    words = _numbered(words)
    seed = words.select("seed").limit(1).collect()
    langs = words.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    most = langs.agg(F.max("v")).first()[0] or 0
    blocks = F.lit(max(1, -(-most // BLOCK_TERMS))).cast("long")
    sources = rows.select("lang", "source").distinct()
    sizes = sources.groupBy("lang").agg(F.ceil(F.count("*") / TILE_GROUPS).alias("tiles"))
    counts = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = written(
        sources.join(sizes, "lang").join(langs, "lang", "left").join(counts, ["lang", "source"], "left").na.fill(0, ["v", "lang_n", "n"])
        .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles")), "groups")

    block = F.pmod("id", blocks).alias("block")
    held = F.collect_list(F.struct("id", F.col("n").alias("count"))).alias("held")
    ids = kept.select("lang", "source", F.xxhash64(F.lit(seed[0][0] if seed else 0), "term").alias("id"), "n")
    of_group = ids.groupBy("lang", "source", block).agg(held)
    every = groups.select("lang", "source", "n", "v", "tile", "tiles", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    pieces = every.join(of_group, ["lang", "source", "block"], "left")
    of_lang = words.groupBy("lang", block).agg(held).join(groups.groupBy("lang").agg(F.first("v").alias("v"), F.first("lang_n").alias("n"), F.first("tiles").alias("tiles")), "lang")
    columns = ["lang", "block", "source", "n", "v", "held"]
    last = F.col("tiles") - 1
    left = pieces.select(*columns, F.col("tile").alias("a"), F.explode(F.sequence("tile", last)).alias("b")).unionByName(
        of_lang.withColumn("source", F.lit(None).cast("string")).select(*columns, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("a")).withColumn("b", F.col("a")))
    right = pieces.select(*[F.col(c).alias(c) for c in columns], F.explode(F.sequence(F.lit(0).cast("long"), "tile")).alias("a"), F.col("tile").alias("b")).where("a < b")
    cell = ["lang", "block", "a", "b"]
    priced = written(
        left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(lambda at, one, other: _priced(top, at[2] == at[3], one, other), _PRICED_DDL), "priced")

    total = priced.where("item is not null").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("held").alias("held"), F.first("unseen").alias("unseen"))
    total = total.join(langs, "lang", "left").withColumn("value", F.col("value") + (F.coalesce("v", F.lit(0)) - F.col("held")) * F.col("unseen"))
    ways = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    pairs = total.select("lang", "value", ways.alias("w")).select("lang", "w.source", "w.item", "value", F.lit("pair").alias("part"))
    terms = priced.where("id is not null").select("lang", "source", "id", "value").join(words.select("lang", "id", F.col("term").alias("item")), ["lang", "id"])
    found = pairs.unionByName(terms.select("lang", "source", "item", "value", F.lit("term").alias("part")))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return found.withColumn("rank", place).where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 10),
l AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(any_value(t.n), 0) AS n FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) t
      ON t.lang = d.lang AND t.source = d.source GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.n + 2 * l.v) AS p, 1 + 1000000000::HUGEINT * (kept.n + 2) // (l.n + 2 * l.v) AS q
      FROM g JOIN l USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
either AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
         UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM either)
WHERE part = 'pair' OR rank <= 10
"""
