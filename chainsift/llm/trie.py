"""A trie of conversations by common first turns, with the tokens that sharing them saves.

A conversation is rebuilt as its family's opening turns and its own rest (``rebuilt``).  A node is a distinct sequence of first turns; turns are
equal if role and text are, by a 128-bit hash.  The sequence of a conversation is cut into blocks of ``BLOCK`` turns, one row each with the turns
as positional columns, and keyed by the node at which the block before ended; SQL's ROLLUP over the columns, with ``grouping_id`` telling the
depth, aggregates all prefixes of all blocks together, however long a conversation is.

What a node's subtree holds needs no walk over depths: each node belongs to its smallest member, the nodes of a member are the last stretch
of its path, so the words of the distinct nodes below, and the leaves, are sums over members again (second ROLLUP).

No conversation is gathered in one task: positions and the keys of blocks are running counts and running xors over a range-partitioned table, with what came
before a partition added from one row per conversation and partition.  The ids of a node's ends, which one digest needs in order, are
joined to texts of bounded length first and streamed through the digest.

Null role or text count as empty, rows without a conv_id take no part; rows of one turn number are ordered by role, then by the MD5 of the text;
repeated rows are turns of their own; an empty table has no nodes; other columns are not read; texts of any length are only hashed and counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import start, table, text_or_empty, written

BLOCK = 8
FAMILY = 20
WORD = r"[^\x20\x09-\x0D]+"
PIECE_IDS = 50_000
NOTHING = hashlib.sha256(b"").hexdigest()
KEY = ["depth", "x1", "x2"]


def before(rows: DataFrame, key: str, order: list[str], sums: dict[str, str | None], xors: dict[str, str], name: str) -> DataFrame:
    """``rows`` with, over the earlier rows of the same ``key``, the sums (of a column, or the count) and xors by name; 0 if there are none.

    Dealt by ranges of key and order, so a key with a third of all rows is spread; each partition's rows start from the aggregate of
    the key's rows in earlier partitions, one row per key and partition."""
    spread = written(rows.repartitionByRange(key, *order, F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), name)
    of_rows = {n: F.sum(c) if c else F.count(F.lit(1)) for n, c in sums.items()} | {n: F.bit_xor(c) for n, c in xors.items()}
    of_parts = {n: F.sum(f"{n}_part") for n in sums} | {n: F.bit_xor(f"{n}_part") for n in xors}
    zero = F.lit(0).cast("long")
    parts = spread.groupBy(key, "part").agg(*[c.alias(f"{n}_part") for n, c in of_rows.items()])
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(key, "part", *[F.coalesce(c.over(earlier), zero).alias(f"{n}_part") for n, c in of_parts.items()])
    inside = Window.partitionBy(key, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = spread.select("*", *[F.coalesce(c.over(inside), zero).alias(f"{n}_here") for n, c in of_rows.items()]).join(parts, [key, "part"])
    total = {n: F.col(f"{n}_here") + F.col(f"{n}_part") for n in sums} | {n: F.col(f"{n}_here").bitwiseXOR(F.col(f"{n}_part")) for n in xors}
    return here.select(*rows.columns, *[c.alias(n) for n, c in total.items()])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, pos, a, b, words)`` of the rebuilt turns, and all ``conv_id``.

    With h = crc32(id) mod 4 the first h turns come from the conversation ``id - id % 20`` (fewer if it has fewer), the others are its own after its first h."""
    role, text = text_or_empty("role"), text_or_empty("text")
    turns = written(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.md5(text.cast("binary")).alias("sum"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")), "hashed")
    placed = written(before(turns, "conv_id", ["turn", "role", "sum"], {"p": None}, {}, "turns").select("conv_id", (F.col("p") + 1).alias("p"), "a", "b", "words"), "placed")
    own_h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = placed.where("p = 1").select("conv_id", own_h.alias("h"), base.alias("base"))
    opening = placed.where((F.col("p") <= 3) & (F.col("conv_id") == base)).select(F.col("conv_id").alias("base"), F.col("p").alias("pos"), "a", "b", "words")
    borrowed = convs.join(opening, "base").where("pos <= h").select("conv_id", "pos", "a", "b", "words")
    own = placed.withColumn("h", own_h).withColumn("base", base).where("p > h")
    own = own.join(opening.groupBy("base").agg(F.count("*").alias("known")), "base", "left")
    pos = F.col("p") - F.col("h") + F.least("h", F.coalesce("known", F.lit(0)))
    return written(own.select("conv_id", pos.alias("pos"), "a", "b", "words").unionAll(borrowed), "rebuilt"), convs.select("conv_id")


def _hash(seed: int, pos: Column, a: Column, b: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos, a, b)


def _turn(i: int) -> Column:
    return F.col(f"t{i}")


def _rollup(rows: DataFrame, measures: str) -> DataFrame:
    """One row per node of each block (the root with block 0): its key, its parent's key, and the measures of its members."""
    turns = ", ".join(f"t{i}" for i in range(1, BLOCK + 1))
    found = rows.sparkSession.sql(
        f"SELECT block, p1, p2, {turns}, {BLOCK} - bit_count(grouping_id()) AS up, {measures} FROM {{rows}} GROUP BY block, p1, p2, ROLLUP({turns})", rows=rows)
    inside = [F.col("up") >= i for i in range(1, BLOCK + 1)]
    last = F.coalesce(*[F.when(F.col("up") == i, _turn(i)) for i in range(1, BLOCK + 1)])
    found = found.withColumn("last", last).where("last is not null or (up = 0 and block = 0)")
    place = F.col("block") * BLOCK
    out = found
    for seed, name in ((1, "x1"), (2, "x2")):
        parts = [F.when(inside[i - 1], _hash(seed, place + i, _turn(i)["a"], _turn(i)["b"])).otherwise(F.lit(0).cast("long")) for i in range(1, BLOCK + 1)]
        x = F.col(f"p{seed}")
        for part in parts:
            x = x.bitwiseXOR(part)
        own = F.when(F.col("up") > 0, _hash(seed, place + F.col("up"), F.col("last")["a"], F.col("last")["b"])).otherwise(F.lit(0).cast("long"))
        out = out.withColumn(name, x).withColumn(f"parent_{name}", F.col(name).bitwiseXOR(own))
    path = sum((F.when(inside[i - 1], _turn(i)["words"]).otherwise(F.lit(0)) for i in range(1, BLOCK + 1)), F.lit(0).cast("long"))
    return out.withColumn("depth", place + F.col("up")).withColumn("words", F.coalesce(F.col("last")["words"], F.lit(0).cast("long"))).withColumn(
        "above", path - F.col("words")).drop(*[f"t{i}" for i in range(1, BLOCK + 1)], "last", "up", "block", "p1", "p2")


# ---------------------------------------------------------------- digests of ordered ids


def _runs(batch: pa.RecordBatch) -> np.ndarray:
    """Where a new key begins in a batch of sorted ``(depth, x1, x2, ...)``."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for i in range(3):
        x = batch.column(i).to_numpy(zero_copy_only=False)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of sorted rows, comma-joined by key, in texts of at most ``PIECE_IDS`` ids."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_IDS):
            some = batch.slice(at, PIECE_IDS)
            begins = _runs(some)
            ids = pa.ListArray.from_arrays(pa.array(np.append(begins, some.num_rows), pa.int32()), pc.cast(some.column("conv_id"), pa.string()))
            head = some.take(pa.array(begins))
            yield pa.RecordBatch.from_arrays([*head.columns[:4], pc.binary_join(ids, ",")], [*KEY, "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces in order, joined by commas."""
    key, state, done = None, None, []
    for batch in batches:
        for *now, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield _digest_rows(done)
            done = []
    if state is not None:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], [*KEY, "ends_sha256"])


def _ends(members: DataFrame) -> DataFrame:
    """``members(depth, x1, x2, conv_id)`` to the digest of each node's ascending ids."""
    order = [*KEY, "conv_id"]
    sorted_ids = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = sorted_ids.mapInArrow(_joined, "depth long, x1 long, x2 long, first long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_digests, "depth long, x1 long, x2 long, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    start(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    columns = turns.columns
    every = turns.unionByName(convs.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in columns if c != "conv_id"]))  # turnless ones have a first block too
    block, slot = F.floor((F.col("pos") - 1) / BLOCK), (F.col("pos") - 1) % BLOCK
    turn = F.struct("a", "b", "words")
    xor = lambda seed: F.coalesce(F.bit_xor(F.when(F.col("pos").isNotNull(), _hash(seed, F.col("pos"), F.col("a"), F.col("b")))), F.lit(0).cast("long"))
    cut = every.groupBy("conv_id", F.coalesce(block, F.lit(0)).cast("long").alias("block")).agg(
        *[F.max(F.when(slot == i - 1, turn)).alias(f"t{i}") for i in range(1, BLOCK + 1)],
        xor(1).alias("y1"), xor(2).alias("y2"), F.coalesce(F.sum("words"), F.lit(0)).alias("w"), F.count("pos").alias("n"))
    rows = written(before(cut, "conv_id", ["block"], {"pw": "w"}, {"p1": "y1", "p2": "y2"}, "blocks"), "rows")
    members = written(rows.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("y1").alias("x1"), F.bit_xor("y2").alias("x2"), F.sum("w").alias("total")), "members")

    nodes = _rollup(rows.drop("y1", "y2", "w", "n"), "count(*) AS n_convs, min(conv_id) AS conv_id, min(pw) AS pw").withColumn("above", F.col("above") + F.col("pw")).drop("pw")
    nodes = written(nodes, "nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("parent_x1").alias("x1"), F.col("parent_x2").alias("x2")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, KEY, "left").na.fill(0, ["n_children"]), "nodes")

    owned = nodes.groupBy("conv_id").agg(F.sum("words").alias("owned"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaf"))
    of_conv = members.select("conv_id", "total").join(owned, "conv_id", "left").na.fill(0, ["owned", "leaf"])
    below = _rollup(rows.select("conv_id", "block", "p1", "p2", *[f"t{i}" for i in range(1, BLOCK + 1)]).join(of_conv, "conv_id"),
                    "sum(total) AS totals, sum(owned) AS all_owned, sum(leaf) AS n_leaves, min(struct(conv_id, total, owned)) AS least")
    below = below.select(*KEY, "totals", "all_owned", "n_leaves", "least")
    # words of members from this node on, less those of the distinct nodes
    saved = F.col("totals") - F.col("n_convs") * F.col("above") - (F.col("all_owned") - F.col("least.owned") + F.col("least.total") - F.col("above"))
    parents = nodes.select(F.col("depth").alias("d"), F.col("x1").alias("px1"), F.col("x2").alias("px2"), F.col("conv_id").alias("parent_conv_id"))
    of_parent = (F.col("depth") - 1 == F.col("d")) & (F.col("parent_x1") == F.col("px1")) & (F.col("parent_x2") == F.col("px2"))
    found = nodes.join(below, KEY).join(_ends(members), KEY, "left").join(parents, of_parent, "left")
    whole = {"conv_id": "conv_id", "depth": "depth", "parent_conv_id": "parent_conv_id", "n_convs": "n_convs", "n_children": "n_children", "n_leaves": "n_leaves"}
    return found.select(*[F.col(c).cast("long").alias(n) for n, c in whole.items()], saved.cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP12_SQL = r"""
WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
               xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda acc, v: CASE WHEN v >= 0 THEN xor(acc, v) ELSE xor(acc >> 1, 3988292384::BIGINT * (acc & 1)) END), 4294967295::BIGINT) % 4 AS h
        FROM (SELECT DISTINCT conv_id FROM c)),
r AS (SELECT i.conv_id, 0 AS part, c.p, c.role, c.text FROM ids i JOIN c ON c.conv_id = i.base AND c.p <= i.h
      UNION ALL SELECT i.conv_id, 1, c.p, c.role, c.text FROM ids i JOIN c ON c.conv_id = i.conv_id WHERE c.p > i.h),
s AS (SELECT i.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.part, r.p) FILTER (r.p IS NOT NULL), []) AS seq
      FROM ids i LEFT JOIN r ON r.conv_id = i.conv_id GROUP BY i.conv_id),
m AS (SELECT conv_id, len(seq) AS l, d, seq[1:d] AS k FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM s)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = d), '')) AS ends,
             CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].text, '[^\x20\x09-\x0D]+')) END AS w FROM m GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.k = n.k AND kids.d = n.d),
up AS (SELECT k[1:e] AS k, e AS d, n_convs, w, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM f)),
sub AS (SELECT k, d, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * w) AS saved FROM up GROUP BY k, d)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM f JOIN sub ON sub.k = f.k AND sub.d = f.d LEFT JOIN f p ON f.d > 0 AND p.d = f.d - 1 AND p.k = f.k[1:f.d - 1]
"""
