"""Nearest neighbours by inner product: multi-index hashing over learned binary codes, then the vectors themselves.

The model is fitted on at most ``SAMPLE`` vectors (those with the smallest hash of their id): several rotations learned by alternating
between the signs of the rotated vectors and the rotation nearest to them give ``BITS`` bits, and a fit of Hamming distance against angle gives
the radius within which a neighbour of a given score lies (``MARGIN`` deviations).  Vectors get one more component that brings all to
the largest norm, so that angles order them as inner products do; all vectors are indexed, none is sampled.

Rows and queries are dealt to cells (a block of rows and a block of queries, both of bounded bytes).  A cell indexes its rows by each
8-bit substring of their codes (a bitmap of rows for each value, widened one flipped bit at a time).  A query's radius r is dealt to the substrings so that a
code within r must lie within the threshold of one of them at least; their bitmaps together hold every code within r.  These are compared whole,
those within r are scored with the vectors in double precision.  The first radius comes from the query's k-th best score in the
sample, then the k-th best of the cell's nearest codes shrinks it.  Each cell hands on its k best, a window joins the cells' answers.

Radius and codes make the search probable, not certain: recall is measured in the tests (0.9 at least).  Where vectors have hardly any
neighbours (isotropic noise) the radius is wide and the bitmaps cover most of a cell; the cost then grows with queries times rows.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without id or with another dimension than
most (the larger, if equally many); of rows of one id one counts, that with the largest vector in order of components; equal scores
are ordered by the smaller id; with fewer candidates all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import start, table, written

TOP = 20
EVERY = 20
BITS = 256
SAMPLE = 4_096
MARGIN = 1.75
ROUNDS = 15
CELL_BYTES = 16 << 20
CELL_ROWS = 16_384
CHUNK = 256
FIRST = 128
PAIRS = 100_000


# ---------------------------------------------------------------- model


@dataclass
class Model:
    """Rotations ``(dimension + 1, BITS)``, the largest norm, and the fit of Hamming distance: share of bits per angle, and its spread."""

    rotations: np.ndarray
    norm: float
    share: float
    spread: float
    sample: np.ndarray

    def codes(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        """Bits of the vectors, as bytes ``(rows, BITS / 8)``; queries have no added component."""
        extra = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.norm**2 - np.einsum("ij,ij->i", x, x), 0))
        return np.packbits(np.column_stack([x, extra]) @ self.rotations > 0, axis=1)

    def radius(self, norms: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Hamming distance that a code of at least this score is not likely to pass, for queries of these norms."""
        angle = np.arccos(np.clip(scores / np.maximum(norms * self.norm, 1e-300), -1, 1))
        p = np.clip(self.share * angle, 0, 1)
        return np.clip(np.floor(BITS * p + MARGIN * self.spread * np.sqrt(BITS * p * (1 - p)) + 2), 0, BITS).astype(np.int64)


def _rotation(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Principal directions of ``x``, rotated so that the signs lose little (alternating least squares)."""
    _, _, basis = np.linalg.svd(x, full_matrices=False)
    basis = basis[: min(BITS, len(basis))].T
    v = x @ basis
    r, _ = np.linalg.qr(rng.standard_normal((v.shape[1], v.shape[1])))
    for _ in range(ROUNDS):
        signs = np.where(v @ r > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(v.T @ signs)
        r = left @ right
    return basis @ r


def fit(sample: np.ndarray, norm: float) -> Model:
    """The model of some vectors, given the largest norm of all."""
    rng = np.random.default_rng(20240607)
    whole = np.column_stack([sample, np.sqrt(np.maximum(norm**2 - np.einsum("ij,ij->i", sample, sample), 0))])
    parts: list[np.ndarray] = []
    while sum(p.shape[1] for p in parts) < BITS:
        parts.append(_rotation(whole, rng))
    model = Model(np.column_stack(parts)[:, :BITS], norm, 1 / np.pi, 1.0, sample)
    some = sample[:256]
    seen = hamming(model.codes(some, queries=True), model.codes(sample)).astype(np.float64).ravel() / BITS
    norms = np.linalg.norm(some, axis=1)
    angle = np.arccos(np.clip(some @ sample.T / (norms[:, None] * norm), -1, 1)).ravel()
    model.share = float((seen * angle).sum() / max((angle * angle).sum(), 1e-300))
    p = np.clip(model.share * angle, 1 / BITS, 1 - 1 / BITS)
    model.spread = max(1.0, float(np.sqrt(np.mean((seen - p) ** 2 / (p * (1 - p) / BITS)))))
    return model


# ---------------------------------------------------------------- multi-index search of a cell


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all codes of two tables of bytes."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(a.shape[1]):
        out += np.bitwise_count(a[:, i, None] ^ b[None, :, i])
    return out


def thresholds(radius: np.ndarray, substrings: int) -> np.ndarray:
    """For each radius a threshold per substring, -1 for none: their sum is radius - substrings + 1, so a code that passes all of them
    differs in more than radius bits."""
    total = radius - substrings + 1
    low, more = total // substrings, total % substrings
    return np.maximum(low[:, None] + (np.arange(substrings)[None, :] < more[:, None]), -1)


class Index:
    """Rows of a cell by the value of each 8-bit substring of their codes."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.width = -(-len(codes) // 8)

    def _balls(self, i: int, most: int) -> np.ndarray:
        """``[t + 1, value]``: bitmap of the rows whose substring lies within t bits of the value (none for t = -1)."""
        out = np.zeros((most + 2, 256, self.width), np.uint8)
        if most >= 0:
            rows = np.arange(len(self.codes))
            np.bitwise_or.at(out[1], (self.codes[:, i], rows >> 3), (128 >> (rows & 7)).astype(np.uint8))
        values = np.arange(256)
        for t in range(1, most + 1):
            out[t + 1] = out[t]
            for bit in range(8):
                out[t + 1] |= out[t][values ^ (1 << bit)]
        return out

    def probe(self, queries: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bitmap of rows for each query: a superset of all codes within its radius."""
        limits = np.minimum(thresholds(radius, queries.shape[1]), 8)
        found = np.zeros((len(queries), self.width), np.uint8)
        for i in range(queries.shape[1]):
            balls = self._balls(i, int(limits[:, i].max()))
            for at in range(0, len(queries), CHUNK):
                found[at : at + CHUNK] |= balls[limits[at : at + CHUNK, i] + 1, queries[at : at + CHUNK, i]]
        return found


def _scores(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for at in range(0, len(i), PAIRS):
        out[at : at + PAIRS] = np.einsum("ij,ij->i", q[i[at : at + PAIRS]], x[j[at : at + PAIRS]])
    return out


def search(model: Model, k: int, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row, score)`` of the ``k`` best rows of a cell for each query, by places, without the query's own."""
    codes, own = model.codes(x), model.codes(q, queries=True)
    norms = np.linalg.norm(q, axis=1)
    found = Index(codes).probe(own, radius)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), CHUNK):
        here = slice(at, at + CHUNK)
        far = np.uint16(BITS + 1)
        distance = np.where(np.unpackbits(found[here], axis=1, count=len(x)).astype(bool), hamming(own[here], codes), far)
        distance[ids[None, :] == query_ids[here, None]] = far
        inside = distance <= radius[here, None]
        first = min(FIRST, len(x))
        if first < len(x):  # the nearest codes' k-th score shrinks the radius
            near = np.argpartition(distance, first - 1, axis=1)[:, :first]
            i = np.repeat(np.arange(len(near)), first)
            score = np.where(np.take_along_axis(inside, near, axis=1), _scores(q[here], x, i, near.ravel()).reshape(near.shape), -np.inf)
            if first >= k:
                kth = -np.partition(-score, k - 1, axis=1)[:, k - 1]
                held = np.isfinite(kth)
                shrunk = radius[here].copy()
                shrunk[held] = np.minimum(shrunk[held], model.radius(norms[here][held], kth[held]))
                inside = distance <= shrunk[:, None]
                inside[i[np.isfinite(score).ravel()], near.ravel()[np.isfinite(score).ravel()]] = True
        i, j = np.nonzero(inside)
        score = _scores(q[here], x, i, j)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out.append((i[keep] + at, j[keep], score[keep]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


# ---------------------------------------------------------------- Spark


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _once(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of one row per id, in order of ids: of several the one with the largest vector."""
    order = np.argsort(ids, kind="stable")
    same = ids[order][1:] == ids[order][:-1]
    if not same.any():
        return order
    order = np.array(sorted(order.tolist(), key=lambda i: (ids[i], x[i].tolist())))
    return order[np.append(ids[order][1:] != ids[order][:-1], True)]


def nearest(vectors: DataFrame, k: int = TOP, every: int = EVERY, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of all other rows for the rows whose id ``every`` divides."""
    spark = vectors.sparkSession
    start(spark)
    x = F.col(vector_column).cast("array<double>")
    norm2 = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    finite = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), x.alias("x")).where("id is not null and x is not null and size(x) > 0").where(finite)
    rows = rows.withColumn("norm2", norm2).where("norm2 > 0")
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"), F.count_if(F.col("id") % every == 0).alias("queries"))
    common = sizes.orderBy(F.desc("n"), F.desc("dim")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None or not common["queries"]:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    rows = written(rows.where(F.size("x") == dim).select("id", "x"), "vectors")
    sample = np.array([r["x"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()])
    model = spark.sparkContext.broadcast(fit(sample, float(np.sqrt(common["norm2"]))))  # (dim + 1) x BITS and SAMPLE x dim numbers, at any size

    def first_radius(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            q = _matrix(b.column(1), dim)
            radius = np.full(len(q), BITS, np.int64)
            if len(m.sample) > k:  # one more, as the query itself may be in the sample
                best = np.concatenate([-np.partition(-(q[i : i + CHUNK] @ m.sample.T), k, axis=1)[:, k] for i in range(0, len(q), CHUNK)]) if len(q) else np.zeros(0)
                radius = m.radius(np.linalg.norm(q, axis=1), best)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(radius)], ["id", "x", "radius"])

    per_cell = max(CHUNK, min(CELL_ROWS, CELL_BYTES // (8 * dim)))
    row_blocks, query_blocks = -(-common["n"] // per_cell), -(-common["queries"] // per_cell)
    queries = rows.where(F.col("id") % every == 0).mapInArrow(first_radius, "id long, x array<double>, radius long")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = rows.select("id", "x", deal(row_blocks).alias("r"), all_of(query_blocks).alias("c"))
    right = queries.select("id", "x", "radius", all_of(row_blocks).alias("r"), deal(query_blocks).alias("c"))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        a, b = a.combine_chunks(), b.combine_chunks()
        ids, query_ids = a["id"].to_numpy(), b["id"].to_numpy()
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if len(ids) and len(query_ids):
            vectors, q = _matrix(a["x"].combine_chunks(), dim), _matrix(b["x"].combine_chunks(), dim)
            rows, asked = _once(ids, vectors), _once(query_ids, q)
            ids, vectors, query_ids, q, radius = ids[rows], vectors[rows], query_ids[asked], q[asked], b["radius"].to_numpy()[asked]
            found = search(model.value, k, ids, vectors, query_ids, q, radius)
        return pa.table({"query_id": query_ids[found[0]], "vec_id": ids[found[1]], "score": found[2]})

    best = left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(cell, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
