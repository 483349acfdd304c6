"""Quality classifier by co-training two views of a document.

* The **text view** sees the content: which telling words occur (words whose presence goes with the label, counted over all
  labelled documents) and, on logarithmic scales, the shares of capitals, digits and sign characters, word length and line repetition.
* The **metadata view** sees language, source and declared length.

Each view is a logistic regression.  In every round both are calibrated on held-out labelled rows, score *all* documents, and hand
their most certain pseudo-labels to the other view.  At the end a logistic regression over the two calibrated views, fitted on the
held-out rows, gives the score of every document.  A document is wanted if its quality label is 1 and it is not toxic.

Bounded by parameters, all for fitting only: ``sample`` labelled rows (by hash of the id), ``exchange`` pseudo-labels per view, class and
round, ``words`` telling words.  Everything else, scores included, covers all documents.

Labels without id, or without quality and not marked toxic, are ignored, a null toxic mark counts as 0, and of several labels the worst holds.
The surest pseudo-labels are those with the largest calibrated margin (0.98 at least), ties by the id's hash. Texts of any length are read whole.  Null and empty
texts are scored by what is left of them (no words); null metadata is a value of its own.  Without labels of both classes every
score is the share of wanted labels (1 without any).  Repeated rows each get a row; empty tables give empty tables; columns travel in
a struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, slices, start, table, text_buffer, text_or_empty, working_tables, written
from .decontaminate import WORDS as LETTERS_AND_DIGITS

SAMPLE, EXCHANGE, ROUNDS, TELLING = 20_000, 1_000, 3, 4_000
MIN_DOCS, MIN_Z = 5, 4.5
SURE = 0.98
HOLD_OUT = 4  # one labelled row in so many calibrates

LEVELS = 16
SIGNS = (b"|", b"!", b"#$%&*@^~", b"0123456789", bytes(range(65, 91)), b"?;:()[]{}<>/\\=+_", b"\n")
N_STATS = len(SIGNS) + 3
META = (1 << 12, 1 << 8, 64)  # sources and languages by hash, lengths by logarithm


# ---------------------------------------------------------------- features


def _level(share: np.ndarray) -> np.ndarray:
    return np.minimum(LEVELS - 1, np.log2(1 + 4096 * share).astype(np.int64))


def _stats(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text the level of every statistic, as numbers of one-hot columns."""
    size = np.maximum(1, np.diff(offsets))
    columns = []
    for signs in SIGNS:
        inside = np.zeros(256, bool)
        inside[list(signs)] = True
        total = np.concatenate([[0], np.cumsum(inside[data], dtype=np.int64)])
        columns.append(_level((total[offsets[1:]] - total[offsets[:-1]]) / size))
    columns.append(np.minimum(LEVELS - 1, (size / np.maximum(1, counts)).astype(np.int64)))
    columns.append(np.minimum(LEVELS - 1, np.log2(1 + counts).astype(np.int64)))
    breaks = np.flatnonzero(data == 10)
    repeated = np.zeros(len(size))
    for k in range(len(size)):
        text = data[offsets[k] : offsets[k + 1]].tobytes()
        lines = [x for x in text.split(b"\n") if x] if len(breaks) else []
        repeated[k] = 1 - len(set(lines)) / len(lines) if lines else 0
    columns.append(_level(repeated))
    return np.stack(columns, axis=1) + LEVELS * np.arange(N_STATS)


def _words_of(part: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_buffer(part.column(part.schema.get_field_index("text")))
    starts, ends, counts = words.spans(data, offsets)
    return data, offsets, counts, words.hashes(data, starts, ends)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each word: texts that have it, and wanted ones among them, summed per run of texts."""
    for b in batches:
        for part in slices(b):
            _, _, counts, h = _words_of(part, LETTERS_AND_DIGITS)
            ends = np.cumsum(counts)
            label = part.column(0).to_numpy(zero_copy_only=False)
            bags = [np.unique(h[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            words, at = np.unique(np.concatenate(bags), return_inverse=True)
            marks = np.repeat(label, [len(x) for x in bags])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(np.bincount(at, minlength=len(words))), pa.array(np.bincount(at, marks, len(words)).astype(np.int64))],
                ["word", "n", "good"])


def _features(shared) -> Callable:
    """Of rows ``(key, meta, text)``: key, metadata features and text features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value  # sorted hashes
        for b in batches:
            for part in slices(b):
                data, offsets, counts, h = _words_of(part, LETTERS_AND_DIGITS)
                stats = _stats(data, offsets, counts)
                at = np.searchsorted(vocabulary, h)
                known = np.flatnonzero((at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == h)) if len(vocabulary) else np.zeros(0, np.int64)
                owner = np.repeat(np.arange(len(counts)), counts)[known]
                pairs = np.unique(owner * (len(vocabulary) + 1) + at[known])
                owner, word = pairs // (len(vocabulary) + 1), pairs % (len(vocabulary) + 1) + LEVELS * N_STATS
                cut = np.searchsorted(owner, np.arange(len(counts) + 1))
                ends = cut + N_STATS * np.arange(len(cut))  # each text's statistics, then its words
                cells = np.empty(int(ends[-1]), np.int32)
                at_stats = (ends[:-1, None] + np.arange(N_STATS)).ravel()
                cells[at_stats] = stats.ravel()
                rest = np.ones(len(cells), bool)
                rest[at_stats] = False
                cells[rest] = word
                content = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cells))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), content], ["key", "meta", "content"])

    return run


def _meta(docs: DataFrame) -> Column:
    def of(name: str):
        return F.col(f"`{name}`") if name in docs.columns else F.lit(None)

    size = of("n_chars").cast("double")
    level = F.when(size.isNull() | (size < 0), 63).otherwise(F.least(F.lit(62), F.floor(4 * F.log10(size + 1)))).cast("int")
    return F.array(
        F.pmod(F.xxhash64(of("source").cast("string")), F.lit(META[0])).cast("int"),
        (F.pmod(F.xxhash64(of("lang").cast("string")), F.lit(META[1])) + META[0]).cast("int"),
        (level + META[0] + META[1]).cast("int"))


# ---------------------------------------------------------------- logistic regressions


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) for r in rows]
    return (np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)), np.repeat(np.arange(len(rows)), sizes)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: list[np.ndarray], labels: np.ndarray, width: int, steps: int = 400, decay: float = 3e-5, begin: np.ndarray | None = None) -> np.ndarray:
    """Weights (bias last) of a logistic regression over one-hot rows, by full-batch Adagrad."""
    at, owner = _flat(rows)
    w, seen = np.zeros(width + 1) if begin is None else begin.copy(), np.full(width + 1, 1e-8)
    n = max(1, len(rows))
    for _ in range(steps):
        wrong = sigmoid(np.bincount(owner, w[at], minlength=len(rows)) + w[-1]) - labels
        g = np.append(np.bincount(at, wrong[owner], minlength=width)[:width], wrong.sum()) / n
        g[:-1] += decay * w[:-1]
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def margin(rows: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    at, owner = _flat(rows)
    return np.bincount(owner, w[at], minlength=len(rows)) + w[-1] if rows else np.zeros(0)


def calibrate(x: np.ndarray, labels: np.ndarray, steps: int = 400) -> np.ndarray:
    """Slope(s) and offset that turn margins into probabilities (regression on few columns, targets drawn in a little)."""
    x = np.column_stack([x.reshape(len(labels), -1), np.ones(len(labels))])
    positive = labels.sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # damped Newton steps
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * w)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def telling_words(texts: DataFrame, share: float, limit: int) -> np.ndarray:
    """Of all words of the labelled texts, those whose presence goes with the label by MIN_Z deviations or more:
    the ``limit`` most telling ones, as sorted hashes."""
    counted = texts.select("label", "text").mapInArrow(_word_counts, "word long, n long, good long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    z = F.abs(F.col("good") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    best = counted.where(F.col("n") >= MIN_DOCS).withColumn("z", z).where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "word").limit(limit)
    return np.sort(np.array([r["word"] for r in best.select("word").collect()], np.int64).view(np.uint64))


# ---------------------------------------------------------------- rounds


def _margins(lists: pa.ListArray, w: np.ndarray) -> np.ndarray:
    """Margins of a column of one-hot rows, read as flat values and offsets."""
    offsets = lists.offsets.to_numpy()
    sums = np.concatenate([[0.0], np.cumsum(w[lists.flatten().to_numpy(zero_copy_only=False)])])
    return sums[offsets[1:] - offsets[0]] - sums[offsets[:-1] - offsets[0]] + w[-1]


def _both(batch: pa.RecordBatch, model: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated margins of the text and the metadata view."""
    (text_w, text_c), (meta_w, meta_c), _ = model
    content, meta = (batch.column(batch.schema.get_field_index(c)) for c in ("content", "meta"))
    return _margins(content, text_w) * text_c[0] + text_c[1], _margins(meta, meta_w) * meta_c[0] + meta_c[1]


def _score(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, m = _both(b, shared.value)
            score = sigmoid(np.column_stack([a, m, np.ones(len(a))]) @ shared.value[2])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigmoid(a)), pa.array(sigmoid(m)), pa.array(score)], ["row", "p_text", "p_meta", "score"])

    return run


KINDS = (("meta", 1), ("meta", 0), ("content", 1), ("content", 0))  # the view that learns, and what it is told


def _surest(shared, exchange: int) -> Callable:
    """Of a task's rows ``(hash, meta, content)``: for each of ``KINDS`` the ``exchange`` of which the other view is surest."""
    least = float(np.log(SURE / (1 - SURE)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table | None] = [None] * len(KINDS)
        for b in batches:
            text, meta = _both(b, shared.value)
            for k, ((view, value), x) in enumerate(zip(KINDS, (text, text, meta, meta), strict=True)):
                sure = x if value else -x
                at = np.flatnonzero(sure >= least)
                if not len(at):
                    continue
                t = pa.table({"kind": np.full(len(at), k, np.int32), "sure": sure[at], "hash": b.column(0).take(pa.array(at)), "features": b.column(view).take(pa.array(at))})
                t = t if held[k] is None else pa.concat_tables([held[k], t])
                if t.num_rows > exchange:
                    t = t.take(np.lexsort((t["hash"].to_numpy(), -t["sure"].to_numpy()))[:exchange])
                held[k] = t.combine_chunks()
        for t in held:
            if t is not None:
                yield from t.to_batches()

    return run


def _views(rows: list, own: list[tuple[np.ndarray, int]], width: int, view: str, held: np.ndarray, labels: np.ndarray,
           begin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A view's weights and calibration, and its calibrated margins of the held-out rows."""
    fitted = [np.array(r[view], np.int64) for r, h in zip(rows, held, strict=True) if not h]
    w = fit(fitted + [x for x, _ in own], np.concatenate([labels[~held], [y for _, y in own]]), width, 400 if begin is None else 100, begin=begin)
    x = margin([np.array(r[view], np.int64) for r, h in zip(rows, held, strict=True) if h], w)
    c = calibrate(x, labels[held])
    return w, c, x * c[0] + c[1]


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
                    exchange: int = EXCHANGE, rounds: int = ROUNDS, words: int = TELLING) -> DataFrame:
    """``(row, p_text, p_meta, score)`` for every row: the calibrated views and their combination; ``row`` is a struct of its columns.

    The rounds read a working table of features alone, which goes when the model is known; the scores are made from the documents again."""
    spark = docs.sparkSession
    start(spark)
    with working_tables(spark):
        return _scored(docs, labels, id_col, text_col, sample, exchange, rounds, words)


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, exchange: int, rounds: int, words: int) -> DataFrame:
    """The scores, read from the documents; working tables are not read again once it returns."""
    spark = docs.sparkSession
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    wanted = (labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | toxic))
              .groupBy(F.col("doc_id").cast("long").alias("wanted"))
              .agg(F.min((F.coalesce(F.col("quality") == 1, F.lit(False)) & ~toxic).cast("int")).alias("label")))
    texts = docs.select(F.struct("*").alias("row"), _meta(docs).alias("meta"), text_or_empty(text_col).alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"))
    wanted = written(wanted, "labels")
    n, good = wanted.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = good / n if n else 1.0
    vocabulary = np.zeros(0, np.uint64)
    if 0 < share < 1:
        vocabulary = telling_words(texts.join(wanted, F.col("id") == F.col("wanted")), share, words)
    # rows to fit on: at most `sample` ids, by hash
    known = written(wanted.orderBy(F.xxhash64("wanted"), "wanted").limit(sample), "labelled")
    found = _features(spark.sparkContext.broadcast(vocabulary))
    features = written(texts.select("id", "meta", "text").mapInArrow(found, "key long, meta array<int>, content array<int>"), "features")

    rows = features.join(F.broadcast(known), F.col("key") == F.col("wanted")).select("wanted", "label", "meta", "content").dropDuplicates(["wanted"])
    rows = rows.orderBy(F.xxhash64("wanted"), "wanted").collect()  # at most `sample`, some dozen numbers each
    y = np.array([r["label"] for r in rows], np.int64)
    held = np.arange(len(rows)) % HOLD_OUT == 0
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        return texts.select("row", *[F.lit(share).alias(c) for c in ("p_text", "p_meta", "score")])

    widths = {"content": LEVELS * N_STATS + len(vocabulary), "meta": sum(META)}
    given: dict[str, list] = {"content": [], "meta": []}  # pseudo-labels that a view has from the other
    unlabelled = features.join(F.broadcast(known.select("wanted")), F.col("key") == F.col("wanted"), "left_anti").select(F.xxhash64("key").alias("hash"), "meta", "content")
    text_w = meta_w = None
    for turn in range(rounds + 1):
        text_w, text_c, text_x = _views(rows, given["content"], widths["content"], "content", held, y, text_w)
        meta_w, meta_c, meta_x = _views(rows, given["meta"], widths["meta"], "meta", held, y, meta_w)
        both = calibrate(np.column_stack([text_x, meta_x]), y[held])
        model = spark.sparkContext.broadcast(((text_w, text_c), (meta_w, meta_c), both))
        if turn == rounds:
            score, row_type = _score(model), texts.schema["row"].dataType.simpleString()
            return texts.select("row", "meta", "text").mapInArrow(lambda batches: score(found(batches)), f"row {row_type}, p_text double, p_meta double, score double")
        # one pass a round: each task's surest, then the surest of all
        sure = unlabelled.mapInArrow(_surest(model, exchange), "kind int, sure double, hash long, features array<int>")
        place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("sure"), "hash"))
        for r in sure.withColumn("place", place).where(F.col("place") <= exchange).select("kind", "features").collect():
            view, value = KINDS[r["kind"]]
            given[view].append((np.array(r["features"], np.int64), value))
    raise AssertionError


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "p_text", "p_meta", "score", (F.col("score") >= 0.5).alias("keep"))
